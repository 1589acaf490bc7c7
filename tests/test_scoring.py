import math

import pytest

from duplexa.functions.parameters import Config, check_seed, seed_spec, sweep, thermal_energy
from duplexa.operators import accessibility, scoring
from duplexa.plans import reports

SCHEMA = "sirna_id string, chrom string, start int, end int, strand string, gene_id string, transcript_id string, energy double, exp_value double, opening_energy double"
RT = thermal_energy()
ROWS = [
    ("s1", "c", 1, 21, "+", "g5", "t5", -30.0, 600.0, 1.65),
    ("s1", "c", 5, 25, "+", "g6", "t6", -30.0, 100.0, 1.15),
    ("s2", "c", 9, 29, "+", "g6", "t7", -20.0, 10.0, 0.0),
    ("s2", "c", 9, 29, "+", "g8", "t8", -25.0, 0.0, 2.0),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def boltzmann(energy, expression=1.0, rt=RT):
    return expression * math.exp(-energy / rt)


def test_probabilities_within_a_sirna(rows):
    got = {(r["sirna_id"], r["transcript_id"]): r["P_off_target"] for r in scoring.score_by_sirna(rows).sites.collect()}
    assert got["s1", "t5"] == pytest.approx(0.727, abs=1e-3) and got["s1", "t6"] == pytest.approx(0.273, abs=1e-3)
    assert got["s2", "t7"] == pytest.approx(1.0) and got["s2", "t8"] == 0.0


def test_the_clamp_is_strict_and_anchored_at_the_raw_minimum(spark):
    base = [("s", "c", 1, 2, "+", "g", f"t{e}", float(e), 1.0, 0.0) for e in (-20, -18, -16)]
    config = Config(0.8, 0.9)
    z = scoring.score_by_sirna(spark.createDataFrame(base, SCHEMA), [config]).sums.first()[f"Z_sirna{config.suffix}"]
    # -16 is 0.8 times the minimum and stays.
    assert z == pytest.approx(2 * boltzmann(-18.0) + boltzmann(-16.0))
    raw = spark.createDataFrame([(*b, -30.0) for b in base], SCHEMA + ", raw_e_min double")
    z = scoring.score_by_sirna(raw, [config]).sums.first()[f"Z_sirna{config.suffix}"]
    assert z == pytest.approx(sum(boltzmann(e) for e in (-20.0, -18.0, -16.0)))


def test_theta_and_sweep_order(rows):
    configs = sweep("1.0;0.8", "0.9", "0.85;1.0")
    assert [c.suffix for c in configs] == ["", ":theta=0.85", ":theta=1.0", ":alpha=0.8,gamma=0.9"]
    sums = {r["sirna_id"]: r for r in scoring.score_by_sirna(rows, configs).sums.collect()}
    assert sums["s2"]["Z_sirna:theta=0.85"] == pytest.approx(boltzmann(0.85 * -10 - 10, 10.0))
    assert sums["s1"]["Z_sirna:theta=1.0"] == pytest.approx(sums["s1"]["Z_sirna"])


def test_on_targets_by_transcript_or_gene(spark, rows):
    targets = spark.createDataFrame([("s1", "g5"), ("s2", "none")], "sirna_id string, target_id string")
    scored = scoring.score_by_sirna(rows, on_targets=targets)
    assert sorted((r["transcript_id"], r["is_on_target"]) for r in scored.sites.collect()) == [("t5", True), ("t6", False), ("t7", False), ("t8", False)]
    by = {r["sirna_id"]: r for r in scoring.summary(scored.sums, [Config()]).collect()}
    assert by["s1"]["P"] == pytest.approx(0.727, abs=1e-3) and by["s2"]["P"] == 0.0
    text = reports.summary_text("s1", scored.sums.where("sirna_id = 's1'").first().asDict(), [Config()])
    assert text.startswith("# On-target info for s1 #\n# For alpha=1.0 and gamma=1.0; P: 0.72") and "Zoff_noacc: " in text


def test_external_on_target_replaces_tagged_rows(spark, rows):
    targets = spark.createDataFrame([("s1", "t5")], "sirna_id string, target_id string")
    outside = spark.createDataFrame([("s1", -31.0, 1.0, 1000.0)], "sirna_id string, energy double, opening_energy double, expression double")
    scored = scoring.score_by_sirna(rows, on_targets=targets, external=outside)
    assert "t5" not in [r["transcript_id"] for r in scored.sites.collect()]
    row = scored.sums.where("sirna_id = 's1'").first()
    assert row["Z_sirna"] == pytest.approx(boltzmann(-28.85, 100.0) + boltzmann(-30.0, 1000.0))
    assert row["W_on"] == pytest.approx(boltzmann(-30.0, 1000.0))


def test_one_partition_function_with_an_appended_row(rows):
    scored, totals = scoring.score_together(rows, on_target={"energy": -30.0, "expression": 50.0, "start": 3, "end": 23, "strand": "+"})
    got = scored.collect()
    assert len(got) == 5 and sum(r["P_off_target"] for r in got) == pytest.approx(1.0)
    assert [r["start"] for r in got if r["transcript_id"] == "onTarget"] == [3]
    assert totals.first()["w_on_target"] == pytest.approx(boltzmann(-30.0, 50.0))


def test_temperature_flattens(rows):
    cold, hot = ({r["transcript_id"]: r["P_off_target"] for r in scoring.score_by_sirna(rows, temperature=t).sites.collect()} for t in (37.0, 60.0))
    assert abs(cold["t5"] - cold["t6"]) < abs(hot["t5"] - hot["t6"]) or cold["t6"] != hot["t6"]


def test_transcripts_and_legacy_lines(rows):
    configs = [Config(), Config(0.8, 0.8)]
    by, totals = scoring.transcript_probabilities(rows, configs)
    assert by.count() == 4
    lines = list(reports.legacy_report("x", by, totals, configs, detailed=True))
    assert lines[0] == "# On-target info for x #" and "Z: 1000;" in lines[1] and lines[-1] == "## End of off-target info"
    assert len(lines) == 4 + 2 + 4 + 1


def test_no_sites(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scoring.score_by_sirna(empty).sites.count() == 0 and scoring.score_together(empty)[0].count() == 0


def test_seeds_and_checks():
    assert seed_spec("7") == (None, None, 7) and seed_spec("2:8/6") == (2, 8, 6) and seed_spec(" 2:8 ") == (2, 8, 7)
    for bad in ("", "a", "2:", "2:8/"):
        with pytest.raises(ValueError):
            seed_spec(bad)
    for bad in ((1, None, 6, "t04"), (0, 5, 5, "t04"), (3, 2, 1, "t04"), (2, 8, 8, "t04"), (None, None, 6, "t05")):
        with pytest.raises(ValueError):
            check_seed(*bad)


def test_opening_energy_bounds_and_rounding(spark):
    profile = spark.createDataFrame(
        [("c", "+", 1, [0.05, 0.35]), ("c", "+", 2, [0.45, 0.25]), ("c", "+", 4, [1.0, 2.04]), ("c", "-", 3, [7.0, 8.0])],
        "chrom string, strand string, position int, u array<float>",
    )
    places = [("a", "c", 1, 1, "+"), ("b", "c", 1, 2, "+"), ("c", "c", 3, 3, "+"), ("d", "c", 3, 9, "+"), ("e", "c", 3, 9, "-"), ("f", "x", 1, 2, "+"), ("g", "c", 1, 4, "+"), ("h", "c", 0, 0, "+"), ("i", "c", 2, 2, "+")]
    sites = spark.createDataFrame(places, "k string, chrom string, start int, end int, strand string")
    got = {r["k"]: r["opening_energy"] for r in accessibility.opening_energy(sites, profile).collect()}
    # Halves go to even, in single precision; absent places are 25.5, which rounds to itself; outside is 10.
    assert got == {"a": 0.0, "b": 0.2, "c": 25.5, "d": 10.0, "e": 10.0, "f": 10.0, "g": 2.0, "h": 10.0, "i": 0.4}


def test_compact_output(rows, tmp_path, spark):
    scored = reports.without_intermediates(scoring.score_by_sirna(rows).sites)
    assert "E_min" not in scored.columns
    reports.write_sites(scored, str(tmp_path / "x"), "parquet")
    assert dict(spark.read.parquet(str(tmp_path / "x")).dtypes)["P_off_target"] == "float"
    reports.write_sites(scored, str(tmp_path / "y"), "tsv", ranked=True)
    assert spark.read.csv(str(tmp_path / "y"), sep="\t", header=True).count() == 4
    reports.write_summaries(scoring.score_by_sirna(rows).sums, [Config()], str(tmp_path / "z"))
    assert spark.read.text(str(tmp_path / "z")).where("value like '# On-target%'").count() == 2
