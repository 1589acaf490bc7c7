"""Profiles in blocks, the layouts they are read from, and lookups in them."""

import random

import pytest
from pyspark.sql import functions as F

from duplexa import api
from duplexa.operators import accessibility, folding
from duplexa.sources import profiles

PLACES = "chrom string, strand string, position int, u array<float>"
SITES = "k int, chrom string, start int, end int, strand string"


def looked_up(rows, site, mirror=False):
    """The energy of one site by the plain rule."""
    _, chrom, start, end, strand = site
    own = {p: u for c, s, p, u in sorted(rows, key=repr, reverse=True) if (c, s) == (chrom, strand)}
    if not own or start < 1 or end > max(own):
        return 10.0
    place = end if strand == "+" else max(own) + 1 - start if mirror else start
    width = max(len(u) for u in own.values())
    column = max(min(end - start + 1, width), 1) - 1
    if place not in own or column >= len(own[place]):
        return 25.5
    return round(own[place][column] * 10) / 10


@pytest.fixture(scope="module")
def many():
    """Profiles of several blocks: whole, with gaps, beginning late, with short rows and a block left out."""
    rng = random.Random(4)
    energies = lambda n: [rng.randrange(0, 255) / 10 for _ in range(n)]
    rows = [("c1", "+", p, energies(3)) for p in range(1, 2600)]
    rows += [("c1", "-", p, energies(3)) for p in range(1, 1500) if p % 7]
    rows += [("c2", "+", p, energies(1 if p % 5 == 0 else 4)) for p in [*range(700, 1030), *range(3000, 3100)]]
    return rows


@pytest.mark.parametrize("mirror", [False, True])
def test_lookups_equal_the_plain_rule(spark, many, mirror):
    rng = random.Random(9)
    sites = [(k, rng.choice(["c1", "c2", "c3"]), s, s + rng.randrange(-1, 8), rng.choice("+-")) for k, s in enumerate(rng.randrange(-3, 3110) for _ in range(1500))]
    sites += [(-1, "c1", 1024, 1024, "+"), (-2, "c1", 1025, 1025, "+"), (-3, "c1", 1, 1024, "+"), (-4, "c1", 2599, 2599, "+"), (-5, "c1", 2599, 2600, "+")]
    frame = spark.createDataFrame(sites, SITES)
    got = accessibility.opening_energy(frame, spark.createDataFrame(many, PLACES).repartition(5), mirror)
    assert got.columns == ["k", "chrom", "start", "end", "strand", "opening_energy"]
    assert {r["k"]: r["opening_energy"] for r in got.collect()} == {s[0]: looked_up(many, s, mirror) for s in sites}


@pytest.mark.parametrize("sent, held, join", [(1 << 30, 0, "BroadcastHashJoin"), (0, 1 << 20, "ShuffledHashJoin"), (0, 0, "SortMergeJoin")])
def test_sites_of_one_block_are_not_sorted_while_blocks_fit(spark, many, monkeypatch, sent, held, join):
    monkeypatch.setattr(accessibility, "SENT_BYTES", sent)
    monkeypatch.setattr(accessibility, "HELD", held)
    sites = [(k, "c1", k % 90 + 1, k % 90 + 3, "+") for k in range(500)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = accessibility.opening_energy(spark.createDataFrame(sites, SITES), spark.createDataFrame(many, PLACES))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert {r["k"]: r["opening_energy"] for r in got.collect()} == {s[0]: looked_up(many, s) for s in sites}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [x for x in ("BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin") for _ in range(plan.count(x + " "))]
    assert joins == sorted(["BroadcastHashJoin", join])


def test_both_ends_of_a_site_are_tested(spark):
    profile = spark.createDataFrame([("c", s, p, [1.0]) for s in "+-" for p in range(1, 51)], PLACES)
    sites = [(1, "c", 0, 20, "+"), (2, "c", -5, 20, "+"), (3, "c", 40, 60, "-"), (4, "c", 1, 50, "+"), (5, "c", 1, 50, "-"), (6, "c", 45, 51, "+"), (7, "c", 0, 3, "-"), (8, "onTarget", 1, 3, "+")]
    got = accessibility.opening_energy(spark.createDataFrame(sites, SITES), profile)
    assert {r["k"]: r["opening_energy"] for r in got.collect()} == {1: 10.0, 2: 10.0, 3: 10.0, 4: 1.0, 5: 1.0, 6: 10.0, 7: 10.0, 8: 10.0}


def test_blocks_hold_what_places_do(spark, many):
    frame = spark.createDataFrame(many, PLACES)
    blocked = profiles.blocks(frame).cache()
    assert blocked.count() == 3 + 2 + 4 and blocked.where("gaps is null").count() == 3 + 0 + 4
    assert profiles.blocks(blocked) is blocked
    back = {(r["chrom"], r["strand"], r["position"]): r["u"] for r in profiles.places(blocked).collect()}
    assert len(back) == len(many)
    for c, s, p, u in many:
        assert [round(v, 3) for v in back[c, s, p] if v is not None] == u
    # A repeated place is taken once, and rows without a place not at all.
    odd = spark.createDataFrame([("c", "+", 2, [2.0]), ("c", "+", 2, [1.0]), ("c", "+", None, [9.0]), ("c", "+", 3, None)], PLACES)
    assert [(r["position"], r["u"]) for r in profiles.places(profiles.blocks(odd)).orderBy("position").collect()] == [(2, [1.0]), (3, [None])]
    assert profiles.blocks(odd.limit(0)).count() == 0


def test_the_join_has_a_row_a_block(spark, many, tmp_path):
    profiles.write_profiles(spark.createDataFrame(many, PLACES), str(tmp_path / "p"))
    stored = profiles.read_blocks(spark, str(tmp_path / "p"))
    assert stored.count() == 9
    sites = spark.createDataFrame([(1, "c1", 5, 9, "+")], SITES)
    plan = accessibility.opening_energy(sites, stored)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Generate" not in plan


def own_files(spark, folder, rows):
    """One file a chromosome with a column for each stretch, as other tools write it."""
    folder.mkdir()
    for chrom in {r[0] for r in rows}:
        flat = [(p, s, *u) for c, s, p, u in rows if c == chrom]
        spark.createDataFrame(flat, "position int, strand string, " + ", ".join(f"u{n + 1} float" for n in range(len(flat[0]) - 2))).toPandas().to_parquet(folder / f"{chrom}.accessibility.parquet")


def test_files_named_for_their_chromosome(spark, tmp_path):
    rows = [("chr1", "+", p, [p / 10, 2.0, 3.0]) for p in range(1, 40)] + [("chr1", "-", p, [4.0, 5.0, 6.0]) for p in range(1, 40)] + [("chrUn_1.2", "+", 1, [7.0, 8.0, 9.0])]
    own_files(spark, tmp_path / "p", rows)
    assert {r["chrom"] for r in profiles.read_profiles(spark, str(tmp_path / "p")).select("chrom").distinct().collect()} == {"chr1", "chrUn_1.2"}
    (tmp_path / "sites.tsv").write_text("s1\t1\t20\tchr1\t5\t5\t+\t-12.0\ns1\t1\t20\tchr1\t30\t45\t+\t-11.0\ns2\t1\t20\tchrUn_1.2\t1\t1\t+\t-15.5\ns2\t1\t20\tchr1\t7\t8\t-\t-15.5\n")
    sites = api.off_targets(spark, str(tmp_path / "sites.tsv"), accessibility_dir=str(tmp_path / "p")).sites
    assert sorted((r["chrom"], r["start"], r["opening_energy"]) for r in sites.collect()) == [("chr1", 5, 0.5), ("chr1", 7, 5.0), ("chr1", 30, 10.0), ("chrUn_1.2", 1, 7.0)]
    own_files(spark, tmp_path / "q", [("other", "+", 1, [1.0])])
    with pytest.raises(ValueError, match="no chromosome"):
        api.off_targets(spark, str(tmp_path / "sites.tsv"), accessibility_dir=str(tmp_path / "q"))


def test_ranges_beyond_a_profile_are_errors(spark, many):
    frame = spark.createDataFrame(many, PLACES)
    for known in (frame, profiles.blocks(frame)):
        assert [r["position"] for r in accessibility.profile_range(known, "c1", "+", 1020, 1030).orderBy("position").collect()] == list(range(1020, 1031))
        for bad in (("c1", "+", 0, 5), ("c1", "+", 9, 5), ("c1", "+", 2599, 2600), ("c2", "-", 1, 2), ("c9", "+", 1, 2)):
            with pytest.raises(ValueError):
                accessibility.profile_range(known, *bad)


def test_written_profiles_are_quantised_and_read_back(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">a\n" + "ACGGUCAUUGC" * 12 + "\n")
    read = api.accessibility(spark, str(tmp_path / "g.fa"), window_size=30, max_span=20, unpaired_prob=4, output=str(tmp_path / "out"))
    made = folding.fold(spark.createDataFrame([("a", "ACGGUCAUUGC" * 12)], "id string, sequence string"), 30, 20, 4, quantised=True)
    order = lambda f: [tuple(r) for r in f.orderBy("chrom", "strand", "position").collect()]
    assert order(read) == order(made) and read.where(F.col("position") == 1).count() == 2
