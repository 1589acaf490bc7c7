import json
import math
import re

import pytest
from pyspark.sql import functions as F

from duplexa import __main__ as cli
from duplexa import api, config
from duplexa.functions.parameters import Config
from duplexa.plans import orchestration
from duplexa.plans.profiling import Profile
from duplexa.streaming import folder

GTF = 'chr1\tt\texon\t1\t100\t.\t+\t0\tgene_id "g1"; transcript_id "t1"; RPKM "600";\nchr1\tt\texon\t150\t300\t.\t+\t0\tgene_id "g2"; transcript_id "t2"; RPKM "100";\n'
SITES = "s1\t1\t21\tchr1\t10\t30\t+\t-28.35\ns1\t1\t21\tchr1\t200\t220\t+\t-28.85\ns1\t1\t21\tchr1\t200\t220\t-\t-40\n"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s1.out").write_text(SITES)
    return tmp_path


def test_off_targets_of_a_file_and_a_folder(spark, files):
    one = api.off_targets(spark, str(files / "in" / "s1.out"), gtf_file=str(files / "a.gtf"), sense_only=True)
    got = {r["transcript_id"]: r["P_off_target"] for r in one.sites.collect()}
    assert got == {"t1": pytest.approx(0.727, abs=1e-3), "t2": pytest.approx(0.273, abs=1e-3)}
    assert one.summary.count() == 1
    many = api.off_targets(spark, str(files / "in"), gtf_file=str(files / "a.gtf"), alpha="0.8", gamma="0.9")
    assert many.sites.first()["E_min"] == -40.0 and len(many.configs) == 2


def test_bad_input(spark, files):
    with pytest.raises(ValueError):
        api.off_targets(spark)
    with pytest.raises(ValueError):
        api.off_targets(spark, sirna_fasta="x.fa")
    with pytest.raises(FileNotFoundError):
        api.off_targets(spark, str(files / "missing"))


def test_every_missing_input_is_told(spark, files):
    sites, none = str(files / "in" / "s1.out"), str(files / "none")
    for given in (
        {"gtf_file": none + ".gtf"},
        {"accessibility_dir": none},
        {"genome_file": none},
        {"on_target_ids_file": none},
        {"on_target_predictions": none},
        {"precomputed_accessibility": none},
    ):
        with pytest.raises(FileNotFoundError):
            api.off_targets(spark, sites, **given)
    for call in (lambda: api.search(spark, none, none), lambda: api.search(spark, none, index=none), lambda: api.index(spark, none), lambda: api.accessibility(spark, none)):
        with pytest.raises(FileNotFoundError):
            call()


def test_clamps_anchored_at_self_energies(spark, files):
    (files / "s.fa").write_text(">s1\nGGCAUCGAUCGGAUUACGCAU\n")
    plain = api.off_targets(spark, str(files / "in"), gtf_file=str(files / "a.gtf"), alpha="0.8", gamma="0.9").sums.first()
    own = api.off_targets(spark, str(files / "in"), sirna_fasta=str(files / "s.fa"), gtf_file=str(files / "a.gtf"), alpha="0.8", gamma="0.9").sums.first()
    from duplexa.operators.search import self_energies
    from duplexa.sources.fasta import read_sirnas

    least = self_energies(read_sirnas(spark, str(files / "s.fa"))).first()["e_min"]
    assert plain["E_min"] == -40.0 and own["E_min"] == pytest.approx(least, abs=1e-3) != -40.0
    single = api.off_targets(spark, str(files / "in" / "s1.out"), sirna_fasta=str(files / "s.fa"), gtf_file=str(files / "a.gtf")).sums.first()
    assert single["E_min"] == pytest.approx(-28.85, abs=1e-3)


def test_energies_given_by_place(spark, files):
    spark.createDataFrame([("chr1", 10, 30, "+", 2.5)], 'chrom string, start int, `end` int, strand string, opening_energy double').write.parquet(str(files / "given"))
    sites = api.off_targets(spark, str(files / "in" / "s1.out"), gtf_file=str(files / "a.gtf"), precomputed_accessibility=str(files / "given")).sites
    assert sorted((r["start"], r["opening_energy"]) for r in sites.collect()) == [(10, 2.5), (200, 10.0)]


def test_an_index_is_used_again_until_its_target_changes(spark, files):
    import os

    (files / "g.fa").write_text(">chr1\nACGTACGT\n")
    where = api.index(spark, str(files / "g.fa"), str(files / "i"))
    made = lambda: (files / "i" / "facts" / "_SUCCESS").stat().st_mtime_ns
    ids = lambda: {r["id"] for r in spark.read.parquet(f"{where}/tiles").collect()}
    written = made()
    assert api.index(spark, str(files / "g.fa"), where) == where and made() == written and ids() == {"chr1"}
    (files / "g.fa").write_text(">chr2\nACGTACGG\n")
    later = written / 1e9 + 10
    os.utime(files / "g.fa", (later, later))
    assert api.index(spark, str(files / "g.fa"), where) == where and made() != written and ids() == {"chr2"}
    # Another k-mer length is another index; one that was never finished is none.
    before = made()
    assert api.index(spark, str(files / "g.fa"), where, k=5) == where and made() != before
    (files / "i" / "facts" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="no index"):
        (files / "s.fa").write_text(">s\nGGCAUCGAUCGGAUUACGCAU\n")
        api.search(spark, str(files / "s.fa"), index=where)


def test_search_prints_all_hits(spark, files, capsys):
    (files / "s.fa").write_text(">s\nGGCAUCGAUCGGAUUACGCAU\n")
    (files / "g.fa").write_text("".join(f">c{n}\nAAAAATGCGTAATCCGATCGATGCCAAAAA\n" for n in range(40)))
    cli.run(spark, "search", {"query": str(files / "s.fa"), "target": str(files / "g.fa"), "energy_threshold": -30.0})
    out = capsys.readouterr().out.splitlines()
    assert out[0].startswith("sirna_id\t") and len({x.split("\t")[3] for x in out[1:]}) == 40


def test_search_index_and_accessibility(spark, files):
    (files / "s.fa").write_text(">s\nGGCAUCGAUCGGAUUACGCAU\n")
    (files / "g.fa").write_text(">chr1\n" + "A" * 30 + "ATGCGTAATCCGATCGATGCC" + "A" * 30 + "\n")
    where = api.index(spark, str(files / "g.fa"))
    assert where.endswith("g.idx")
    hits = api.search(spark, str(files / "s.fa"), index=where, seed_length="2:8/7", energy_threshold=-20.0)
    assert hits.count() >= 1 and hits.first()["chrom"] == "chr1"
    folded = api.accessibility(spark, str(files / "g.fa"), 20, 15, 5, output=str(files / "acc"))
    assert folded.count() == 2 * 81
    scored = api.off_targets(spark, sirna_fasta=str(files / "s.fa"), target_fasta=str(files / "g.fa"), accessibility_dir=str(files / "acc"))
    assert scored.sites.where("opening_energy is null").count() == 0
    on = api.off_targets(
        spark, sirna_fasta=str(files / "s.fa"), target_index=where, on_target_file=str(files / "g.fa"), query_file=str(files / "s.fa"), window_size=20, max_span=15, unpaired_prob=25
    )
    row = on.sums.first()
    assert 0 < row["W_on"] < row["Z_sirna"]


def test_command_line_from_a_description(spark, files):
    (files / "run.json").write_text(json.dumps({"command": "off-targets", "predictions_file": "in/s1.out", "gtf_file": "a.gtf", "output_file": "out", "theta": "0.85"}))
    command, options = config.load(str(files / "run.json"))
    assert command == "off-targets" and options["gtf_file"] == str(files / "a.gtf")
    cli.run(spark, command, options)
    assert spark.read.csv(str(files / "out"), sep="\t", header=True).count() == 2
    assert spark.read.text(str(files / "out.summaries")).where("value like '# For theta=0.85%'").count() == 1
    (files / "bad.json").write_text(json.dumps({"command": "off-targets", "nonsense": 1}))
    with pytest.raises(ValueError, match="nonsense"):
        config.load(str(files / "bad.json"))


def test_files_are_scored_as_they_arrive(spark, files):
    for _ in range(2):
        query = folder.score_arrivals(spark, str(files / "in"), str(files / "out"), str(files / "state"), configs=[Config()])
        assert query.awaitTermination(60)
        (files / "in" / "s2.out").write_text(SITES.replace("s1", "s2"))
    sums = spark.read.parquet(str(files / "out" / "sums"))
    assert sorted(r["sirna_id"] for r in sums.collect()) == ["s1", "s2"]


def test_older_report_and_profile(spark, files, capsys):
    given = {"predictions_file": str(files / "in" / "s1.out"), "gtf_file": str(files / "a.gtf")}
    cli.run(spark, "off-targets", given | {"detailed_report": True, "profile": True})
    out = capsys.readouterr().out
    assert "# On-target info for siRNA #" in out and "chr1\tt1\t" in out and "plan" in out


def test_older_report_with_an_on_target(spark, files, capsys):
    (files / "on.out").write_text("x 1 21 onTarget 5 25 + -33.0\nx 1 21 onTarget 9 29 + -20.0\n")
    (files / "target.tsv").write_text("s1\tt1\n")
    given = {"predictions_file": str(files / "in" / "s1.out"), "gtf_file": str(files / "a.gtf"), "on_target_predictions": str(files / "on.out")}
    given |= {"query_file": str(files / "my_sirna.fa"), "on_target_ids_file": str(files / "target.tsv"), "detailed_report": True}
    cli.run(spark, "off-targets", dict(given))
    out = capsys.readouterr().out
    # The on-target's own weight, and every transcript, the tagged one too.
    rt = 0.001987 * 310.15
    on, off = 1000 * math.exp(33 / rt), 600 * math.exp(28.35 / rt) + 100 * math.exp(28.85 / rt)
    pon = float(re.search(r"Pon: ([-+.e\d]+)", out)[1])
    assert "my_sirna" in out and "chr1\tt1\t" in out and "chr1\tt2\t" in out and pon == pytest.approx(on / (on + off), rel=1e-4)
    cli.run(spark, "off-targets", given | {"output_file": str(files / "old")})
    assert (files / "old.results").read_text() == out
    assert spark.read.csv(str(files / "old.detailed_results"), sep="\t", header=True).count() >= 1


def test_steps_and_rows_are_watched(spark):
    profile = Profile()
    with profile.step("count"):
        assert profile.rows("all", spark.range(7)).collect()
    assert profile.as_dict()["rows"] == {"all": 7} and "count" in profile.table()


def test_steps_tell_what_spark_measured(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    spark.range(5000).repartition(3).write.parquet(str(tmp_path / "in"))
    profile = Profile(spark)
    with profile.step("sum"):
        spark.read.parquet(str(tmp_path / "in")).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*")).collect()
    with profile.step("write"):
        spark.read.parquet(str(tmp_path / "in")).where("id < 40").write.parquet(str(tmp_path / "out"))
    with profile.step("nothing"):
        pass
    got = profile.stages
    assert got["sum"]["rows_in"] == 5000 and 10 <= got["sum"]["shuffled_rows"] <= 40 and got["sum"]["tasks"] >= 2 and got["sum"]["execution_memory"] > 0
    assert got["write"]["rows_out"] == 40 and got["write"]["bytes_out"] > 0 and got["nothing"]["jobs"] == 0 and not got["sum"]["forgotten"]
    assert "MB spilled" in profile.table() and profile.as_dict()["stages"]["sum"]["jobs"] >= 1
    # Outside of a step nothing is counted, nor is what another thread runs.
    before = dict(got["sum"])
    spark.range(9).count()
    with profile.step("alone"), ThreadPoolExecutor(1) as pool:
        pool.submit(lambda: spark.range(9).count()).result()
    assert profile.stages["sum"] == before and profile.stages["alone"]["jobs"] == 0


def test_a_whole_run(spark, files):
    (files / "s.fa").write_text(">s\nGGCAUCGAUCGGAUUACGCAU\n")
    (files / "g.fa").write_text(">chr1\n" + "A" * 30 + "ATGCGTAATCCGATCGATGCC" + "A" * 30 + "\n")
    jobs = orchestration.plan(str(files / "s.fa"), str(files / "g.fa"), {"all": str(files / "a.gtf")}, str(files / "run"), window_size=20, max_span=15, unpaired_prob=5)
    assert orchestration.waves(jobs) == [["accessibility", "index"], ["search"], ["off-targets:all"]]
    assert orchestration.execute(spark, jobs, dry_run=True)[-1] == "off-targets:all" and not (files / "run").exists()
    orchestration.execute(spark, jobs)
    assert spark.read.parquet(str(files / "run" / "all" / "sites")).count() >= 1
    with pytest.raises(ValueError, match="wait"):
        orchestration.waves([orchestration.Job("a", None, ["b"]), orchestration.Job("b", None, ["a"])])


def test_a_run_goes_on_where_it_was_stopped(spark, files):
    import threading

    both, seen = threading.Barrier(2, timeout=60), []

    def job(name, fails=False, meets=False):
        def run(spark):
            seen.append(name)
            if meets:
                both.wait()
            if fails:
                raise RuntimeError("stopped")
            spark.range(3).write.mode("overwrite").parquet(str(files / name))

        return run

    def jobs(fails):
        made = [orchestration.Job(n, job(n, meets=not (files / "a").exists()), output=str(files / n)) for n in "ab"]
        return [*made, orchestration.Job("c", job("c", fails), ["a", "b"], str(files / "c")), orchestration.Job("d", job("d"), ["c"], str(files / "d"))]

    # The first wave's jobs wait for each other, so they run side by side.
    with pytest.raises(RuntimeError, match="stopped"):
        orchestration.execute(spark, jobs(True))
    assert sorted(seen) == ["a", "b", "c"]
    seen.clear()
    assert orchestration.execute(spark, jobs(False), resume=True) == ["a", "b", "c", "d"] and seen == ["c", "d"]
    seen.clear()
    orchestration.execute(spark, jobs(False), resume=True)
    assert not seen and spark.read.parquet(str(files / "d")).count() == 3
    orchestration.execute(spark, jobs(False), side_by_side=1)
    assert sorted(seen) == ["a", "b", "c", "d"]


SECTIONED = """
command: off-targets
verbose: false
off_targets:
  risearch_file: in/s1.out
  transcriptome: ../{name}/a.gtf
  transcriptome_format: gtf
  feature: exon
  window: 70
  on_target_accessibility: null
  alpha: "0.8;1.0"
  gamma: 1.0
  theta: ""
  type: gw
  output: ./out/sites.tsv
  legacy_format: false
accessibility:
  fasta: g.fa
  output: ./acc
  span: 30
"""


def test_descriptions_with_sections(spark, files):
    (files / "run.yaml").write_text(SECTIONED.format(name=files.name))
    command, given = config.load(str(files / "run.yaml"))
    assert command == "off-targets" and given["gtf_file"] == str(files / "a.gtf") and given["predictions_file"] == str(files / "in" / "s1.out")
    assert given["window_size"] == 70 and given["gamma"] == "1.0" and given["predictions_type"] == "gw" and given["output_file"] == str(files / "out" / "sites.tsv")
    cli.run(spark, command, dict(given))
    written = spark.read.csv(given["output_file"], sep="\t", header=True)
    assert written.count() == 2 and "P_off_target:alpha=0.8,gamma=1.0" in written.columns
    (files / "run.yaml").write_text(SECTIONED.format(name=files.name).replace("command: off-targets", "command: accessibility"))
    assert config.load(str(files / "run.yaml")) == ("accessibility", {"genome": str(files / "g.fa"), "output": str(files / "acc"), "max_span": 30})
    for text, word in (
        ("command: invalid", "unknown command"),
        ("command: off-targets\noff_targets: {}\n", "needs risearch_file"),
        ("command: accessibility\naccessibility:\n  fasta: g.fa\n", "needs output"),
        ("command: off-targets\noff_targets:\n  risearch_file: x\n  colour: red\n", "unknown colour"),
        ("command: off-targets\nother: 1\noff_targets:\n  risearch_file: x\n", "unknown other"),
    ):
        (files / "bad.yaml").write_text(text)
        with pytest.raises(ValueError, match=word):
            config.load(str(files / "bad.yaml"))


def test_other_names_of_parameters(spark, files):
    (files / "on.out").write_text("x 1 21 onTarget 5 25 + -33.0\n")
    ours = api.off_targets(spark, str(files / "in" / "s1.out"), gtf_file=str(files / "a.gtf"), on_target_predictions=str(files / "on.out"))
    theirs = api.off_targets(spark, risearch_file=str(files / "in" / "s1.out"), gtf_file=str(files / "a.gtf"), on_target_risearch_file=str(files / "on.out"), n_workers=4)
    assert ours.sums.collect() == theirs.sums.collect()


def test_sites_that_name_no_sirna(spark, files):
    sites = [("chr1", 10, 30, "+", -28.35), ("chr1", 200, 220, "+", -28.85), ("chr1", 200, 220, "-", -40.0)]
    spark.createDataFrame(sites, "chrom string, start int, `end` int, strand string, energy float").write.parquet(str(files / "sites.parquet"))
    (files / "on.out").write_text("x 1 21 onTarget 5 25 + -29.0\n")
    given = {"predictions_file": str(files / "sites.parquet"), "gtf_file": str(files / "a.gtf")}
    alone = api.off_targets(spark, **given)
    assert {r["transcript_id"]: r["P_off_target"] for r in alone.sites.collect()} == {"t1": pytest.approx(0.727, abs=1e-3), "t2": pytest.approx(0.273, abs=1e-3)}
    both = api.off_targets(spark, **given, on_target_predictions=str(files / "on.out"), on_target_expression=50.0)
    rows = {r["transcript_id"]: r for r in both.sites.collect()}
    rt = 0.001987 * 310.15
    w = {"t1": 600 * math.exp(28.35 / rt), "t2": 100 * math.exp(28.85 / rt), "onTarget": 50 * math.exp(29 / rt)}
    assert {t: r["P_off_target"] for t, r in rows.items()} == {t: pytest.approx(x / sum(w.values()), rel=1e-5) for t, x in w.items()}
    assert (rows["onTarget"]["chrom"], rows["onTarget"]["start"], rows["onTarget"]["gene_id"], rows["onTarget"]["dG_total"]) == ("onTarget", 5, "onTarget", -29.0)
    assert both.summary.first()["z_total"] == pytest.approx(sum(w.values()), rel=1e-5)
    with pytest.raises(ValueError, match="name their siRNA"):
        api.off_targets(spark, **given, theta="0.9")


def test_each_sirna_has_a_summary_file(spark, files):
    for n in (2, 3):
        (files / "in" / f"s{n}.out").write_text(SITES.replace("s1", f"s/{n}"))
    (files / "target.tsv").write_text("s1\tt1\n")
    given = {"predictions_file": str(files / "in"), "gtf_file": str(files / "a.gtf"), "on_target_ids_file": str(files / "target.tsv"), "theta": "0.85", "summary_only": True}
    for _ in range(2):
        cli.run(spark, "off-targets", given | {"output_file": str(files / "out")})
    found = {p.parent.name: p for p in (files / "out.summaries").rglob("part-*")}
    assert sorted(found) == ["sirna_id=s%2F2", "sirna_id=s%2F3", "sirna_id=s1"] and not (files / "out").exists()
    rt = 0.001987 * 310.15
    on, other = 600 * math.exp(28.35 / rt), 100 * math.exp(28.85 / rt)
    lines = found["sirna_id=s1"].read_text().split("\n")
    assert lines[0] == "# On-target info for s1 #" and lines[3:] == ["## End of on-target info ##", ""]
    told = re.fullmatch(r"# For alpha=1.0 and gamma=1.0; P: (\S+); P_noacc: (\S+); Z: (\S+); Z_noacc: (\S+); Zoff: (\S+); Zoff_noacc: (\S+)", lines[1])
    want = [on / (on + other)] * 2 + [on + other] * 2 + [other] * 2
    assert [float(x) for x in told.groups()] == [pytest.approx(x, rel=1e-5) for x in want] and lines[2].startswith("# For theta=0.85; P: ")
    assert "P: 0.0; " in found["sirna_id=s%2F2"].read_text() and "for s/2 #" in found["sirna_id=s%2F2"].read_text()


def test_a_folder_s_own_files_alone_are_read(spark, files):
    (files / "in" / "more").mkdir()
    (files / "in" / "more" / "s9.out").write_text(SITES.replace("s1", "s9"))
    (files / "in" / "x=1").mkdir()
    (files / "in" / "x=1" / "s8.out").write_text(SITES.replace("s1", "s8"))
    (files / "in" / "notes.txt").write_text("no sites\n")
    assert {r["sirna_id"] for r in api.load_sites(spark, str(files / "in")).collect()} == {"s1"}
