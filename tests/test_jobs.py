"""The jobs: reruns, growing input, settings and the command line, on copies of the tables."""

import json
import os
import re
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from against_sql import DATA, same
from pyspark.sql import functions as F

from duplexa.functions.sequences import BASES, LETTERS, spelt
from duplexa.operators import scoring, search
from duplexa.plans import workload
from duplexa.plans.profiling import Profile
from jobs import gene_risk, queries, seed_screen
from duplexa.sources.files import new_folder
from jobs.common import load_settings

TABLES = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables here")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_job_equals_its_sql(spark, name):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], TABLES)
    assert before == {k: spark.conf.get(k, None) for k in before} and not spark.streams.active


def rows(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def test_gene_risk_reruns_to_the_same_files_content(spark, tmp_path):
    out = str(tmp_path / "risk")
    first = rows(gene_risk.run(spark, TABLES, out))
    assert sorted(p.name for p in Path(out).glob("chrom=*")) == [f"chrom={n}" for n in range(8)]
    # What another run left goes: the output is replaced as a whole.
    spark.createDataFrame([(1,)], "least_energy int").write.parquet(f"{out}/chrom=99")
    assert rows(gene_risk.run(spark, TABLES, out)) == first
    assert not (Path(out) / "chrom=99").exists()


def test_gene_risk_follows_its_settings(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"theta": "0.5"}))
    written = gene_risk.run(spark, TABLES, str(tmp_path / "risk"), str(path))
    assert [c for c in written.columns if c.startswith("p")] == ["p", "p_t0_5"]
    total = written.groupBy("sirna_id").agg({"p": "sum", "p_t0_5": "sum"}).toPandas()
    assert total["sum(p)"].round(5).eq(1).all() and total["sum(p_t0_5)"].round(5).eq(1).all()


def test_gene_risk_moves_met_pairs_once(spark):
    sites = spark.range(4000).selectExpr("id % 3 AS sirna_id", "id DIV 100000 AS chrom", "id AS start", "id + 21 AS end", "'A' AS strand", "-(id % 40) * 0.5D AS energy")
    features = spark.range(4).selectExpr("id DIV 100000 AS chrom", "id * 1000 AS start", "id * 1000 + 1000 AS end", "'A' AS strand", "id % 2 AS gene_id", "id AS transcript_id", "1D AS exp_value")
    targets = spark.createDataFrame([(0, 1)], "sirna_id long, target_id long")
    profile = Profile(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As with large tables, where Spark itself sends nothing.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with profile.step("risk"):
            found = gene_risk.gene_risk(sites, features, targets, {"alpha": "0.8;1.0", "gamma": "0.9", "theta": "0.85", "temperature": 37.0}).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Sites near three edges meet two features. Sites move to their bins and pairs to their transcripts; the rest are sums.
    assert len(found) == 6 and sum(r["n_sites"] for r in found) == 4000 + 3 * 20
    assert 8000 <= profile.stages["risk"]["shuffled_rows"] < 9000


def test_gene_risk_of_very_many_sirnas(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SENT_SIRNAS", 0)
    same(spark, queries.job1_gene_risk, queries.ORACLE_SQL["job1_gene_risk"], TABLES)


def test_gene_risk_leaves_out_sites_without_a_sirna(spark):
    sites = spark.createDataFrame([(1, 0, 10, 31, "A", -12.0), (None, 0, 10, 31, "A", -40.0)], "sirna_id long, chrom long, start long, `end` long, strand string, energy double")
    features = spark.createDataFrame([(0, 0, 90, "A", 5, 7, 2.0), (0, 20, 60, "A", 5, 7, 9.0), (0, 20, 60, "A", 5, 8, 2.0)], "chrom long, start long, `end` long, strand string, gene_id long, transcript_id long, exp_value double")
    targets = spark.createDataFrame([(1, 8), (2, 5)], "sirna_id long, target_id long")
    given = {"alpha": "0.8", "gamma": "0.9", "theta": "", "temperature": 37.0}
    (row,) = gene_risk.gene_risk(sites, features, targets, given).collect()
    assert tuple(row) == (0, 1, 5, 2, 2, -12.0, True, 1.0, 1.0, 1)


def found_by_hand(spark, texts, start=2, length=7):
    """Seed matches of texts by plain search, letter by letter."""
    bases = str.maketrans(LETTERS, BASES)
    wanted = {}
    for r in workload.oligos(spark, TABLES)[0].collect():
        seed = r["sequence"][start - 1 : start - 1 + length].translate(str.maketrans("ACGU", "UGCA"))[::-1]
        wanted.setdefault(seed, []).append(r["id"])
    places = {}
    for doc_id, text, lang in texts:
        target = re.sub("[^A-Za-z]", "", text or "").translate(bases)
        for at in range(len(target) - length + 1):
            for sirna in wanted.get(target[at : at + length], ()):
                places.setdefault((sirna, doc_id, lang), []).append(at + 1)
    return Counter({(*k, len(v), min(v)): 1 for k, v in places.items()})


def as_counter(frame):
    return Counter(tuple(r) for r in frame.select("sirna_id", "doc_id", "lang", "n_sites", "first_site").collect())


@pytest.fixture
def growing(spark, tmp_path):
    """A copy of the tables whose documents are a folder that holds the first of three files; and a function that adds the next."""
    tables = tmp_path / "tables"
    (tables / "documents.parquet").mkdir(parents=True)
    for name in ("part", "supplier"):
        shutil.copy(f"{TABLES}/{name}.parquet", tables)
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang")
    parts = [docs.where("doc_id % 3 = 0"), docs.where("doc_id % 3 = 1"), spark.createDataFrame([(0, "again " * 40, "de"), (-1, None, None), (-2, "", None), (None, "no id " * 30, None)], docs.schema)]
    known = []

    def add():
        n = len(known)
        parts[n].coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
        (file,) = (tmp_path / f"part{n}").glob("part-*.parquet")
        shutil.copy(file, tables / "documents.parquet" / f"file{n}.parquet")
        known.append([tuple(r) for r in parts[n].collect()])
        return [r for rows in known for r in rows]

    return str(tables), add


def test_seed_screen_takes_only_what_is_new(spark, growing, tmp_path):
    tables, add = growing
    out, checkpoint = str(tmp_path / "hits"), str(tmp_path / "checkpoint")
    run = lambda: seed_screen.run(spark, tables, out, checkpoint)
    batches = lambda: sorted(p.name for p in Path(out).glob("batch=*"))
    written = lambda: {p: p.stat().st_mtime_ns for p in Path(out).rglob("part-*")}
    texts = add()
    assert as_counter(run()) == found_by_hand(spark, texts) and batches() == ["batch=0"]
    before = written()
    assert as_counter(run()) == found_by_hand(spark, texts) and written() == before
    texts = add()
    assert as_counter(run()) == found_by_hand(spark, texts)
    assert {p: t for p, t in written().items() if p in before} == before and len(batches()) == 2
    # Rows without text or id, and a document whose second part comes later in another language's name.
    texts = add()
    assert as_counter(run()) == found_by_hand(spark, texts) and len(batches()) == 3


@pytest.mark.parametrize("sent", [10**6, 0])
def test_seed_hits_shuffle_texts_and_not_matches(spark, monkeypatch, sent):
    monkeypatch.setattr(search, "SENT_ROWS", sent)
    texts = spark.createDataFrame([(1, "gattaca tag " * 9, "de"), (1, "acgt" * 7, "de"), (1, "acgt" * 7, ""), (2, "tgca", None), (None, "g" * 40, None)], "doc_id long, text string, lang string")
    turned = lambda word: "A" + word.translate(str.maketrans(LETTERS, BASES))[::-1].translate(str.maketrans("ACGU", "UGCA")) + "GG"
    sirnas = spark.createDataFrame([("a", turned("gtacgta")), ("a", turned("gtacgta")), ("b", turned("gattaca")), ("c", turned("ggggggg"))], "id string, sequence string")
    for wobble in (False, True):
        found = seed_screen.seed_hits(texts, sirnas, seed_screen.DEFAULTS | {"seed_wobble": wobble})
        plan = found._jdf.queryExecution().executedPlan().toString()
        if sent:
            # The texts' shuffle, and that of the siRNAs' own k-mers.
            assert plan.count("Exchange hashpartitioning") == 2 and "hashpartitioning(lang" in plan
        records = texts.selectExpr("struct(doc_id, nullif(lang, '') AS lang) AS id", "text").select("id", spelt(F.col("text")).alias("sequence"))
        want = Counter((r["sirna_id"], r["target"]["doc_id"], r["target"]["lang"]) for r in search.seeds(sirnas, records, 7, 2, 8, wobble).collect())
        rows = found.collect()
        assert want and {(r["sirna_id"], r["doc_id"], r["lang"]): r["n_sites"] for r in rows} == want and len(rows) == len(want)


def test_one_batch_is_read_back_without_a_shuffle(spark, growing, tmp_path):
    tables, add = growing
    add()
    run = lambda: seed_screen.run(spark, tables, str(tmp_path / "hits"), str(tmp_path / "checkpoint"))
    assert "Exchange" not in run()._jdf.queryExecution().executedPlan().toString()
    add()
    assert "Exchange" in run()._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("sent", [10**6, 0])
def test_sirnas_of_one_seed_are_kept_beside_the_texts(spark, growing, tmp_path, monkeypatch, sent):
    tables, add = growing
    oligos, real = workload.oligos, seed_screen.seed_hits
    # Each sequence under ten ids.
    many = lambda *given: (oligos(*given)[0].selectExpr("explode(sequence(0, 9)) AS n", "*").selectExpr("concat(id, '-', n) AS id", "sequence"), None)
    refused = lambda *given: pytest.fail("pairs of siRNAs and texts are written")
    for n in range(3):
        texts = add()
        with monkeypatch.context() as m:
            m.setattr(workload, "oligos", many)
            m.setattr(seed_screen, "SENT_SIRNAS", sent, raising=False)
            # The last batch is kept by siRNA, beside those by seed; texts of all of them repeat ids.
            m.setattr(search, "SHARED", 0 if n < 2 else 10**6)
            m.setattr(seed_screen, "seed_hits", refused if n < 2 else real)
            found = as_counter(seed_screen.run(spark, tables, str(tmp_path / "hits"), str(tmp_path / "checkpoint")))
        assert found == Counter({(f"{s}-{i}", *rest): 1 for s, *rest in found_by_hand(spark, texts) for i in range(10)})
    assert 20 * spark.read.parquet(f"{tmp_path}/hits/batch=0").count() < len(found)


def test_a_batch_that_failed_is_done_over(spark, growing, tmp_path, monkeypatch):
    tables, add = growing
    texts, out, checkpoint = add(), str(tmp_path / "hits"), str(tmp_path / "checkpoint")
    real = seed_screen.seed_hits

    def failing(batch, sirnas, given):
        from pyspark.sql import functions as F

        return real(batch, sirnas, given).withColumn("n_sites", F.when(F.col("doc_id") == 30, F.raise_error(F.lit("lost"))).otherwise(F.col("n_sites")))

    monkeypatch.setattr(seed_screen, "seed_hits", failing)
    with pytest.raises(Exception, match="lost"):
        seed_screen.run(spark, tables, out, checkpoint)
    monkeypatch.setattr(seed_screen, "seed_hits", real)
    assert as_counter(seed_screen.run(spark, tables, out, checkpoint)) == found_by_hand(spark, texts)


def test_an_output_without_its_checkpoint_is_refused(spark, growing, tmp_path):
    tables, add = growing
    add()
    out = str(tmp_path / "hits")
    seed_screen.run(spark, tables, out, str(tmp_path / "checkpoint"))
    with pytest.raises(ValueError, match="another checkpoint"):
        seed_screen.run(spark, tables, out, str(tmp_path / "other"))


def test_paths_that_only_spark_can_open(spark, growing, tmp_path):
    tables, add = growing
    texts = add()
    for name in ("lineitem", "orders"):
        shutil.copy(f"{TABLES}/{name}.parquet", tables)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.jobs.link./data", f"file://{tmp_path}")
    far = "viewfs://jobs/data"
    first = gene_risk.run(spark, f"{far}/tables", f"{far}/risk")
    assert first.count() and rows(first) == rows(gene_risk.run(spark, tables, str(tmp_path / "near")))
    for _ in range(2):
        found = seed_screen.run(spark, f"{far}/tables", f"{far}/hits", f"{far}/checkpoint")
        assert as_counter(found) == found_by_hand(spark, texts)
        texts = add()


def test_settings_are_checked(spark, tmp_path):
    path = tmp_path / "s.json"
    for text, word in (('{"seeds": 1}', "unknown seeds"), ('{"seed_length": "7"}', "not a int"), ('{"seed_wobble": 1}', "not a bool")):
        path.write_text(text)
        with pytest.raises(ValueError, match=word):
            load_settings(spark, str(path), seed_screen.DEFAULTS)
    path.write_text('{"temperature": 40}')
    assert load_settings(spark, f"file://{path}", gene_risk.DEFAULTS)["temperature"] == 40
    assert new_folder(spark, "x") != new_folder(spark, "x") and new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_the_command_line_runs_a_job_and_logs_it(tmp_path):
    root = Path(__file__).resolve().parent.parent
    args = [sys.executable, "-m", "jobs.seed_screen", "--tables", TABLES, "--output", f"{tmp_path}/hits", "--checkpoint", f"{tmp_path}/checkpoint"]
    done = subprocess.run(args, cwd=root, capture_output=True, text=True, timeout=300, check=True)
    assert "read 200 texts" in done.stderr and "pairs under" in done.stderr and list(tmp_path.glob("hits/batch=0/lang=*/part-*"))
