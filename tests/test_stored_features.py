"""Stored annotation against the plain joins, and what its plans move."""

import random

import pytest

from duplexa import api
from duplexa.operators import overlap, stored_features

SITES = "sirna_id string, chrom string, start int, end int, strand string, energy double"
FEATURES = "chrom string, start int, end int, strand string, gene_id string, transcript_id string, exp_value float"


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(5)
    lengths = [0, 1, 30, 900, 5_000, 70_000, 5_000_000]
    features = []
    for n in range(700):
        start = rng.randrange(0, 300_000)
        features.append((rng.choice(["1", "2", None]), start, start + rng.choice(lengths), rng.choice("+-"), f"g{n % 90}", f"t{n % 150}", n / 7))
    features += [("1", 1000, 1200, "+", "hot", f"h{n}", 1.0) for n in range(200)] + [("1", None, 5, "+", "x", "x", None), ("1", 9, None, "+", "x", "x", None)]
    sites = [(f"s{n % 9}", rng.choice(["1", "2", "3", None]), s, s + rng.choice([0, 1, 20, 3000]), rng.choice("+-"), -10.0 - n % 30) for n, s in enumerate(rng.randrange(0, 310_000) for _ in range(500))]
    sites += [("s1", "1", 1100, 1121, "+", -20.0), ("s1", "t5", 3, 24, "-", -11.0)]
    path = str(tmp_path_factory.mktemp("stored") / "f")
    frame = spark.createDataFrame(features, FEATURES)
    stored_features.store(frame, path, bin_width=256)
    return spark.createDataFrame(sites, SITES), frame, path


def rows(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


@pytest.mark.parametrize("mode", ["gw", "tw"])
def test_the_rows_are_those_of_the_plain_join(made, mode):
    sites, features, path = made
    want = rows(overlap.intersect(sites, features, mode))
    assert want and rows(stored_features.intersect(sites, path, mode)) == want
    assert rows(stored_features.features(sites.sparkSession, path)) == rows(features)
    with pytest.raises(ValueError, match="gw or tw"):
        stored_features.intersect(sites, path, "xx")


def test_stored_features_are_not_shuffled_and_need_no_action(spark, made):
    sites, features, path = made
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    tag = "stored-features-test"
    spark.addTag(tag)
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        stored, plain = stored_features.overlap_join(sites, path), overlap.overlap_join(sites, features)
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in (stored, plain)]
    finally:
        spark.removeTag(tag)
        for k, v in before.items():
            spark.conf.set(k, v)
    # One side moves, the sites; without the store both do.
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 2] and "Bucketed: true" in plans[0]


def test_an_empty_annotation(spark, made, tmp_path):
    sites, features, _ = made
    stored_features.store(features.limit(0), str(tmp_path / "f"))
    assert stored_features.intersect(sites, str(tmp_path / "f")).count() == 0
    with pytest.raises(ValueError, match="no stored"):
        stored_features.overlap_join(sites, str(tmp_path / "g"))


def test_runs_take_what_was_prepared(spark, tmp_path):
    gtf = 'chr1\tt\texon\t1\t100\t.\t+\t0\tgene_id "g1"; transcript_id "t1"; RPKM "600";\nchr1\tt\texon\t150\t300\t.\t+\t0\tgene_id "g2"; transcript_id "t2"; RPKM "100";\n'
    (tmp_path / "a.gtf").write_text(gtf)
    (tmp_path / "s.out").write_text("s1\t1\t21\tchr1\t10\t30\t+\t-28.35\ns1\t1\t21\tchr1\t200\t220\t+\t-28.85\n")
    path = api.prepare(spark, str(tmp_path / "a.gtf"), str(tmp_path / "stored"))
    plain, stored = (api.off_targets(spark, str(tmp_path / "s.out"), gtf_file=f) for f in (str(tmp_path / "a.gtf"), path))
    assert rows(plain.sites) == rows(stored.sites) and rows(plain.sums) == rows(stored.sums)
    # Prepared anew, it is replaced.
    (tmp_path / "a.gtf").write_text(gtf.splitlines()[0] + "\n")
    api.prepare(spark, str(tmp_path / "a.gtf"), path)
    assert [r["transcript_id"] for r in api.off_targets(spark, str(tmp_path / "s.out"), gtf_file=path).sites.collect()] == ["t1"]
