"""The k-mer index against the plain search, and what its plans move."""

import random

import pytest

from duplexa.operators import kmer_index, search
from duplexa.plans.profiling import Profile

COLUMNS = ["sirna_id", "target", "strand", "q_start", "t_start", "total", "before", "around", "query"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(8)
    bases = lambda n: "".join(rng.choice("ACGU") for _ in range(n))
    texts = [("long", bases(900)), ("long", bases(130)), ("poly", "A" * 300 + "c" * 60), ("odd", bases(40) + "NNÄNN" + bases(40).replace("U", "t")), ("tiny", "ACGU"), ("none", ""), ("edge", bases(128))]
    records = spark.createDataFrame([*texts, (None, bases(50))], "id string, sequence string")
    queries = spark.createDataFrame([(f"s{n}", bases(21)) for n in range(6)] + [("u", "U" * 21), ("short", "ACGUA"), ("n", "ACGNNNNACGUACGU")], "id string, sequence string")
    path = str(tmp_path_factory.mktemp("index") / "i")
    kmer_index.build(records, path, tile_size=64)
    return queries, records.where("id is not null"), path


def listed(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("given", [(6, None, None, True, 20), (6, 2, 9, False, 0), (7, 2, 8, True, 30), (9, None, None, True, 12), (4, 2, 6, False, 5)])
def test_seeds_in_an_index_are_those_of_the_plain_search(made, given, sent, monkeypatch):
    queries, records, path = made
    if not sent:
        monkeypatch.setattr(search, "SENT_ROWS", 0)
    length, start, end, wobble, flank = given
    rows = listed(search.seeds(queries, records, length, start, end, wobble, ("+", "-"), flank))
    assert rows and rows == listed(kmer_index.seeds(queries, path, length, start, end, wobble, ("+", "-"), flank))
    # Around a seed stands what pairs with it, and nothing is left out but at a record's ends.
    whole = {t: s for t, s in ((r["id"], r["sequence"].upper().replace("T", "U")) for r in records.collect()) if t != "long"}
    for _, target, strand, q_start, t_start, total, before, around, query in rows:
        if target in whole and "Ä" not in whole[target]:
            text = whole[target] if strand == "+" else whole[target][::-1].translate(str.maketrans("ACGU", "UGCA"))
            assert total == len(text) and around == text[max(t_start - 1 - flank, 0) : t_start - 1 + length + flank] and before == min(flank, t_start - 1)
        seed, against = query[q_start - 1 : q_start - 1 + length], around[before : before + length][::-1]
        assert all(b in {"A": "U", "C": "G", "G": "CU" if wobble else "C", "U": "AG" if wobble else "A"}[a] for a, b in zip(seed, against))


@pytest.mark.parametrize("given", [(6, None, None, True, 20), (7, 2, 8, True, 30), (9, None, None, True, 12), (4, 2, 6, False, 5)])
def test_places_that_meet_many_sirnas_give_the_same_seeds(made, given, monkeypatch):
    queries, records, path = made
    length, start, end, wobble, flank = given
    ask = lambda: [listed(search.seeds(queries, records, length, start, end, wobble, ("+", "-"), flank)), listed(kmer_index.seeds(queries, path, length, start, end, wobble, ("+", "-"), flank))]
    plain = ask()
    monkeypatch.setattr(search, "SENT_ROWS", 0)
    monkeypatch.setattr(search, "SHARED", 0)
    assert ask() == plain and plain[0] == plain[1]


@pytest.mark.parametrize("indexed", [False, True])
def test_what_moves_follows_the_inputs_and_not_their_matches(spark, tmp_path, indexed, monkeypatch):
    monkeypatch.setattr(search, "SENT_ROWS", 0)
    records = spark.createDataFrame([(f"t{n}", "GGACGUUCAGCAUUGACC") for n in range(100)], "id string, sequence string")
    queries = spark.range(1000).selectExpr("cast(id AS string) AS id", "'AAGCUGAACAA' AS sequence")
    if indexed:
        kmer_index.build(records, str(tmp_path / "i"))
    profile = Profile(spark)
    with profile.step("seeds"):
        find = (lambda *a: kmer_index.seeds(queries, str(tmp_path / "i"), *a)) if indexed else (lambda *a: search.seeds(queries, records, *a))
        found = find(7, 3, 9, False, ("+", "-"), 4).count()
    assert found == 100 * 1000 and profile.stages["seeds"]["shuffled_rows"] < 15_000


def test_sites_found_in_an_index(made):
    queries, records, path = made
    plain = search.search(queries, records, energy_threshold=-6.0)
    assert plain.count() > 20 and sorted(plain.collect()) == sorted(kmer_index.find(queries, path, energy_threshold=-6.0).collect())


@pytest.mark.parametrize("sent", [True, False])
def test_the_target_side_is_not_shuffled(spark, made, sent, monkeypatch):
    queries, _, path = made
    if not sent:
        monkeypatch.setattr(search, "SENT_ROWS", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = kmer_index.seeds(queries, path, strands=("+", "-"), flank=20)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Tiles are read by bucket, and postings too unless the siRNAs were sent; only siRNA k-mers and hits move.
    shuffles = plan.count("Exchange hashpartitioning")
    assert shuffles == (1 if sent else 2) and plan.count("FileScan parquet") == 2
    assert plan.count("Bucketed: true") >= (1 if sent else 2)


def test_flanks_beyond_the_context_are_refused(made):
    queries, _, path = made
    with pytest.raises(ValueError, match="too few"):
        kmer_index.seeds(queries, path, 6, flank=59)
    with pytest.raises(ValueError, match="no index"):
        kmer_index.seeds(queries, path + "-none")


def test_no_table_is_left_behind(spark, made):
    queries, _, path = made
    kmer_index.seeds(queries, path).count()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("duplexa")]


def test_empty_targets_and_queries(spark, made, tmp_path):
    queries, records, path = made
    kmer_index.build(records.limit(0), str(tmp_path / "i"))
    assert kmer_index.seeds(queries, str(tmp_path / "i")).count() == 0
    assert kmer_index.seeds(queries.limit(0), path).count() == 0
