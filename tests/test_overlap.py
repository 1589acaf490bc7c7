import random

import pytest

from duplexa.operators import overlap
from duplexa.plans.profiling import Profile

SITE = "sirna_id string, chrom string, start int, end int, strand string, energy double"
FEATURE = "chrom string, start int, end int, strand string, gene_id string, transcript_id string, exp_value double"


def pairs(spark, sites, features, **options):
    left, right = spark.createDataFrame(sites, SITE), spark.createDataFrame(features, FEATURE)
    return overlap.overlap_join(left, right, **options)


def test_touching_ends_do_not_overlap(spark):
    feature = [("c", 100, 200, "+", "g", "t", 1.0)]
    places = [(50, 100, 0), (200, 250, 0), (99, 101, 1), (199, 300, 1), (120, 130, 1), (10, 900, 1), (150, 150, 1), (100, 100, 0)]
    for start, end, n in places:
        assert pairs(spark, [("s", "c", start, end, "+", -10.0)], feature, bin_width=16).count() == n, (start, end)
    assert pairs(spark, [("s", "c", 120, 130, "-", -10.0), ("s", None, 120, 130, "+", -10.0)], feature).count() == 0


def test_binned_join_equals_all_pairs(spark):
    rnd = random.Random(5)
    sites = [("s%d" % (i % 3), rnd.choice("ab"), s := rnd.randrange(3000), s + rnd.randrange(0, 60), rnd.choice("+-"), -float(i)) for i in range(300)]
    features = [(rnd.choice("ab"), s := rnd.randrange(3000), s + rnd.choice([1, 20, 300, 2900]), rnd.choice("+-"), "g%d" % i, "t%d" % (i % 20), 1.0) for i in range(80)]
    want = sorted((s[5], f[4]) for s in sites for f in features if s[1] == f[0] and s[4] == f[3] and s[2] < f[2] and s[3] > f[1])
    for width in (1, 7, 64, 10_000):
        got = sorted((r["energy"], r["gene_id"]) for r in pairs(spark, sites, features, bin_width=width).collect())
        assert got == want, width


def test_exons_of_one_transcript_and_copies_collapse(spark):
    site = ("s", "c", 10, 40, "+", -10.0)
    features = [("c", 0, 20, "+", "g", "t", 5.0), ("c", 30, 50, "+", "g", "t", 7.0), ("c", 0, 90, "+", "h", "u", 1.0)]
    rows = overlap.intersect(spark.createDataFrame([site, site], SITE), spark.createDataFrame(features, FEATURE)).orderBy("transcript_id").collect()
    assert [(r["transcript_id"], r["trans_start"], r["exp_value"]) for r in rows] == [("t", 0, 5.0), ("u", 0, 1.0)]


def test_by_transcript_every_exon_counts(spark):
    features = [("c", 0, 20, "+", "g", "t", 5.0), ("c", 30, 50, "-", "g", "t", 7.0)]
    rows = overlap.intersect(spark.createDataFrame([("s", "t", 1, 5, "+", -10.0)], SITE), spark.createDataFrame(features, FEATURE), "tw")
    assert sorted(r["exp_value"] for r in rows.collect()) == [5.0, 7.0] and "start_trans" in rows.columns
    with pytest.raises(ValueError):
        overlap.intersect(rows, rows, "both")


def test_merge(spark):
    rows = spark.createDataFrame([("c", "+", 1, 5), ("c", "+", 2, 3), ("c", "+", 5, 8), ("c", "+", 11, 12), ("c", "-", 1, 2)], "chrom string, strand string, start int, end int")
    assert sorted(tuple(r) for r in overlap.merge_intervals(rows).collect()) == [("c", "+", 1, 8), ("c", "+", 11, 12), ("c", "-", 1, 2)]
    assert overlap.merge_intervals(rows, padding=3).count() == 2


def test_empty(spark):
    assert pairs(spark, [], []).count() == 0


@pytest.mark.parametrize("width", [1, 7, 100, 1 << 20])
def test_unions_do_not_depend_on_bins(spark, width):
    rnd = random.Random(width)
    rows = [(rnd.choice("ab"), "+", at := rnd.randrange(600), at + rnd.choice([0, 1, 5, 90])) for _ in range(120)] + [(None, "+", 1, 2), ("a", "+", None, 5)]
    frame = spark.createDataFrame(rows, "chrom string, strand string, start int, `end` int")
    for padding in (0, 3):
        want = []
        for chrom in "ab":
            for low, high in sorted((s, e) for c, _, s, e in rows if c == chrom and s is not None):
                if want and want[-1][0] == chrom and low <= want[-1][2] + padding:
                    want[-1][2] = max(want[-1][2], high)
                else:
                    want.append([chrom, low, high])
        got = overlap.merge_intervals(frame, padding, bin_width=width).collect()
        assert sorted([r["chrom"], r["start"], r["end"]] for r in got) == sorted(want)


def test_equal_intervals_that_begin_a_union_stay_together(spark):
    # Two of each: as the SQL twin leaves them in any order, one could be put into the union before.
    rows = spark.range(2000).selectExpr("0 AS chrom", "'+' AS strand", "id DIV 2 * 40 AS start", "id DIV 2 * 40 + 21 AS end")
    for width in (64, 1 << 20):
        got = overlap.merge_intervals(rows, 5, bin_width=width).orderBy("start").collect()
        assert [(r["start"], r["end"]) for r in got] == [(n * 40, n * 40 + 21) for n in range(1000)]


def test_merging_moves_the_rows_once(spark):
    rows = spark.range(3000).selectExpr("id % 3 AS chrom", "'+' AS strand", "id * 7 % 5000 AS start", "id * 7 % 5000 + 40 + id % 9 AS end")
    profile = Profile(spark)
    with profile.step("merge"):
        found = overlap.merge_intervals(rows, 2, bin_width=1000).count()
    # Every other shuffle moves unions within bins, or a row a bin.
    assert found < 10 and 3000 <= profile.stages["merge"]["shuffled_rows"] < 3300
