"""Sums of arriving files against one run over all of them."""

import random

import pytest

from duplexa.functions.parameters import Config, sweep
from duplexa.operators import overlap, scoring
from duplexa.sources import predictions
from duplexa.streaming import folder

FEATURES = "chrom string, start int, end int, strand string, gene_id string, transcript_id string, exp_value double"


def line(rng):
    start = rng.randrange(0, 3000)
    return f"s{rng.randrange(4)}\t1\t21\tchr{rng.randrange(2)}\t{start}\t{start + 20}\t{rng.choice('+-')}\t{-10 - rng.randrange(200) / 10}"


@pytest.mark.parametrize("annotated", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_sums_equal_the_batch_run_in_any_order_of_files(spark, tmp_path, annotated, seed):
    rng = random.Random(seed)
    lines = [line(rng) for _ in range(160)]
    # Every siRNA is in most files, and some predictions are in several.
    files = [[*rng.sample(lines, 40), *lines[n::6]] for n in range(6)]
    features = None
    if annotated:
        rows = [(f"chr{rng.randrange(2)}", s, s + rng.randrange(50, 900), rng.choice("+-"), f"g{n % 7}", f"t{n % 11}", 1.0 + n % 5) for n, s in enumerate(rng.sample(range(2800), 60))]
        features = spark.createDataFrame(rows, FEATURES)
    configs = sweep(theta="0.85")
    rng.shuffle(files)
    for some in (files[:2], files[2:3], files[3:]):
        for n, content in enumerate(some):
            (tmp_path / "in").mkdir(exist_ok=True)
            (tmp_path / "in" / f"{rng.randrange(10**9)}-{n}.tsv").write_text("\n".join(content) + "\n")
        query = folder.sum_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), features, configs, files_each=2)
        assert query.awaitTermination(120)
    got = folder.arrived(spark, str(tmp_path / "out"), configs)
    sites = predictions.read_predictions(spark, str(tmp_path / "in"))
    if annotated:
        sites = overlap.intersect(sites, features)
    want = scoring.score_by_sirna(sites, configs)
    a, b = ({r["sirna_id"]: r.asDict() for r in x.sums.collect()} for x in (got, want))
    assert a.keys() == b.keys() and len(a) == 4
    for sirna, sums in b.items():
        assert a[sirna] == {k: pytest.approx(v, rel=1e-12) if k != "sirna_id" else v for k, v in sums.items()}
    names = [c for c in want.sites.columns if not c.startswith("P_off")]
    key = lambda r: tuple(map(repr, (r[c] for c in names)))
    a, b = (sorted((key(r), r["P_off_target"], r["P_off_target:theta=0.85"]) for r in x.sites.collect()) for x in (got, want))
    assert [x[0] for x in a] == [x[0] for x in b] and all(x[1:] == pytest.approx(y[1:], rel=1e-12) for x, y in zip(a, b))


def test_clamps_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="clamped"):
        folder.sum_arrivals(spark, str(tmp_path), str(tmp_path / "o"), str(tmp_path / "c"), configs=[Config(0.8, 0.9)])
