"""Records read in pieces and tiles, whatever the splits of their files."""

import random
from pathlib import Path

import pytest

from duplexa.operators import folding, kmer_index, search
from duplexa.sources import fasta

COLUMNS = ["id", "offset", "low", "total", "sequence", "size"]


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(3)
    bases = lambda n: "".join(rng.choice("ACGTacgtN") for _ in range(n))

    def wrapped(text, width, end="\n"):
        return "".join(text[i : i + width] + end for i in range(0, len(text), width))

    path = tmp_path / "fa"
    path.mkdir()
    (path / "a.fa").write_text("stray\nlines\n>long one of several\n" + wrapped(bases(9_000), 61) + ">short\n" + wrapped(bases(70), 60) + "\n\n>empty\n>twice x\nACGT\n" + "".join(f">r{n}\n{bases(n)}\n" for n in range(1, 60)))
    (path / "b.fa").write_text(">wide\r\n" + wrapped(bases(2_500), 2_000, "\r\n") + ">\nNOID\n> spaced id\nAC GT\n\tAC\n>twice\nGGGG\n>last\n" + wrapped(bases(1_400), 7))
    (path / "c.fa").write_text("only stray text\n")
    return str(path)


def plainly(folder):
    """Records by reading line after line."""
    found = []
    for path in sorted(Path(folder).glob("*.fa")):
        known = None
        for line in path.read_text().splitlines():
            if line.startswith(">"):
                known = [(line[1:].split() or [""])[0], ""]
                found.append(known)
            elif known:
                known[1] += "".join(line.split())
    return [tuple(r) for r in found if r[0]]


def rows(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


@pytest.mark.parametrize("overlap, size", [(0, 100), (30, 64), (200, 50), (5, 100_000)])
def test_tiles_are_those_of_whole_records(spark, folder, small_splits, overlap, size):
    assert spark.read.text(folder).rdd.getNumPartitions() > 15
    whole = search.tile(spark.createDataFrame(plainly(folder), "id string, sequence string"), overlap, size)
    assert rows(fasta.read_tiles(spark, folder, overlap, size)) == rows(whole)


def test_pieces_are_bounded_and_cover_their_records(spark, folder, small_splits, monkeypatch):
    pieces = fasta.read_pieces(spark, folder).collect()
    records = {}
    for p in sorted(pieces, key=lambda p: p["begin"]):
        key = (p["file"], p["head"], p["id"])
        assert p["begin"] == len(records.get(key, ""))
        records[key] = records.get(key, "") + p["bases"]
    assert sorted((k[2], s) for k, s in records.items()) == sorted(plainly(folder)) and ("empty", "") in plainly(folder)
    assert sorted(map(tuple, fasta.read_fasta(spark, folder).collect())) == sorted(plainly(folder))
    assert all(p["total"] == len(records[p["file"], p["head"], p["id"]]) for p in pieces) and max(len(p["bases"]) for p in pieces) < 3_000


def test_no_file_is_told_at_once(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        fasta.tiles(spark, str(tmp_path / "none"))
    (tmp_path / "e.fa").write_text("")
    assert fasta.read_tiles(spark, str(tmp_path / "e.fa"), 3, 10).count() == 0


def test_search_fold_and_index_take_tiles(spark, folder, small_splits, tmp_path):
    queries = spark.createDataFrame([("s", "ACGUACGUUGCAUGCAACGUA"), ("t", "GGCAUUACGGAUCCAGUCAAG")], "id string, sequence string")
    records, tiles = fasta.read_fasta(spark, folder), fasta.tiles(spark, folder)
    whole = sorted(search.search(queries, records, energy_threshold=-7.0).collect())
    assert whole and whole == sorted(search.search(queries, tiles, energy_threshold=-7.0).collect())
    kmer_index.build(tiles, str(tmp_path / "i"))
    assert whole == sorted(kmer_index.find(queries, str(tmp_path / "i"), energy_threshold=-7.0).collect())
    order = lambda f: [tuple(r) for r in f.where("chrom in ('long', 'short', 'r3')").orderBy("chrom", "strand", "position").collect()]
    a, b = order(folding.fold(records, 20, 12, 3)), order(folding.fold(tiles, 20, 12, 3, tile_size=500))
    assert [x[:3] for x in a] == [x[:3] for x in b] and all(x[3] == pytest.approx(y[3], abs=1e-4) for x, y in zip(a, b))
