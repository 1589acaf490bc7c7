"""An inverted k-mer index of targets: postings packed by tile and bucketed by k-mer, and tiles to fetch flanks from."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.functions.energies import codes
from duplexa.functions.parameters import check_seed
from duplexa.operators import search
from duplexa.shipping import ship
from duplexa.sources import bucketed, files

#: Length of indexed k-mers, and bases kept beyond a tile's ends for seeds and their flanks.
K, CONTEXT = 6, 64
#: Bases that one bucket's postings are of, about; buckets at least.
BUCKET_BASES, BUCKETS = 1 << 20, 8
FORM = 1

TILES = "id string, offset int, low int, total int, size int, bases binary, tile long"
POSTINGS = "kmer string, id string, offset int, tile long, places array<int>"
TILE_KEY = ["id", "offset", "tile"]


def _postings(k: int):
    """Of each tile: a row for each k-mer that begins in its body, with its places there."""

    def run(batches):
        for batch in batches:
            out = {"kmer": [], "id": [], "offset": [], "tile": [], "places": []}
            for name, offset, low, size, bases, tile in zip(*(batch.column(c).to_pylist() for c in ("id", "offset", "low", "size", "bases", "tile"))):
                code = codes(bases.decode()).astype(np.int64)
                first = offset - low
                count = min(size, len(code) - k + 1 - first)
                if count <= 0:
                    continue
                views = np.lib.stride_tricks.sliding_window_view(code[first : first + count + k - 1], k)
                # Letters that pair with nothing have the code 4.
                good = np.nonzero((views < 4).all(axis=1))[0]
                keys = views[good] @ (4 ** np.arange(k - 1, -1, -1))
                order = np.argsort(keys, kind="stable")
                cuts = np.nonzero(np.diff(keys[order], prepend=-1))[0]
                for at, places in zip(cuts, np.split(good[order] + first, cuts[1:])):
                    begin = good[order[at]] + first
                    out["kmer"].append(bases[begin : begin + k].decode())
                    out["id"].append(name)
                    out["offset"].append(offset)
                    out["tile"].append(tile)
                    out["places"].append(places.astype(np.int32))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("kmer", pa.string()), ("id", pa.string()), ("offset", pa.int32()), ("tile", pa.int64()), ("places", pa.list_(pa.int32()))]))

    return run


def build(records: search.Targets, path: str, k: int = K, context: int = CONTEXT, tile_size: int = search.TILE, told: str = "") -> None:
    """Index ``records`` (id, sequence) under ``path``: tiles, postings, and at last the facts that readers need.

    A tile is read once; its postings leave the task packed, one row a k-mer, and move in
    one shuffle, ranged by bucket and tile, so that a k-mer that is very frequent is many
    rows of many tasks. '-' needs no postings: a k-mer there is the turned one on '+'.
    Records may share an id; of those that share their sequence too, one is kept. Records
    without an id are left out. Sequences are held in upper case RNA letters.
    """
    cut = search.tile_bases(records, context, tile_size).where("id IS NOT NULL")
    spark = cut.sparkSession
    ship(spark)
    cut = cut.select(F.col("id").cast("string").alias("id"), F.col("offset").cast("int").alias("offset"), F.col("low").cast("int").alias("low"), F.col("total").cast("int").alias("total"), F.col("size").cast("int").alias("size"), "bases", "tile")
    bases = cut.agg(F.sum(F.least(F.col("size"), F.col("total") - F.col("offset")).cast("long"))).first()[0] or 0
    buckets = max(BUCKETS, min(4**k, -(-bases // BUCKET_BASES)))
    dealt = cut.repartition(buckets, *TILE_KEY).dropDuplicates(TILE_KEY)
    bucketed.write(dealt, f"{path}/tiles", buckets, TILE_KEY)
    tiles = spark.read.schema(TILES).parquet(f"{path}/tiles")
    packed = tiles.mapInArrow(_postings(k), POSTINGS)
    ranged = packed.repartitionByRange(buckets, F.expr(f"pmod(hash(kmer), {buckets})"), *TILE_KEY)
    bucketed.write(ranged, f"{path}/postings", buckets, ["kmer"])
    bucketed.write_facts(spark, path, {"form": FORM, "k": k, "context": context, "buckets": buckets, "told": told})


def facts(spark: SparkSession, path: str) -> dict | None:
    """What an index says of itself; None where there is none, or none that was finished."""
    known = bucketed.read_facts(spark, path)
    return known if known and known.get("form") == FORM else None


def ensure(spark: SparkSession, records: search.Targets, target: str, path: str, k: int = K) -> str:
    """The index of a target file under ``path``, built unless one of this file as it is now, by size and time, is there."""
    about = files.status(spark, target)
    told = f"{about.getLen()} bytes of {about.getModificationTime()}"
    known = facts(spark, path)
    if not known or known["told"] != told or known["k"] != k:
        bucketed.drop_facts(spark, path)
        build(records, path, k, told=told)
    return path


def seeds(
    queries: DataFrame,
    path: str,
    length: int = K,
    start: int | None = None,
    end: int | None = None,
    wobble: bool = True,
    strands: tuple[str, ...] = ("+",),
    flank: int = 0,
) -> DataFrame:
    """The rows of ``search.seeds``, found in an index.

    siRNA k-mers meet the postings, which stay where they are: sent whole where they are
    few, else dealt to the postings' buckets; where many share a spelling (``search.crowd``)
    places are looked up first and meet them last. Only tiles with a posting found give up
    their bases, joined once for a k-mer and tile and again in their own buckets. Longer
    seeds are looked up by their first k bases and compared in the tile; shorter ones are
    looked for in all tiles.
    """
    spark = queries.sparkSession
    known = facts(spark, path)
    if not known:
        raise ValueError(f"no index in {path}")
    k, buckets = known["k"], known["buckets"]
    if length + flank > known["context"]:
        raise ValueError(f"the index keeps {known['context']} bases beside a tile, too few for seeds of {length} with {flank} beside them")
    q = search.query_kmers(queries, length, start, end, wobble, strands)
    tiles = bucketed.read(spark, f"{path}/tiles", TILES, buckets, TILE_KEY)
    if length < k:
        return search.scan(q, tiles, length, flank, strands)
    postings = bucketed.read(spark, f"{path}/postings", POSTINGS, buckets, ["kmer"])
    sent = search.sent_whole(q)
    if not sent and (tasks := search.crowd(q)):
        asked = q.select(F.substring("kmer", 1, k).alias("kmer"))
        places = postings.join(asked.distinct(), "kmer", "left_semi").drop("kmer").join(tiles, TILE_KEY).withColumn("at", F.explode("places")).drop("places")
        # A place near a record's end may be too short for a longer seed, and then meets none.
        places = places.withColumn("kmer", search.piece(F.col("at"), F.lit(length)))
        return search.meet(places, q, length, flank, strands, tasks)
    q = q.withColumn("seed", F.col("kmer")).withColumn("kmer", F.substring("kmer", 1, k))
    hits = postings.join(F.broadcast(q) if sent else q, "kmer").drop("kmer")
    hits = hits.join(tiles, TILE_KEY).withColumn("at", F.explode("places")).drop("places")
    if length > k:
        hits = hits.where(search.piece(F.col("at"), F.lit(length)) == F.col("seed"))
    return search.around(hits, length, flank)


def find(
    queries: DataFrame,
    path: str,
    seed_length: int = K,
    max_extension: int = 20,
    energy_threshold: float = -10.0,
    seed_start: int | None = None,
    seed_end: int | None = None,
    seed_wobble: bool = True,
    matrix: str = "t04",
    strands: tuple[str, ...] = ("+", "-"),
) -> DataFrame:
    """``search.search`` in an index."""
    check_seed(seed_start, seed_end, seed_length, matrix)
    found = seeds(queries, path, seed_length, seed_start, seed_end, seed_wobble, strands, flank=max_extension)
    return search.extend(found, seed_length, max_extension, energy_threshold, matrix)
