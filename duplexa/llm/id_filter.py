"""A filter of ids, bounded in size, that lets a scan pass over most rows which a join would drop."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest filter that is sent to the executors, in bits (16 MB); a fuller one lets more rows pass, and the join decides.
FILTER_BITS = 1 << 27
#: Bytes of the pieces in which tasks' filters are put together.
PIECE = 1 << 16
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(29))) * U64(0x9E3779B97F4A7C15)
    return x ^ (x >> U64(32))


def _places(ids: np.ndarray, size: int):
    x = mix(ids.astype(np.int64).view(U64))
    for shift in (0, 32):
        at = (x >> U64(shift)) % U64(size)
        yield (at >> U64(3)).astype(np.int64), (at & U64(7)).astype(np.uint8)


def passing(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter; all that are in it are among them."""
    hit = np.ones(len(ids), bool)
    for byte, bit in _places(ids, 8 * len(bits)):
        hit &= (bits[byte] >> bit & 1) > 0
    return hit


def _pieces(size: int):
    def run(batches):
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for byte, bit in _places(batch.column(0).to_numpy(zero_copy_only=False), size):
                np.bitwise_or.at(bits, byte, np.uint8(1) << bit)
        cut = bits.reshape(-1, min(PIECE, len(bits)))
        used = np.nonzero(cut.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([cut[i].tobytes() for i in used], pa.binary())], ["piece", "bits"])

    return run


def _join_pieces(table: pa.Table) -> pa.Table:
    out = np.frombuffer(table.column("bits")[0].as_py(), np.uint8).copy()
    for x in table.column("bits"):
        out |= np.frombuffer(x.as_py(), np.uint8)
    return pa.table({"piece": table.column("piece").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})


def broadcast_filter(ids: DataFrame, column: str, count: int):
    """A broadcast of the filter's bytes: 16 bits an id, FILTER_BITS at most. Tasks' filters meet by pieces, on the executors."""
    spark = ids.sparkSession
    size = min(FILTER_BITS, 1 << max(16, (16 * count).bit_length()))
    parts = ids.select(F.col(column)).mapInArrow(_pieces(size), "piece int, bits binary")
    full = np.zeros((-(-size // 8 // PIECE), min(PIECE, size // 8)), np.uint8)
    for row in parts.groupBy("piece").applyInArrow(_join_pieces, "piece int, bits binary").toLocalIterator():
        full[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(full.tobytes())
