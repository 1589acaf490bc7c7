"""Removal of byte runs that an earlier document has, by sorted suffixes at content-chosen anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.id_filter import broadcast_filter, mix, passing
from duplexa.llm.scratch import Scratch
from duplexa.llm.suffix_sort import common_prefixes, deep_shallow_order
from duplexa.llm.worker_cache import claim

U64 = np.uint64
#: Bytes of an anchor.
GRAM = 16
#: Window starts hashed at a time, texts gathered before anchors are sent, anchors of a task, contexts of a task.
SEGMENT, GATHER, TASK_ANCHORS, TASK_CONTEXTS = 1 << 19, 8 << 20, 1_000_000, 100_000
#: Bytes of short texts that are hashed together: calls are shared, and each array stays in the cache and below the size at which it would be mapped anew.
TOGETHER = 12 << 10
#: An anchor with more extents than this in one gathering is compared by windows wherever it is.
FREQUENT = 48
TABLE, OTHER = np.random.default_rng(77).integers(0, 2**63, (2, 256), dtype=U64) * U64(2) + U64(1)
ODD = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
with np.errstate(over="ignore"):
    #: Of both hashes of extents: the table of bytes, and powers of the base and of its inverse.
    HASHES = [
        (table, np.cumprod(np.full(SEGMENT + 4096, U64(base), U64)), np.cumprod(np.full(SEGMENT + 4096, U64(pow(base, -1, 2**64)), U64)))
        for table, base in ((TABLE, 0xA24BAED4963EE407), (OTHER, 0x8EBC6AF09C88C6E3))
    ]


def _minima(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(text: bytes, length: int = 50, hashed: bool = True):
    """Anchors of a text: (key, 64 and 32 bits of its extent's hashes, anchor place, first window, last window), arrays in order.

    Each string of ``length`` bytes is laid to its anchor, the gram in it of least hash
    (leftmost if tied): equal strings have equal anchors at equal places. Windows of one
    anchor follow on each other; together they cover its extent. Very long texts are
    hashed in segments of window starts, over which an anchor may come as two.
    """
    out = []
    for low in range(0, max(0, len(text) - length + 1), SEGMENT):
        part = np.frombuffer(text, np.uint8, min(SEGMENT + length - 1, len(text) - low), low)
        *hashes, at, first, last = _anchors_in(part, np.arange(len(part) - length + 1), length, hashed)
        out.append((*hashes, at + low, first + low, last + low))
    return [np.concatenate(x) for x in zip(*out)] if out else _none()


def _none() -> list[np.ndarray]:
    return [np.empty(0, U64)] * 3 + [np.empty(0, np.int64)] * 3


def _anchors_in(part: np.ndarray, window: np.ndarray, length: int, hashed: bool):
    """``anchors`` of the windows that begin at some places of a run of bytes; windows of different texts share none."""
    h = TABLE[part]
    step = 1
    for odd in ODD:
        h = h[:-step] * odd + h[step:]
        step *= 2
    h = mix(h)
    # The place in the low bits makes the leftmost of equal grams the least.
    least = _minima((h & ~U64((1 << 24) - 1)) | np.arange(len(h), dtype=U64), length - GRAM + 1)
    place = (least & U64((1 << 24) - 1)).astype(np.int64)[window]
    begin = np.concatenate([[0], np.nonzero(np.diff(place))[0] + 1])
    first, last = window[begin], window[np.concatenate([begin[1:] - 1, [len(place) - 1]])]
    at = place[begin]
    extents = []
    for table, powers, inverses in HASHES if hashed else ():
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(table[part] * powers[: len(part)])])
        extent = (sums[last + length] - sums[first]) * inverses[first]
        extents.append(mix(extent + (last - first).astype(U64) * ODD[0] + (at - first).astype(U64) * ODD[1]))
    extents = [extents[0], extents[1] >> U64(32)] if hashed else [h[:0]] * 2
    # Anchors have small hashes; mixed again, their keys are spread evenly, so that ranges of keys are buckets of one size.
    return [mix(h[at]) >> U64(16), *extents, at, first, last]


def _groups(column):
    """A text column's rows in groups of at most TOGETHER bytes, or of one text: number of the first row, and texts as bytes."""
    low, texts, size = 0, [], 0
    for n, text in enumerate(column):
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        if texts and size + len(data) > TOGETHER:
            yield low, texts
            low, texts, size = n, [], 0
        texts.append(data)
        size += len(data)
    if texts:
        yield low, texts


def _in_batches(batches, rows: int):
    """Small batches joined to some of at least so many rows, but for the last."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def anchors_of(texts: list[bytes], length: int = 50, hashed: bool = True):
    """``anchors`` of each of a group's texts: (where each text begins in all bytes, how many anchors it has, anchors of all of them).

    Places are those in the bytes of all texts behind each other. A text's anchors do not depend on its group.
    """
    starts = np.cumsum([0, *map(len, texts)])
    if len(texts) == 1:
        found = anchors(texts[0], length, hashed)
        return starts, np.array([len(found[0])]), found
    part = np.frombuffer(b"".join(texts), np.uint8)
    own = np.repeat(np.arange(len(texts)), np.diff(starts))
    window = np.nonzero(np.arange(length, len(part) + length) <= starts[own + 1])[0]
    found = _anchors_in(part, window, length, hashed) if len(window) else _none()
    return starts, np.bincount(own[found[4]], minlength=len(texts)), found


#: Extents of one anchor are told apart by 96 bits: of 10 ** 9 of them two are taken for equal with a chance below 10 ** -11.
PLANES = (("key", 6), ("extent", 8), ("extra", 4), ("doc", 8), ("row", 8), ("nth", 4))


#: Bytes of a mark's row, anchor and kind.
MARK = (8, 4, 1)


def _planes(values, width: int) -> bytes:
    """Lowest bytes of numbers, all first bytes, then all second ones: what hardly varies compresses."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def _pack(columns, widths) -> bytes:
    """Columns of numbers, compressed; the first is in order and goes as its steps."""
    n = len(columns[0])
    if not n:
        return b""
    steps = np.diff(columns[0].astype("<i8"), prepend=np.int64(0))
    data = b"".join(_planes(x, w) for x, w in zip((steps, *columns[1:]), widths))
    return n.to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes, widths) -> list[np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    planes = pa.decompress(data[4:], n * sum(widths), codec="zstd", asbytes=True) if n else b""
    out, at = [], 0
    for w in widths:
        out.append(_numbers(planes[at : at + n * w], w))
        at += n * w
    out[0] = np.cumsum(out[0])
    return out


def _widths_of(named: bool) -> list[int]:
    """Bytes of what is sent of an anchor; rows that go by their id need no name of their own."""
    return [w for name, w in PLANES if named or name != "row"]


def _anchor_order(key, extent, extra, doc) -> np.ndarray:
    """Order by key, extent and document; only anchors that come again need more than their key."""
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    again = np.nonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))[0] if len(key) else order
    some = order[again]
    order[again] = some[np.lexsort((doc[some], extra[some], extent[some], key[some]))]
    return order


def _anchor_blocks(buckets: int, length: int, named: bool):
    def flush(held):
        key, extent, extra, doc, row, nth = (np.concatenate([h[i] for h in held]) for i in range(6))
        order = _anchor_order(key, extent, extra, doc)
        key, extent, extra, doc, row, nth = (x[order] for x in (key, extent, extra, doc, row, nth))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (extent[1:] != extent[:-1]) | (extra[1:] != extra[:-1])
        source = doc[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        # Extents that a smaller document of this task has are settled here; one stands for all.
        here = doc > source
        # Of an anchor with very many extents two are sent on, from two documents; all are to be compared.
        start = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        count = np.add.reduceat(new.astype(np.int64), start)
        number = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
        low, high = np.minimum.reduceat(doc, start), np.maximum.reduceat(doc, start)
        many = ((count > FREQUENT) & (low != high))[number] & ~here
        sent = ~here & ~many
        least, most = (np.nonzero(many & (doc == x[number]))[0] for x in (low, high))
        for some in (least, most):
            sent[some[np.unique(number[some], return_index=True)[1]]] = True
        # Ranges of the key's upper 32 bits.
        bucket = ((key >> U64(16)) * U64(buckets) >> U64(32)).astype(np.int64)
        ends = np.searchsorted(bucket, np.arange(buckets + 1))
        parts = [key, extent, extra, doc, *([row] if named else []), nth]
        cols = {"bucket": [], "open": [], "done": [], "many": []}
        for b in range(buckets):
            i = np.arange(ends[b], ends[b + 1])
            if len(i):
                cols["bucket"].append(b)
                which = i[sent[i]]
                cols["open"].append(_pack([x[which] for x in parts], _widths_of(named)))
                for name, taken in (("done", here), ("many", many)):
                    which = i[taken[i]]
                    which = which[np.lexsort((nth[which], row[which]))]
                    cols[name].append(_pack([row[which], nth[which]], (8, 4)))
        return pa.RecordBatch.from_pydict(cols, pa.schema([("bucket", pa.int32()), ("open", pa.binary()), ("done", pa.binary()), ("many", pa.binary())]))

    def run(batches):
        claim()
        held, size = [], 0
        for batch in batches:
            row, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "doc"))
            for low, texts in _groups(batch.column("text")):
                _, count, (key, extent, extra, *_) = anchors_of(texts, length)
                if len(key):
                    nth = np.arange(len(key)) - np.repeat(np.cumsum(count) - count, count)
                    held.append((key, extent, extra, *(np.repeat(x[low : low + len(texts)], count) for x in (doc, row)), nth))
                    size += sum(map(len, texts))
                    if size >= GATHER:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return run


def _mark(buckets: int, named: bool):
    """Marks of anchors, in blocks by row: settled ones and those whose windows must be compared."""

    def run(batches):
        claim()
        widths = _widths_of(named)
        opened, done, many = ([[np.empty(0, np.int64)] for _ in range(n)] for n in (len(widths), 2, 2))
        for batch in batches:
            for name, into, w in (("open", opened, widths), ("done", done, (8, 4)), ("many", many, (8, 4))):
                for x in batch.column(name):
                    for parts, part in zip(into, _unpack(x.as_py(), w)):
                        parts.append(part)
        key, extent, extra, doc, *row, nth = map(np.concatenate, opened)
        order = _anchor_order(key, extent, extra, doc)
        key, extent, extra, doc, nth = (x[order] for x in (key, extent, extra, doc, nth))
        row = row[0][order] if named else doc
        n = len(key)
        covered = mixed = np.zeros(n, bool)
        if n:
            group = np.ones(n, bool)
            group[1:] = key[1:] != key[:-1]
            same = group.copy()
            same[1:] |= (extent[1:] != extent[:-1]) | (extra[1:] != extra[:-1])
            own = np.maximum.accumulate(np.where(same, np.arange(n), 0))
            covered = doc > doc[own]
            # An anchor's other extents matter where one of them is in another document.
            number = np.cumsum(group) - 1
            low, high, kinds = (f.reduceat(x, np.nonzero(group)[0]) for f, x in ((np.minimum, doc), (np.maximum, doc), (np.add, same.astype(np.int64))))
            mixed = ((low != high) & (kinds > 1))[number] & ~covered
        row_of = np.concatenate([*done[0], row[covered], row[mixed], *many[0]])
        nth_of = np.concatenate([*done[1], nth[covered], nth[mixed], *many[1]])
        kind = np.zeros(len(row_of), np.int64)
        kind[sum(map(len, done[0])) + np.count_nonzero(covered) :] = 1
        bucket = (mix(row_of.view(U64)) % U64(buckets)).astype(np.int64)
        order = np.lexsort((nth_of, row_of, bucket))
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        cols = {"bucket": [], "marks": []}
        for b in range(buckets):
            i = order[ends[b] : ends[b + 1]]
            if len(i):
                cols["bucket"].append(b)
                cols["marks"].append(_pack([row_of[i], nth_of[i], kind[i]], MARK))
        yield pa.RecordBatch.from_pydict(cols, pa.schema([("bucket", pa.int32()), ("marks", pa.binary())]))

    return run


def _gather(batches):
    """One row for each of the table's with marks: ``done`` and ``open`` hold the anchors' numbers."""
    parts = [[np.empty(0, np.int64)] for _ in range(3)]
    for batch in batches:
        for x in batch.column("marks"):
            for into, part in zip(parts, _unpack(x.as_py(), MARK)):
                into.append(part)
    row_of, nth_of, kind = map(np.concatenate, parts)
    order = np.lexsort((kind, row_of))
    row_of, nth_of, kind = row_of[order], nth_of[order].astype("<u4"), kind[order]
    starts = np.concatenate([np.nonzero(np.diff(row_of, prepend=row_of[:1] - 1))[0], [len(row_of)]])
    for at in range(0, len(starts) - 1, 10_000):
        some = starts[at : at + 10_001]
        rows, a, b = [], [], []
        for i, j in zip(some[:-1].tolist(), some[1:].tolist()):
            m = i + int(np.searchsorted(kind[i:j], 1))
            rows.append(int(row_of[i]))
            a.append(nth_of[i:m].tobytes())
            b.append(nth_of[m:j].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["row", "done", "open"])


def _slices(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """Stretches of bytes, from ``low`` to before ``high``, as one binary column."""
    ends = np.cumsum(high - low)
    places = np.repeat(low - ends + (high - low), high - low) + np.arange(ends[-1])
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(low), [None, pa.py_buffer(offsets), pa.py_buffer(data[places])])


def _contexts(length: int):
    """The bytes around each open anchor of a text: key, doc, row, nth, least and most bytes before it, left and right."""

    def run(batches):
        claim()
        for batch in batches:
            row, doc, parts = (batch.column(c) for c in ("row", "doc", "open"))
            for low, texts in _groups(batch.column("text")):
                starts, count, (key, _, _, at, first, last) = anchors_of(texts, length, hashed=False)
                asked = [np.unique(np.frombuffer(parts[low + n].as_py(), "<u4")).astype(np.int64) for n in range(len(texts))]
                nth, size = np.concatenate(asked), [len(x) for x in asked]
                if not len(nth):
                    continue
                of = low + np.repeat(np.arange(len(texts)), size)
                i = nth + np.repeat(np.cumsum(count) - count, size)
                a, p, q = at[i], first[i], last[i]
                data = np.frombuffer(b"".join(texts), np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[i].astype(np.int64)),
                        doc.take(pa.array(of)),
                        row.take(pa.array(of)),
                        *(pa.array(x.astype(np.int32)) for x in (nth, a - q, a - p)),
                        _slices(data, p, a),
                        _slices(data, a + GRAM, q + length),
                    ],
                    ["key", "doc", "row", "nth", "least", "most", "left", "right"],
                )

    return lambda batches: _in_batches(run(batches), 8192)


def covered_windows(key, doc, least, most, left: list[bytes], right: list[bytes], length: int = 50) -> np.ndarray:
    """For each context a mask: bit n is set if its window with n bytes before the anchor is in a smaller document.

    What follows the anchors and, turned round, what goes before them are sorted. Two
    windows are equal if their rests are in one interval of common prefixes on both
    sides, at the lengths that the window has there.
    """
    heads = [int(k).to_bytes(8, "big") for k in key]
    sides = []
    for texts in ([h + t[::-1] for h, t in zip(heads, left)], [h + t for h, t in zip(heads, right)]):
        order = deep_shallow_order(texts)
        sides.append((order, common_prefixes(texts, order)))
    masks = np.zeros(len(doc), np.int64)
    for before in range(length - GRAM + 1):
        rows = np.nonzero((least <= before) & (before <= most))[0]
        if len(rows) < 2:
            continue
        classes = []
        for (order, lcp), depth in zip(sides, (before, length - GRAM - before)):
            number = np.empty(len(doc), np.int64)
            number[order] = np.cumsum(lcp < 8 + depth)
            classes.append(number[rows])
        both = classes[0] * (len(doc) + 1) + classes[1]
        order = np.lexsort((doc[rows], both))
        new = np.ones(len(rows), bool)
        new[1:] = np.diff(both[order]) != 0
        source = doc[rows][order][np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        masks[rows[order][doc[rows][order] > source]] |= 1 << before
    return masks


def _windows(length: int):
    """A row for each window of a context: a 128-bit digest of its bytes, and where it is."""

    def run(batches):
        claim()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                rows = []
                for doc, row, nth, key, least, most, left, right in zip(*(part.column(c).to_pylist() for c in ("doc", "row", "nth", "key", "least", "most", "left", "right"))):
                    head = key.to_bytes(8, "big", signed=True)
                    for before in range(least, most + 1):
                        digest = xxhash.xxh3_128(head + left[len(left) - before :] + b"|" + right[: length - GRAM - before]).digest()
                        rows.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True), before, doc, row, nth))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()))], ["w1", "w2", "before", "doc", "row", "nth"]
                )

    return run


def _by_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(row, nth, mask) for anchors with more contexts than a task holds: smallest documents of equal windows, joined back.

    Work follows the number of windows; the least document is combined before the
    shuffle, and the join may be split where one window is in very many documents.
    """
    rows = contexts.mapInArrow(_windows(length), "w1 long, w2 long, before int, doc long, row long, nth int")
    first = rows.groupBy("before", "w1", "w2").agg(F.min("doc").alias("source"), F.count("*").alias("n")).where("n > 1").drop("n")
    hit = rows.join(first, ["before", "w1", "w2"]).where("doc > source")
    return hit.groupBy("row", "nth").agg(F.bit_or(F.expr("shiftleft(1L, before)")).alias("mask"))


def _compare(length: int):
    def run(table: pa.Table) -> pa.Table:
        column = lambda c: np.asarray(table.column(c))
        texts = lambda c: table.column(c).to_pylist()
        masks = covered_windows(column("key"), column("doc"), column("least"), column("most"), texts("left"), texts("right"), length)
        hit = masks != 0
        return pa.table({"row": pa.array(column("row")[hit]), "nth": pa.array(column("nth")[hit]), "mask": pa.array(masks[hit])})

    return run


def _cut(length: int, with_text: bool):
    def run(batches):
        for batch in batches:
            for low, texts in _groups(batch.column("text")):
                part = batch.slice(low, len(texts))
                starts, count, (_, _, _, at, first, last) = anchors_of(texts, length, hashed=False)
                before = np.cumsum(count) - count
                whole = np.concatenate([np.unique(np.frombuffer(x.as_py() or b"", "<u4")).astype(np.int64) + n for x, n in zip(part.column("done"), before)])
                # The numbers of anchors with masks, and of each mask the windows that it names.
                listed = pc.fill_null(pc.list_value_length(part.column("nths")), 0).to_numpy(zero_copy_only=False)
                some, masks = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("nths", "masks"))
                of, ahead = np.nonzero(masks[:, None] >> np.arange(length - GRAM + 1) & 1)
                single = at[some + np.repeat(before, listed)][of] - ahead
                size = starts[-1] + 1
                change = np.bincount(np.concatenate([first[whole], single]), minlength=size) - np.bincount(np.concatenate([last[whole], single]) + length, minlength=size)
                gone = np.cumsum(change[:-1]) > 0
                data = np.frombuffer(b"".join(texts), np.uint8)
                removed, spans, digests, kept = [], [], [], []
                for i, j in zip(starts[:-1].tolist(), starts[1:].tolist()):
                    here = gone[i:j]
                    rest = data[i:j][~here].tobytes()
                    removed.append(int(np.count_nonzero(here)))
                    spans.append(int(np.count_nonzero(np.diff(here.astype(np.int8), prepend=0) == 1)))
                    digests.append(hashlib.sha256(rest).hexdigest())
                    kept.append(rest.decode("utf-8", "ignore") if with_text else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests), pa.array(kept, pa.string())],
                    ["row", "n_removed", "n_spans", "kept_sha256", "kept_text"],
                )

    return lambda batches: _in_batches(run(batches), 256)


def _passing(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows that are not in ``ids``, so that the join with them moves less."""
    sent = broadcast_filter(ids, "row", ids.count())

    def run(batches):
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            yield batch.take(pa.array(np.nonzero(passing(bits, batch.column(0).to_numpy(zero_copy_only=False)))[0]))

    return docs.mapInArrow(run, "row long, doc long, text string")


def dedup_substrings(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 (and text_sha256 and kept_text, null where all is kept) of every document.

    Every byte goes that lies in a ``length``-byte string which also starts in a document
    of smaller id; strings are those of the input, over UTF-8 bytes, within documents.

    Suffixes are taken at anchors, some one in 18 bytes, chosen by content so that equal
    strings have equal anchors. They are dealt out by their first bytes (the anchor),
    which is the shallow order; equal extents are settled by digest, first within a task
    and so before the shuffle. Where extents around one anchor differ between documents,
    their bytes are sorted deep: multikey quicksort, then blind tries, and intervals of
    common prefixes tell which windows are equal. Anchors with more contexts than a task
    holds are settled by digests of their windows, and of anchors that are frequent in one
    task two extents are sent on, so no anchor is gathered whole. The text moves only of documents with such anchors or
    with removals. kept_text leaves out what remains of characters cut in part.

    Null text counts as empty. A null id is neither changed nor a source. Rows that
    repeat an id are judged each by its own text, and no row removes from another with
    its id; where their texts differ, such a row goes by a hash of id and text. Other
    columns are ignored; an empty table gives an empty result.
    """
    if length - GRAM < 0 or length - GRAM > 62:
        raise ValueError("length must be from 16 to 78")
    spark = documents.sparkSession
    scratch = Scratch(spark, "suffixes")
    rows = documents.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.col("doc").cast("long"))
    again = rows.where("doc is not null").groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    again = scratch.save(again, "again")
    named = again.limit(1).count() > 0
    if named:
        rows = rows.join(again.withColumnRenamed("row", "again"), F.col("row") == F.col("again"), "left")
        rows = rows.select("doc", "text", F.when(F.col("again").isNull(), F.col("row")).otherwise(F.xxhash64("doc", "text")).alias("row"))
    heads = rows.select("doc", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    docs = rows.where("doc is not null").select("row", F.col("doc").cast("long").alias("doc"), "text")
    total = heads.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (18 * TASK_ANCHORS)))
    blocks = docs.mapInArrow(_anchor_blocks(4 * tasks, length, named), "bucket int, open binary, done binary, many binary")
    marks = blocks.repartition(tasks, "bucket").mapInArrow(_mark(4 * tasks, named), "bucket int, marks binary")
    marks = scratch.save(marks.repartition(tasks, "bucket").mapInArrow(_gather, "row long, done binary, open binary"), "marks")

    asked = marks.where("length(open) > 0").select("row", "open")
    around = _passing(docs, asked).join(asked, "row").mapInArrow(
        _contexts(length), "key long, doc long, row long, nth int, least int, most int, left binary, right binary"
    )
    # Only rows that repeat both id and text are met twice.
    around = scratch.save(around.distinct() if named else around, "contexts")
    n = around.count()
    parts = max(1, -(-n // TASK_CONTEXTS))
    usual = around
    if n > TASK_CONTEXTS:
        hot = around.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TASK_CONTEXTS).select("key")
        # At most one in TASK_CONTEXTS contexts: sent whole, so that contexts need not move to be told apart.
        hot = F.broadcast(scratch.save(hot, "hot"))
        usual = around.join(hot, "key", "left_anti")
    masks = usual.groupBy(F.pmod(F.xxhash64("key"), F.lit(parts))).applyInArrow(_compare(length), "row long, nth int, mask long")
    if n > TASK_CONTEXTS:
        masks = masks.union(_by_windows(around.join(hot, "key", "left_semi"), length))
    masks = masks.groupBy("row").agg(F.collect_list(F.struct("nth", "mask")).alias("m"))
    masks = scratch.save(masks.select("row", F.col("m.nth").alias("nths"), F.col("m.mask").alias("masks")), "masks")

    done = marks.where("length(done) > 0").select("row", "done")
    edits = scratch.save(done.join(masks, "row", "full"), "edits")
    cut = _passing(docs, edits).join(edits, "row").mapInArrow(
        _cut(length, with_text), "row long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    )
    cut = scratch.save(cut.dropDuplicates(["row"]) if named else cut, "cut")
    scratch.drop("marks", "contexts", "masks", "edits", "hot")
    out = heads.join(cut, "row", "left").select(
        F.col("doc").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        *([F.col("sha").alias("text_sha256"), "kept_text"] if with_text else []),
    )
    return out
