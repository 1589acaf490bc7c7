"""Fixed-length sequences filled with neighbouring documents along a Hilbert curve."""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.bpe_automaton import byte_letters
from duplexa.llm.scratch import Scratch
from duplexa.llm.worker_cache import claim

DIMS, BITS, BUCKETS = 3, 16, 1024
#: Words a worker remembers, some 200 bytes each.
REMEMBERED = 100_000
#: Words in a line that the tokenizer is given, and text bytes encoded at a time.
LINE = 5000
SLICE = 2 << 20
#: Signs that no rule of the tokenizer joins with letters before them.
SIGNS = ".,;:!?#$%&*+()[]{}=~^@\"/|-_"
#: A task's sequences are numbered from its partition number times this.
NUMBERS = 1 << 40


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of each row of whole coordinates below 2**bits.

    Gray-code undoing and bit exchanges after Skilling (2004), over all rows at once.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


@lru_cache(maxsize=1)
def projection() -> np.ndarray:
    """The fixed random directions onto which hashed document vectors are projected."""
    return np.random.default_rng(20_240_229).standard_normal((BUCKETS, DIMS))


def curve_points(ids: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Coordinates of documents laid end to end: hashed token counts at unit length, projected and squashed."""
    begins = np.concatenate([[0], stops[:-1]])
    out = np.zeros((len(stops), DIMS))
    for at in range(0, len(stops), 512):
        low, high = int(begins[at]), int(stops[min(at + 512, len(stops)) - 1])
        sizes = (stops - begins)[at : at + 512]
        bucket = (ids[low:high].astype(np.int64) * 40_503 >> 4) % BUCKETS
        bucket += np.repeat(np.arange(len(sizes)) * BUCKETS, sizes)
        counts = np.bincount(bucket, minlength=len(sizes) * BUCKETS).reshape(len(sizes), BUCKETS).astype(np.float64)
        norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        out[at : at + 512] = counts @ projection() / np.maximum(norm, 1)
    return np.minimum(((np.tanh(out) + 1) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def _lowered(word: str) -> str:
    """A Latin word in lower case, if that is all the tokenizer's normaliser does to it; else the empty string."""
    return word.lower() if max(word) < "\u0250" and unicodedata.is_normalized("NFC", word) else ""


class _Library:
    """The tokenizer, one without its normaliser and splitting for plain words, and the ids of words met so far."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        data = json.loads(spec)
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.known: dict[str, bytes] = {}
        self.young: dict[str, bytes] = {}
        suffix = data["model"].get("end_of_word_suffix")
        #: Of each id, whether it ends a word.
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in data["model"]["vocab"].items():
            self.ends[i] = bool(suffix) and token.endswith(suffix)
        self.letters = byte_letters()
        data |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": [], "truncation": None, "padding": None}
        self.bare = Tokenizer.from_str(json.dumps(data)) if self.ends.any() else None

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words. Words met twice are remembered, others until too many are new."""
        known, young = self.known, self.young
        parts = list(map(known.get, words))
        missing = [n for n, x in enumerate(parts) if x is None]
        fresh = []
        for n in missing:
            found = young.get(words[n])
            if found is None:
                fresh.append(words[n])
            else:
                parts[n] = found
                if len(known) < REMEMBERED:
                    known[words[n]] = young.pop(words[n])
        if fresh:
            now = self.encode(fresh)
            for n in missing:
                if parts[n] is None:
                    parts[n] = now[words[n]]
            if len(young) > REMEMBERED:
                young.clear()
            young |= now
        return parts

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(words, add_special_tokens=False)]

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of runs without white space.

        Latin letters, and such before a run of signs, are one word of the tokenizer (or
        two); the letters are encoded in long lines without normalising, which part where
        an id ends a word. All others, and all if a line does not part so, are encoded one by one.
        """
        plain, rest = [], []
        for w in words:
            base = w if w.isalpha() else w.rstrip(SIGNS)
            low = base.lower() if base.isascii() else _lowered(base)
            if low.isalpha():
                plain.append((w, low, w[len(base) :]))
            else:
                rest.append(w)
        lows = list({low for _, low, _ in plain})
        parted = [x for at in range(0, len(lows), LINE) for x in self._line(lows[at : at + LINE])] if self.bare else []
        if len(parted) != len(lows):
            plain, rest = [], words
        out = dict(zip(rest, self._one_by_one(rest))) if rest else {}
        if plain:
            tails = list({tail for *_, tail in plain} - {""})
            marks = dict(zip(tails, self._one_by_one(tails))) | {"": b""}
            coded = dict(zip(lows, parted))
            out |= {w: coded[low] + marks[tail] if tail else coded[low] for w, low, tail in plain}
        return out

    def _line(self, lows: list[str]) -> list[bytes]:
        """Ids of each word of a line, or nothing if it does not part into them."""
        letters = self.letters
        line = " ".join([x if x.isascii() else "".join([letters[b] for b in x.encode()]) for x in lows])
        ids = np.array(self.bare.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
        stop = (np.nonzero(self.ends[ids])[0] + 1) * 4
        if len(stop) != len(lows):
            return []
        flat, stop = ids.tobytes(), stop.tolist()
        return [flat[i:j] for i, j in zip([0, *stop], stop)]


@lru_cache(maxsize=1)
def _library(spec: str) -> _Library:
    return _Library(spec)


def encode_all(spec: str, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by ``end_id``, laid end to end, and where each text's end.

    Texts are cut at ASCII white space, over which no token reaches; each distinct word of
    them is looked up once, and encoded if it is new.
    """
    library = _library(spec)
    texts = pc.fill_null(texts, "")
    # The tokenizer reads letters in lower case anyway, but in the names of special tokens.
    texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
    cut = pc.ascii_split_whitespace(texts)
    offsets = cut.offsets.to_numpy().astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    distinct = coded.dictionary
    # One string, parted again, is a faster way to Python's strings than one by one.
    words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct), " ")[0].as_py().split(" ") if len(distinct) else []
    parts = library.look_up(words)
    flat = np.frombuffer(b"".join(parts), "<u4")
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    word = coded.indices.to_numpy()
    length = sizes[word]
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    # Where each word's ids begin in ``flat``, less where they begin in the result.
    shift = (np.cumsum(sizes) - sizes)[word] - (ends - length)
    ids = flat[np.repeat(shift, length) + np.arange(total)]
    stops = np.concatenate([[0], ends])[offsets[1:] - offsets[0]]
    return np.insert(ids, stops, np.uint32(end_id)), stops + np.arange(1, len(stops) + 1)


def _packed(ids: np.ndarray, stops: np.ndarray) -> pa.Array:
    """A binary array of the documents' ids."""
    offsets = np.concatenate([[0], stops]) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(stops), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())


def _slices(batch: pa.RecordBatch, column: int):
    """The batch in slices of about SLICE text bytes, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // SLICE
    cuts = [0, *(np.nonzero(np.diff(group))[0] + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield batch.slice(low, high - low)


def _tokenize(shared, end_id: int):
    def run(batches):
        library = _library(shared.value)
        claim(library.known, library.young)
        for batch in batches:
            for part in _slices(batch, 1):
                ids, stops = encode_all(shared.value, part.column(1), end_id)
                keys = pa.array(hilbert_keys(curve_points(ids, stops)))
                # Two bytes an id where they do: half to store and move.
                fits = int(ids.max(initial=0)) < 65536
                packed, none = _packed(ids.astype("<u2") if fits else ids, stops), pa.nulls(len(stops), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), keys, packed if fits else none, none if fits else packed], ["doc", "curve_key", "small", "large"])

    return run


def _fill(length: int, with_ids: bool):
    def run(batches):
        sequence, offset = TaskContext.get().partitionId() * NUMBERS, 0
        names = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        rows, held = [], 0

        def batch():
            kinds = [None, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, doc_type if k is None else k) for v, k in zip(zip(*rows), kinds)], names)

        for part in batches:
            doc_type = part.schema.field(0).type
            for doc, small, large in zip(*(part.column(i) for i in range(3))):
                ids = np.frombuffer(small.as_py(), "<u2").astype("<u4").tobytes() if small.is_valid else large.as_py()
                total, start = len(ids) // 4, 0
                while start < total:
                    n = min(length - offset, total - start)
                    piece = ids[4 * start : 4 * (start + n)]
                    rows.append((doc.as_py(), start, n, zlib.crc32(piece), total, sequence, offset, piece if with_ids else None))
                    start, offset, held = start + n, offset + n, held + 4 * n
                    if offset == length:
                        sequence, offset = sequence + 1, 0
                if held > 8_000_000:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()

    return run


def pack(documents: DataFrame, spec: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces of documents laid end to end into sequences: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    Each document is tokenized once by the tokenizers library, ``end_id`` closing it, and
    written with its Hilbert key. The table is dealt out by ranges of (key, id), so copies
    that share a key still spread, sorted, and cut every ``length`` ids. A document runs
    over into the next sequence; only a task's last sequence has room left, so padding is
    below one sequence a task. ``ids`` (null unless ``with_ids``) are little-endian unsigned 32-bit numbers.
    sequence_id is unique and grows along the curve, with gaps between tasks.

    Null and empty texts are the end id alone. Repeated rows are packed each. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "packing")
    shared = spark.sparkContext.broadcast(spec)
    kind = documents.schema[id_col].dataType.simpleString()
    coded = documents.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _tokenize(shared, end_id), f"doc {kind}, curve_key long, small binary, large binary"
    )
    coded = scratch.save(coded, "coded")
    ordered = coded.repartitionByRange("curve_key", "doc").sortWithinPartitions("curve_key", "doc").select("doc", "small", "large")
    filled = ordered.mapInArrow(
        _fill(length, with_ids), f"doc {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return filled.withColumnRenamed("doc", id_col)
