"""Near-duplicate documents: an inverted join on MinHash coordinates, confirmed on whole shingle sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.components import connected_components, forest
from duplexa.llm.id_filter import broadcast_filter, mix, passing
from duplexa.llm.scratch import Scratch
from duplexa.llm.worker_cache import claim

COORDINATES = 32
#: Documents of a family, and bytes of their sets, that one task compares with as many others.
BLOCK, BLOCK_BYTES = 512, 32 << 20
#: Of a family larger than a block, about so many documents visit every block, and so many bytes of theirs.
HUBS, HUB_BYTES = 64, 8 << 20
#: Rows and bytes of families smaller than a block that are compared in one go.
TOGETHER, TOGETHER_BYTES = 4096, 16 << 20
REMEMBERED = 200_000
U64 = np.uint64


class _Words(dict):
    def __missing__(self, word):
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


_words = _Words()


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct runs of ``words`` words.

    A-Z are lower-cased, and words part at ASCII white space. Fewer words: all of them
    are one run. No words: none.
    """
    parts = (text or "").encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(_words.__getitem__, parts), U64, len(parts))
    if not len(h):
        return h
    width = min(words, len(h))
    run = h[: len(h) - width + 1]
    for i in range(1, width):
        run = mix(run) + h[i : len(h) - width + 1 + i]
    return np.unique(mix(run + U64(width)))


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, 2**63, COORDINATES, dtype=U64) * U64(2) + U64(1), rng.integers(0, 2**63, COORDINATES, dtype=U64)


FACTORS, TERMS = _constants()


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of the set under each of COORDINATES permutations."""
    return np.array([((hashes ^ t) * f).min() for f, t in zip(FACTORS, TERMS)], U64)


def least_matches(percent: int) -> int:
    """Equal coordinates that a pair at the threshold has but for five standard deviations."""
    p = percent / 100
    return max(1, math.floor(COORDINATES * p - 5 * math.sqrt(COORDINATES * p * (1 - p))))


def _digest(hashes: bytes) -> tuple[int, int]:
    """Two halves of a set's 128-bit digest, by which equal sets are known."""
    digest = xxhash.xxh3_128(hashes).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _sign(words: int):
    def run(batches):
        claim(_words)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                size, one, two, sig = [], [], [], []
                for text in part.column("text"):
                    s = shingles(text.as_py(), words)
                    size.append(len(s))
                    for into, half in zip((one, two), _digest(s.tobytes())):
                        into.append(half)
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sig, pa.binary())],
                    ["id", "n", "d1", "d2", "sig"],
                )

    return run


#: Tells the coordinates' values apart.
SALT = mix(np.arange(1, COORDINATES + 1, dtype=U64))


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), U64).reshape(len(column), COORDINATES)


def _post(batches):
    """A row for each coordinate-value pair of a document, the pair as one 64-bit number."""
    for batch in batches:
        if batch.num_rows:
            rep = batch.column("rep").to_numpy(zero_copy_only=False)
            keys = mix(_signatures(batch.column("sig")) + SALT[None]).view(np.int64)
            for at in range(0, len(rep), 4096):
                part = keys[at : at + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(part.ravel()), pa.array(np.repeat(rep[at : at + 4096], COORDINATES))], ["key", "rep"])


def collisions(left: np.ndarray, right: np.ndarray, least: int, at_once: int = 1_000_000):
    """(i, j, count) of all pairs of a left and a right row with ``least`` or more equal coordinates.

    Rows hold their coordinate-value pairs as keys. The right rows are posted under theirs.
    Of a left row's lists the ``least`` - 1 longest are skipped: a row with enough
    collisions is in one of the others, which are merged. What the merge finds, and that
    alone, is looked up in the skipped lists.
    """
    width = left.shape[1]
    order = np.argsort(right.ravel(), kind="stable")
    posted, row_of = right.ravel()[order], order // width
    low = np.searchsorted(posted, left)
    size = np.searchsorted(posted, left, "right") - low
    by_size = np.argsort(size, axis=1, kind="stable")
    short, long = by_size[:, : width - least + 1], by_size[:, width - least + 1 :]
    low, size = np.take_along_axis(low, short, 1), np.take_along_axis(size, short, 1)
    work = np.cumsum(size.sum(axis=1))
    out = [(np.empty(0, np.int64),) * 3]
    begin = 0
    while begin < len(left):
        done = int(work[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(work, done + at_once, "right")))
        n = size[begin:end].ravel()
        at = np.repeat(low[begin:end].ravel() - (np.cumsum(n) - n), n) + np.arange(n.sum())
        i = np.repeat(np.arange(begin, end), size[begin:end].sum(axis=1))
        pair, count = np.unique(i * len(right) + row_of[at], return_counts=True)
        i, j = pair // len(right), pair % len(right)
        skipped = long[i]
        count += (left[i[:, None], skipped] == right[j[:, None], skipped]).sum(axis=1)
        enough = count >= least
        out.append((i[enough], j[enough], count[enough]))
        begin = end
    return tuple(np.concatenate(x) for x in zip(*out))


def _keys(table: pa.Table) -> np.ndarray:
    """Coordinate-value pairs of rows, told apart by the rows' families."""
    family = mix(np.asarray(table.column("family")).astype(np.int64).view(U64))
    return mix(_signatures(table.column("sig")) + SALT[None]) ^ family[:, None]


def _fit(size_i, size_j, percent: int):
    """Sets of such sizes can have 100 * common >= percent * union."""
    return 100 * np.minimum(size_i, size_j) >= percent * np.maximum(size_i, size_j)


def _matched(percent: int, least: int):
    """Of whole families, the documents that any other has enough collisions with."""

    def run(table: pa.Table) -> pa.Table:
        keys, size, rep = _keys(table), np.asarray(table.column("n")), np.asarray(table.column("rep"))
        i, j, _ = collisions(keys, keys, least)
        return pa.table({"rep": pa.array(rep[np.unique(i[(i != j) & _fit(size[i], size[j], percent)])])})

    return run


def _met(percent: int, least: int):
    """Of whole lists, links that join what pairs with enough collisions would."""

    def run(table: pa.Table) -> pa.Table:
        keys, size, rep = _keys(table), np.asarray(table.column("n")), np.asarray(table.column("rep"))
        i, j, _ = collisions(keys, keys, least)
        fits = (i < j) & _fit(size[i], size[j], percent)
        a, b = forest(rep[i[fits]], rep[j[fits]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _sets(shared, words: int):
    def run(batches):
        bits = np.frombuffer(shared.value, np.uint8)
        claim(_words)
        for batch in batches:
            hit = passing(bits, batch.column("id").to_numpy(zero_copy_only=False))
            part = batch.take(pa.array(np.nonzero(hit)[0]))
            made, at = [], 0
            for row, text in enumerate(part.column("text"), 1):
                made.append(shingles(text.as_py(), words).tobytes())
                if row == part.num_rows or sum(map(len, made)) > BLOCK_BYTES // 4 or len(made) == 512:
                    one, two = zip(*map(_digest, made))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").slice(at, len(made)), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(made, pa.binary())], ["least", "d1", "d2", "hashes"]
                    )
                    made, at = [], row

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def matches(left, right, labels, keys, size, percent: int, least: int):
    """Pairs (i, j) of a left with a right row to be confirmed, most collisions first: ``least`` or more, sizes and labels permitting."""
    at_left, at_right = np.nonzero(left)[0], np.nonzero(right)[0]
    i, j, count = collisions(keys[at_left], keys[at_right], least)
    i, j = at_left[i], at_right[j]
    # A pair that both sides hold is tried once.
    fits = ~(left[j] & right[i] & (i >= j)) & (labels[i] != labels[j]) & _fit(size[i], size[j], percent)
    i, j, count = i[fits], j[fits], count[fits]
    order = np.argsort(-count, kind="stable")
    return i[order], j[order]


def confirm(reps, labels, sets, i, j, percent: int, dense_from: int = 20_000):
    """Links that join the labels as all pairs (i, j) with 100 * common >= percent * union would; pairs of joined labels are skipped.

    Pairs are confirmed on whole sets in the order given. Where many are left over, common
    elements of all of them are counted at once by products of incidence matrices.
    """
    size = np.array([len(s) for s in sets])
    names, root = np.unique(labels, return_inverse=True)
    parent = np.arange(len(names))

    def roots(x):
        while True:
            up = parent[x]
            if (up == x).all():
                return x
            x = parent[up]

    out = []

    def link(a, b):
        x, y = (int(roots(np.array([root[v]]))[0]) for v in (a, b))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((reps[a], reps[b]))

    tried = 0
    while True:
        apart = roots(root[i]) != roots(root[j])
        i, j = i[apart], j[apart]
        if not len(i):
            return out
        if tried >= 2000 and len(i) >= dense_from:
            break
        step = max(64, len(i) // 8 if len(i) < dense_from else 500)
        for a, b in zip(i[:step].tolist(), j[:step].tolist()):
            if int(roots(np.array([root[a]]))[0]) != int(roots(np.array([root[b]]))[0]):
                common = _common(sets[a], sets[b])
                if 100 * common >= percent * (size[a] + size[b] - common):
                    link(a, b)
        tried += step
        i, j = i[step:], j[step:]
    rows, columns = np.unique(i), np.unique(j)
    used = np.unique(np.concatenate([rows, columns]))
    values = np.unique(np.concatenate([sets[v] for v in used]))
    common = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, len(values), 8192):
        part = values[low : low + 8192]
        made = {}
        for v in used:
            s = sets[v]
            s = s[np.searchsorted(s, part[0]) : np.searchsorted(s, part[-1], "right")]
            row = np.zeros(len(part), np.float32)
            row[np.searchsorted(part, s)] = 1
            made[v] = row
        common += np.stack([made[v] for v in rows]) @ np.stack([made[v] for v in columns]).T
    common = common[np.searchsorted(rows, i), np.searchsorted(columns, j)].astype(np.int64)
    good = 100 * common >= percent * (size[i] + size[j] - common)
    for a, b in zip(i[good].tolist(), j[good].tolist()):
        link(a, b)
    return out


def _compare(percent: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        column = lambda c: np.asarray(table.column(c))
        found = []
        if len(table) > 1:
            sets = [np.frombuffer(x.as_buffer(), U64) for x in table.column("hashes")]
            size = np.array([len(s) for s in sets])
            reps, labels, family = column("rep"), column("label"), column("family")
            i, j = matches(column("left"), column("right"), labels, _keys(table), size, percent, least)
            # One family after the other, as only its own sets have much in common.
            order = np.argsort(family[i], kind="stable")
            cuts = np.nonzero(np.diff(family[i[order]]))[0] + 1
            for some in np.split(order, cuts) if len(order) else ():
                used, flat = np.unique(np.concatenate([i[some], j[some]]), return_inverse=True)
                found += confirm(reps[used], labels[used], [sets[v] for v in used], flat[: len(some)], flat[len(some) :], percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links) and kept of every document.

    Linked are documents with 100 * |common shingles| >= percent * |all shingles|. Equal
    sets are one class. Every class is posted under its 32 coordinate-value pairs;
    frequencies put each class's pairs in one global order, rarest first, and only the
    prefix that two classes with enough equal coordinates must share is joined, so what
    very many documents have in common posts nothing. Classes that meet are a family; one
    of more rows than a block is parted again by its lists' collisions, a list longer than
    a block left whole. Within families collisions are counted from postings, the longest lists skipped
    (``collisions``), before any set moves: a class without a partner above the match
    threshold is done. The others' pairs above it are confirmed on whole sets, pairs
    already joined skipped. A family of more rows or bytes than a block meets some hubs in
    each block first; then only what is still apart from its largest part is compared with
    all blocks. Only links that join something leave a task. A pair at the threshold lacks
    the matches with a chance of about 4 in a million.

    Null and empty texts have no shingles and link with nothing. Rows that repeat an id
    are one document for links, whatever their texts: each is linked as any of them is. A null id links with nothing. Other columns are ignored;
    an empty table gives an empty result.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "minhash")
    least = least_matches(percent)
    prefix = COORDINATES - least + 1
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = scratch.save(docs.mapInArrow(_sign(words), "id long, n long, d1 long, d2 long, sig binary"), "signed")
    classes = signed.where("n > 0 and id is not null").groupBy("d1", "d2").agg(F.min("id").alias("least"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    # A class goes by its smallest id; where an id is the smallest of several, by a hash of id and set.
    shared = classes.groupBy("least").agg(F.count("*").alias("classes")).where("classes > 1").drop("classes")
    shared = scratch.save(shared, "shared")
    repeated = shared.limit(1).count() > 0
    rep = F.col("least")
    if repeated:
        classes = classes.join(shared.withColumnRenamed("least", "again"), F.col("least") == F.col("again"), "left")
        rep = F.when(F.col("again").isNull(), rep).otherwise(F.xxhash64("least", "d1", "d2"))
    classes = scratch.save(classes.select("d1", "d2", rep.alias("rep"), "least", "n", "sig"), "classes")
    posts = scratch.save(classes.select("rep", "sig").mapInArrow(_post, "key long, rep long"), "posts")
    frequent = posts.groupBy("key").agg(F.count("*").alias("f")).where("f > 1")
    shared = posts.join(frequent, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("f", "key"))).alias("keys"))
    # The pairs that a class has alone come first in the order.
    first = F.greatest(F.lit(prefix - COORDINATES) + F.size("keys"), F.lit(0))
    lists = scratch.save(shared.select("rep", F.explode(F.slice("keys", 1, first)).alias("k")).select("rep", F.col("k.key").alias("key")), "lists")
    scratch.drop("posts")
    hubs = lists.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("f")).where("f > 1")
    met = lists.join(hubs, "key").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    families = connected_components(met, scratch, "met").withColumnsRenamed({"node": "rep", "component": "family"})
    families = scratch.save(families, "families")
    sizes = families.groupBy("family").agg(F.count("*").alias("m"))
    if sizes.where(F.col("m") > BLOCK).limit(1).count():
        # Chains of classes that share a little grow faster than the table: only what a long list or enough collisions join stays together.
        sized = scratch.save(families.join(sizes, "family"), "sized")
        posted = sized.where(F.col("m") > BLOCK).select("rep").join(lists, "rep").join(hubs.withColumnRenamed("f", "length"), "key")
        posted = scratch.save(posted, "posted")
        n = posted.count()
        lots = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-n // TOGETHER))))
        short = posted.where(F.col("length") <= BLOCK).join(classes.select("rep", "n", "sig"), "rep").withColumn("family", F.col("key"))
        met = short.groupBy(lots).applyInArrow(_met(percent, least), "a long, b long")
        met = met.union(posted.where(F.col("length") > BLOCK).select("rep", "hub"))
        parted = connected_components(met, scratch, "parted").withColumnsRenamed({"node": "rep", "component": "family"})
        families = scratch.save(sized.where(F.col("m") <= BLOCK).select("rep", "family").union(parted.select("rep", "family")), "apart")

    # Families that fit in a block are compared many at a time, and by signatures first.
    sizes = families.groupBy("family").agg(F.count("*").alias("m"))
    signs = families.join(sizes, "family").join(classes, "rep")
    signs = scratch.save(signs, "signs")
    n = signs.count()
    lots = F.pmod(F.xxhash64("family"), F.lit(max(1, -(-n // TOGETHER))))
    small = signs.where(F.col("m") <= BLOCK)
    matched = small.groupBy(lots).applyInArrow(_matched(percent, least), "rep long")
    wanted = signs.where(F.col("m") > BLOCK).select("rep").union(matched)
    wanted = scratch.save(signs.join(wanted, "rep").select("family", "rep", "least", "d1", "d2", "sig"), "wanted")

    sent = broadcast_filter(wanted, "least", wanted.count())
    sets = docs.where("id is not null").mapInArrow(_sets(sent, words), "least long, d1 long, d2 long, hashes binary")
    # Rows that repeat an id have one class's set each, which its digest tells.
    group = wanted.join(sets, ["least", "d1", "d2"]).select("family", "rep", "sig", "hashes").dropDuplicates(["rep"])
    group = scratch.save(group, "sets")
    bytes_ = F.sum(F.length("hashes")).alias("bytes")
    sizes = group.groupBy("family").agg(F.count("*").alias("m"), bytes_)
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int")
    group = group.join(sizes, "family").select("family", "rep", "hashes", "sig", blocks.alias("blocks"), F.ceil(F.greatest(F.col("m") / HUBS, F.col("bytes") / HUB_BYTES)).cast("long").alias("each"))
    group = scratch.save(group.withColumn("block", F.expr("pmod(xxhash64(rep), blocks)").cast("int")), "group")
    scratch.drop("sets")

    hub = (F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit(3), "rep"), F.greatest("each", F.lit(1))) == 0)
    visits = F.when(hub, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    # Families of one block share tasks; their members have nothing to visit.
    total = group.agg(F.coalesce(F.sum(F.length("hashes")), F.lit(0)), F.count("*")).first()
    lots = F.pmod(F.xxhash64("family"), F.lit(max(1, -(-total[0] // TOGETHER_BYTES), -(-total[1] // TOGETHER))))
    single = F.col("blocks") == 1
    placed = group.withColumn("at", F.explode(visits)).select(
        single.alias("single"), F.when(single, lots).otherwise(F.col("family")).alias("task"),
        "family", "at", "rep", F.col("rep").alias("label"), (F.col("at") == F.col("block")).alias("left"), F.lit(True).alias("right"), "hashes", "sig"
    )
    links = scratch.save(placed.groupBy("single", "task", "at").applyInArrow(_compare(percent, least), "a long, b long"), "links")

    large = group.where("blocks > 1")
    if large.limit(1).count():
        parts = connected_components(links, scratch, "parts").withColumnsRenamed({"node": "rep", "component": "label"})
        large = large.join(parts, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        large = scratch.save(large, "large")
        most = large.groupBy("family", "label").agg(F.count("*").alias("n")).groupBy("family").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("m"))
        rest = large.groupBy("family", "label").agg(F.count("*").alias("n"), bytes_).join(most, "family").where("label <> main").groupBy("family").agg(
            F.max("main").alias("main"), F.ceil(F.greatest(F.sum("n") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("rest_blocks")
        )
        large = large.join(rest, "family")
        own = F.expr("pmod(xxhash64(7, rep), rest_blocks)").cast("int")
        columns = ["family", "rep", "label", "hashes", "sig"]
        apart = large.where("label <> main").withColumn("u", own)
        lefts = apart.withColumn("at", F.explode(F.expr("sequence(0, blocks - 1)"))).select(*columns, "u", "at", F.lit(True).alias("left"), F.lit(False).alias("right"))
        rights = large.withColumn("u", F.explode(F.expr("sequence(0, rest_blocks - 1)"))).select(*columns, "u", F.col("block").alias("at"), F.lit(False).alias("left"), F.lit(True).alias("right"))
        more = lefts.union(rights).groupBy("family", "u", "at").applyInArrow(_compare(percent, least), "a long, b long")
        links = links.union(scratch.save(more, "more"))
    if repeated:
        # All sets of one id are one document: its classes are joined.
        several = signed.where("n > 0 and id is not null").select("id", "d1", "d2").distinct().join(classes.select("d1", "d2", "rep"), ["d1", "d2"])
        joined = several.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("sets"))
        links = links.union(several.join(joined.where("sets > 1"), "id").select("a", F.col("rep").alias("b")).where("a <> b"))
    components = connected_components(links, scratch, "joined")
    found = classes.select("d1", "d2", "rep", "least").join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    if repeated:
        smallest = found.groupBy("component").agg(F.min("least").alias("id"))
        found = found.join(smallest, "component").withColumn("component", F.col("id"))
    found = found.select("d1", "d2", "component")
    out = signed.select("id", "n", "d1", "d2").join(found, ["d1", "d2"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    return out.select(
        F.col("id").cast(documents.schema[id_col].dataType).alias(id_col),
        F.col("n").alias("n_shingles"),
        component.cast(documents.schema[id_col].dataType).alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
