"""Accessibility by local folding: chances that stretches are unpaired, in sliding windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.functions.energies import BRANCH, BULGE, HAIRPIN, INTERIOR, MOST_UNPAIRED, MULTILOOP, can_pair, codes, stacks
from duplexa.functions.parameters import DEFAULT_TEMPERATURE, thermal_energy
from duplexa.functions.sequences import reverse_complement, to_dna, to_rna
from duplexa.operators.search import Targets, tile
from duplexa.shipping import ship

#: Energy of a stretch that is never open.
CLOSED = 25.5
#: Unpaired bases in an interior loop or bulge at most, and windows folded at a time.
LOOP, BATCH = MOST_UNPAIRED, 256


def unpaired_chances(windows: np.ndarray, span: int, unpaired: int, rt: float) -> np.ndarray:
    """chance[w, last, n - 1] that the n bases ending at ``last`` are unpaired in window w.

    McCaskill's inside and outside sums over hairpins, stacks, bulges, interior loops and
    loops with branches, for all windows and all places of one span at once.
    """
    count, size = windows.shape
    stack = np.pad(stacks(), [(0, 1)] * 4)
    pairs = np.pad(can_pair(), [(0, 1)] * 2) > 0
    span = min(span, size)
    factor = lambda e: np.exp(-e / rt)
    inside, outside = (np.zeros((count, size, size)) for _ in range(2))
    hairpins = np.zeros(size + 1)
    for n in range(3, size + 1):
        hairpins[n] = factor(HAIRPIN.get(n, 6.4 + 1.75 * rt * np.log(max(n, 9) / 9)))
    # Loops whose factor depends on the bases: stacks, and bulges of one.
    near = [(0, 0), (0, 1), (1, 0)]
    far = np.zeros((LOOP + 1, LOOP + 1))
    for a in range(LOOP + 1):
        for b in range(LOOP + 1 - a):
            if a + b > 1:
                far[a, b] = factor(INTERIOR.get(a + b, 1.6) if a and b else BULGE[a + b])

    def steps(d):
        """Of pairs (i, i + d): each near loop's inner pairs and factor."""
        i = np.arange(size - d)
        for a, b in near:
            if d - 2 - a - b < 4:
                continue
            e = factor(stack[windows[:, i], windows[:, i + d], windows[:, i + 1 + a], windows[:, i + d - 1 - b]] + (BULGE[1] if a + b else 0.0))
            yield i, a, b, e

    def within(d):
        """Of pairs (i, i + d): views of the sums of all pairs inside, and the factor of the loop between by (a, b), b counted from the inside."""
        m = min(LOOP + 1, d - 5)
        if m < 1:
            return None
        s0, s1, s2 = inside.strides
        low = d - m  # the last m places before i + d
        view = np.lib.stride_tricks.as_strided(inside[:, 1:, low:], (count, size - d, m, m), (s0, s1 + s2, s1, s2), writeable=False)
        weight = far[:m, :m][:, ::-1].copy()
        # Inner pairs of at least four places.
        weight[(np.arange(m)[:, None] + np.arange(m)[::-1][None]) > d - 6] = 0.0
        return view, weight

    # Within loops with branches: ``last`` sums one branch that begins at i and open bases after
    # it, ``lead`` the same with open bases before it, ``some`` one branch or more.
    branch, multi = factor(BRANCH), factor(MULTILOOP + BRANCH)
    last, lead, some = (np.zeros((count, size, size)) for _ in range(3))
    for d in range(4, span):
        i = np.arange(size - d)
        total = np.full((count, size - d), hairpins[d - 1])
        for _, a, b, e in steps(d):
            total = total + e * inside[:, i + 1 + a, i + d - 1 - b]
        if inner := within(d):
            total = total + np.einsum("wiab,ab->wi", *inner)
        for k in range(4, d - 6):
            total = total + multi * some[:, i + 1, i + 1 + k] * last[:, i + 2 + k, i + d - 1]
        inside[:, i, i + d] = np.where(pairs[windows[:, i], windows[:, i + d]], total, 0.0)
        last[:, i, i + d] = last[:, i, i + d - 1] + branch * inside[:, i, i + d]
        lead[:, i, i + d] = last[:, i, i + d] + lead[:, i + 1, i + d]
        branches = lead[:, i, i + d]
        for k in range(4, d - 4):
            branches = branches + some[:, i, i + k] * last[:, i + k + 1, i + d]
        some[:, i, i + d] = branches
    # Sums over the outer stretch: before each base, and from each base on.
    ahead, behind = np.ones((count, size + 1)), np.ones((count, size + 1))
    for j in range(size):
        low = max(0, j - span + 1)
        ahead[:, j + 1] = ahead[:, j] + (ahead[:, low : j + 1] * inside[:, low : j + 1, j]).sum(axis=1)
    for i in range(size - 1, -1, -1):
        high = min(size, i + span)
        behind[:, i] = behind[:, i + 1] + (inside[:, i, i:high] * behind[:, i + 1 : high + 1]).sum(axis=1)
    whole = ahead[:, size][:, None]
    free = np.zeros((count, size + 2, size + 2))  # weight of loops whose open bases lie between two places (shifted by one)
    # What is outside of the parts of loops with branches; ``taken`` adds up ``last_`` from each place on.
    some_, last_, taken = np.zeros_like(some), np.zeros_like(last), np.zeros((count, size, size + 1))
    for d in range(span - 1, 3, -1):
        i = np.arange(size - d)
        around = some_[:, i, i + d]
        last_[:, i, i + d] += around
        for k in range(1, d - 3):
            last_[:, i + k, i + d] += around
            free[:, i, i + k + 1] += around * last[:, i + k, i + d]
        for k in range(4, d - 4):
            some_[:, i, i + k] += around * last[:, i + k + 1, i + d]
            last_[:, i + k + 1, i + d] += around * some[:, i, i + k]
        around = last_[:, i, i + d] * branch
        for k in range(1, d - 3):
            free[:, i + d - k + 1, i + d + 2] += around * inside[:, i, i + d - k]
        taken[:, i, i + d] = taken[:, i, i + d + 1] + around
        outside[:, i, i + d] += ahead[:, i] * behind[:, i + d + 1] / whole + taken[:, i, i + d]
        closed = outside[:, i, i + d] * (inside[:, i, i + d] > 0)
        free[:, i + 1, i + d + 1] += closed * hairpins[d - 1]
        for k in range(4, d - 6):
            left, right = some[:, i + 1, i + 1 + k], last[:, i + 2 + k, i + d - 1]
            some_[:, i + 1, i + 1 + k] += closed * multi * right
            last_[:, i + 2 + k, i + d - 1] += closed * multi * left
        for _, a, b, e in steps(d):
            w = closed * e
            outside[:, i + 1 + a, i + d - 1 - b] += w
            w = w * inside[:, i + 1 + a, i + d - 1 - b]
            if a:
                free[:, i + 1, i + 2 + a] += w
            if b:
                free[:, i + d - b, i + d + 1] += w
        if inner := within(d):
            view, weight = inner
            m = len(weight)
            left, right = np.einsum("wiab,ab->wia", view, weight), np.einsum("wiab,ab->wib", view, weight)
            for a in range(1, m):
                free[:, i + 1, i + 2 + a] += closed * left[:, :, a]
                free[:, i + d - a, i + d + 1] += closed * right[:, :, m - 1 - a]
            for n in i:
                outside[:, n + 1 : n + 1 + m, n + d - m : n + d] += closed[:, n, None, None] * weight
    # Loops that begin before a stretch and end after it.
    around = np.cumsum(free, axis=1)
    around = np.cumsum(around[:, :, ::-1], axis=2)[:, :, ::-1]
    out = np.zeros((count, size, unpaired))
    for n in range(1, min(unpaired, size) + 1):
        last = np.arange(n - 1, size)
        first = last - n + 1
        out[:, last, n - 1] = ahead[:, first] * behind[:, last + 1] / whole + around[:, first, last + 2]
    return np.clip(out, 0.0, 1.0)


def profiles(sequences: list[str], window: int, span: int, unpaired: int, temperature: float = DEFAULT_TEMPERATURE) -> list[np.ndarray]:
    """energy[place, n - 1] of opening the n bases that end at a place, of each sequence; chances are means over the windows that hold them.

    Windows of one size are folded BATCH at a time, whichever sequences they are of.
    """
    rt = thermal_energy(temperature)
    bases = [codes(s) for s in sequences]
    sums, held = ([np.zeros((len(x), unpaired)) for x in bases] for _ in range(2))
    by_size = {}
    for own, base in enumerate(bases):
        size = min(window, len(base))
        by_size.setdefault(size, []).extend((own, s) for s in range(len(base) - size + 1))
    for size, starts in by_size.items():
        for at in range(0, len(starts) if size else 0, BATCH):
            some = starts[at : at + BATCH]
            chances = unpaired_chances(np.stack([bases[own][s : s + size] for own, s in some]), span, unpaired, rt)
            for k, (own, s) in enumerate(some):
                for m in range(min(unpaired, size)):
                    sums[own][s + m : s + size, m] += chances[k, m:, m]
                    held[own][s + m : s + size, m] += 1
    out = []
    for total, n in zip(sums, held):
        chance = total / np.maximum(n, 1)
        with np.errstate(divide="ignore"):
            out.append(np.where((n > 0) & (chance > 0), np.minimum(-rt * np.log(chance), CLOSED), CLOSED))
    return out


def profile(sequence: str, window: int, span: int, unpaired: int, temperature: float = DEFAULT_TEMPERATURE) -> np.ndarray:
    """``profiles`` of one sequence."""
    return profiles([sequence], window, span, unpaired, temperature)[0]


#: Bases of short tiles that are folded together, at most but for one tile.
GATHER = 16_384


def _fold(window: int, span: int, unpaired: int, temperature: float, quantised: bool):
    def folded(held):
        for (name, strand, low, offset, size, _), whole in zip(held, profiles([row[-1] for row in held], window, span, unpaired, temperature)):
            energy = whole[offset - low : offset - low + size]
            if quantised:
                energy = np.rint(energy * 10) / 10
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(energy), pa.string()),
                    pa.array([strand] * len(energy), pa.string()),
                    pa.array(np.arange(offset + 1, offset + 1 + len(energy), dtype=np.int32)),
                    pa.array(list(energy.astype(np.float32)), pa.list_(pa.float32())),
                ],
                ["chrom", "strand", "position", "u"],
            )

    def run(batches):
        held, bases = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "strand", "low", "offset", "size", "sequence"))):
                held.append(row)
                bases += len(row[-1])
                if bases >= GATHER:
                    yield from folded(held)
                    held, bases = [], 0
        if held:
            yield from folded(held)

    return run


def fold(
    records: Targets, window: int = 80, span: int = 40, unpaired: int = 30, temperature: float = DEFAULT_TEMPERATURE, quantised: bool = False, tile_size: int = 4096
) -> DataFrame:
    """(chrom, strand, position, u array<float>) of both strands of every record.

    Sequences are cut into tiles with a window's context at each end, so a chromosome is
    folded by as many tasks as it has tiles. '-' is the profile of the reverse complement,
    counted from its own start; its tiles are those of '+', turned. Stretches never open,
    or cut off by the start, get 25.5.
    """
    cut = tile(records, window, tile_size)
    ship(cut.sparkSession)
    count = F.least(F.col("size"), F.col("total") - F.col("offset"))
    plus = cut.select("id", F.lit("+").alias("strand"), "low", "offset", count.alias("size"), to_rna(F.col("sequence")).alias("sequence"))
    minus = cut.select(
        "id",
        F.lit("-").alias("strand"),
        (F.col("total") - F.col("low") - F.length("sequence")).alias("low"),
        (F.col("total") - F.col("offset") - count).alias("offset"),
        count.alias("size"),
        to_rna(reverse_complement(to_dna(F.col("sequence")))).alias("sequence"),
    )
    # By number, as few bytes are much work, which adaptive execution would put into one task.
    tasks = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = plus.union(minus).repartition(tasks, "id", "strand", "offset")
    return both.mapInArrow(_fold(window, span, unpaired, temperature, quantised), "chrom string, strand string, position int, u array<float>")
