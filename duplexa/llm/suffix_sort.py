"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, blind tries below it."""

from __future__ import annotations

import numpy as np

#: Bytes that quicksort looks at, in words of eight; a group still equal there goes to a trie.
SHALLOW = 24
SMALL = 12


def _words(strings: list[bytes], depth: int) -> np.ndarray:
    """The first ``depth`` bytes of each string as big-endian words, short strings filled up with zeros."""
    flat = b"".join([s[:depth].ljust(depth, b"\0") for s in strings])
    return np.frombuffer(flat, ">u8").reshape(len(strings), depth // 8).astype(np.uint64)


class BlindTrie:
    """A compacted trie whose inner nodes hold only the place where strings part.

    A search skips what lies between those places, ends at some string, and one
    comparison with that string tells where the new one leaves the trie.
    """

    def __init__(self):
        self.root = None

    def insert(self, s: bytes) -> None:
        if self.root is None:
            self.root = s
            return
        node = self.root
        while not isinstance(node, bytes):
            place, branches = node
            byte = s[place] if place < len(s) else -1
            node = branches[byte] if byte in branches else next(iter(branches.values()))
        if node == s:
            return
        n = min(len(s), len(node))
        lcp = next((i for i in range(n) if s[i] != node[i]), n)
        own, other = (s[lcp] if lcp < len(s) else -1), (node[lcp] if lcp < len(node) else -1)
        above, at = None, self.root
        while not isinstance(at, bytes) and at[0] < lcp:
            above = (at, s[at[0]])
            at = at[1][above[1]]
        if not isinstance(at, bytes) and at[0] == lcp:
            at[1][own] = s
            return
        made = (lcp, {own: s, other: at})
        if above is None:
            self.root = made
        else:
            above[0][1][above[1]] = made

    def ordered(self):
        stack = [] if self.root is None else [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                yield node
            else:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> np.ndarray:
    """Indices of ``strings`` in lexicographic order; equal strings keep their order."""
    n = len(strings)
    if not n:
        return np.empty(0, np.int64)
    words = _words(strings, shallow)
    out: list[np.ndarray] = []
    stack: list[tuple[np.ndarray, int]] = [(np.arange(n), 0)]
    while stack:
        index, depth = stack.pop()
        if len(index) <= SMALL:
            out.append(np.array(sorted(index.tolist(), key=strings.__getitem__), np.int64))
        elif depth == words.shape[1]:
            places: dict[bytes, list[int]] = {}
            for i in index.tolist():
                places.setdefault(strings[i], []).append(i)
            trie = BlindTrie()
            for s in places:
                trie.insert(s)
            out.append(np.array([i for s in trie.ordered() for i in places[s]], np.int64))
        else:
            column = words[index, depth]
            pivot = np.sort(column[:: max(1, len(column) // 63)])
            pivot = pivot[len(pivot) // 2]
            low, high = column < pivot, column > pivot
            for part, deeper in ((index[high], depth), (index[~low & ~high], depth + 1), (index[low], depth)):
                if len(part):
                    stack.append((part, deeper))
    return np.concatenate(out)


def common_prefixes(strings: list[bytes], order: np.ndarray) -> np.ndarray:
    """For each string in order, how many bytes it shares with the one before; 0 for the first."""
    n = len(strings)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    width = max(1, max(map(len, strings)))
    flat = np.frombuffer(b"".join([strings[i].ljust(width, b"\0") for i in order.tolist()]), np.uint8).reshape(n, width)
    size = np.array([len(strings[i]) for i in order.tolist()])
    differ = flat[1:] != flat[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    out[1:] = np.minimum(first, np.minimum(size[1:], size[:-1]))
    return out
