"""Byte-pair encoding by a deterministic automaton over tokens, built one merge gadget at a time."""

from __future__ import annotations

import hashlib
import json
import re
import string
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duplexa.llm.worker_cache import claim
from duplexa.shipping import ship

#: Words and pieces a worker remembers; rarer ones are encoded anew.
REMEMBERED = 300_000
#: States of a worker's table, some 500 bytes each with their arcs; beyond, the table begins anew.
STATES = 100_000
NEVER = 1 << 40
#: str.split() also parts these four, which the tokenizer's white space class does not hold.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SPACE = re.compile("[ \\t-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


SIGNS = string.punctuation


def chunks(text: str) -> list[str]:
    """The runs of a text between white space."""
    if any(c in text for c in SEPARATORS):
        return [x for x in SPACE.split(text) if x]
    return text.split()


def byte_letters() -> list[str]:
    """The letter of each byte: itself if printable in Latin-1, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class TokenAutomaton:
    """States are last tokens, arcs are next tokens; one path spells each word, and it is the word's encoding.

    The start has one state with an arc for each letter. The gadget of merge k, (a, b) -> c:
    c gets an arc beside every arc a whose state has arc b; the state after c copies the
    arcs which the state after b has just then; the state after a loses arc b. ``left``,
    ``right`` and ``born`` hold the gadgets in order of rank, ``pairs`` the arcs they take.
    An arc's presence follows from the two gadgets that made its ends.

    Words are read letter by letter through a table compiled from it: a state of the table
    is the set of paths still open, each a last token and the place in the tree of labels
    that the letters since have reached. Paths end at one token at most, which the table
    holds, and one for a word's last letter. Rows of the table are made when a word first
    asks for them, as the whole has more states than any text uses.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        size = max(vocab.values(), default=0) + 1
        self.left, self.right, self.born = [0] * size, [0] * size, [-1] * size
        self.pairs: dict[int, int] = {}
        self.labels = {i: t for t, i in vocab.items()}
        letters = byte_letters()
        reached = {vocab[x] for letter in letters for x in (letter, letter + suffix) if x in vocab}
        for rank, pair in enumerate(merges):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            c = vocab[self.labels[a] + self.labels[b]]
            # Without an arc b after a just now, the gadget adds no arc.
            if a in reached and b in reached and self._open(a, b, rank):
                reached.add(c)
            self.left[c], self.right[c], self.born[c] = a, b, rank
            self.pairs[a << 20 | b] = rank
        # The tree of labels: (node, letter) as one number -> node; of each node the inner and the closing token, -1 for none.
        self.tree: dict[int, int] = {}
        self.inner, self.closing, self.length = [-1], [-1], [0] * size
        for token, i in vocab.items():
            if i in reached:
                closes = bool(suffix) and token.endswith(suffix)
                text, node = (token[: -len(suffix)] if closes else token), 0
                for letter in text:
                    key = node << 21 | ord(letter)
                    node = self.tree.get(key, 0) or self.tree.setdefault(key, len(self.inner))
                    if node == len(self.inner):
                        self.inner.append(-1)
                        self.closing.append(-1)
                self.length[i] = len(text)
                if closes or not suffix:
                    self.closing[node] = i
                if not closes:
                    self.inner[node] = i
        #: Of each state its open paths and the token that ends there; the numbers of states.
        self.states: list[tuple] = []
        self.ended: list[int] = []
        self.numbers: dict[tuple, int] = {}
        #: (state, letter) as one number -> the state after it, or the token that closes the word with it.
        self.steps: dict[int, int] = {}
        self.closes: dict[int, int] = {}
        self.clear()

    def _open(self, u: int, v: int, before: int) -> bool:
        pairs, born = self.pairs, self.born
        while True:
            if pairs.get(u << 20 | v, NEVER) < before:
                return False
            if born[u] < 0 and born[v] < 0:
                return True
            if born[v] >= born[u]:
                before, v = born[v] + 1, self.left[v]
            else:
                before, u = born[u], self.right[u]

    def clear(self) -> None:
        """Begin the table anew; state 0 is before a word's first letter."""
        self.states, self.ended = [((0, -1),)], [-1]
        for table in (self.numbers, self.steps, self.closes):
            table.clear()

    def _step(self, state: int, letter: int, tokens: list[int]) -> tuple[list, int]:
        """The open paths after a letter, and the token that ends with it."""
        paths, token = [], -1
        for node, last in self.states[state]:
            node = self.tree.get(node << 21 | letter, 0)
            if node:
                paths.append((node, last))
                t = tokens[node]
                if token < 0 <= t and (last < 0 or self._open(last, t, NEVER)):
                    token = t
        return paths, token

    def _next(self, state: int, letter: int) -> int:
        paths, token = self._step(state, letter, self.inner)
        if token >= 0:
            paths.append((0, token))
        made = tuple(paths)
        number = self.numbers.setdefault(made, len(self.states))
        if number == len(self.states):
            self.states.append(made)
            self.ended.append(token)
        self.steps[state << 21 | letter] = number
        return number

    def encode(self, word: str) -> list[int]:
        """Token ids of one pre-split word given in byte letters."""
        if len(self.states) > STATES:
            self.clear()
        steps, state, ended = self.steps, 0, []
        *inner, last = map(ord, word)
        for letter in inner:
            known = steps.get(state << 21 | letter)
            state = self._next(state, letter) if known is None else known
            ended.append(self.ended[state])
        key = state << 21 | last
        token = self.closes.get(key)
        if token is None:
            token = self.closes[key] = self._step(state, last, self.closing)[1]
        out, at = [token], len(word) - self.length[token]
        while at:
            token = ended[at - 1]
            out.append(token)
            at -= self.length[token]
        return out[::-1]


class WordTokenizer:
    """A word-level BPE file: normalise, pre-split, run the automaton, and spell ids back."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.auto = TokenAutomaton(model["vocab"], model["merges"], self.suffix)
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.auto.labels |= {i: t for t, i in self.special.items()}
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = next(x["pattern"]["Regex"] for x in data["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        self.split = regex.compile(pattern)
        self.letters = byte_letters()
        self.pieces: dict[str, list[int]] = {}
        self.library = Tokenizer.from_str(spec)

    def presplit(self, text: str) -> list[str]:
        """Normalised words in byte letters.

        Beyond Latin letters, where Unicode tables differ from release to release, the
        library's own normaliser and pre-tokenizer decide.
        """
        if text.isascii():
            # Letters, and signs after them, are what the pattern would part them into.
            low = text.lower()
            base = low.rstrip(SIGNS)
            if base.isalpha():
                return [base, low[len(base) :]] if len(base) < len(low) else [base]
            return [x if x.isalnum() else "".join([self.letters[b] for b in x.encode()]) for x in self.split.findall(text.lower())]
        if max(text) >= "\u0250":
            return [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
        text = "".join(c.lower() for c in unicodedata.normalize("NFC", text))
        return ["".join([self.letters[b] for b in x.encode()]) for x in self.split.findall(text)]

    def _plain(self, text: str) -> list[int]:
        out = []
        for piece in self.presplit(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.auto.encode(piece)
                if len(self.pieces) < REMEMBERED:
                    self.pieces[piece] = ids
            out += ids
        return out

    def encode_chunk(self, text: str) -> list[int]:
        """Ids of a run without white space; special tokens in it stand for themselves."""
        if self.parts is None or "<" not in text:
            return self._plain(text)
        out = []
        for part in self.parts.split(text):
            out += [self.special[part]] if part in self.special else self._plain(part)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for chunk in chunks(text) for i in self.encode_chunk(chunk)]

    def decode(self, ids) -> str:
        """The arcs' labels in order, one space between them."""
        labels = self.auto.labels
        return " ".join([labels[i] for i in ids])


@lru_cache(maxsize=2)
def tokenizer(spec: str) -> WordTokenizer:
    return WordTokenizer(spec)


class _Remembered(dict):
    """chunk -> (ids as text, labels), computed when first asked for."""

    def __init__(self, tok: WordTokenizer):
        self.tok = tok

    def __missing__(self, chunk):
        ids = self.tok.encode_chunk(chunk)
        found = (" ".join(map(str, ids)), self.tok.decode(ids))
        if len(self) < REMEMBERED:
            self[chunk] = found
        return found


@lru_cache(maxsize=2)
def _remembered(spec: str) -> _Remembered:
    return _Remembered(tokenizer(spec))


TYPES = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def _texts(column):
    """Texts of an Arrow column; what is not whole UTF-8 cannot occur in it."""
    for x in column:
        yield x.as_py() or ""


def encode_decode(documents: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", outputs=("ids", "decoded")) -> DataFrame:
    """The id column and the chosen ``outputs`` (see TYPES) for every whole text.

    ``spec`` is the content of a tokenizers JSON file of the word-BPE kind, sent to the
    executors once. Ids equal that library's without special tokens added; ``decoded`` is
    its decode() of them. A text is cut at white space, over which no token reaches, so
    frequent words are looked up and only others run through the automaton's table. One pass, no
    shuffle. Null or empty text: no ids and an empty string. Repeated rows stay; other
    columns are ignored; an empty table gives an empty result.
    """
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(spec)
    schema = ", ".join([f"`{id_col}` {documents.schema[id_col].dataType.simpleString()}"] + [f"{c} {TYPES[c]}" for c in outputs])
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}

    def run(batches):
        known = _remembered(shared.value)
        auto = known.tok.auto
        claim(known, known.tok.pieces, auto.numbers, auto.steps, auto.closes)
        look = known.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = {c: [] for c in outputs}
                for text in _texts(part.column(1)):
                    pairs = [x for x in map(look, chunks(text)) if x[0]]
                    ids = " ".join([x[0] for x in pairs])
                    for c, into in made.items():
                        if c == "n_tokens":
                            into.append(ids.count(" ") + 1 if ids else 0)
                        elif c == "ids":
                            into.append([int(x) for x in ids.split()])
                        elif c == "ids_sha256":
                            into.append(hashlib.sha256(ids.encode()).hexdigest())
                        else:
                            decoded = " ".join([x[1] for x in pairs])
                            into.append(decoded if c == "decoded" else hashlib.sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(v, kinds.get(c, pa.string())) for c, v in made.items())], [id_col, *outputs]
                )

    return documents.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)
