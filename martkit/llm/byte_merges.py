"""Byte-level BPE by a segment tree, encoding and decoding.

The bytes of a word are the leaves of a segment tree. A leaf holds the rank of
the pair that begins there, with its position; an inner node the least of its
two children, so the root is the leftmost pair of the lowest rank. A merge
writes the new token over the pair, takes the second part out of the chain of
live neighbours, and updates three leaves and their ancestors: the taken out
one, the new pair to the right and the new pair to the left.

Short words are merged many at a time: a forest of trees of equal width, one
column each, whose roots are merged in the same numpy step. A long word has a
tree of its own. Each distinct piece of text is encoded once per task, what
follows is a look-up.

Defined cases: null counts as empty, empty texts have no ids; a word that is a
token as a whole is that token, as in the library; a task holds a bounded
number of words, and texts are taken a few megabytes at a time, long ones by
stretches of pieces; repeated rows and ids each give a row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import for_workers
from martkit.llm.tokens import by_bytes
from martkit.llm.words import Numbers, Pieces, Ragged, first_runs, literal, stretches

#: Widest tree of a forest, in bytes; longer words have their own tree.
FOREST = 64
#: Trees of a forest that are merged together: bounds the memory of a step.
TREES = 1 << 14
#: Pieces that a task remembers, and those it keeps when there are more.
MOST_PIECES, KEPT_PIECES = 500_000, 100_000
#: Bytes of text taken at a time, or one text.
TEXT_BYTES = 4 << 20
_NONE = np.int64(1) << 62


class Vocabulary:
    """Ranks of a tiktoken file: the rank of a token is its id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = dict(zip(self.ids.values(), self.ids))
        size = max(self.tokens) + 1
        self.shift = size.bit_length()
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        # Each way to put a token together from two: what a merge looks up.
        joins = {
            (left << self.shift) | right: i
            for token, i in self.ids.items()
            for k in range(1, len(token))
            if (left := self.ids.get(token[:k])) is not None and (right := self.ids.get(token[k:])) is not None
        }
        self.joins = joins
        keys = np.fromiter(joins, np.int64, len(joins))
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.fromiter(joins.values(), np.int64, len(joins))[order], _NONE)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or none; a negative id has no pair."""
        key = np.where((left < 0) | (right < 0), -1, (left << self.shift) | right)
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE)


def merge_long(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word, by a tree of its own."""
    n, joins, shift = len(word), vocabulary.joins, vocabulary.shift
    if n < 2:
        return vocabulary.byte_ids[list(word)].tolist()
    width = 1 << (n - 1).bit_length()
    bits, none = width.bit_length(), int(_NONE)
    token = array("q", vocabulary.byte_ids[np.frombuffer(word, np.uint8)].tobytes())
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    tree = array("q", [none]) * (2 * width)
    for i in range(n - 1):
        found = joins.get(token[i] << shift | token[i + 1])
        if found is not None:
            tree[width + i] = found << bits | i
    for node in range(width - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b

    def update(place: int, left: int, right: int) -> None:
        """Sets the leaf of ``place`` to the pair (left, right), or to none."""
        found = joins.get(token[left] << shift | token[right]) if 0 <= left and right < n else None
        value = none if found is None else found << bits | place
        node = width + place
        while node and tree[node] != value:
            tree[node] = value
            other = tree[node ^ 1] if node > 1 else none
            value = value if value < other else other
            node >>= 1

    while tree[1] != none:
        at = tree[1] & ((1 << bits) - 1)
        gone = after[at]
        token[at], right = tree[1] >> bits, after[gone]
        after[at] = right
        if right < n:
            before[right] = at
        update(gone, -1, n)
        update(at, at, right)
        left = before[at]
        if left >= 0:
            update(left, left, at)
    out, at = [], 0
    while at < n:
        out.append(token[at])
        at = after[at]
    return out


def merge_forest(words: list[bytes], width: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words of at most ``width`` bytes (a power of two), one tree each:
    all ids in a row, and their number for each word."""
    count, bits = len(words), width.bit_length()
    sizes = np.fromiter(map(len, words), np.int64, count)
    cells = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(count, width).T
    places = np.arange(width)[:, None]
    token = np.full((width + 2, count), -1, np.int64)  # the last two rows stand for no neighbour
    token[:width] = np.where(places < sizes, vocabulary.byte_ids[cells], -1)
    after, before = np.empty((2, width + 2, count), np.int64)
    after[:], before[:] = np.arange(1, width + 3)[:, None], np.arange(-1, width + 1)[:, None]
    after[:width][places + 1 >= sizes] = width
    after[width:], before[0] = width, width + 1

    tree = np.full((2 * width, count), _NONE, np.int64)
    ranks = vocabulary.rank(token[: width - 1], token[1:width])
    tree[width : 2 * width - 1] = np.where(ranks == _NONE, _NONE, ranks << bits | places[:-1])
    level = width
    while level > 1:
        tree[level // 2 : level] = np.minimum(tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2])
        level //= 2

    def update(place: np.ndarray, word: np.ndarray, value: np.ndarray) -> None:
        node = place + width
        tree[node, word] = value
        for _ in range(bits - 1):
            value = np.minimum(value, tree[node ^ 1, word])
            node = node >> 1
            tree[node, word] = value

    def pair(place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        ranks = vocabulary.rank(left, right)
        return np.where(ranks == _NONE, _NONE, ranks << bits | place)

    word = np.flatnonzero(tree[1] != _NONE)
    while len(word):
        root = tree[1, word]
        at, rank = root & ((1 << bits) - 1), root >> bits
        gone = after[at, word]
        right = after[gone, word]
        token[at, word], token[gone, word] = rank, -1
        after[at, word], before[right, word] = right, at
        update(gone, word, np.full(len(word), _NONE))
        update(at, word, pair(at, rank, token[right, word]))
        left = before[at, word]
        has = left < width
        update(left[has], word[has], pair(left[has], token[left[has], word[has]], rank[has]))
        word = word[tree[1, word] != _NONE]
    live = token[:width].T
    held = live >= 0
    return live[held], held.sum(axis=1)


class Coder:
    """Encodes and decodes texts, and remembers the pieces it has met."""

    def __init__(self, path: str, pattern: str, most: int = MOST_PIECES, kept: int = KEPT_PIECES):
        import regex

        self.vocabulary = Vocabulary(path)
        # White space as in Unicode; Python's \s has four separators more.
        plain = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(plain)
        self.most, self.kept = most, kept
        self.known, self.found = Numbers(), Ragged(np.uint32)
        size = max(self.vocabulary.tokens) + 1
        held = [self.vocabulary.tokens.get(i, b"") for i in range(size)]
        self.spelled = Ragged(np.uint8)
        self.spelled.add(np.frombuffer(b"".join(held), np.uint8), np.fromiter(map(len, held), np.int64, size))

    def words(self, text: str) -> list[bytes]:
        """The matches of the pattern."""
        body = text[1:] if text[:1] == " " else text
        return [text.encode()] if body.isalpha() else [m.encode() for m in self.pattern.findall(text)]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and their number for each word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        known = np.fromiter((self.vocabulary.ids.get(w, -1) for w in words), np.int64, len(words))
        counts = np.where(known >= 0, 1, 0)
        parts, owners = [known[known >= 0]], [np.flatnonzero(known >= 0)]
        widths = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64)
        for width in np.unique(widths[known < 0]).tolist():
            chosen = np.flatnonzero((known < 0) & (widths == width))
            step = TREES if width <= FOREST else 1
            for a in range(0, len(chosen), step):
                some = chosen[a : a + step]
                if width <= FOREST:
                    ids, n = merge_forest([words[i] for i in some], width, self.vocabulary)
                else:
                    ids = np.array(merge_long(words[some[0]], self.vocabulary), np.int64)
                    n = np.array([len(ids)])
                counts[some] = n
                parts.append(ids)
                owners.append(np.repeat(some, n))
        order = np.argsort(np.concatenate(owners), kind="stable")
        return np.concatenate(parts)[order], counts

    def _learn(self) -> None:
        split = [self.words(literal(p)) for p in self.known.new]
        self.known.new = []
        flat = [w for words in split for w in words]
        ids, counts = self.merge(flat)
        ends = np.cumsum([0, *map(len, split)])
        upto = np.append(0, np.cumsum(counts))
        self.found.add(ids, upto[ends[1:]] - upto[ends[:-1]])

    def encode(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and their number for each piece."""
        if len(self.known) > self.most:
            self.known.keep(self.kept)
            self.found.keep(self.kept)
        at = pieces.numbered(self.known)
        if self.known.new:
            self._learn()
        return self.found.take(at)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.spelled.take(ids)[0].tobytes()

    def encode_text(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        pieces = Pieces()
        pieces.add(first_runs(text))
        return self.encode(pieces)[0]


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def _digests(path: str, pattern: str):
    def run(batches):
        machine = coder(path, pattern)
        for batch in batches:
            for part in by_bytes(batch, "text", TEXT_BYTES):
                texts = part.column("text").to_pylist()
                counts = np.zeros(len(texts), np.int64)
                marks = [(hashlib.sha256(), hashlib.sha256()) for _ in texts]
                for pieces, owners, ends in stretches(texts, spaced=False):
                    ids, sizes = machine.encode(pieces)
                    raw, decoded = ids.astype("<u4").tobytes(), machine.decode(ids)
                    lengths = np.append(0, np.cumsum(machine.spelled.sizes(ids)))
                    upto = np.append(0, np.cumsum(sizes))[[0, *ends]]
                    for k, x, y in zip(owners, upto.tolist(), upto[1:].tolist()):
                        counts[k] += y - x
                        marks[k][0].update(raw[4 * x : 4 * y])
                        marks[k][1].update(decoded[lengths[x] : lengths[y]])
                rows = [(i.hexdigest(), d.hexdigest()) for i, d in marks]
                columns = [part.column("doc_id"), pa.array(counts), *(pa.array([r[c] for r in rows], pa.string()) for c in (0, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def merge_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids_sha256`` (ids as
    little-endian 32-bit integers) and ``decoded_sha256`` (bytes that the ids
    decode to)."""
    for_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(_digests(path, pattern), schema)
