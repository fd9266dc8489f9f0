"""Alignment of two tokenizers over a corpus, with an identity-map fast path.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B
(sentencepiece) the text, to which it adds that space itself. Both spell out the
same bytes; where tokens of both end, the bytes are cut into groups, and all
A-B occurrences inside a group are linked.

An array, made once from the two vocabularies, gives for each A id the B id of
the same bytes. Links along it, which are the groups of one token each and most
of all links, are counted in vectors as long as the vocabulary: documents per A
id, and no pair is ever formed for them. Only the links of irregular groups
enter the shuffle, and once per block of documents instead of once per document.
Their corpus-wide counts come back to the blocks that asked, where every
document looks up its own links.

Groups never reach over an edge at which neither tokenizer joins, so pieces of
text between such edges are aligned once per task (``words``).

Defined cases: texts that are null, empty, or whose bytes under A or B are not
those of a space and the text (the mark that B writes for a space occurs in
them) have no tokens, and no links; strings of special tokens are plain text;
repeated rows and ids count as documents of their own; texts are taken a few
megabytes at a time, long ones by stretches; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import Staging, for_workers
from martkit.llm.tokens import by_bytes
from martkit.llm.words import LETTERS, MARKS, Numbers, Pieces, Ragged, literal, stretches

#: Bytes of text of a block of documents, or one text.
BLOCK_BYTES = 6 << 20
#: Pieces that a task remembers, and those it keeps when there are more.
MOST_PIECES, KEPT_PIECES = 500_000, 150_000
#: New pieces that are aligned in one call of the tokenizers.
JOINED = 4096
_SPACE = "▁"  # Fixed value: what B writes for a space.
_BREAK = "\n"


def _byte_letters() -> dict[str, int]:
    """Byte of each letter in which byte-level vocabularies write bytes: those
    that print stand for themselves, the others for letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Two tokenizers, and what is known of the pieces of text met so far."""

    #: Per piece: tokens of A and B, groups, links, and whether bytes differ.
    STATS = ("n_a", "n_b", "n_groups", "n_links", "bad")

    def __init__(self, path_a: str, path_b: str, most: int = MOST_PIECES, kept: int = KEPT_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        bytes_a = {i: added.get(i) or bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.size_a, self.size_b = max(bytes_a) + 1, self.b.get_piece_size()
        words_a = [bytes_a.get(i, b"") for i in range(self.size_a)]
        pieces_b = [self.b.id_to_piece(i) for i in range(self.size_b)]
        words_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces_b)
        ]
        self.spelled_a, self.spelled_b = _spelled(words_a), _spelled(words_b)
        # Of B ids with the same bytes, the one that is no byte on its own.
        by_word = {w: i for i, w in enumerate(words_b) if self.b.is_byte(i)}
        by_word |= {w: i for i, w in enumerate(words_b) if w and not self.b.is_byte(i) and not self.b.is_unknown(i)}
        self.same = np.array([by_word.get(w, -1) if w else -1 for w in words_a], np.int64)
        # Pieces can stand alone if no token of B joins over their edges.
        inner = [p for i, p in enumerate(pieces_b) if not self.b.is_byte(i)]
        joins = any(_BREAK in p or any(x != _SPACE and y == _SPACE for x, y in zip(p, p[1:])) for p in inner)
        ends = [self.a.encode(_BREAK, add_special_tokens=False).ids, self.b.encode(_BREAK)[1:]]
        self.whole = joins or any(len(e) != 1 for e in ends)
        self.break_a = ends[0][0]
        joined = re.compile(f"[{LETTERS}][{MARKS}]")
        self.marks = not any(joined.search(p) for p in inner)
        # How ids are written in groups: within a side, at the end of A's, of B's.
        written = [f"{i}{c}".encode() for n, ends in ((self.size_a, ",|"), (self.size_b, ",;")) for c in ends for i in range(n)]
        self.written = _spelled(written)
        self.most, self.kept = most, kept
        self._forget(0)

    def _forget(self, kept: int) -> None:
        if not kept:
            self.known, self.same_links, self.pair_links = Numbers(), Ragged(np.int32), Ragged(np.int64)
            self.texts, self.stats = [], np.zeros((0, len(self.STATS)), np.int64)
            return
        self.known.keep(kept)
        self.same_links.keep(kept)
        self.pair_links.keep(kept)
        self.texts, self.stats = self.texts[:kept], self.stats[:kept].copy()

    def _aligned(self, ids_a: np.ndarray, ids_b: np.ndarray, raw: bytes, piece_a: np.ndarray, count: int, skip: bool):
        """Facts on ``count`` pieces that stand in a row in ``raw``, or nothing
        if the bytes differ. ``piece_a`` has the piece of each A token; with
        ``skip`` the first token of each piece is a mere separator."""
        if self.spelled_a.take(ids_a)[0].tobytes() != raw or self.spelled_b.take(ids_b)[0].tobytes() != raw:
            return None
        end_a, end_b = np.cumsum(self.spelled_a.sizes(ids_a)), np.cumsum(self.spelled_b.sizes(ids_b))
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        piece = piece_a[first_a]
        real = np.ones(len(cuts), bool)
        if skip:
            real[group_a[np.append(True, piece_a[1:] != piece_a[:-1])]] = False
        texts = self._written(ids_a, ids_b, group_a, group_b, n_a, n_b, real, piece, count)
        total = lambda values: np.bincount(piece[real], values[real], count).astype(np.int64)
        stats = np.stack([total(n_a), total(n_b), total(np.ones_like(n_a)), total(n_a * n_b), np.zeros(count, np.int64)], axis=1)
        # All links: every A token with each B token of its group.
        of_a = real[group_a]
        times = n_b[group_a][of_a]
        a = np.repeat(ids_a[of_a].astype(np.int64), times)
        offset = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        b = ids_b[np.repeat(first_b[group_a][of_a], times) + offset].astype(np.int64)
        owner = np.repeat(piece_a[of_a], times)
        same = self.same[a] == b
        sizes = [np.bincount(owner[x], minlength=count) for x in (same, ~same)]
        return texts, stats, (a[same], sizes[0]), ((a * self.size_b + b)[~same], sizes[1])

    def _written(self, ids_a, ids_b, group_a, group_b, n_a, n_b, real, piece, count) -> list[bytes]:
        """The groups of each piece as text, each with its semicolon."""
        a, b = self.size_a, self.size_b
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        group = np.empty_like(code)
        for ids, of, sizes, before, plain in (
            (ids_a, group_a, n_a, np.cumsum(n_b) - n_b, 0),
            (ids_b, group_b, n_b, np.cumsum(n_a), 2 * a),
        ):
            last = np.append(of[1:] != of[:-1], True)
            place = np.arange(len(ids)) + before[of]
            code[place] = ids + plain + last * (b if plain else a)
            group[place] = of
        kept = real[group]
        raw, sizes = self.written.take(code[kept])
        ends = np.cumsum(np.bincount(piece[group[kept]], sizes, count)).astype(np.int64).tolist()
        raw = raw.tobytes()
        return [raw[x:y] for x, y in zip([0, *ends], ends)]

    def _alone(self, text: str):
        """One piece that opens with a space or follows a line break."""
        ids_a = np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        ids_b = np.array(self.b.encode(text[1:] if text[0] == " " else _BREAK + text)[0 if text[0] == " " else 2 :], np.int64)
        if text == " ":  # B reads nothing there, and writes its space only before something
            ids_b = np.array(self.b.encode(_BREAK)[:1], np.int64)
        facts = self._aligned(ids_a, ids_b, text.encode(), np.zeros(len(ids_a), np.int64), 1, False)
        nothing = (np.zeros(0, np.int64), np.zeros(1, np.int64))
        return facts or ([b""], np.array([[0, 0, 0, 0, 1]]), nothing, nothing)

    def _in_a_row(self, pieces: list[str], breaks: bool):
        """Pieces that open with a line break (or are put after one)."""
        joined = "".join(pieces) if breaks else _BREAK + _BREAK.join(literal(p, self.marks) for p in pieces)
        ids_a = np.array(self.a.encode(joined, add_special_tokens=False).ids, np.int64)
        ids_b = np.array(self.b.encode(joined)[1:], np.int64)
        piece_a = np.cumsum(ids_a == self.break_a) - 1
        fits = len(ids_a) and piece_a[0] == 0 and piece_a[-1] == len(pieces) - 1
        return self._aligned(ids_a, ids_b, joined.encode(), piece_a, len(pieces), not breaks) if fits else None

    def _learn(self) -> None:
        new, self.known.new = self.known.new, []
        kinds = [[], [], []]
        for i, p in enumerate(new):
            odd = type(p) is tuple or not p or _SPACE in p
            kinds[2 if odd or p == _BREAK else int(p[0] == _BREAK)].append(i)
        order, parts = [], []
        for kind, chosen in enumerate(kinds[:2]):
            for k in range(0, len(chosen), JOINED):
                some = chosen[k : k + JOINED]
                facts = self._in_a_row([new[i] for i in some], bool(kind))
                if facts is None:
                    kinds[2] += some
                else:
                    order += some
                    parts.append(facts)
        for i in kinds[2]:
            order.append(i)
            parts.append(self._alone(literal(new[i], self.marks)))
        # In the order of the numbers that the pieces have.
        place = np.argsort(np.array(order, np.int64))
        texts = [t for p in parts for t in p[0]]
        self.texts += [texts[i] for i in place.tolist()]
        self.stats = np.concatenate([self.stats, np.concatenate([p[1] for p in parts])[place]])
        for which, held in ((2, self.same_links), (3, self.pair_links)):
            loose = Ragged(held.flat.dtype)
            loose.add(np.concatenate([p[which][0] for p in parts]), np.concatenate([p[which][1] for p in parts]))
            held.add(*loose.take(place))

    def numbers(self, pieces: Pieces) -> np.ndarray:
        """The number of each piece; facts on it are in the other attributes."""
        if len(self.known) > self.most:
            self._forget(self.kept)
        at = pieces.numbered(self.known)
        if self.known.new:
            self._learn()
        return at


def _spelled(words: list[bytes]) -> Ragged:
    out = Ragged(np.uint8)
    out.add(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))
    return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Counts:
    """Occurrences per document and link, gathered by stretches."""

    def __init__(self, size: int):
        self.size, self.keys, self.times = size, [], []

    def add(self, documents: np.ndarray, links: np.ndarray) -> None:
        keys, times = np.unique(documents * self.size + links, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)

    def done(self, dropped: np.ndarray):
        """(document, link, times) without the dropped documents."""
        if not self.keys:
            return np.zeros((3, 0), np.int64)
        if len(self.keys) == 1:
            keys, times = self.keys[0], self.times[0]
        else:
            keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            times = np.bincount(at, np.concatenate(self.times)).astype(np.int64)
        documents = keys // self.size
        kept = ~dropped[documents]
        return documents[kept], keys[kept] % self.size, times[kept]


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32 in few bytes: by byte planes, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return np.uint64(len(values)).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw[:8], np.uint64)[0])
    planes = np.frombuffer(pa.decompress(raw[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_STATS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.string()))]
    + [(n, pa.list_(pa.int64())) for n in (*_STATS, "same", "same_docs", "pairs", "pair_docs")]
    + [(f"{kind}_{n}", pa.binary()) for kind in ("same", "pair") for n in ("sizes", "at", "times")]
)
_BLOCK_DDL = ", ".join(
    f"{f.name} " + ("binary" if f.type == pa.binary() else "long" if f.type == pa.int64() else f"array<{'string' if f.name == 'digests' else 'long'}>")
    for f in _BLOCK
)


def _blocks(path_a: str, path_b: str):
    """A row per block of documents, with its links and how often each document
    has them."""

    def run(batches):
        machine = aligner(path_a, path_b)
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in by_bytes(batch, "text", BLOCK_BYTES):
                yield _block(machine, (part << 32) + done, rows)
                done += 1

    return run


def _whole(texts: list):
    """Each text as one piece, for tokenizers that join over any edge."""
    for k, text in enumerate(texts):
        if text:
            pieces = Pieces()
            pieces.add([[(" " + text,)]])
            yield pieces, [k], [1]


def _block(machine: Aligner, block: int, rows: pa.RecordBatch) -> pa.RecordBatch:
    texts = rows.column("text").to_pylist()
    n = len(texts)
    stats = np.zeros((n, len(machine.STATS)), np.int64)
    digests = [None] * n
    same, pairs = _Counts(machine.size_a), _Counts(machine.size_a * machine.size_b)
    for pieces, owners, ends in _whole(texts) if machine.whole else stretches(texts, spaced=True, marks=machine.marks):
        at = machine.numbers(pieces)
        edges = [0, *ends]
        document = np.repeat(np.array(owners, np.int64), np.diff(edges))
        for column in range(stats.shape[1]):
            stats[:, column] += np.bincount(document, machine.stats[at, column], n).astype(np.int64)
        for counts, held in ((same, machine.same_links), (pairs, machine.pair_links)):
            links, sizes = held.take(at)
            counts.add(np.repeat(document, sizes), links.astype(np.int64))
        spelled = [machine.texts[i] for i in at.tolist()]
        for k, x, y in zip(owners, edges, ends):
            if digests[k] is None:
                digests[k] = hashlib.sha256()
            else:  # the semicolon after the last stretch
                digests[k].update(b";")
            digests[k].update(b"".join(spelled[x:y])[:-1])
    bad = (stats[:, -1] > 0) | np.array([d is None for d in digests], bool)
    stats[bad] = 0
    columns = [[block], [rows.column("doc_id").to_pylist()], [["" if x else d.hexdigest() for x, d in zip(bad, digests)]]]
    columns += [[stats[:, i].tolist()] for i in range(len(_STATS))]
    packed = []
    for counts in (same, pairs):
        document, link, times = counts.done(bad)
        links, at, documents = np.unique(link, return_inverse=True, return_counts=True)
        columns += [[links], [documents]]
        packed += [[_packed(np.bincount(document, minlength=n))], [_packed(at)], [_packed(times)]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns + packed, _BLOCK)], schema=_BLOCK)


def _answers(size_b: int, same_count, best_count):
    """Rows of the report from blocks and the counts of their pairs."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield _answer(batch.slice(row, 1).to_pydict(), size_b, same_count.value, best_count.value)

    return run


def _answer(block: dict, size_b: int, same_count: np.ndarray, best_count: np.ndarray) -> pa.RecordBatch:
    held = {k: v[0] for k, v in block.items()}
    n = len(held["doc_ids"])
    totals = {"same": same_count[held["same"]], "pair": np.array(held["totals"] or [], np.int64)}
    first = {"same": np.array(held["same"], np.int64), "pair": np.array(held["pairs"], np.int64) // size_b}
    n_best, count_sum = np.zeros((2, n), np.int64)
    for kind in ("same", "pair"):
        document = np.repeat(np.arange(n), _unpacked(held[f"{kind}_sizes"]))
        at, times = _unpacked(held[f"{kind}_at"]), _unpacked(held[f"{kind}_times"])
        count, a = totals[kind][at], first[kind][at]
        np.add.at(n_best, document, times * (count == best_count[a]))
        np.add.at(count_sum, document, times * count)
    columns = [held["doc_ids"], *(held[c] for c in _STATS), n_best, count_sum, held["digests"]]
    names = ["doc_id", *_STATS, "n_best", "count_sum", "groups_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "groups_sha256" else pa.int64()) for k, c in zip(names, columns)], names=names)


def link_report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: tokens of A and B, groups, links, links whose pair is
    the most frequent of its A id (``n_best``), the sum of the links' counts, and
    the digest of the groups. The count of a pair is the number of documents
    that hold it linked."""
    spark = docs.sparkSession
    for_workers(spark)
    staging = Staging(spark)
    vocabulary = aligner(path_a, path_b)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = staging.keep(rows.mapInArrow(_blocks(path_a, path_b), _BLOCK_DDL), "blocks")

    def each(ids: str, documents: str) -> DataFrame:
        entries = F.explode(F.arrays_zip(ids, documents)).alias("e")
        return blocks.select("block", entries).select("block", F.col(f"e.{ids}").alias("link"), F.col(f"e.{documents}").alias("n"))

    def vector(counts: DataFrame) -> np.ndarray:
        """One number per A id: at most the size of the vocabulary."""
        out = np.zeros(vocabulary.size_a, np.int64)
        found = counts.toPandas()
        out[found["a"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
        return out

    same_count = vector(each("same", "same_docs").groupBy(F.col("link").alias("a")).agg(F.sum("n").alias("n")))
    asked = each("pairs", "pair_docs")
    totals = staging.keep(asked.groupBy("link").agg(F.sum("n").alias("total")), "totals")
    a = F.expr(f"link div {vocabulary.size_b}").alias("a")
    best_count = np.maximum(same_count, vector(totals.groupBy(a).agg(F.max("total").alias("n"))))

    # Both sides have their links in order, so the totals are a list alone.
    entry = F.array_sort(F.collect_list(F.struct("link", "total")))
    back = asked.select("block", "link").join(totals, "link").groupBy("block").agg(entry.alias("e"))
    answered = blocks.join(back.select("block", F.col("e.total").alias("totals")), "block", "left")
    send = spark.sparkContext.broadcast
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in (*_STATS, "n_best", "count_sum")) + ", groups_sha256 string"
    return answered.mapInArrow(_answers(vocabulary.size_b, send(same_count), send(best_count)), schema)
