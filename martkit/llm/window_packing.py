"""Hierarchical packing into windows of several lengths.

Documents are encoded whole and cut only where they are longer than the longest
window. What remains is routed to the shortest window that holds it. The long
windows are packed first: each opens with the longest piece of its tier, and its
gap is filled, best fit first, with pieces of any shorter tier. The shorter tiers
pack windows of their own size that come out full, and give the rest to long
windows again. Steps take windows of one length, as many as make the same number
of tokens, so steps weigh alike.

Pieces are dealt at random into groups of bounded size, each packed by one task
with all lengths at hand; only lengths and checksums are shuffled, no tokens.

Defined cases: a null text counts as empty and has the end id only; repeated
rows are packed as often as they come; null ids are packed like others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import Staging, tidy
from martkit.llm.tokens import by_bytes, encoder

#: Window lengths, powers of two, ascending.
TIERS = (256, 512, 1024, 2048)
#: Tokens of a full step, and the mean number of pieces in a group.
STEP, GROUP = 16_384, 20_000
#: Bytes of text that a task encodes at a time, or one text; its arrays take
#: about twenty times as much, and fewer bytes take more CPU.
TEXT_BYTES = 8 << 20
_PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, deal long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, longest: int = TIERS[-1], most: int = TEXT_BYTES) -> DataFrame:
    """Encodes every whole text; a row per piece of at most ``longest`` ids.
    ``deal`` is a random number that does not depend on the document."""

    def cut(batches):
        from pyspark import TaskContext

        code = encoder(tokenizer)
        chance = np.random.default_rng([17, TaskContext.get().partitionId()])
        for batch in batches:
            for some in by_bytes(batch, "text", most):
                rows = []
                found = code.encode([x or "" for x in some.column("text").to_pylist()])
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), found):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for a in range(0, len(ids), longest):
                        part = ids[a : a + longest]
                        rows.append((doc_id, a, len(part), zlib.crc32(part.tobytes()), len(ids)))
                names = [x.split()[0] for x in _PIECES.split(", ")]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                deal = pa.array(chance.integers(0, 1 << 62, len(rows)))
                yield pa.RecordBatch.from_arrays([*columns, deal], names=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(tidy(cut), _PIECES)


def fill(lengths: np.ndarray, tiers=TIERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window number, offset in it, and window length of each piece.

    Long windows open with the pieces that only they hold, and close their gaps
    with the longest pieces that fit. Shorter windows are kept if they come out
    full; what does not fill one goes to further long windows, so that padding is
    left in the last ones only. Numbers grow from the longest windows on.
    """
    order = np.argsort(lengths, kind="stable")
    ends = np.searchsorted(lengths[order], np.arange(tiers[-1] + 1), side="right")
    left = np.diff(np.append(0, ends)).tolist()  # pieces of each length
    there = sum(1 << n for n, k in enumerate(left) if k)  # a bit per length that is left

    def best(room: int) -> int:
        """The longest length up to ``room`` with a piece left, or 0."""
        return max(0, (there & ((2 << room) - 1)).bit_length() - 1)

    def move(length: int, by: int) -> None:
        nonlocal there
        left[length] += by
        there = there | (1 << length) if left[length] else there & ~(1 << length)

    def window_of(first: int, tier: int) -> list[int]:
        held, room = [], tier
        while first:
            move(first, -1)
            held.append(first)
            room -= first
            first = best(room)
        return held

    longest = tiers[-1]
    made: dict[int, list[list[int]]] = {t: [] for t in tiers}
    while (length := best(longest)) > tiers[-2]:
        made[longest].append(window_of(length, longest))
    for tier, below in zip(reversed(tiers[:-1]), [*reversed(tiers[:-2]), 0]):
        aside = []
        while (length := best(tier)) > below:
            held = window_of(length, tier)
            if sum(held) == tier:
                made[tier].append(held)
            else:
                for n in held[1:]:
                    move(n, 1)
                aside.append(length)
        for n in aside:
            move(n, 1)
    while length := best(longest):
        made[longest].append(window_of(length, longest))

    tops = ends.tolist()
    window, offset, size = (np.zeros(len(lengths), np.int64) for _ in range(3))
    number = 0
    for tier in reversed(tiers):
        for held in made[tier]:
            at = 0
            for n in held:
                tops[n] -= 1
                piece = order[tops[n]]
                window[piece], offset[piece], size[piece] = number, at, tier
                at += n
            number += 1
    return window, offset, size


def pack(found: DataFrame, tiers=TIERS, group: int = GROUP, step: int = STEP) -> DataFrame:
    """Windows for the rows of ``pieces``: ``sequence_id``, ``offset``,
    ``window`` (its length) and ``step_id`` are added."""
    n = found.count()
    groups = max(1, -(-n // group))

    def run(key: tuple[int, ...], rows: pd.DataFrame) -> pd.DataFrame:
        base = int(key[0]) << 32
        rows = rows.sort_values(["deal", "doc_id", "start"]).reset_index(drop=True)
        window, offset, size = fill(rows["length"].to_numpy(), tiers)
        # Windows come longest first, so the number within a tier is known.
        first = {t: window[size == t].min(initial=np.iinfo(np.int64).max) for t in tiers}
        within = window - np.array([first[t] for t in size], np.int64)
        per_step = np.maximum(1, step // size)
        rank = np.array([tiers[::-1].index(t) for t in size], np.int64)
        out = rows.assign(sequence_id=base + window, offset=offset, window=size.astype("int32"))
        out["step_id"] = base + (rank << 28) + within // per_step
        return out[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_id"]]

    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_id long"
    dealt = found.withColumn("length", F.col("length").cast("long")).withColumn("group", F.col("deal") % groups)
    return dealt.groupBy("group").applyInPandas(run, fields)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, tiers=TIERS, most: int = TEXT_BYTES) -> DataFrame:
    """Encodes and packs every document; a row per piece. A task encodes
    ``most`` bytes of text at a time."""
    found = Staging(docs.sparkSession).keep(pieces(docs, tokenizer, end_id, tiers[-1], most), "pieces")
    return pack(found, tiers)
