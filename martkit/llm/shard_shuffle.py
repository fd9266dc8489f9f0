"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered without gaps in the order of their id. A four-round Feistel
network permutes the smallest domain of an even number of bits that holds all
numbers, and walks on along its cycle while the result lies outside; so the
numbers 0 to n-1 are permuted among themselves, by a key. The place p of a row
gives its shard p mod s and its slot p div s: shard sizes differ by one at most.
Place and row can both be computed from n, s and the key alone, without data.

Defined cases: a null text has size 1 and checksum 0; null and repeated ids are
numbered by size and checksum too, and rows alike in all three are
interchangeable; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.rank import global_row_number

ROUNDS = 4
_M = np.uint64(0xFFFFFFFFFFFFFFFF)


def _half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mix(x: np.ndarray, key: int, r: int) -> np.ndarray:
    """A 64-bit finaliser of a half, the key and the round."""
    x = x + np.uint64((key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _network(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    bits, low = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> bits, x & low
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            left, right = right ^ (_mix(left, key, r) & low), left
        else:
            left, right = right, left ^ (_mix(right, key, r) & low)
    return (left << bits) | right


def permute(rows, n: int, key: int, back: bool = False) -> np.ndarray:
    """Places of row numbers below ``n``, or with ``back`` the rows of places."""
    half = _half_bits(n)
    with np.errstate(over="ignore"):
        x = _network(np.asarray(rows).astype(np.uint64), half, key, back)
        while (out := x >= np.uint64(n)).any():
            x[out] = _network(x[out], half, key, back)
    return x.astype(np.int64)


def locate(row: int, n: int, shards: int, key: int) -> tuple[int, int]:
    """Shard and slot of a row number."""
    place = int(permute([row], n, key)[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, n: int, shards: int, key: int) -> int:
    """The row number at a shard and slot."""
    return int(permute([slot * shards + shard], n, key, back=True)[0])


def shuffle_into_shards(docs: DataFrame, shards: int, key: int, order=("doc_id",), total: int | None = None) -> DataFrame:
    """``docs`` with ``row_no`` (from 0 in that order), ``shard`` and ``slot``.

    ``order`` should be total; ``total`` saves counting the rows.
    """
    numbered = global_row_number(docs, list(order), "row_no").withColumn("row_no", F.col("row_no") - 1)
    n = docs.count() if total is None else total

    @F.arrow_udf("long")
    def place(rows: pa.Array) -> pa.Array:
        return pa.array(permute(rows.to_numpy(zero_copy_only=False), n, key))

    placed = numbered.withColumn("_place", place("row_no"))
    return placed.select(
        *[c for c in placed.columns if c != "_place"],
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.expr(f"_place div {shards}").alias("slot"),
    )


def shard_report(docs: DataFrame, shards: int = 16, key: int = 20) -> DataFrame:
    """Size, checksum, shard and slot of every document; the texts themselves
    are not shuffled."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
    )
    placed = shuffle_into_shards(slim, shards, key, ["doc_id", "size", "text_crc32"], docs.select("doc_id").count())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )
