"""Global ranking without a one-partition window (WN-1, KEY-1, SL-2).

``ntile().over(orderBy)`` sends the whole table to one task. A tile only needs
the rows that start each tile: ``global_ntiles`` sorts the keys alone by range,
counts the ranges, takes the row at each sought position out of the range that
holds it, and labels every row of the table with comparisons. That is one narrow
shuffle per order, whatever the size, and none of the table.
``global_row_number`` needs all positions: it sorts by range and adds the sizes
of the preceding ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.ordering import as_text, at_or_after, keys_of, literals, sorts
from martkit.session import scratch, staged

_POSITION_BITS = 33


def global_ntile(df: DataFrame, n: int, order, out: str = "tile") -> DataFrame:
    return global_ntiles(df, n, {out: order})


def global_ntiles(df: DataFrame, n: int, orders: dict) -> DataFrame:
    """SQL ``NTILE(n)`` for several orders at once; each order must be total."""
    fixed = staged(df, "ntile")
    tiles = []
    for out, order in orders.items():
        keys = keys_of(order)
        tile = F.lit(1)
        for texts in _tile_bounds(fixed, n, keys):
            tile = tile + at_or_after(keys, literals(fixed, keys, texts)).cast("int")
        tiles.append(tile.alias(out))
    return fixed.select("*", *tiles)


def tile_starts(total: int, n: int) -> list[int]:
    """0-based ranks at which tiles 2..n begin; the first ``total % n`` tiles
    hold one row more."""
    size, extra = divmod(total, n)
    ranks = [t * size + min(t, extra) for t in range(1, n)]
    return sorted({r for r in ranks if 0 < r < total})


def _tile_bounds(df: DataFrame, n: int, keys) -> list[list]:
    """Key texts of the rows that start tiles 2..n; only they reach the driver."""
    with scratch(_in_ranges(df.select(*dict.fromkeys(k.name for k in keys)), keys), "keys") as ranged:
        before = _sizes_before(ranged)
        total = sum(size for _, _, size in before)
        sought = {}
        for rank in tile_starts(total, n):
            found = next((r, first) for r, first, size in before if first <= rank < first + size)
            sought[(found[0] << _POSITION_BITS) + rank - found[1]] = rank
        if not sought:
            return []
        bound = F.array(*as_text(ranged, keys)).alias("bound")
        rows = ranged.filter(F.col("_at").isin(list(sought))).select("_at", bound).collect()
    return [row["bound"] for row in sorted(rows, key=lambda row: row["_at"])]


def _in_ranges(df: DataFrame, keys) -> DataFrame:
    """Rows sorted by range, ``_at`` their range and position in it."""
    ranged = df.repartitionByRange(*sorts(keys)).sortWithinPartitions(*sorts(keys))
    return ranged.withColumn("_at", F.monotonically_increasing_id())


def _sizes_before(ranged: DataFrame) -> list[tuple[int, int, int]]:
    """(range, rows before it, rows in it); one row per range."""
    sizes = ranged.groupBy(F.shiftright("_at", _POSITION_BITS).alias("range")).count().collect()
    before, out = 0, []
    for row in sorted(sizes):
        out.append((row["range"], before, row["count"]))
        before += row["count"]
    return out


def global_row_number(df: DataFrame, order, out: str = "rn", write=staged) -> DataFrame:
    """Dense 1-based row number in a total order; ``write`` says how the ranged
    rows are written down.

    The ranged rows are written down before the sizes of the ranges are
    counted, since ranges are sampled and may differ in a second run.
    """
    fixed = write(_in_ranges(df, keys_of(order)), "ranked")
    offsets = [(range_, before) for range_, before, _ in _sizes_before(fixed)]
    shift = df.sparkSession.createDataFrame(offsets, "_range long, _before long")
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = fixed.withColumn("_range", F.shiftright("_at", _POSITION_BITS)).join(F.broadcast(shift), "_range")
    return numbered.select(*df.columns, (F.col("_before") + position + 1).alias(out))


def surrogate_key(df: DataFrame, natural_key, out: str) -> DataFrame:
    """Dense integer key over distinct natural keys; the same set of natural
    keys always gets the same numbers."""
    return global_row_number(df, natural_key, out)


def top_n(df: DataFrame, n: int, order, tie) -> DataFrame:
    """First ``n`` rows; the tie-break makes the cut repeatable."""
    return df.orderBy(*sorts(keys_of(order)), *sorts(keys_of(tie))).limit(n)
