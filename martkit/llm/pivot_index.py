"""Near copies of vectors by a pivot-permutation index.

A bounded sample of vectors, thinned so that they lie apart, serves as pivots: a
large group of near vectors has few of its own, which its members share. Each
vector is described by its nearest pivots in order of nearness; inverted lists
hold, per pivot, the vectors that name it. Pairs of a list that share enough
pivots are verified by their cosine in double precision. A pair that shares t of
L pivots meets in a list of the first L - t + 1 of either, by number of the
pivot, so only those are listed.

How many pivots a vector names and a pair has to share is fitted to the data: a
bounded sample of vectors is compared with all rows, and of the settings that
find nearly all of its links the cheapest is taken. Where vectors crowd so that
none does, each vector names every pivot, and every pair is verified. Each
length of vectors is an index of its own; lengths that few vectors have need no
pivots, their vectors share one list.

Long lists are cut into chunks, and chunk meets chunk inside a task, which
returns counts of links and a spanning forest instead of pairs. Equal vectors
are compared once and counted by their number.

Defined cases: null, empty, zero or non-finite vectors and rows without id link
with nothing, vectors of different lengths not with each other; repeated ids
count as vectors of their own; of ties in nearness the pivot with the smaller number
comes first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import Staging, components
from martkit.llm.ngram_join import _forest

THRESHOLD = 0.9
#: Pivots that a vector may name, pivots that a pair may have to share, and the
#: most pivots: the bound of the sample and of what every task receives.
NEAREST, SHARED, MOST_PIVOTS = (12, 16, 24, 32), (3, 2, 1), 32_768
#: Vectors that settings are fitted on, links of them that a batch looks at, and
#: the share of links that a setting has to find.
FITTED, LOOKED_AT, AIM = 512, 2000, 0.97
#: Vectors of a length, at most, that share one list without pivots.
FEW = 1024
#: Vectors of a list, and pivots, that are compared at a time.
CHUNK, PIVOT_SLICE = 4096, 1024


def pivot_count(n: int) -> int:
    """Twice the square root of the vectors: lists and pivots grow alike."""
    return int(min(MOST_PIVOTS, max(NEAREST[0], 2 * math.isqrt(n))))


def _apart(sample: np.ndarray, least: float) -> np.ndarray:
    """The rows of ``sample`` that have a cosine below ``least`` with every row
    taken before them."""
    taken = np.empty_like(sample)
    n = 0
    for s in range(0, len(sample), 256):
        some = sample[s : s + 256]
        some = some[(some @ taken[:n].T).max(axis=1, initial=-2) < least]
        near, own = some @ some.T >= least, np.zeros(len(some), bool)
        for i in range(len(some)):
            own[i] = not (near[i] & own).any()
        taken[n : n + own.sum()] = some[own]
        n += own.sum()
    return taken[:n]


def thinned(sample: np.ndarray, threshold: float) -> np.ndarray:
    """Pivots of a sample of unit vectors. Apart by twice the angle of a link, no
    two lie in the group that one vector links with; where all vectors crowd in
    one direction, so that this costs most of the pivots, they may be nearer."""
    wide = max(-1.0, 2 * threshold * threshold - 1)
    most = _apart(sample, threshold)
    for least in (wide, (wide + threshold) / 2):
        found = _apart(sample, least)
        if 2 * len(found) >= len(most):
            return found
    return most


def _unit(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Row numbers and unit vectors of the usable rows of a batch."""
    rows, out = [], []
    for i, v in enumerate(column.to_pylist()):
        if v and None not in v:
            x = np.array(v, np.float64)
            top = np.abs(x).max()
            if np.isfinite(x).all() and top > 0:
                x = x / top
                rows.append(i)
                out.append(x / math.sqrt(float(x @ x)))
    return rows, out


def _units(batches):
    for batch in batches:
        rows, units = _unit(batch.column("embedding"))
        ids = batch.column("vec_id").take(pa.array(rows, pa.int64()))
        raw = [u.tobytes() for u in units]
        cls = [int(np.uint64(xxhash.xxh3_64_intdigest(r)).astype(np.int64)) for r in raw]
        columns = [ids, pa.array(cls, pa.int64()), pa.array(raw, pa.binary()), pa.array([len(u) for u in units], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cls", "unit", "dims"])


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)


def nearest(units: np.ndarray, pivots: np.ndarray, n: int = NEAREST[0]) -> np.ndarray:
    """Numbers of the nearest pivots of each vector, nearest first."""
    n = min(n, len(pivots))
    out = np.empty((len(units), n), np.int32)
    for s in range(0, len(units), 512):
        near = -(units[s : s + 512] @ pivots.T)
        some = np.argpartition(near, n - 1, axis=1)[:, :n]
        some.sort(axis=1)
        order = np.argsort(np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
        out[s : s + 512] = np.take_along_axis(some, order, axis=1)
    return out


def _shared(described: np.ndarray, rows: np.ndarray, others: np.ndarray, below: int | None = None) -> np.ndarray:
    """How many pivots each of ``rows`` shares with each of ``others``, or how
    many with a number under ``below``: products of 0/1 matrices over a slice of
    the pivots at a time."""
    pivots, times = np.unique(described, return_counts=True)
    pivots = pivots[(times > 1) & (pivots < (np.iinfo(np.int32).max if below is None else below))]
    out = np.zeros((len(rows), len(others)), np.float32)
    for s in range(0, len(pivots), PIVOT_SLICE):
        some = pivots[s : s + PIVOT_SLICE]
        parts = []
        for own in (rows, others):
            at = np.minimum(np.searchsorted(some, described[own]), len(some) - 1)
            r, k = np.nonzero(some[at] == described[own])
            named = np.zeros((len(own), len(some)), np.float32)
            named[r, at[r, k]] = 1
            parts.append(named)
        out += parts[0] @ parts[1].T
    return out


class Setting(NamedTuple):
    """The pivots of one length of vectors, how many of them a vector names and
    how many a pair has to share."""

    pivots: np.ndarray
    near: int
    shared: int


def _looked_up(pivots: np.ndarray, sample: np.ndarray, own: np.ndarray, threshold: float):
    """Per vector of the sample and setting, how many of its links with the rows
    of a batch the setting finds; near 0 counts all."""
    most = min(NEAREST[-1], len(pivots))
    named = nearest(sample, pivots, most)

    def run(batches):
        for batch in batches:
            units, cls = _matrix(batch.column("unit"), sample.shape[1]), batch.column("cls").to_numpy()
            x, y = np.nonzero(units @ sample.T >= threshold) if len(units) else (np.zeros(0, int), np.zeros(0, int))
            other = cls[x] != own[y]
            x, y = x[other], y[other]
            if len(x) > LOOKED_AT:
                some = np.sort(np.random.default_rng(len(x)).choice(len(x), LOOKED_AT, replace=False))
                x, y = x[some], y[some]
            rows = [(y, 0, 0)]
            if len(x):
                where, at = np.unique(x, return_inverse=True)
                a, b = nearest(units[where], pivots, most)[at], named[y]
                same = a[:, :, None] == b[:, None, :]
                for near in NEAREST:
                    common = same[:, :near, :near].sum(axis=(1, 2))
                    rows += [(y[common >= t], near, t) for t in SHARED]
            for who, near, t in rows:
                who, n = np.unique(who, return_counts=True)
                columns = [pa.array(who, pa.int64()), pa.array([near] * len(who), pa.int32()), pa.array([t] * len(who), pa.int32()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["who", "near", "shared", "n"])

    return run


def fit(classes: DataFrame, dims: int, n: int, threshold: float) -> Setting:
    """Pivots for the ``n`` vectors of a length, and the cheapest setting that
    finds the links of a bounded sample: of all its links and of those of the
    average vector, a share of ``AIM`` at least."""
    order = F.xxhash64("cls"), "cls"
    mine = classes.filter(F.col("dims") == dims).select("cls", "unit")
    drawn = mine.orderBy(*order).select("unit").limit(pivot_count(n)).collect()
    pivots = thinned(np.frombuffer(b"".join(r["unit"] for r in drawn), np.float64).reshape(len(drawn), dims), threshold)
    asked = mine.orderBy(F.xxhash64("cls", F.lit(7)), "cls").limit(FITTED).collect()
    sample = np.frombuffer(b"".join(r["unit"] for r in asked), np.float64).reshape(len(asked), dims)
    counter = _looked_up(pivots, sample, np.array([r["cls"] for r in asked], np.int64), threshold)
    counts = mine.mapInArrow(counter, "who long, near int, shared int, n long").groupBy("who", "near", "shared").agg(F.sum("n").alias("n"))
    found = {(r["who"], r["near"], r["shared"]): r["n"] for r in counts.collect()}  # at most FITTED times the settings
    linked = [who for who, near, _ in found if not near]
    p = len(pivots)
    # Lists grow with what is named: beyond the number of pivots, it costs more than all pairs.
    costs = {(near, t): (near - t + 1) ** 2 for near in NEAREST for t in SHARED if near < p}
    costs = {(near, t): cost for (near, t), cost in costs.items() if near == NEAREST[0] or cost <= p}
    for near, t in sorted(costs, key=costs.get):
        shares = [found.get((who, near, t), 0) / found[(who, 0, 0)] for who in linked]
        total = sum(found.get((who, near, t), 0) for who in linked) / max(1, sum(found[(who, 0, 0)] for who in linked))
        if not linked or min(total, sum(shares) / len(shares)) >= AIM:
            return Setting(pivots, near, t)
    return Setting(pivots, p, p)


def _meet(threshold: float, settings: dict[int, tuple[int, int]]):
    """Compares two chunks of a pivot's list; rows (node, links, other)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dims, pivot, low, high = (k.as_py() for k in key)
        near, shared = settings.get(dims, (1, 1))
        chunk = table.column("chunk").to_numpy()
        cls, weight = table.column("cls").to_numpy(), table.column("weight").to_numpy()
        units = _matrix(table.column("unit"), dims)
        described = np.frombuffer(b"".join(table.column("described").to_pylist()), np.int32).reshape(-1, near)
        left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        links, edges = np.zeros(len(cls), np.int64), []
        for s in range(0, len(left), 512):
            rows = left[s : s + 512]
            linked = units[rows] @ units[right].T >= threshold
            if low == high:
                linked &= rows[:, None] < right[None, :]
            if shared < near and linked.any():  # else all rows name the same pivots
                linked &= _shared(described, rows, right) >= shared
                # The list of the smallest pivot that both name counts the pair.
                linked &= _shared(described, rows, right, pivot) == 0
            x, y = np.nonzero(linked)
            x, y = rows[x], right[y]
            links += np.bincount(x, weight[y], len(cls)).astype(np.int64) + np.bincount(y, weight[x], len(cls)).astype(np.int64)
            edges += _forest(x, y)
        some = np.flatnonzero(links)
        ends = np.array(_forest(*np.array(edges, np.int64).reshape(-1, 2).T), np.int64).reshape(-1, 2)
        node = np.concatenate([cls[some], cls[ends[:, 0]]])
        count = np.concatenate([links[some], np.zeros(len(ends), np.int64)])
        other = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cls[ends[:, 1]], pa.int64())])
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(count), "other": other})

    return run


def _described(setting: Setting | None, units: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
    """The pivots that vectors name, and those in whose lists they are."""
    if setting is None:
        return [np.zeros(1, np.int32).tobytes()] * len(units), [np.zeros(1, np.int32)] * len(units)
    named = nearest(units, setting.pivots, setting.near)
    return [r.tobytes() for r in named], list(np.sort(named, axis=1)[:, : setting.near - setting.shared + 1])


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, near: int | None = None, shared: int | None = None) -> DataFrame:
    """A row per row of ``vectors`` (vec_id, embedding): ``vec_id``, ``n_links``,
    ``component_id`` (smallest id reachable by links), ``kept``. ``near`` and
    ``shared`` take the place of fitted settings."""
    spark = vectors.sparkSession
    staging = Staging(spark)
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = slim.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    units = staging.keep(usable.mapInArrow(_units, "vec_id long, cls long, unit binary, dims int"), "units")
    classes = units.groupBy("cls").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("weight"), F.first("unit").alias("unit"), F.first("dims").alias("dims"))
    classes = staging.keep(classes, "vector-classes")
    lengths = classes.groupBy("dims").agg(F.count("*").alias("n"))
    large = {r["dims"]: r["n"] for r in lengths.orderBy(F.desc("n"), "dims").limit(1).collect()}
    large |= {r["dims"]: r["n"] for r in lengths.filter(F.col("n") > FEW).collect()}  # each has more than FEW vectors
    settings = {dims: fit(classes, dims, n, threshold) for dims, n in large.items()}
    if near or shared:
        settings = {d: Setting(s.pivots, min(near, len(s.pivots)), min(shared, near, len(s.pivots))) for d, s in settings.items()}
    sent = spark.sparkContext.broadcast(settings)

    def describe(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            raw, lists = [None] * batch.num_rows, [None] * batch.num_rows
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                for i, name, listed in zip(rows.tolist(), *_described(sent.value.get(d), _matrix(batch.column("unit").take(pa.array(rows)), d))):
                    raw[i], lists[i] = name, listed
            columns = [*(batch.column(c) for c in ("cls", "weight", "unit", "dims")), pa.array(raw, pa.binary()), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "weight", "unit", "dims", "described", "pivots"])

    index = classes.select("cls", "weight", "unit", "dims").mapInArrow(describe, "cls long, weight long, unit binary, dims int, described binary, pivots array<int>")
    index = staging.keep(index, "index")
    listed = index.withColumn("pivot", F.explode("pivots"))
    sizes = listed.groupBy("dims", "pivot").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("dims", "pivot", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    placed = listed.join(sizes, ["dims", "pivot"])
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(3)), F.col("chunks")).cast("int"))
    placed = placed.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = placed.select("dims", "pivot", F.least("chunk", "met").alias("low"), F.greatest("chunk", "met").alias("high"), "chunk", "cls", "weight", "unit", "described")
    widths = {d: (s.near, s.shared) for d, s in settings.items()}
    met = placed.groupBy("dims", "pivot", "low", "high").applyInArrow(_meet(threshold, widths), "node long, links long, other long")
    met = staging.keep(met, "met")
    staging.drop(index)

    counts = met.filter("other is null").groupBy(F.col("node").alias("cls")).agg(F.sum("links").alias("n"))
    edges = met.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = components(spark, edges).select(F.col("node").alias("cls"), "root")
    graph = classes.drop("unit", "dims").join(counts, "cls", "left").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = graph.groupBy("root").agg(F.min("class_id").alias("component_id"))
    graph = graph.join(least, "root").select("cls", "component_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    found = units.select("vec_id", "cls").join(graph, "cls").select("vec_id", "n_links", "component_id")
    # Rows that are no usable vectors: what the table has beyond the units.
    every = slim.groupBy("vec_id").agg(F.count("*").alias("n"))
    used = units.groupBy(F.col("vec_id").alias("_v")).agg(F.count("*").alias("m"))
    rest = every.join(used, F.col("vec_id") == F.col("_v"), "left").withColumn("left", F.col("n") - F.coalesce("m", F.lit(0))).filter("left > 0")
    rest = rest.select("vec_id", F.explode(F.sequence(F.lit(1).cast("long"), "left"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = found.union(rest)
    return whole.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
