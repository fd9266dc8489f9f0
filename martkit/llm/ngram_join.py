"""N-gram Jaccard join with Bayesian candidate pruning.

Texts become sets of hashed five-word shingles. Texts with equal sets are one
class, and only classes are compared. MinHash bands propose classes that may be
similar; pairs are then compared a few MinHash values at a time, and dropped as
soon as the posterior probability that their similarity reaches the threshold
falls below a tolerance (uniform prior, binomial matches). What is left is
verified exactly on the shingle sets.

Buckets with the same members are handled once. Pairs of small buckets become
rows. Large buckets, which hold groups of copies, are joined to clusters, cut
into chunks, and chunk is compared with chunk inside a task, which returns link
counts and a spanning forest instead of pairs. No pair is written for a group,
no partner is capped, and where the line between small and large lies does not
change the result.

Defined cases: words are runs of anything but ASCII white space; a text of one
to four words is a single shingle; texts without words (null, empty) and rows
without id link with nothing and are kept; an id that is repeated with one text
counts as copies of itself, with several texts by each of them; an empty table
gives an empty result; other columns are untouched.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from martkit.llm.common import Staging, cells, components, give_back, tidy

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with a probability of 1.5e-4.
BAND, BANDS = 8, 48
#: MinHash values for the pruning, values per step, and the tolerance.
SIGNATURE, STRIDE, TOLERANCE = 96, 16, 1e-6
#: Buckets up to this size give pairs as rows; above, chunks of this size meet.
SMALL, CHUNK = 24, 1024

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    letters = rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
    k = BAND * BANDS
    return letters, rng.integers(0, 1 << 31, k, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, k, np.uint32)


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_ODD, _BACK):
        powers = np.full(1 << bits, base, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a UTF-8 text."""
    flat = b" ".join(raw.split())
    if not flat:
        return np.zeros(0, np.uint64)
    letters, _, _ = _tables()
    chars = np.frombuffer(flat, np.uint8)
    up, down = _powers(max(16, int(len(flat)).bit_length()))
    # Prefix sums of a polynomial give the hash of every stretch at once.
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(letters[chars] * up[: len(chars)], out=sums[1:])
    gaps = np.flatnonzero(chars == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(chars))
    n = max(1, len(starts) - words + 1)
    first, last = starts[:n], ends[min(words, len(ends)) - 1 :][:n]
    x = (sums[last] - sums[first]) * down[first]
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return np.unique(x ^ (x >> np.uint64(33)))


def minhash(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set, as unsigned 32-bit integers."""
    _, times, plus = _tables()
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(times), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 2048):
        part = x[None, a : a + 2048] * times[:, None]
        part += plus[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def _mark(found: np.ndarray) -> int:
    """A class: the hash of a sorted set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def _profiles(batches):
    """Class, number of shingles, values for the pruning and band keys."""
    for batch in batches:
        ids, rows = [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), cells(batch.column("text").cast(pa.binary()))):
            found = shingles(text or b"")
            if len(found):
                values = minhash(found)
                keys = [xxhash.xxh3_64_intdigest(b.tobytes(), seed=i) for i, b in enumerate(values.reshape(BANDS, BAND))]
                ids.append(doc_id)
                rows.append((_mark(found), values[:SIGNATURE].tobytes(), np.array(keys, np.uint64).astype(np.int64)))
        columns = list(zip(*rows)) or [(), (), ()]
        offsets = np.arange(0, BANDS * len(ids) + 1, BANDS, dtype=np.int32)
        keys = np.concatenate(columns[2]) if ids else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.ListArray.from_arrays(offsets, keys)],
            names=["doc_id", "cls", "sig", "bands"],
        )


@F.arrow_udf(LongType())
def _class_of(texts: pa.Array) -> pa.Array:
    out = []
    for text in cells(texts.cast(pa.binary())):
        found = shingles(text or b"")
        out.append(_mark(found) if len(found) else None)
    give_back()
    return pa.array(out, pa.int64())


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For each number of compared values, the least number of matches at which
    the posterior probability of reaching the threshold is at least the
    tolerance. With a uniform prior the posterior is a Beta distribution, whose
    upper tail is a binomial sum."""
    out = [0]
    for n in range(1, SIGNATURE + 1):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows ``a[x], b[y]`` outlive the pruning."""
    least = least_matches(threshold)
    alive, matches = np.arange(len(x)), np.zeros(len(x), np.int32)
    for k in range(0, SIGNATURE, STRIDE):
        some = slice(k, k + STRIDE)
        matches = matches + (a[x[alive], some] == b[y[alive], some]).sum(axis=1, dtype=np.int32)
        ok = matches >= least[min(k + STRIDE, SIGNATURE)]
        alive, matches = alive[ok], matches[ok]
    return alive


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SIGNATURE)


def _similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Exact test; the sets are sorted."""
    if min(len(x), len(y)) < threshold * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= threshold * (len(x) + len(y) - both) - 1e-9


def _small_pairs(threshold: float):
    """Pairs within small buckets; rows come sorted by bucket, so a bucket ends
    where the next one begins, and at most one is carried over."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        bucket, cls, weight, cluster = (table.column(c).to_numpy() for c in ("bucket", "cls", "weight", "cluster"))
        sig = _signatures(table.column("sig"))
        found = []
        for k in range(1, SMALL):
            x = np.flatnonzero(bucket[:-k] == bucket[k:])
            if not len(x):
                break
            y = x + k
            ok = (cls[x] != cls[y]) & ((cluster[x] == 0) | (cluster[x] != cluster[y]))
            x, y = x[ok], y[ok]
            for s in range(0, len(x), 100_000):
                alive = survivors(sig, sig, x[s : s + 100_000], y[s : s + 100_000], threshold)
                found.append((x[s : s + 100_000][alive], y[s : s + 100_000][alive]))
        x, y = (np.concatenate(p) if found else np.zeros(0, np.int64) for p in (list(zip(*found)) or [[], []]))
        x, y = np.where(cls[x] < cls[y], x, y), np.where(cls[x] < cls[y], y, x)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (cls[x], weight[x], cls[y], weight[y])], names=["x", "wx", "y", "wy"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            buckets = table.column("bucket").to_numpy()
            if not len(buckets):
                continue
            cut = int(np.searchsorted(buckets, buckets[-1]))
            held = table.slice(cut)
            if cut:
                yield pairs(table.slice(0, cut))
        if held is not None:
            yield pairs(held)

    return run


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            x, y = (cells(batch.column(c).cast(pa.binary())) for c in ("tx", "ty"))
            ok = pa.array([_similar(shingles(a), shingles(b), threshold) for a, b in zip(x, y)], pa.bool_())
            yield batch.drop_columns(["tx", "ty"]).filter(ok)

    return run


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1
    matrices over a slice of the vocabulary at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    flat = [np.concatenate(s) for s in (a, b)]
    owner = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b)]
    words = np.intersect1d(flat[0], flat[1])
    at = [np.searchsorted(words, f) for f in flat]
    hit = [p < len(words) for p in at]
    hit = [h & (words[np.minimum(p, max(0, len(words) - 1))] == f) if len(words) else h for h, p, f in zip(hit, at, flat)]
    at, owner = [p[h] for p, h in zip(at, hit)], [o[h] for o, h in zip(owner, hit)]
    order = [np.argsort(p, kind="stable") for p in at]
    at, owner = [p[o] for p, o in zip(at, order)], [w[o] for w, o in zip(owner, order)]
    for s in range(0, len(words), 4096):
        parts = []
        for p, o, n in zip(at, owner, (len(a), len(b))):
            lo, hi = np.searchsorted(p, (s, s + 4096))
            m = np.zeros((n, min(4096, len(words) - s)), np.float32)
            m[o[lo:hi], p[lo:hi] - s] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _forest(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that join what no earlier pair has joined."""
    above: dict[int, int] = {}

    def root(v: int) -> int:
        while (up := above.get(v, v)) != v:
            above[v] = above.get(up, up)
            v = up
        return v

    out = []
    for a, b in zip(x.tolist(), y.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            above[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _meet(threshold: float):
    """Compares two chunks of a cluster, or a chunk with itself: rows (node,
    links, other); ``other`` is null in counts, and links is 0 in forest edges."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        chunk = table.column("chunk").to_numpy()
        cls, weight = table.column("cls").to_numpy(), table.column("weight").to_numpy()
        sig = _signatures(table.column("sig").combine_chunks())
        sets = [shingles(t) for t in table.column("text").cast(pa.binary()).to_pylist()]
        left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        links = np.zeros(len(cls), np.int64)
        edges: list[tuple[int, int]] = []
        for s in range(0, len(left), 128):
            rows = left[s : s + 128]
            x, y = np.repeat(rows, len(right)), np.tile(right, len(rows))
            if low == high:
                x, y = x[x < y], y[x < y]
            alive = survivors(sig, sig, x, y, threshold)
            x, y = x[alive], y[alive]
            if not len(x):
                continue
            a, at_a = np.unique(x, return_inverse=True)
            b, at_b = np.unique(y, return_inverse=True)
            both = _overlaps([sets[i] for i in a], [sets[i] for i in b])[at_a, at_b]
            size = np.array([len(v) for v in sets], np.float64)
            ok = both >= threshold * (size[x] + size[y] - both) - 1e-9
            x, y = x[ok], y[ok]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            edges += _forest(x, y)
        edges = _forest(*np.array(edges, np.int64).reshape(-1, 2).T)
        some = np.flatnonzero(links)
        ends = np.array(edges, np.int64).reshape(-1, 2)
        node = np.concatenate([cls[some], cls[ends[:, 0]]])
        count = np.concatenate([links[some], np.zeros(len(ends), np.int64)])
        other = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cls[ends[:, 1]], pa.int64())])
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(count), "other": other})

    return run


def similarity_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, ``class_id`` (smallest id with the
    same shingles), ``n_links`` (other documents at least that similar),
    ``component_id`` (smallest id reachable by links), ``kept``."""
    return _report(docs, threshold).select("doc_id", "class_id", "n_links", "component_id", "kept")


def _report(docs: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``similarity_join`` with their class ``cls`` and ``root``, one
    class of their group; both are null where nothing is compared."""
    spark = docs.sparkSession
    staging = Staging(spark)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = slim.filter("doc_id is not null")
    fields = "doc_id long, cls long, sig binary, bands array<long>"
    profiles = staging.keep(named.mapInArrow(tidy(_profiles), fields), "profiles")
    classes = profiles.groupBy("cls").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("weight"))
    classes = staging.keep(classes, "classes")

    # One profile a class, also where a row is repeated: equal sets have equal
    # profiles, whichever row it is.
    firsts = profiles.groupBy("cls").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("weight"), F.first("sig").alias("sig"), F.first("bands").alias("bands")
    )
    banded = firsts.select("cls", F.posexplode("bands").alias("band", "key"))
    member = F.xxhash64("cls", F.lit(1)).cast("decimal(38,0)")
    buckets = banded.groupBy("band", "key").agg(
        F.count("*").alias("size"), F.min("cls").alias("least"), F.sum(member).alias("mark")
    )
    buckets = staging.keep(buckets.filter("size > 1"), "buckets")
    # Buckets with the same members are handled once.
    single = buckets.groupBy("size", "least", "mark").agg(F.min(F.struct("band", "key")).alias("b"))
    single = single.select("size", "least", F.col("b.band").alias("band"), F.col("b.key").alias("key"))
    held = banded.join(single, ["band", "key"]).withColumn("bucket", F.xxhash64("band", "key"))
    held = staging.keep(held.select("cls", "bucket", "size", "least"), "members")

    large = held.filter(F.col("size") > SMALL)
    clusters = staging.keep(components(spark, large.select(F.col("cls").alias("a"), F.col("least").alias("b"))), "clusters")
    near = held.select("cls").distinct()
    cluster = clusters.select(F.col("node").alias("cls"), F.col("root").alias("cluster"))
    known = firsts.drop("bands").join(near, "cls").join(cluster, "cls", "left").fillna(0, ["cluster"])
    known = staging.keep(known, "candidates")

    small = held.filter(F.col("size") <= SMALL).select("cls", "bucket").join(known.drop("class_id"), "cls")
    small = small.select("bucket", "cls", "weight", "cluster", "sig").repartition("bucket").sortWithinPartitions("bucket")
    pairs = small.mapInArrow(tidy(_small_pairs(threshold)), "x long, wx long, y long, wy long").distinct()
    pairs = staging.keep(pairs, "pairs")

    wanted = pairs.select(F.col("x").alias("cls")).union(pairs.select(F.col("y").alias("cls"))).distinct()
    wanted = known.select("cls", "class_id").join(wanted.union(cluster.select("cls")).distinct(), "cls")
    texts = named.join(wanted, named.doc_id == wanted.class_id).select("cls", "text")
    texts = texts.filter(F.col("cls") == _class_of.asNondeterministic()("text")).dropDuplicates(["cls"])
    texts = staging.keep(texts, "texts")

    side = lambda c: texts.select(F.col("cls").alias(c), F.col("text").alias(f"t{c}"))
    checked = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "wx", "y", "wy", "tx", "ty")
    links = staging.keep(checked.mapInArrow(tidy(_verify(threshold)), "x long, wx long, y long, wy long"), "links")

    sizes = clusters.groupBy(F.col("root").alias("cluster")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    placed = known.filter("cluster <> 0").join(sizes, "cluster").join(texts, "cls")
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(2)), F.col("chunks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = placed.select(
        "cluster", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        "chunk", "cls", "weight", "sig", "text",
    )
    dense = placed.groupBy("cluster", "low", "high").applyInArrow(_meet(threshold), "node long, links long, other long")
    dense = staging.keep(dense, "dense")

    counts = (
        links.select(F.col("x").alias("cls"), F.col("wy").alias("n"))
        .union(links.select("y", "wx"))
        .union(dense.filter("other is null").select("node", "links"))
        .groupBy("cls")
        .agg(F.sum("n").alias("n"))
    )
    edges = links.select(F.col("x").alias("a"), F.col("y").alias("b")).union(dense.filter("other is not null").select("node", "other"))
    roots = components(spark, edges).select(F.col("node").alias("cls"), "root")
    graph = classes.join(counts, "cls", "left").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = graph.groupBy("root").agg(F.min("class_id").alias("component_id"))
    graph = graph.join(least, "root").select("cls", "root", "class_id", "component_id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    graph = staging.keep(graph, "graph")
    found = profiles.select("doc_id", "cls").join(graph, "cls")
    rest = slim.select("doc_id").join(found.select("doc_id").distinct(), "doc_id", "left_anti")
    alone = rest.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    none = F.lit(None).cast("long")
    whole = found.select("doc_id", "class_id", "n_links", "component_id", "cls", "root").union(alone.withColumns({"cls": none, "root": none}))
    return whole.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` of which the smallest id of each group stays, with all
    their columns. An id that stands for several texts is judged by each of them;
    of the rows with the smallest id of one group that with the smallest text
    stays. Rows without id or without words all stay."""
    staging = Staging(docs.sparkSession)
    report = staging.keep(_report(docs, threshold), "near-copies")
    key = F.col("doc_id").cast("long")
    gone = report.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    kept = docs.join(gone, key == F.col("_gone"), "left_anti")
    several = docs.select(key.alias("_id")).filter("_id is not null").groupBy("_id").count().filter("count > 1").select("_id")
    several = staging.keep(several, "repeated-ids")
    if several.limit(1).count() == 0:
        return kept
    kept = kept.join(several, key == F.col("_id"), "left_anti")
    whole = F.struct(F.col("text"), *[F.col(c) for c in docs.columns if c != "text"])
    rows = docs.join(several, key == F.col("_id"), "left_semi")
    rows = rows.select(key.alias("id"), _class_of.asNondeterministic()(F.col("text").cast("string")).alias("cls"), whole.alias("row"))
    first = report.filter("kept and root is not null").select(F.col("doc_id").alias("id"), "cls", "root").distinct()
    one = rows.join(first, ["id", "cls"]).groupBy("root").agg(F.min("row").alias("row")).select("row")
    one = one.union(rows.filter("cls is null").select("row"))
    return one.select(*[F.col(f"row.{c}").alias(c) for c in docs.columns]).union(kept)


#: The same rows in DuckDB's SQL, by every pair of texts that share a shingle.
JOIN_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y, c = a.n AND c = b.n AS same FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 10 * c >= 8 * (a.n + b.n - c)),
both_ways AS (SELECT x, y, same FROM links UNION ALL SELECT y, x, same FROM links),
reached AS (
  SELECT x AS node, y AS seen FROM both_ways
  UNION
  SELECT node, y FROM reached JOIN both_ways ON seen = x),
roots AS (SELECT node, min(seen) AS least FROM reached GROUP BY node),
counts AS (SELECT x, count(*) AS n, min(y) FILTER (WHERE same) AS twin FROM both_ways GROUP BY x)
SELECT doc_id, least(doc_id, coalesce(twin, doc_id)) AS class_id, coalesce(n, 0) AS n_links,
  least(doc_id, coalesce(least, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(least, doc_id)) AS kept
FROM documents LEFT JOIN roots ON node = doc_id LEFT JOIN counts ON x = doc_id
"""
