"""Exact repeated byte strings by a distributed difference-cover suffix order.

Suffixes are sorted where it counts. Minimizers (the least hash of 12-byte grams
in every window of 187) cut a text into phrases; what is cut inside a string of
400 bytes depends on that string alone, so equal strings have equal phrases.
Phrases that occur once end a suffix; the others form strings of symbols, of
about one symbol per 90 bytes of repeated text. Their suffixes are sorted by the
difference cover of 3: triples at positions 1 and 2 mod 3 are sorted and named,
the strings of names are sorted by recursion, the remaining suffixes are merged
in by (symbol, rank of the next) against class 1 and (two symbols, rank after)
against class 2. The recursion ends at the depth that 400 bytes can need. Then
neighbours in suffix order are compared: their common prefixes tell which runs of
phrases occur elsewhere, which an exact check of the bytes follows.

The check: windows of 400 bytes with the same first and last anchor form a
family, with a core between the anchors and up to 186 bytes of context on each
side. Families equal in all bytes repeat as a whole. Where the families of a core
differ on one side only, they are put in order by that side, and neighbours
compared. Where they differ on both, each window is hashed (128 bits).

Texts are compared by their distinct content; a text of 400 bytes or more that
occurs twice is repeated as a whole.

Defined cases: a null text counts as empty; texts shorter than 400 bytes keep
all; repeated rows and ids count as texts of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from martkit.llm.common import Staging
from martkit.llm.tokens import by_bytes
from martkit.operators.rank import global_row_number

LENGTH, GRAM, WINDOW = 400, 12, 187
#: From a window of 400 bytes to the last gram window in it.
_LAST = LENGTH - WINDOW - GRAM + 1
#: Positions that are hashed at a time; bounds the memory for long texts.
_SLICE = 1 << 21
#: Bits of the filter that spares texts without candidates a shuffle, at most.
_FILTER_BITS = 1 << 27
_BUCKET_BITS = 15
#: Bytes of text that a task takes apart at a time, or one text.
_TEXT_BYTES = 4 << 20
#: More phrases than any window has: no window begins with this one.
_NEVER = 1 << 30


# --- one text ----------------------------------------------------------------


def anchors_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, anchor): gram windows from ``start`` to the next start have their
    minimum, the rightmost of equals, at ``anchor``."""
    total = len(raw) - GRAM + 1 - WINDOW + 1
    starts, anchors, last = [], [], -1
    for s in range(0, total, _SLICE):
        n = min(_SLICE, total - s)
        grams = n + WINDOW - 1
        part = raw[s : s + grams + GRAM - 1]
        words = np.ndarray(len(part) - 7, "<u8", part, strides=(1,))
        h = words[:grams] * np.uint64(0x9E3779B97F4A7C15)
        h ^= words[GRAM - 8 : GRAM - 8 + grams] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h &= np.uint64(0xFFFFFFFF00000000)
        h |= np.uint64(0xFFFFFFFF) - np.arange(grams, dtype=np.uint64)  # the later of equals is less
        size = 1
        while size < WINDOW:
            step = min(size, WINDOW - size)
            h = np.minimum(h[:-step], h[step:])
            size += step
        at = (np.uint64(0xFFFFFFFF) - (h & np.uint64(0xFFFFFFFF))).astype(np.int64) + s
        new = np.flatnonzero(np.append(at[0] != last, at[1:] != at[:-1]))
        starts.append(new + s)
        anchors.append(at[new])
        last = int(at[-1])
    return np.concatenate(starts), np.concatenate(anchors)


def phrases_of(raw: bytes, anchors: np.ndarray) -> list[int]:
    """Symbols of the phrases from anchor to anchor, all above 0."""
    at = anchors.tolist()
    return [xxhash.xxh3_64_intdigest(raw[a : b + GRAM]) >> 1 or 1 for a, b in zip(at, at[1:])]


def families_of(n: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, number of first anchor, of last anchor)."""
    windows = n - LENGTH + 1
    low = np.unique(np.concatenate([starts, starts - _LAST]))
    low = low[(low >= 0) & (low < windows)]
    low = np.unique(np.append(0, low))
    high = np.append(low[1:] - 1, windows - 1)
    first = np.searchsorted(starts, low, side="right") - 1
    last = np.searchsorted(starts, low + _LAST, side="right") - 1
    return low, high, first, last


def _slices(batches):
    """Batches of a few megabytes of text, so that a task holds little at a time."""
    for batch in batches:
        yield from by_bytes(batch, "raw", _TEXT_BYTES)


def _parse(batches):
    """Per text its symbols; how many of them begin within 400 bytes; and the
    fewest that a window beginning there needs in common with another."""
    for batch in _slices(batches):
        rows = []
        for key, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "raw"))):
            if len(text) < LENGTH:
                continue
            starts, anchors = anchors_of(text)
            symbols = np.array(phrases_of(text, anchors), np.int64)
            reach = np.searchsorted(anchors, anchors[:-1] + LENGTH) - np.arange(len(symbols))
            _, _, first, last = families_of(len(text), starts)
            need = np.full(len(anchors), _NEVER, np.int32)
            np.minimum.at(need, first, (last - first).astype(np.int32))
            rows.append((key, doc_id, len(text), int((last - first).max()), symbols, reach.astype(np.int32), need[:-1]))
        columns = list(zip(*rows)) or [()] * 7
        ends = np.cumsum([0, *map(len, columns[4])]).astype(np.int32)
        flat = lambda parts, t: np.concatenate(parts) if parts else np.zeros(0, t)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32()),
                pa.ListArray.from_arrays(ends, flat(columns[4], np.int64)), pa.ListArray.from_arrays(ends, flat(columns[5], np.int32)),
                pa.ListArray.from_arrays(ends, flat(columns[6], np.int32)),
            ],
            names=["key", "doc_id", "n", "depth", "symbols", "reach", "need"],
        )


# --- orders over all rows -----------------------------------------------------


def counts_below(rows: DataFrame, keys: list[str], counts: list[str], staging: Staging) -> DataFrame:
    """Per distinct key the sums of ``counts`` over all smaller keys, as
    ``below_<count>``. Keys are sorted by range; each range is summed on its own
    and moved by the sums of those before it."""
    sums = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
    ranged = sums.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    fixed = staging.keep(ranged, "order").withColumn("_range", F.shiftright("_at", 33))
    totals = fixed.groupBy("_range").agg(*[F.sum(c).alias(c) for c in counts]).collect()  # one row per range
    before, shift = [0] * len(counts), []
    for row in sorted(totals):
        shift.append((row["_range"], *before))
        before = [b + row[c] for b, c in zip(before, counts)]
    fields = "_range long" + "".join(f", _shift_{c} long" for c in counts)
    running = W.partitionBy("_range").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    summed = fixed.select("*", *[F.coalesce(F.sum(c).over(running), F.lit(0)).alias(f"_run_{c}") for c in counts])
    moved = summed.join(rows.sparkSession.createDataFrame(shift, fields), "_range")
    return moved.select(*keys, *[(F.col(f"_run_{c}") + F.col(f"_shift_{c}")).alias(f"below_{c}") for c in counts])


def with_neighbours(rows: DataFrame, order: list[str], values: list[str], staging: Staging) -> DataFrame:
    """``rows`` with ``prev_`` and ``next_`` of some columns in a global order.
    Rows are numbered and cut into buckets, and those at an edge are also sent to
    the bucket beside it, so that a large group is compared by many tasks."""
    numbered = global_row_number(rows, order, "_rn", staging.keep)
    bucket = lambda x: F.shiftright(x, _BUCKET_BITS)
    rn = F.col("_rn")
    sent = numbered.withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket(rn), bucket(rn - 1), bucket(rn + 1)))))
    w = W.partitionBy("_bucket").orderBy("_rn")
    seen = sent.select("*", *[F.lag(v).over(w).alias(f"prev_{v}") for v in values], *[F.lead(v).over(w).alias(f"next_{v}") for v in values])
    return seen.filter(F.col("_bucket") == bucket(rn)).drop("_bucket", "_rn")


# --- difference cover -----------------------------------------------------------


def _triples(batches):
    """Triples at positions 1 and 2 mod 3; nothing counts after a 0."""
    for batch in batches:
        out = [[] for _ in range(5)]
        for name, s in zip(batch.column("str").to_pylist(), batch.column("s").to_pylist()):
            x = np.array([*s, 0, 0], np.int64)
            at = np.arange(len(s))
            at = at[(at % 3 != 0) & (x[:-2] != 0)]
            b = x[at + 1]
            for column, v in zip(out, (np.full(len(at), name), at, x[at], b, np.where(b != 0, x[at + 2], 0))):
                column.append(v)
        columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["str", "at", "a", "b", "c"])


def _renamed(batches):
    """Names by string become two strings, one per class; gaps become 0."""
    for batch in batches:
        names, strings = [], []
        for name, at, ranks in zip(*(batch.column(c).to_pylist() for c in ("str", "at", "names"))):
            at, ranks = np.array(at), np.array(ranks, np.int64)
            for r in (1, 2):
                own = at % 3 == r
                if own.any():
                    s = np.zeros(int(at[own].max()) // 3 + 1, np.int64)
                    s[at[own] // 3] = ranks[own]
                    names.append(2 * name + r - 1)
                    strings.append(s)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(strings, pa.list_(pa.int64()))], names=["str", "s"])


def _merge_keys(batches):
    """Per position its class, own rank, and what the merge compares."""
    for batch in batches:
        out = [[] for _ in range(8)]
        for name, s, at, ranks in zip(*(batch.column(c).to_pylist() for c in ("str", "s", "at", "names"))):
            x = np.array([*s, 0, 0], np.int64)
            r = np.zeros(len(x) + 1, np.int64)
            if at:
                r[np.array(at)] = ranks
            p = np.flatnonzero(x[:-2])
            after = x[p + 1] != 0
            columns = (np.full(len(p), name), p, p % 3, r[p], x[p], np.where(after, r[p + 1], 0), x[p + 1], np.where(after & (x[np.minimum(p + 2, len(x) - 1)] != 0), r[p + 2], 0))
            for column, v in zip(out, columns):
                column.append(v)
        columns = [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["str", "at", "cls", "own", "s0", "r1", "s1", "r2"])


def suffix_ranks(strings: DataFrame, depth: int, staging: Staging) -> DataFrame:
    """(str, at, rank) for every suffix of ``strings`` (str long, s array<long>,
    0 ends a suffix, symbols are above 0): 1 + the number of smaller suffixes, exact in the first
    ``depth`` symbols; suffixes equal in more may share a rank."""
    outer, staging = staging, Staging(staging.spark)
    triples = staging.keep(strings.mapInArrow(_triples, "str long, at long, a long, b long, c long"), "triples")
    one = triples.withColumn("n", F.lit(1).cast("long"))
    below = counts_below(one, ["a", "b", "c"], ["n"], staging)
    below = staging.keep(below.select("a", "b", "c", (F.col("below_n") + 1).alias("name")), "names")
    named = staging.keep(triples.join(below, ["a", "b", "c"]).select("str", "at", "name"), "named")
    staging.drop(triples)
    if depth > 3 and below.count() < named.count():
        by_string = named.groupBy("str").agg(F.collect_list("at").alias("at"), F.collect_list("name").alias("names"))
        shorter = staging.keep(by_string.mapInArrow(_renamed, "str long, s array<long>"), "shorter")
        inner = suffix_ranks(shorter, -(-depth // 3), staging)
        r = F.pmod("str", F.lit(2)) + 1
        sample = inner.select(F.shiftright("str", 1).alias("str"), (F.col("at") * 3 + r).alias("at"), F.col("rank").alias("name"))
    else:
        sample = named
    known = sample.groupBy("str").agg(F.collect_list("at").alias("at"), F.collect_list("name").alias("names"))
    empty = F.array().cast("array<long>")
    joined = strings.join(known, "str", "left").select("str", "s", F.coalesce("at", empty).alias("at"), F.coalesce("names", empty).alias("names"))
    fields = "str long, at long, cls long, own long, s0 long, r1 long, s1 long, r2 long"
    rows = staging.keep(joined.mapInArrow(_merge_keys, fields), "merge")
    rows = rows.select("*", *[(F.col("cls") == k).cast("long").alias(f"is{k}") for k in range(3)])
    first = counts_below(rows.filter("cls <> 2"), ["s0", "r1"], ["is0", "is1"], staging).withColumnsRenamed({"below_is0": "f0", "below_is1": "f1"})
    second = counts_below(rows.filter("cls <> 1"), ["s0", "s1", "r2"], ["is0", "is2"], staging).withColumnsRenamed({"below_is0": "g0", "below_is2": "g2"})
    placed = rows.join(first, ["s0", "r1"], "left").join(second, ["s0", "s1", "r2"], "left")
    place = F.when(F.col("cls") == 0, F.col("f0") + F.col("f1") + F.col("g2") + 1).when(F.col("cls") == 1, F.col("own") + F.col("f0")).otherwise(F.col("own") + F.col("g0"))
    ranks = outer.keep(placed.select("str", "at", place.alias("rank")), "ranks")
    staging.drop_all()
    return ranks


# --- the exact check ------------------------------------------------------------


def _candidates(batches):
    """Families whose run of phrases occurs elsewhere, by digests of the core and
    of the context on either side. Families that are equal within a text become
    one row with their number ``n``, and rows without a core for the windows that
    they cover."""
    for batch in _slices(batches):
        rows = []
        for text_no, text, at, lcps in zip(*(batch.column(c).to_pylist() for c in ("text_no", "raw", "idx", "lcps"))):
            starts, anchors = anchors_of(text)
            common = np.zeros(len(anchors), np.int64)
            np.maximum.at(common, np.array(at), np.array(lcps))
            low, high, first, last = families_of(len(text), starts)
            ok = common[first] >= last - first
            same: dict[tuple, list] = {}
            for i, j, a, z in zip(low[ok].tolist(), high[ok].tolist(), anchors[first[ok]].tolist(), anchors[last[ok]].tolist()):
                key = (_digest(text[a : z + GRAM]), _signed(text[i:a]), _signed(text[z + GRAM : j + LENGTH]))
                same.setdefault(key, []).append((i, j, a, z))
            covered = []
            for key, found in same.items():
                rows.append((text_no, *found[0], *key, len(found)))
                if len(found) > 1:
                    covered += [f[:2] for f in found]
            for i, j in _joined(covered):
                rows.append((text_no, i, j, 0, 0, None, 0, 0, 0))
        columns = list(zip(*rows)) or [()] * 9
        types = [*[pa.int64()] * 5, pa.binary(), *[pa.int64()] * 3]
        names = ["text_no", "i", "j", "a", "z", "core", "left", "right", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_digest = xxhash.xxh3_128_digest


def _joined(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Ranges of windows, joined where they touch."""
    out: list[list[int]] = []
    for i, j in sorted(ranges):
        if out and i <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return out


def _signed(raw: bytes) -> int:
    """A digest as a signed integer; the length is part of it."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(raw, seed=len(raw))).astype(np.int64))


def _surroundings(batches):
    """For a core with one left context the right one, with one right context the
    left one, reversed; for others the digest of each window."""
    for batch in _slices(batches):
        rows = []
        for text_no, text, found in zip(*(batch.column(c).to_pylist() for c in ("text_no", "raw", "found"))):
            for f in found:
                i, j, a, z = f["i"], f["j"], f["a"], f["z"]
                if f["kind"] == "right":
                    rows.append((text_no, i, j, a, z, f["kind"], f["n"], f["core"], text[z + GRAM : j + LENGTH]))
                elif f["kind"] == "left":
                    rows.append((text_no, i, j, a, z, f["kind"], f["n"], f["core"], text[i:a][::-1]))
                else:
                    for w in range(i, j + 1):
                        rows.append((text_no, w, w, a, z, f["kind"], f["n"], xxhash.xxh3_128_digest(text[w : w + LENGTH]), b""))
        columns = list(zip(*rows)) or [()] * 9
        types = [*[pa.int64()] * 5, pa.string(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["text_no", "i", "j", "a", "z", "kind", "n", "core", "side"])


def _common_prefix(a: str, b: str) -> Column:
    """Length of the common prefix of two arrays; 0 if one is null."""
    n = f"least(size({a}), size({b}))"
    differs = f"array_position(zip_with(slice({a}, 1, {n}), slice({b}, 1, {n}), (x, y) -> x = y), false)"
    return F.expr(f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 0 WHEN {differs} = 0 THEN {n} ELSE {differs} - 1 END").cast("int")


def _prefix_lengths(pairs: list[tuple[pa.Array, pa.Array]]) -> pa.Array:
    out = np.full(len(pairs[0][0]), -LENGTH, np.int32)  # nothing to compare with
    for a, b in pairs:
        for k, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
            if y is not None:
                n = min(len(x), len(y))
                if x[:n] != y[:n]:
                    n = next(i for i in range(n) if x[i] != y[i])
                out[k] = max(out[k], n)
    return pa.array(out)


def _longest_common(rows: DataFrame, staging: Staging) -> DataFrame:
    """``rows`` with ``common``: bytes that ``side`` shares with a neighbour among
    rows of the same core."""
    near = with_neighbours(rows, ["core", "side", "text_no", "i"], ["core", "side"], staging)

    @F.arrow_udf("int")
    def longest(own: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
        return _prefix_lengths([(own, before), (own, after)])

    beside = [F.when(F.col(f"{k}_core") == F.col("core"), F.col(f"{k}_side")) for k in ("prev", "next")]
    return near.withColumn("common", longest("side", *beside)).select(*rows.columns, "common")


def _removed(batches):
    """Covered bytes of every text: spans are joined, the rest is digested."""
    for batch in _slices(batches):
        rows = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "raw", "spans"))):
            kept, done, gone, runs = hashlib.sha256(), 0, 0, 0
            view, last = memoryview(text), -1
            for span in sorted((s["low"], s["high"]) for s in spans or ()):
                low, high = max(span[0], done), min(span[1], len(text))
                if span[0] > last:
                    runs += 1
                if high > low:
                    kept.update(view[done:low])
                    gone += high - low
                    done = high
                last = max(last, high)
            kept.update(view[done:])
            rows.append((doc_id, len(text), gone, runs, kept.hexdigest()))
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _member_filter(spark, keys: DataFrame):
    """A function that says of a hash column whether it may be among ``keys``
    (h long); wrong only with a yes. Its size is bounded, so it is sent to all
    tasks; where it fills up, it only spares less."""
    n = keys.count()
    bits = min(_FILTER_BITS, 1 << max(16, (32 * n).bit_length()))
    spots = keys.select(F.pmod("h", F.lit(bits)).alias("spot"))
    words = spots.groupBy(F.shiftright("spot", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(spot % 32)))").alias("b"))
    flags = np.zeros(bits // 32, np.int64)
    found = words.toPandas()  # at most bits / 32 rows
    flags[found["word"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast(flags)

    @F.arrow_udf(BooleanType())
    def may_have(h: pa.Array) -> pa.Array:
        at = np.mod(h.to_numpy(zero_copy_only=False), bits)
        return pa.array((sent.value[at >> 5] >> (at & 31)) & 1 == 1)

    return may_have


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed`` (bytes covered
    by a 400-byte string that also starts elsewhere), ``n_spans`` (maximal
    removed runs), ``kept_sha256`` (of the bytes that remain)."""
    spark, staging = docs.sparkSession, Staging(docs.sparkSession)
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("raw")).withColumn("key", F.unhex(F.md5("raw")))

    # Distinct texts, as symbols.
    fields = "key binary, doc_id long, n long, depth int, symbols array<long>, reach array<int>, need array<int>"
    parsed = known.mapInArrow(_parse, fields)
    texts = parsed.groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("depth").alias("depth"),
        F.first("symbols").alias("symbols"), F.first("reach").alias("reach"), F.first("need").alias("need"),
    )
    texts = staging.keep(texts.withColumn("text_no", F.monotonically_increasing_id()), "texts")
    depth = texts.agg(F.max("depth")).first()[0] or 1

    # Strings of phrases that occur twice or more.
    zipped = F.arrays_zip("symbols", "reach", "need")
    flat = texts.select("text_no", F.posexplode(zipped).alias("idx", "x")).select("text_no", "idx", F.col("x.symbols").alias("sym"), F.col("x.reach").alias("reach"), F.col("x.need").alias("need"))
    twice = flat.groupBy("sym").count().filter("count > 1").select("sym")
    some = flat.join(twice, "sym").groupBy("text_no").agg(F.array_sort(F.collect_list(F.struct("idx", "sym", "reach", "need"))).alias("x"))
    strings = staging.keep(some.mapInArrow(_strings, "str long, s array<long>, idx array<int>, reach array<int>, need array<int>, sure array<int>, sure_lcp array<int>"), "strings")
    ranks = suffix_ranks(strings.select("str", "s"), depth, staging)

    # Neighbours in suffix order, and what prefix they share.
    here = F.arrays_zip("s", "idx", "reach", "need")
    tails = strings.select("str", "s", F.posexplode(here).alias("at", "x")).filter("x.s <> 0")
    tails = tails.select("str", F.col("at").cast("long").alias("at"), F.col("x.idx").alias("idx"), F.col("x.need").alias("need"), F.expr("slice(s, at + 1, x.reach)").alias("tail"))
    cut = F.array_position("tail", F.lit(0).cast("long"))
    tails = tails.withColumn("tail", F.when(cut == 0, F.col("tail")).otherwise(F.slice("tail", F.lit(1), (cut - 1).cast("int"))))
    near = with_neighbours(tails.join(ranks, ["str", "at"]), ["rank", "str", "at"], ["tail"], staging)
    lcp = F.greatest(_common_prefix("tail", "prev_tail"), _common_prefix("tail", "next_tail"))
    shared = near.select(F.col("str").alias("text_no"), "idx", "need", lcp.alias("lcp")).filter("lcp >= need")
    shared = shared.groupBy("text_no").agg(F.collect_list("idx").alias("idx"), F.collect_list("lcp").alias("lcps"))
    sure = strings.filter("size(sure) > 0").select(F.col("str").alias("text_no"), F.col("sure").alias("idx"), F.col("sure_lcp").alias("lcps"))
    shared = shared.union(sure).groupBy("text_no").agg(F.flatten(F.collect_list("idx")).alias("idx"), F.flatten(F.collect_list("lcps")).alias("lcps"))
    shared = staging.keep(shared.join(texts.select("text_no", "key", "rep"), "text_no"), "shared")

    staging.drop(strings)
    staging.drop(ranks)

    # The bytes of texts with candidates, one row a text.
    marks = shared.select(F.xxhash64("key").alias("h"))
    may = _member_filter(spark, marks)
    held = known.filter(may.asNondeterministic()(F.xxhash64("key")))
    want = shared.select(F.col("key").alias("_key"), "rep", "text_no", "idx", "lcps")
    own = held.join(want.hint("merge"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    own = staging.keep(own.select("text_no", "raw", "idx", "lcps"), "bytes")
    fields = "text_no long, i long, j long, a long, z long, core binary, whole binary"
    if own.groupBy("text_no").count().filter("count > 1").limit(1).count():
        own = own.dropDuplicates(["text_no"])  # rows that are repeated with their id
    fields = "text_no long, i long, j long, a long, z long, core binary, left long, right long, n long"
    found = staging.keep(own.mapInArrow(_candidates, fields), "families")
    within = found.filter("core is null").select("text_no", "i", "j")
    families = found.filter("core is not null")
    whole = ["core", "left", "right"]
    groups = families.groupBy(*whole).agg(F.sum("n").alias("n"), F.min(F.struct("text_no", "i", "j", "a", "z")).alias("f"))
    groups = staging.keep(groups, "groups")
    full = families.join(groups.filter("n > 1").select(*whole), whole, "left_semi").select("text_no", "i", "j")

    # Where a core has several surroundings, one family of each.
    several = groups.groupBy("core").agg(
        F.count("*").alias("m"), F.expr("min(left) <> max(left)").alias("lefts"), F.expr("min(right) <> max(right)").alias("rights")
    )
    kind = F.expr("CASE WHEN NOT lefts THEN 'right' WHEN NOT rights THEN 'left' ELSE 'both' END")
    reps = groups.join(several.filter("m > 1").select("core", kind.alias("kind")), "core").select("core", "kind", "n", "f.*")
    reps = reps.groupBy("text_no").agg(F.collect_list(F.struct("i", "j", "a", "z", "kind", "core", "n")).alias("found"))
    fields = "text_no long, i long, j long, a long, z long, kind string, n long, core binary, side binary"
    sides = own.select("text_no", "raw").join(reps, "text_no").mapInArrow(_surroundings, fields)
    sides = staging.keep(sides, "surroundings")
    staging.drop(own)
    rest = F.lit(LENGTH - GRAM) - (F.col("z") - F.col("a"))
    low = F.when(F.col("kind") == "left", F.greatest(F.col("i"), F.col("a") - F.col("common"))).otherwise(F.col("i"))
    high = F.when(F.col("kind") == "right", F.least(F.col("j"), F.col("a") - rest + F.col("common"))).otherwise(F.col("j"))
    ends = _longest_common(sides.filter("kind <> 'both'"), staging)
    ends = ends.filter("n = 1").select("text_no", low.alias("i"), high.alias("j")).filter("i <= j")
    windows = sides.filter("kind = 'both'").select("text_no", "i", "j", "core")
    again = windows.groupBy("core").count().filter("count > 1").select("core")
    single = windows.join(again, "core").select("text_no", "i", "j")

    found = full.union(within).union(ends).union(single).select("text_no", F.col("i").alias("low"), (F.col("j") + LENGTH).alias("high"))
    copies = texts.filter("copies > 1").select("text_no", F.lit(0).cast("long").alias("low"), F.col("n").alias("high"))
    spans = found.union(copies).groupBy("text_no").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    spans = staging.keep(spans.join(texts.select("text_no", "key"), "text_no").select(F.col("key").alias("_key"), "spans"), "spans")
    may = _member_filter(spark, spans.select(F.xxhash64("_key").alias("h")))
    marked = known.withColumn("may", may.asNondeterministic()(F.xxhash64("key")))
    touched = marked.filter("may").join(spans.hint("merge"), F.col("key") == F.col("_key"), "left").select("doc_id", "raw", "spans")
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    none = F.lit(0).cast("long")
    clean = marked.filter("not may").select(
        "doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2("raw", 256).alias("kept_sha256")
    )
    return touched.mapInArrow(_removed, fields).union(clean)


def _strings(batches):
    """Repeated phrases of a text as one string, 0 where one is missing.

    Of a long run of one symbol, as periodic texts have, only both ends stay: the
    suffixes between are equal as far as 400 bytes reach, so their common prefix
    is ``sure`` within the text, and one of them stands for all.
    """
    for batch in batches:
        names, out = [], [[] for _ in range(6)]
        for name, x in zip(batch.column("text_no").to_pylist(), batch.column("x").to_pylist()):
            sym, idx, reach, need = (np.array([e[k] for e in x], np.int64) for k in ("sym", "idx", "reach", "need"))
            new = np.append(True, (sym[1:] != sym[:-1]) | (idx[1:] != idx[:-1] + 1))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(sym)) - 1
            stay = np.ones(len(sym), bool)
            sure = np.zeros(len(sym), bool)
            for a, b in zip(first.tolist(), last.tolist()):
                r = int(reach[a])
                if b - a > 2 * r + 2:
                    stay[a + r : b - r] = False
                    sure[a : b - r] = True
            known = np.flatnonzero(sure)
            sym, idx, reach, need, tops, at = sym[stay], idx[stay], reach[stay], need[stay], reach[known], idx[known]
            gaps = np.flatnonzero(idx[1:] != idx[:-1] + 1) + 1
            names.append(name)
            for column, v in zip(out, (np.insert(sym, gaps, 0), np.insert(idx, gaps, -1), np.insert(reach, gaps, 0), np.insert(need, gaps, 0), at, tops)):
                column.append(v)
        types = [pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([names, *out], types)], names=["str", "s", "idx", "reach", "need", "sure", "sure_lcp"])
