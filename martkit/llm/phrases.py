"""Phrase collocations by prefix-free parsing.

Every text becomes a sequence of words and breaks. Where the hash of three
neighbouring words is a multiple of a parameter, a chunk ends, and the next one
begins with those three: content alone decides where. So copies fall apart into
the same chunks, and the corpus is a dictionary of distinct chunks, each with
the number of times that the parse has it. N-grams of up to four words are
counted inside the chunks of the dictionary only, weighted by that number; one
that lies in the three words that two chunks share counts in the first alone.

A phrase is frequent only if all its parts are. Words are counted first, then
pairs of words that may be frequent, then longer phrases of pairs that may be.
What may be is told by a filter of bounded size, which errs on the side of yes
and so never loses a phrase; the counts themselves are exact.

A frequent phrase is scored by its weakest cut, dropped if a longer one explains
it, and ranked within its language, in parts first, so that no task gets all
phrases of a large language.

Defined cases: the language null is ``und``; null, empty and blank texts have no
words; repeated rows count as often as they come; long texts are cut into chunks
like any other, and where nothing triggers, after a fixed number of words; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.llm.common import Staging, for_workers
from martkit.llm.tokens import by_bytes
from martkit.llm.words import encoded

LEAST, TOP, COVER = 30, 2000, 80
WORDS = 4
#: Words that neighbouring chunks share, words of a chunk on average, at most.
OVERLAP, MEAN, LONGEST = WORDS - 1, 32, 4096
#: Bits of the filter of parts that may be frequent, at most.
FILTER_BITS = 1 << 27
_BITMAP = 1 << 15  # Fixed value: bits of a bitmap of Spark's bitmap functions.
#: Bytes of text that are parsed, and of chunks that are counted, at a time.
PARSED, COUNTED = 4 << 20, 12 << 20
#: Parts that the phrases of a language are ranked in before the last ranking.
PARTS = 64

_BREAK = b"\n"
_PAD = b" \n" * OVERLAP
# Ends of pieces become line breaks, tabs spaces.
_SIGNS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pieces_of(text: str) -> list[bytes]:
    """Pieces of a text that have words, in lower case (A to Z)."""
    return [p for p in map(bytes.strip, text.encode().lower().translate(_SIGNS).split(_BREAK)) if p]


def parse(texts: list[list[bytes]], mean: int = MEAN, longest: int = LONGEST) -> list[tuple[int, bytes]]:
    """(number of the text, chunk) for texts given as pieces, all with words.
    A chunk is words and breaks with a space between; a text begins and ends
    with as many breaks as chunks share words, so that all chunks are alike."""
    joined = _PAD[1:] + b" " + (_PAD + b" ").join(b" \n ".join(p) for p in texts) + _PAD
    if b"  " in joined:
        joined = b" ".join(t for t in joined.split(b" ") if t)
    ids, words, starts = encoded(joined)
    distinct = words.to_pylist()
    h = np.fromiter(map(zlib.crc32, distinct), np.uint64, len(distinct))[ids]
    seen = h[2:] + np.uint64(0x9E3779B97F4A7C15) * (h[1:-1] + np.uint64(0x9E3779B97F4A7C15) * h[:-2])
    edge = ids == distinct.index(_BREAK)
    edge = edge[2:] & edge[1:-1] & edge[:-2]  # pieces have words, so only texts are this far apart
    at = np.flatnonzero((_mixed(seen) % np.uint64(mean) == 0) | edge) + 2
    far = np.flatnonzero(np.diff(at) > longest)
    if len(far):
        more = [np.arange(at[i] + longest, at[i + 1], longest) for i in far]
        at = np.unique(np.concatenate([at, *more]))
    number = np.cumsum(edge[at - 2])[:-1] - 1
    first, last = starts[at[:-1] - 2].tolist(), (starts[at[1:] + 1] - 1).tolist()
    return [(k, joined[x:y]) for k, x, y in zip(number.tolist(), first, last)]


def _chunks(batches):
    for batch in batches:
        for part in by_bytes(batch, "text", PARSED):
            langs, texts = [], []
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                pieces = pieces_of(text or "")
                if pieces:
                    langs.append(lang)
                    texts.append(pieces)
            rows = parse(texts) if texts else []
            columns = [pa.array([langs[k] for k, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk"])


def dictionary_of(docs: DataFrame) -> DataFrame:
    """The distinct chunks of each language, with their parse frequency."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_chunks, "lang string, chunk binary").groupBy("lang", "chunk").agg(F.count("*").alias("n"))


def _seed(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang)


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = _seed(lang)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sum of their weights."""
    if (weights == 1).all():
        return np.unique(keys, return_counts=True)
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights, len(found)).astype(np.int64)


def _phrases(lang: str, chunks: list[bytes], times: np.ndarray, sizes: range, words_may=None, pairs_may=None):
    """(phrases, counts, words) of the n-grams of chunks, by number of words."""
    ids, words, _ = encoded(b" \n ".join(chunks))
    ids = ids.astype(np.int64)
    distinct, count = words.to_pylist(), len(words)
    lengths = np.fromiter((c.count(b" ") for c in chunks), np.int64, len(chunks)) + 2  # a break after each
    lengths[-1] -= 1
    weight = np.repeat(times, lengths)
    # What ends in the words that a chunk shares lies in the chunk before as well.
    own = np.ones(len(ids), bool)
    starts = np.cumsum(lengths) - lengths
    own[(starts[:, None] + np.arange(OVERLAP)).ravel()] = False
    spelled = lambda *parts: parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, b" ")
    real = np.fromiter((w != _BREAK for w in distinct), bool, count)
    if sizes[0] == 1:
        x = np.flatnonzero(own & real[ids])
        sums = np.bincount(ids[x], weight[x], count).astype(np.int64)
        found = np.flatnonzero(sums)
        yield words.take(pa.array(found)), sums[found], 1
        return
    hashes = _word_hashes(lang, distinct)
    known = (real & words_may(hashes))[ids]
    pair = np.append(False, known[1:] & known[:-1])
    if sizes[0] == 2:
        x = np.flatnonzero(pair & own)
        found, sums = _summed(ids[x - 1] * count + ids[x], weight[x])
        yield spelled(words.take(pa.array(found // count)), words.take(pa.array(found % count))), sums, 2
        return
    # Longer ones out of pairs that may be frequent.
    x = np.flatnonzero(pair)
    pair[x] = pairs_may(_pair_hash(hashes[ids[x - 1]], hashes[ids[x]]))
    three = np.append(False, pair[1:] & pair[:-1])
    four = np.append(False, three[1:] & three[:-1])
    for size, some in ((3, three), (4, four)):
        x = np.flatnonzero(some & own)
        # Numbers for the first two words, then with what follows as one key.
        heads, at = np.unique(ids[x - size + 1] * count + ids[x - size + 2], return_inverse=True)
        if size == 3:
            found, sums = _summed(at * count + ids[x], weight[x])
            head, tail = found // count, [found % count]
        else:
            tails, after = np.unique(ids[x - 1] * count + ids[x], return_inverse=True)
            found, sums = _summed(at * max(1, len(tails)) + after, weight[x])
            head, tail = found // max(1, len(tails)), tails[found % max(1, len(tails))]
            tail = [tail // count, tail % count]
        parts = [heads[head] // count, heads[head] % count, *tail]
        yield spelled(*(words.take(pa.array(p)) for p in parts)), sums, size


def _counter(sizes: range, words_may=None, pairs_may=None):
    """Counts the n-grams of a dictionary, batch by batch."""

    def run(batches):
        for lang, chunks, times in _by_language(batches):
            for found, counts, size in _phrases(lang, chunks, times, sizes, words_may, pairs_may):
                n = len(found)
                columns = [pa.repeat(pa.scalar(lang), n), found.cast(pa.string()), pa.array(counts, pa.int64()), pa.repeat(pa.scalar(size, pa.int32()), n)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "n", "size"])

    return run


def _by_language(batches):
    """Batches of a dictionary as (language, chunks, their frequencies), some
    megabytes at a time."""
    held: dict[str, tuple[list, list]] = {}
    size = 0
    for batch in batches:
        for lang, chunk, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "chunk", "n"))):
            chunks, times = held.setdefault(lang, ([], []))
            chunks.append(chunk)
            times.append(n)
            size += len(chunk)
            if size > COUNTED:
                yield from ((lang, c, np.array(t, np.int64)) for lang, (c, t) in held.items())
                held, size = {}, 0
    yield from ((lang, c, np.array(t, np.int64)) for lang, (c, t) in held.items())


class _Filter:
    """Says of hashes whether they may be in a set; wrong only with a yes."""

    def __init__(self, sent, bits: int):
        self.sent, self.bits = sent, bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        spot = (hashes % np.uint64(self.bits)).astype(np.int64)
        return (self.sent.value[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


def _filter(frequent: DataFrame) -> _Filter:
    """The filter of frequent words, or of frequent pairs. Its size is bounded,
    so it is sent to all tasks; where it fills up, it only spares less."""
    spark = frequent.sparkSession
    bits = min(FILTER_BITS, 1 << max(16, (32 * frequent.count()).bit_length()))

    def spots(batches):
        for batch in batches:
            out = []
            for lang, phrase in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase"))):
                hashes = _word_hashes(lang, phrase.encode().split(b" "))
                h = hashes[:1] if len(hashes) == 1 else _pair_hash(hashes[:1], hashes[1:])
                out.append(int(h[0] % np.uint64(bits)) + 1)  # the bitmap functions count from 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["spot"])

    found = frequent.select("lang", "phrase").mapInArrow(spots, "spot long")
    bitmaps = found.groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    flags = np.zeros(bits // 8, np.uint8)
    for row in bitmaps.toLocalIterator():  # at most bits / 2^15 rows of 4 KB
        a = (row["bucket"] - 1) * _BITMAP // 8
        flags[a : a + _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)[: len(flags) - a]
    return _Filter(spark.sparkContext.broadcast(flags), bits)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of one to four words that occur
    ``least`` times, and (lang, n), the number of words."""
    for_workers(docs.sparkSession)
    staging = Staging(docs.sparkSession)
    chunks = staging.keep(dictionary_of(docs), "chunks")

    def counted(sizes: range, name: str, keep: int, words_may=None, pairs_may=None) -> DataFrame:
        rows = chunks.mapInArrow(_counter(sizes, words_may, pairs_may), "lang string, phrase string, n long, size int")
        sums = rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
        if keep:
            sums = sums.filter(F.col("n") >= keep)
        return staging.keep(sums, name)

    words = counted(range(1, 2), "words", 0)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.filter(F.col("n") >= least)
    words_may = _filter(words)
    pairs = counted(range(2, 3), "pairs", least, words_may)
    longer = counted(range(3, WORDS + 1), "longer", least, words_may, _filter(pairs))
    return words.unionByName(pairs).unionByName(longer), totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``
    (its count), ``l`` and ``r`` (counts of the parts of its weakest cut), ``n``
    (words of the language) and ``score``."""
    frequent, totals = frequent_phrases(docs, least)
    words = F.split("phrase", " ")
    some = frequent.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))

    # Phrases that a longer one explains go.
    inner = [(s, k) for s in range(2, WORDS) for k in range(WORDS)]
    parts = F.array(*[F.when(F.col("size") >= k + s, F.struct(F.lit(s).alias("s"), F.array_join(F.slice(words, k + 1, s), " ").alias("part"))) for s, k in inner])
    within = some.filter("size > 2").select("lang", "size", "a", F.explode(F.array_compact(parts)).alias("p")).filter("p.s < size")
    most = within.groupBy("lang", F.col("p.part").alias("phrase")).agg(F.max("a").alias("most"))
    kept = some.join(most, ["lang", "phrase"], "left").filter(~F.coalesce(100 * F.col("most") >= cover * F.col("a"), F.lit(False)))

    # Each cut of the others needs the counts of both its parts.
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = kept.select("lang", "phrase", "size", "a", cut).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    count_of = lambda part, name: frequent.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    scored = cuts.join(count_of("left", "l"), ["lang", "left"]).join(count_of("right", "r"), ["lang", "right"])
    # Decimals of 38 digits, since the product may pass 64 bits.
    score = F.expr("(2000000 * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + r)")
    weakest = scored.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    )
    rows = weakest.select("lang", "phrase", "a", "cut.*").withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for group in (["lang", "_part"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*best))).filter(F.col("rank") <= top)
    return rows.join(F.broadcast(_few(totals)), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _few(totals: DataFrame, most: int = 100_000) -> DataFrame:
    """The table if it is small; it has one row per language."""
    if totals.count() > most:
        raise ValueError(f"more than {most} languages")
    return totals


#: The same in DuckDB's SQL.
PHRASES_SQL = """
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents where text is not null
), worded as (
    select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]'), lambda x: x <> '') as w from pieces
), grams as (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k)
    group by all
), totals as (
    select lang, sum(f)::bigint as n from grams where k = 1 group by lang
), frequent as (
    select lang, k, phrase, f, string_split(phrase, ' ') as w from grams where f >= 30
), inner_parts as (
    select lang, array_to_string(w[i:i + s - 1], ' ') as phrase, max(f) as most
    from (select lang, w, f, s, unnest(range(1, k - s + 2)) as i from frequent, (select unnest([2, 3]) as s) where k > s)
    group by all
), kept as (
    select f.lang, f.phrase, f.k, f.w, f.f as a from frequent f left join inner_parts p using (lang, phrase)
    where f.k > 1 and not coalesce(100 * p.most >= 80 * f.f, false)
), cuts as (
    select c.lang, c.phrase, c.a, c.c, x.f as l, y.f as r, ((2000000::hugeint * c.a) // (x.f + y.f))::bigint as score
    from (select *, unnest(range(1, k)) as c from kept) c
    join frequent x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.c], ' ')
    join frequent y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.c + 1:], ' ')
), weakest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, c) = 1
), ranked as (
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score from weakest
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""
