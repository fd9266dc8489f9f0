"""Quality rules: a learned decision list over text statistics.

Statistics of every whole text are counted in Arrow batches. A sequential
covering learner reads the statistics of a bounded sample of labelled
documents, grows conjunctions of thresholds, prunes them on held-out rows, and
keeps those that are precise there. The list is emitted as one ordered Spark
conditional expression, so that applying it costs nothing but the statistics.

Defined cases: a null text counts as empty; rows with a null or a contradictory
label are not learned from; without usable labels the list is empty and only the
base rule rejects; repeated rows are judged alike; other columns are untouched.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martkit.llm.common import cells, free_name, give_back

#: Labelled documents that the learner reads at most.
LABEL_SAMPLE = 20_000
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_lines", "n_upper", "n_digits", "n_bangs", "n_bars",
)
_TYPE = StructType([StructField(c, LongType()) for c in COUNTS])
_WINDOW = 3


def count_text(raw: bytes) -> tuple[int, ...]:
    """The counts of one UTF-8 text, in the order of ``COUNTS``."""
    words = raw.split()  # on ASCII white space, the six characters of SPACES
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(seen[0x80:0xC0].sum())
    of = lambda chars: int(seen[list(chars)].sum())
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    lines = raw.split(b"\n")
    filled = [x for x in lines if x and not x.isspace()]
    return (
        len(words), points - of(SPACES), of(SYMBOLS), len(filled) - len(set(filled)), _repeated(ids, len(numbers)),
        len(numbers), len(filled), int(seen[65:91].sum()), int(seen[48:58].sum()), of(b"!"), of(b"|"),
    )


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(ids) <= _WINDOW:
        return 0
    pairs = ids[:-2] * distinct + ids[1:-1]
    if distinct > 2_000_000:  # the product below would overflow
        _, pairs = np.unique(pairs, return_inverse=True)
    keys = pairs * distinct + ids[2:]
    ranked = np.sort(keys)
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(again):
        return 0
    hit = np.isin(keys, again)
    covered = np.zeros(len(ids), bool)
    for k in range(_WINDOW):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


@F.arrow_udf(_TYPE)
def _stats(texts: pa.Array) -> pa.Array:
    counted = [count_text(x or b"") for x in cells(texts.cast(pa.binary()))]
    columns = np.array(counted, np.int64).reshape(-1, len(COUNTS)).T
    give_back()
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], names=list(COUNTS))


def with_stats(docs: DataFrame, text: str = "text", out: str = "stats") -> DataFrame:
    """``docs`` with a struct of the counts of the whole text."""
    return docs.withColumn(out, _stats.asNondeterministic()(F.col(text).cast("string")))


#: name: (numerator, denominator), the features that rules compare.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "variety": ("n_distinct_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "bangs": ("n_bangs", "n_words"),
    "bars": ("n_bars", "n_words"),
}


def _feature(stats: str, name: str) -> Column:
    top, below = FEATURES[name]
    value = F.col(f"{stats}.{top}").cast("double")
    return value / F.greatest(F.col(f"{stats}.{below}"), F.lit(1)) if below else value


@dataclass(frozen=True)
class Test:
    """``feature >= value`` or ``feature < value``."""

    feature: str
    above: bool
    value: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.value:.6g}"

    def column(self, stats: str) -> Column:
        found = _feature(stats, self.feature)
        return found >= F.lit(self.value) if self.above else found < F.lit(self.value)

    def hits(self, data: dict[str, np.ndarray]) -> np.ndarray:
        return data[self.feature] >= self.value if self.above else data[self.feature] < self.value


class DecisionList:
    """Ordered rules; the first that holds rejects a document."""

    def __init__(self, rules: list[tuple[Test, ...]]):
        self.rules = rules

    def reason(self, stats: str = "stats") -> Column:
        """Text of the first rule that holds, null where none does."""
        out: Column | None = None
        for rule in self.rules:
            holds = rule[0].column(stats)
            for test in rule[1:]:
                holds = holds & test.column(stats)
            said = F.lit(" and ".join(map(str, rule)))
            out = F.when(holds, said) if out is None else out.when(holds, said)
        return F.lit(None).cast("string") if out is None else out

    def hits(self, data: dict[str, np.ndarray]) -> np.ndarray:
        n = len(next(iter(data.values())))
        out = np.zeros(n, bool)
        for rule in self.rules:
            out |= _covered(rule, data, n)
        return out


def _covered(rule, data, n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.hits(data)
    return out


def learn(
    data: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 12,
    max_tests: int = 4,
    least_precision: float = 0.97,
    least_cover: int = 5,
) -> DecisionList:
    """Sequential covering: grow on two thirds of the rows, prune on the rest,
    take what a rule covers away, until no rule is precise on both parts."""
    n = len(bad)
    held = np.arange(n) % 3 == 2
    left = np.ones(n, bool)
    rules: list[tuple[Test, ...]] = []
    for _ in range(4 * max_rules):
        rule = _grow(data, bad, left & ~held, max_tests)
        if not rule or len(rules) == max_rules:
            break
        rule = _prune(rule, data, bad, left & held)
        hit = _covered(rule, data, n) & left
        ok = all(
            (hit & part).sum() >= least and (bad & hit & part).sum() >= least_precision * (hit & part).sum()
            for part, least in ((~held, least_cover), (held, max(1, least_cover // 2)))
        )
        if ok:
            rules.append(rule)
            left &= ~hit
        else:
            left &= ~(hit & bad)  # look for a rule for other rows
    return DecisionList(rules)


def _grow(data, bad, rows, max_tests) -> tuple[Test, ...]:
    """Adds the test with the greatest gain until no good row is covered."""
    rule: tuple[Test, ...] = ()
    rows = rows.copy()
    while len(rule) < max_tests and (bad & rows).any() and (~bad & rows).any():
        best = max((_best_test(name, data[name][rows], bad[rows]) for name in sorted(data)), key=lambda x: x[0])
        if best[0] <= 0:
            break
        rule += (best[1],)
        rows &= best[1].hits(data)
    return rule


def _best_test(name: str, values: np.ndarray, bad: np.ndarray) -> tuple[float, Test | None]:
    """The threshold with the greatest gain, between two neighbouring values."""
    order = np.argsort(values, kind="stable")
    v, b = values[order], bad[order]
    cut = np.flatnonzero(v[1:] > v[:-1]) + 1
    if not len(cut):
        return 0.0, None
    bad_below = np.cumsum(b)[cut - 1]
    all_below, p, total = cut, b.sum(), len(b)
    base = np.log2(p / total)
    best: tuple[float, Test | None] = (0.0, None)
    for above, pos, size in ((False, bad_below, all_below), (True, p - bad_below, total - all_below)):
        gain = pos * (np.log2(np.maximum(pos, 1e-9) / size) - base)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), Test(name, above, float((v[cut[k] - 1] + v[cut[k]]) / 2)))
    return best


def _prune(rule, data, bad, rows) -> tuple[Test, ...]:
    """The beginning of the rule that is worth most on held-out rows."""

    def worth(k: int) -> float:
        hit = _covered(rule[:k], data, len(bad)) & rows
        p, n = int((bad & hit).sum()), int((~bad & hit).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), k))]


def fit(docs: DataFrame, labels: DataFrame, sample: int = LABEL_SAMPLE, **limits) -> DecisionList:
    """Learns from at most ``sample`` labelled documents, chosen by a hash of the
    id: a bound on what the driver receives and on what is broadcast."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .drop("other")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = with_stats(texts.join(F.broadcast(chosen), "doc_id"))
    found = known.select("doc_id", "quality", *[_feature("stats", f).alias(f) for f in FEATURES])
    rows = found.toPandas().sort_values(["doc_id", *FEATURES]).drop_duplicates("doc_id")
    if rows.empty:
        return DecisionList([])
    rows = rows.sample(frac=1, random_state=11)
    return learn({f: rows[f].to_numpy() for f in FEATURES}, (rows["quality"] == 0).to_numpy(), **limits)


def base_failed(stats: str = "stats") -> Column:
    words, again = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < 50) | (100 * again > 50 * words)


def judge(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and the ``reason`` of the
    rule that rejected, one row per row of ``docs``."""
    known = with_stats(docs.select("doc_id", "text"))
    reason = rules.reason()
    return known.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(f"stats.{c}").alias(c) for c in COUNTS],
        base_failed().alias("base_failed"),
        (~base_failed() & reason.isNull()).alias("kept"),
        F.when(base_failed(), F.lit("base")).otherwise(reason).alias("reason"),
    )


def filter_quality(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The rows of ``docs`` that the base rule and the list keep, with all their
    columns."""
    stats = free_name(docs, "stats")
    known = with_stats(docs, out=stats)
    return known.filter(~base_failed(stats) & rules.reason(stats).isNull()).drop(stats)
