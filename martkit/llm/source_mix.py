"""Mixing sources to target weights by Poisson replication.

Each source has a target weight; with a total of ``epochs`` times all rows, its
mean repetition rate is weight x total / its rows. Every document draws its
number of copies from a Poisson distribution with that mean, inverted at a
uniform number that comes from a hash of seed and id: no state, no order, the
same draw on every run. Copies are exploded and shuffled globally by a second
hash. A rate above 64 is split into equal parts whose draws are added, so that
the distribution never underflows. All of it is built-in SQL functions; the only
thing joined is one row per source.

Defined cases: a null source is a source of its own; a null id draws as the text
``null``; repeated rows draw alike; a source without target weight gets weight
0; an empty table gives an empty table; texts are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import free_name
from martkit.operators.rank import global_row_number

#: Without given weights a source weighs its rows to this power.
TEMPER = 0.7
#: Largest mean that is inverted at once, and the terms that its sum runs over.
PART, TERMS = 64.0, 200
#: Sources, at most, whose distributions (1.6 KB each) are sent to all tasks.
MOST_SENT = 2000


def tempered(docs: DataFrame, power: float = TEMPER) -> DataFrame:
    """Default weights: (source, weight), rows to a power below one lift small
    sources."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    return sizes.select("source", F.pow(F.col("n").cast("double"), F.lit(power)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """Per source: rows, number of parts, and the cumulative distribution of one
    part as an array; one row per source."""
    sizes = docs.groupBy("source").agg(F.count("*").alias("n"))
    given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("_w"))
    known = sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        "source", "n", F.greatest(F.coalesce("_w", F.lit(0.0)), F.lit(0.0)).alias("w")
    )
    sums = known.agg(F.sum("n").alias("rows"), F.sum(F.col("w").cast("decimal(38,12)")).cast("double").alias("w")).first()
    rows, all_w = F.lit(sums["rows"] or 0), F.lit(sums["w"] or 0.0)  # two numbers, not a table
    rate = F.when(all_w > 0, F.col("w") / all_w * F.lit(float(epochs)) * rows / F.col("n")).otherwise(0.0)
    part = F.col("rate") / F.col("parts")
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-part).alias("p"), F.array(F.exp(-part)).alias("cdf")),
        lambda a, k: F.struct(
            (a["p"] * part / k).alias("p"),
            F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * part / k)).alias("cdf"),
        ),
    )
    return (
        known.select("source", "n", rate.alias("rate"))
        .withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int"))
        .select("source", "n", "rate", "parts", terms["cdf"].alias("cdf"))
    )


def _uniform(seed: int, key: Column, draw: Column) -> Column:
    """52 bits of a hash as a number in [0, 1)."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key, draw.cast("string"))), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def _key(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))


def replicate(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = 7) -> DataFrame:
    """``docs`` with one row per copy and three more columns: ``copy`` (from 1),
    ``n_copies`` and ``shuffle_key``; documents that draw 0 are left out."""
    weights = tempered(docs) if weights is None else weights
    found = rates(docs, weights, epochs)
    source, cdf, parts = (free_name(docs, c) for c in ("_source", "_cdf", "_parts"))
    small = found.select(F.col("source").alias(source), F.col("cdf").alias(cdf), F.col("parts").alias(parts))
    # One row per source: sent to the documents, which are not shuffled, unless
    # there are too many of them for that.
    if small.count() <= MOST_SENT:
        small = F.broadcast(small)
    known = docs.join(small, F.col("source").eqNullSafe(F.col(source)))
    uniforms = F.transform(F.sequence(F.lit(1), F.col(parts)), lambda j: _uniform(seed, _key("doc_id"), j))
    drawn = F.aggregate(uniforms, F.lit(0), lambda n, u: n + F.size(F.filter(cdf, lambda c: c <= u)))
    counted = known.withColumn("n_copies", drawn.cast("long")).filter("n_copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))))
    key = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), _key("doc_id"), F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", key).drop(source, cdf, parts)


def mix(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = 7) -> DataFrame:
    """The mixed corpus: every copy as a row of ``docs``, in a globally shuffled
    order over the partitions."""
    copies = replicate(docs, weights, epochs, seed)
    return copies.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key").select(*docs.columns)


def mix_report(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = 7) -> DataFrame:
    """``doc_id``, ``source``, ``copy``, ``n_copies`` and the ``position`` in the
    shuffled order (from 1) of every copy."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    copies = replicate(slim, weights, epochs, seed)
    placed = global_row_number(copies, ["shuffle_key", "doc_id", "copy"], "position")
    return placed.select("doc_id", "source", "copy", "n_copies", "position")


#: The same rows in SQL: default weights, one epoch, seed 7.
MIX_SQL = f"""
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {TEMPER}) AS w FROM documents GROUP BY source),
rated AS (SELECT source, w / sum(w::DECIMAL(38,12)) OVER ()::DOUBLE * 1.0 * sum(n) OVER () / n AS rate FROM sizes),
parted AS (SELECT source, greatest(ceil(rate / {PART}), 1)::INT AS parts, rate / greatest(ceil(rate / {PART}), 1)::INT AS part FROM rated),
terms AS (
  SELECT source, 0 AS k, exp(-part) AS p, exp(-part) AS c FROM parted
  UNION ALL
  SELECT t.source, k + 1, p * part / (k + 1), c + p * part / (k + 1)
  FROM terms t JOIN parted r ON t.source IS NOT DISTINCT FROM r.source WHERE k < {TERMS}
),
cdfs AS (SELECT source, list(c ORDER BY k) AS cdf FROM terms GROUP BY source),
draws AS (
  SELECT row_no, doc_id, source, unnest(generate_series(1, parts)) AS j
  FROM (SELECT d.doc_id, d.source, parts, row_number() OVER () AS row_no
        FROM documents d JOIN parted r ON d.source IS NOT DISTINCT FROM r.source)
),
counted AS (
  SELECT row_no, any_value(doc_id) AS doc_id, any_value(d.source) AS source,
    sum(len(list_filter(cdf, lambda x: x <= ('0x' || substr(md5(concat_ws(':', '7', coalesce(doc_id::VARCHAR, 'null'), j::VARCHAR)), 1, 13))::BIGINT / 4503599627370496.0)))::BIGINT AS n_copies
  FROM draws d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source GROUP BY row_no
),
copies AS (SELECT doc_id, source, n_copies, unnest(generate_series(1, n_copies)) AS copy FROM counted WHERE n_copies > 0)
SELECT doc_id, source, copy, n_copies,
  row_number() OVER (ORDER BY md5(concat_ws(':', 'order7', coalesce(doc_id::VARCHAR, 'null'), copy::VARCHAR)), doc_id, copy) AS position
FROM copies
"""
