"""Tables in buckets of a key, found by extendible hashing (SNK-7, ST-10).

The leading bits of a key's hash name its bucket. A directory of buckets is kept
with the table's commits; a bucket that grows beyond its limit is split by
further bits and alone is rewritten, so buckets keep their size as the table
grows. New rows are delta files of the buckets that they fall in; a bucket that
has gathered many is rewritten as one. Whoever looks for some keys opens their
buckets only.
"""

from __future__ import annotations

from copy import copy

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.operators.latest import latest
from martkit.session import COMPRESSION, brief_shuffles
from martkit.sinks.commits import CommitLog

#: Rows of a bucket, files that a bucket may gather, bits of the directory,
#: and buckets of a table before the limit of a bucket grows with it up to LIMIT.
LIMIT, MOST_PARTS, MOST_BITS, MOST_BUCKETS = 20_000_000, 16, 16, 32
#: Buckets that each task may write a file of, without a shuffle by bucket, and
#: rows that a task takes when buckets are rewritten.
FEW_BUCKETS, TASK_ROWS = 4, 500_000


class HashedTable:
    """A table of a commit log in buckets of ``keys``.

    With ``order_by`` it has one row per key, the one with the greatest order,
    of equal ones that of the latest commit. Without, rows are only added.
    ``limit`` holds for small tables: the buckets of a large one grow with it up
    to ``LIMIT``, so that their number, and that of files, does not.
    """

    def __init__(self, log: CommitLog, name: str, keys, order_by=None, limit: int = LIMIT, bits: int = 3, most_parts: int = MOST_PARTS):
        self.log, self.name = log, name
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.order_by = [order_by] if isinstance(order_by, str) else list(order_by or [])
        self.limit, self.bits, self.most_parts = limit, bits, most_parts
        self.fixed: dict | None = None

    # --- reading ---

    def read(self, state: dict | None = None) -> DataFrame | None:
        """All rows, or None if nothing was written yet."""
        rows = self.log.read(self.name, state or self.fixed)
        return None if rows is None else self._reduced(rows)

    def known(self) -> bool:
        """Whether anything was written yet."""
        return self.name in (self.fixed or self.log.state())["tables"]

    def at(self, state: dict) -> HashedTable:
        """The table as of a state, for several readings of the same version."""
        fixed = copy(self)
        fixed.fixed = state
        return fixed

    def near(self, rows: DataFrame, keys=None) -> DataFrame | None:
        """The rows of the buckets that the keys of ``rows`` fall in, which is
        where rows with these keys are; no other bucket is opened."""
        state = self.fixed or self.log.state()
        entry = state["tables"].get(self.name)
        if entry is None:
            return None
        named = rows.select(*[F.col(k).alias(o) for k, o in zip([keys] if isinstance(keys, str) else keys or self.keys, self.keys)])
        touched = {r[0] for r in self._placed(self._cast(named, entry), entry).select("_bucket").distinct().collect()}  # at most the buckets
        return self._reduced(self.log.read(self.name, state, lambda part: part["bucket"] in touched))

    def buckets(self) -> dict[str, int]:
        """Rows written to each bucket since it was last rewritten."""
        entry = self.log.state()["tables"].get(self.name)
        return _sizes(entry) if entry else {}

    def _reduced(self, rows: DataFrame) -> DataFrame:
        if self.order_by:
            rows = latest(rows, self.keys, [*self.order_by, "_commit"])
        return rows.drop("_commit")

    # --- writing ---

    def added(self, rows: DataFrame, state: dict) -> dict:
        """The table's entry after new rows, for a commit of the log. The rows
        are written, and do not count before that commit."""
        entry = state["tables"].get(self.name)
        if entry is None:
            shape = rows.withColumn("_commit", F.lit(0).cast("long")).schema
            entry = {"schema": shape.jsonValue(), "parts": [], "buckets": _names("", self.bits)}
        rows = self._cast(rows, entry)
        if self.order_by:
            rows = latest(rows, self.keys, self.order_by)
        return self._put(rows.withColumn("_commit", F.lit(state["version"] + 1).cast("long")), entry)

    def upsert(self, rows: DataFrame) -> None:
        """Adds rows, or newer rows of keys that are there, in one commit."""
        state = self.log.state()
        self.maintain(self.log.commit(state, {self.name: self.added(rows, state)}))

    def maintain(self, state: dict | None = None) -> None:
        """Splits buckets beyond their limit, and rewrites those of many parts;
        no other bucket is touched."""
        state = state or self.log.state()
        entry = state["tables"].get(self.name)
        if entry is None:
            return
        counts: dict[str, int] = {}
        for part in entry["parts"]:
            counts[part["bucket"]] = counts.get(part["bucket"], 0) + 1
        sizes = _sizes(entry)
        limit = max(self.limit, min(sum(sizes.values()) // MOST_BUCKETS, LIMIT))
        split = {b for b, n in sizes.items() if n > limit and len(b) < MOST_BITS and b not in entry.get("single", [])}
        due = split | {b for b, n in counts.items() if n > self.most_parts}
        if not due:
            return
        rows = self.log.read(self.name, state, lambda part: part["bucket"] in due)
        if self.order_by:
            rows = latest(rows, self.keys, [*self.order_by, "_commit"])
        else:  # files are dealt by bucket already
            rows = rows.coalesce(-(-sum(sizes[b] for b in due) // TASK_ROWS) or 1)
        names = [n for b in entry["buckets"] for n in (_split(b, sizes[b], limit) if b in split else [b])]
        rest = {**entry, "buckets": names, "parts": [p for p in entry["parts"] if p["bucket"] not in due]}
        after = self._put(rows, rest, dealt=not self.order_by)
        # A bucket of a single key cannot be split: its rows stay together.
        told = _sizes(after)
        single = {n for n in names for b in split if n.startswith(b) and told.get(n, 0) > limit and told[n] == sum(told.get(m, 0) for m in names if m.startswith(b))}
        after["single"] = sorted(set(entry.get("single", [])) | single)
        self.maintain(self.log.commit(state, {self.name: after}, news=False))

    def _put(self, rows: DataFrame, entry: dict, dealt: bool = False) -> dict:
        path = self.log.attempt(self.name)
        placed = self._placed(rows, entry)
        if not dealt and len(entry["buckets"]) > FEW_BUCKETS:
            placed = placed.hint("rebalance", F.col("_bucket"))
        with brief_shuffles(placed.sparkSession):
            placed.write.partitionBy("_bucket").option("compression", COMPRESSION).parquet(path)
        # Only the folder names and the counts in the files' footers are read.
        written = self.log.spark.read.schema(placed.schema).parquet(path).groupBy("_bucket").count().collect()  # at most the buckets
        parts = [{"path": f"{path}/_bucket={r['_bucket']}", "bucket": r["_bucket"], "rows": r["count"]} for r in sorted(written)]
        return {**entry, "parts": [*entry["parts"], *parts]}

    def _cast(self, rows: DataFrame, entry: dict) -> DataFrame:
        """With the types of the table: a bucket must not depend on the width
        of an update's integers."""
        kinds = {f["name"]: f["type"] for f in entry["schema"]["fields"]}
        own = self.log.open([], entry["schema"]).schema
        return rows.select(*[F.col(c).cast(own[c].dataType) for c in rows.columns if c in kinds])

    def _placed(self, rows: DataFrame, entry: dict) -> DataFrame:
        """Rows with their bucket, by a directory of at most 2^16 slots."""
        bits = max(len(b) - 1 for b in entry["buckets"])
        names = [(int("0" + b[1:].ljust(bits, "0"), 2), 1 << (bits + 1 - len(b)), b) for b in entry["buckets"]]
        directory = [(first + k, b) for first, size, b in names for k in range(size)]
        held = self.log.spark.createDataFrame(directory, "_slot long, _bucket string")
        slot = F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - bits) if bits else F.lit(0).cast("long")
        return rows.withColumn("_slot", slot).join(F.broadcast(held), "_slot").drop("_slot")


def _names(prefix: str, bits: int) -> list[str]:
    """Buckets below a prefix; names begin with a letter, so they stay text."""
    return [f"{prefix or 'b'}{i:0{bits}b}" if bits else prefix or "b" for i in range(1 << bits)]


def _split(bucket: str, rows: int, limit: int) -> list[str]:
    more = min(max(1, (rows // limit).bit_length()), MOST_BITS - len(bucket) + 1)
    return _names(bucket, more)


def _sizes(entry: dict) -> dict[str, int]:
    sizes = dict.fromkeys(entry["buckets"], 0)
    for part in entry["parts"]:
        sizes[part["bucket"]] += part["rows"]
    return sizes


def hashed_table(spark: SparkSession, path: str, keys, order_by, **options) -> HashedTable:
    """A table with a commit log of its own."""
    return HashedTable(CommitLog(spark, path), "rows", keys, order_by, **options)
