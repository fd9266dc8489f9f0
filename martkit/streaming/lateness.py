"""Late events of a stream, told apart and counted (ST-3, ST-4).

Spark's own watermark drops late rows inside stateful operators and only counts
them. Here the watermark is part of each batch's commit, so it survives restarts
and repeats, and late rows go to a table instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.joins import missing_from
from martkit.operators.latest import first
from martkit.session import scratch
from martkit.sinks.commits import CommitLog, added_batch, written_at_once
from martkit.sinks.hashed import HashedTable
from martkit.streaming.runner import BatchWriter


def is_late(event_time: str, watermark: int | None) -> Column:
    """Whether a row is older than the watermark (microseconds). Rows without
    event time are never late, nor is anything before the first batch."""
    if watermark is None:
        return F.lit(False)
    return F.coalesce(F.unix_micros(F.col(event_time).cast("timestamp")) < watermark, F.lit(False))


def deduplicating_sink(log: CommitLog, keys: list[str], event_time: str, delay_seconds: int, order_by=None, writer: str = "stream", **options) -> BatchWriter:
    """Each key once into ``kept``, late rows into ``late``, both with the number
    of their batch, published together.

    A row is late if its event time lies more than ``delay_seconds`` behind the
    greatest event time of the batches before. ``keys`` have no nulls. Of equal
    keys the first batch counts, within a batch the first in ``order_by`` (all
    columns). Only the buckets of a batch's keys are opened to find what is
    there; ``options`` are those of the table in buckets.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        state = log.state()
        marks = state["marks"]
        if marks.get(writer, -1) >= batch_id:
            return
        highest = marks.get(f"{writer}-time")
        watermark = None if highest is None else highest - delay_seconds * 1_000_000
        with scratch(batch.withColumn("batch_id", F.lit(batch_id).cast("long")), "micro-batch") as rows:
            late = is_late(event_time, watermark)
            newest = rows.agg(F.max(F.unix_micros(F.col(event_time).cast("timestamp")))).first()[0]
            table = HashedTable(log, "kept", keys, **options)
            once = first(rows.filter(~late), keys, order_by or batch.columns).select(*rows.columns)
            held = table.at(state).near(once)
            fresh = once if held is None else missing_from(once, held, keys)[0].select(*rows.columns)
            writes = {
                "kept": lambda: table.added(fresh, state),
                "late": lambda: added_batch(log, state, "late", rows.filter(late), batch_id),
            }
            times = [t for t in (highest, newest) if t is not None]
            log.commit(state, written_at_once(writes), {writer: batch_id, **({f"{writer}-time": max(times)} if times else {})})
        table.maintain()

    return write
