"""Streams in event time: windows and sessions with a watermark, and replays without their repeats.

State is bounded by the watermark: a window, a session or an id is forgotten once the latest moment seen is further on than the
delay allows. Rows later than that no longer change a result and are counted instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weir.functions.text import is_missing
from weir.operators.contract import ENVELOPE, require_fields
from weir.operators.route import BATCH

MOMENT = "_moment"


@dataclass(frozen=True)
class Ran:
    """What a run of a stream reports: its batches, the rows it read and how many entries came too late for the state.

    A task combines its rows before the state sees them, so late entries are counted after that: for windows and
    sessions one for each group that a task had, for repeats one for each row.
    """

    batches: int
    rows: int
    late: int
    updated: int = 0  # entries of the state that the last batch with rows wrote


def in_event_time(stream: DataFrame, moment: str, delay: str) -> DataFrame:
    """Add the moment as a timestamp with its watermark. A moment that does not parse is NULL and never in a window."""
    require_fields(stream, [moment])
    return stream.withColumn(MOMENT, F.try_to_timestamp(F.col(moment))).withWatermark(MOMENT, delay)


def windowed(timed: DataFrame, length: str, amounts: Mapping[str, Column], keys: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Aggregate in windows of event time, for each key if given."""
    return _grouped(timed, F.window(MOMENT, length, slide) if slide else F.window(MOMENT, length), amounts, keys)


def sessions(timed: DataFrame, gap: str, amounts: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Aggregate the runs of each key's rows that follow one another within ``gap``."""
    return _grouped(timed, F.session_window(MOMENT, gap), amounts, keys)


def _grouped(timed: DataFrame, at: Column, amounts: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    grouped = timed.groupBy(at.alias("at"), *keys).agg(*(amount.alias(name) for name, amount in amounts.items()))
    return grouped.select("at.start", "at.end", *keys, *amounts)


def without_repeats(timed: DataFrame, key: str) -> DataFrame:
    """Drop messages whose id came before within the watermark's delay.

    A message without an id is no repeat: it is told apart by its place in the topic. So it stays, whatever
    other messages without ids there are, unless it is read again from the same place. A message without a moment has
    no place in event time, so nothing says when its id may be forgotten: it is passed on each time it comes.
    """
    require_fields(timed, [key, MOMENT, *ENVELOPE[1:]])
    absent = is_missing(F.col(key))
    place = F.struct(*(F.col(c) for c in ENVELOPE[1:]))
    dated = timed.where(F.col(MOMENT).isNotNull())
    marked = dated.withColumns({"_id": F.when(~absent, F.col(key)), "_at_place": F.when(absent, place)})
    once = marked.dropDuplicatesWithinWatermark(["_id", "_at_place"]).drop("_id", "_at_place")
    return once.unionByName(timed.where(F.col(MOMENT).isNull()))


def run_closed(result: DataFrame, path: str, checkpoint: str) -> Ran:
    """Append what the watermark has closed, each window or session once; the rest stays in the state for a later run."""
    query = (
        result.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    return ran(query)


def run_changed(result: DataFrame, path: str, checkpoint: str) -> Ran:
    """Write, after each batch, the windows that it changed, open ones included; a retry replaces its own batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    query = (
        result.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    return ran(query)


def read_changed(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Read each window as the last batch that changed it left it."""
    written = spark.read.option("basePath", path).parquet(path)
    columns = [c for c in written.columns if c != BATCH]
    newest = written.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.max_by(F.struct(*columns), BATCH).alias("_newest"))
    return newest.select("_newest.*")


def ran(query: StreamingQuery) -> Ran:
    """Wait for the last available batch and report the run."""
    query.awaitTermination()
    progress = query.recentProgress
    late = sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators)
    updated = [sum(op.numRowsUpdated for op in p.stateOperators) for p in progress if p.numInputRows]
    return Ran(len(progress), sum(p.numInputRows for p in progress), late, updated[-1] if updated else 0)
