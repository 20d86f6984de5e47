"""Streaming runs that consume what is there and stop.

Every run names its checkpoint folder. A new folder replays the source from its beginning; the
same folder continues, and batches written before a failure are replaced, not repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from weir.operators.ordering import first_messages
from weir.operators.route import BATCH, Landing
from weir.operators.running import OFFSET, PARTITION, Measure, running, with_mean

LAST, NEXT = "_last_offset", "_next_offset"


def stream_files(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """Read a parquet table, a folder of files or one file, as a stream from its first file on."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # Only a pattern may name a single file; in braces the last name is a pattern for itself.
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{folder}/{{{name}}}")


def write_in_turn(table: DataFrame, order: str, path: str, turns: int, rows_each: int = 1_000_000) -> int:
    """Write a table as files that arrive in ``turns`` groups, earlier rows first; returns the files of a group.

    Each group is written by as many tasks as it has files, one group after the other. All groups have the same number of
    files, of ``rows_each`` rows or less where there are enough rows, so a stream that admits that many files takes
    a group at a time. Rows without an order come first.
    """
    cuts = sorted(set(table.approxQuantile(order, [k / turns for k in range(1, turns)], 0.01)))
    turn = sum((F.coalesce((F.col(order) > cut).cast("int"), F.lit(0)) for cut in cuts), F.lit(0))
    sizes = {row["turn"]: row["n"] for row in table.groupBy(turn.alias("turn")).agg(F.count("*").alias("n")).collect()}
    most, least = max(sizes.values(), default=1), min(sizes.values(), default=1)
    # Dealt in rounds, so no file is empty while there are many more rows than files.
    files = max(1, min(max(2, -(-most // rows_each)), least // 64))
    for number in sorted(sizes) or [0]:
        table.where(turn == number).repartition(files).write.mode("append").parquet(path)
    return files


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Hand every micro-batch that is available to ``each`` and stop when there are no more."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)


def run_append(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream to a parquet table; the sink's own log makes each batch count once."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)


def run_latest(aggregated: DataFrame, path: str, checkpoint: str) -> None:
    """Write the whole result of a streaming aggregate after each batch, as a new version.

    The version before the newest stays until the next one is written, for whoever reads it; older ones go.
    """
    spark = aggregated.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{batch_id}")
        drop_before(spark, path, batch_id - 1)

    query = (
        aggregated.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Read the newest version written by ``run_latest``; only its name is looked up."""
    return spark.read.parquet(f"{path}/{versions(spark, path)[-1]}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Return the numbers of the finished versions in a folder."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    named = [status.getPath() for status in files.listStatus(folder) if status.getPath().getName().isdigit()]
    done = [p.getName() for p in named if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(name) for name in done)


def drop_before(spark: SparkSession, path: str, version: int) -> None:
    """Remove the versions below a number."""
    files, _ = _folder(spark, path)
    for old in versions(spark, path):
        if old < version:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}"), True)


def _folder(spark: SparkSession, path: str):
    """Return the file system of a folder and the folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def land(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], landing: Landing, checkpoint: str) -> None:
    """Check and enrich each micro-batch with ``prepare`` and land both branches of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        landing.write(prepare(batch), batch_id)

    run_batches(stream, checkpoint, write)


@dataclass(frozen=True)
class Carried:
    """Running values that outlive a batch, stored by batch number.

    Batch N reads the state of batch N-1 and writes its own, so a retry of N computes the same
    values again. Older states are removed.
    """

    spark: SparkSession
    path: str
    schema: StructType

    def before(self, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{batch_id - 1}")

    def save(self, state: DataFrame, batch_id: int) -> None:
        state.write.mode("overwrite").parquet(f"{self.path}/{batch_id}")
        drop_before(self.spark, self.path, batch_id - 1)


class LateOffsets(ValueError):
    """A batch holds offsets at or before those whose running values are written."""


def run_running(
    stream: DataFrame, measures: dict[str, Measure], keys: list[str], path: str, state_path: str, checkpoint: str
) -> None:
    """Write every row with its running values, which continue from batch to batch for each key.

    Within a key, later batches must hold later offsets, as they do when keys are whole
    partitions of a topic. The state keeps the highest offset of each key; a batch that goes back before it fails.
    """
    spark = stream.sparkSession
    wanted = running(_empty_like(spark, stream), measures, keys).select(*keys, *measures).schema
    carried = Carried(spark, state_path, StructType([*wanted.fields, StructField(LAST, LongType())]))

    def write(batch: DataFrame, batch_id: int) -> None:
        state = carried.before(batch_id)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if state is not None:
                _require_later(batch, keys, state)
            rows = running(batch, measures, keys, initial=state)
            rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            carried.save(_next_state(batch, measures, keys, state), batch_id)
        finally:
            batch.unpersist()

    run_batches(stream, checkpoint, write)


def _require_later(batch: DataFrame, keys: list[str], state: DataFrame) -> None:
    """Stop at a batch that goes back before what is written."""
    firsts = batch.groupBy(*keys).agg(F.min(OFFSET).cast("long").alias("_first"))
    ends = state.select(*(F.col(k).alias(f"_of_{k}") for k in keys), LAST)
    same = reduce(Column.__and__, (firsts[k].eqNullSafe(ends[f"_of_{k}"]) for k in keys))
    late = firsts.join(ends, same).where(F.col("_first") <= F.col(LAST)).first()
    if late is not None:
        raise LateOffsets(f"offset {late['_first']} came after {late[LAST]} for {[late[k] for k in keys]}")


def _next_state(batch: DataFrame, measures: dict[str, Measure], keys: list[str], state: DataFrame | None) -> DataFrame:
    """Fold a batch into the carried totals: one row per key."""
    kept = {**measures, LAST: Measure("max", F.col(OFFSET).cast("long"))}
    totals = batch.groupBy(*keys).agg(*(m.of_rows().alias(n) for n, m in kept.items()))
    if state is None:
        return totals
    return totals.unionByName(state).groupBy(*keys).agg(*(m.of_totals(n).alias(n) for n, m in kept.items()))


def restart(spark: SparkSession, checkpoint: str) -> None:
    """Forget how far a bounded consumer came, so that the next run starts at the first message."""
    files, folder = _folder(spark, f"{checkpoint}-positions")
    files.delete(folder, True)


def run_bounded(messages: DataFrame, limit: int | None, state_path: str, each: Callable[[DataFrame, int], None]) -> None:
    """Consume at most ``limit`` more messages, valid or not, in the order (partition, offset).

    ``messages`` is a batch read of the whole topic. The state holds the next offset of each partition and is written
    after ``each`` has taken its messages, so a message that was not taken is the first one of the next run, with
    whatever limit that has. A run that fails in between takes the same messages again under the same number.
    """
    spark = messages.sparkSession
    done = versions(spark, state_path)
    number = done[-1] + 1 if done else 0
    schema = StructType([StructField(PARTITION, IntegerType()), StructField(NEXT, LongType())])
    state = spark.read.schema(schema).parquet(f"{state_path}/{done[-1]}") if done else None
    pending = messages
    if state is not None:
        pending = messages.join(state, PARTITION, "left").where(F.col(OFFSET) >= F.coalesce(NEXT, F.lit(0))).drop(NEXT)
    taken = pending if limit is None else first_messages(pending, limit)
    taken = taken.select(*messages.columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if taken.isEmpty():
            return
        each(taken, number)
        ends = taken.groupBy(PARTITION).agg((F.max(OFFSET) + 1).cast("long").alias(NEXT))
        if state is not None:
            ends = ends.union(state).groupBy(PARTITION).agg(F.max(NEXT).alias(NEXT))
        ends.select(F.col(PARTITION).cast("int"), NEXT).write.mode("overwrite").parquet(f"{state_path}/{number}")
        drop_before(spark, state_path, number - 1)
    finally:
        taken.unpersist()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written batch by batch."""
    return spark.read.option("basePath", path).parquet(path).drop(BATCH)


def running_stats_rows(spark: SparkSession, path: str) -> DataFrame:
    """Read rows written by ``run_running`` with the statistics measures, mean included."""
    return with_mean(read_batches(spark, path))


def _empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([], df.schema)


def _finish(query: StreamingQuery) -> None:
    """Wait for the last available batch; a failed batch raises here."""
    query.awaitTermination()
