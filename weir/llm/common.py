"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weir.session import workspace

#: The characters that part words: space and U+0009 to U+000D.
WORD_BREAKS = " \t\n\x0b\x0c\r"
WORD_BREAK_PATTERN = r"[\x20\x09-\x0D]+"
#: Spark's setting for the removal of a query's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Return one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and return the written table.

    This cuts the lineage: a lost executor costs at most a read of that table, and a
    value such as a row number stays what it was.
    """
    return keep_at(frame, name)[0]


def keep_at(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    """What ``keep`` does; returns the written table and its folder, for a table that is discarded later."""
    spark = frame.sparkSession
    path = workspace(spark, name)
    with freed_shuffles(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove the shuffle files of what runs here as soon as it has run.

    Otherwise they stay until the driver happens to collect the garbage that held them, so a chain of written tables
    would need the disk of several of its shuffles at a time.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def words(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK_PATTERN), lambda w: w != "")


def word_count(text: Column) -> Column:
    """How many words a text has."""
    return F.size(words(text)).cast("long")


def running_before(frame: DataFrame, keys: list[str], block: str, order: list, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of a key that come before a row.

    Rows are ordered by ``block``, then ``order``; keys and block hold no NULL. Only one block of a key has to
    fit in a task: sums of whole blocks are carried by a table with a row for each block. The rows are
    shuffled once, since the join deals them as the window does.
    """
    totals = frame.groupBy(*keys, block).agg(F.sum(value).alias("_total"))
    across = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, block, F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_carry"))
    within = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = frame.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inside.join(carried, [*keys, block]).withColumn(out, F.col("_carry") + F.col("_inside")).drop("_inside", "_carry")


def small_batches(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, or one row that is larger."""
    for batch in batches:
        upto = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
        at = 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            to = max(at + 1, int(upto.searchsorted(before + size, side="right")))
            yield batch.slice(at, to - at)
            at = to
