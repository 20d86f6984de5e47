"""Bounded prefixes of an order, and layouts that keep each key in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from weir.functions.text import is_missing
from weir.operators.contract import require_fields
from weir.operators.running import OFFSET, PARTITION


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Return the first ``n`` rows of an explicit order: a bounded replay of a source.

    The order's columns are dealt into ranges and each range is counted. Rows of the ranges that lie wholly
    within the prefix are kept by comparing them with the last such key; only the range that is cut is
    ordered. So no task receives more than its range, whatever ``n`` is. The order should end in a
    column that tells rows apart; among equal keys at the cut any may stay.
    """
    require_fields(df, order)
    if n <= 0:
        return df.limit(0)
    key = F.struct(*(F.col(name) for name in order))
    ranged = df.select(*order).repartitionByRange(*order)
    counted = ranged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(key).alias("last"))
    ranges = sorted(counted.collect(), key=lambda r: tuple((v is not None, v) for v in r["last"]))  # a row a partition
    whole, before = None, 0
    for found in ranges:
        if before + found["n"] > n:
            upto = _at_most(order, found["last"])
            inside = df.where(upto if whole is None else upto & ~_at_most(order, whole))
            cut = inside.orderBy(*order).limit(n - before)
            return cut if whole is None else df.where(_at_most(order, whole)).union(cut)
        whole, before = found["last"], before + found["n"]
    return df


def _at_most(order: Sequence[str], last: Row) -> Column:
    """True where a row's key is at or before ``last``, with NULL before everything else."""
    reached = F.lit(True)
    for name, value in reversed(list(zip(order, last))):
        column = F.col(name)
        if value is None:
            reached = column.isNull() & reached
        else:
            before = column.isNull() | F.coalesce(column < F.lit(value), F.lit(False))
            reached = before | (F.coalesce(column == F.lit(value), F.lit(False)) & reached)
    return reached


def first_messages(df: DataFrame, n: int) -> DataFrame:
    """Return the first ``n`` messages by (partition, offset), whether they are valid or not."""
    return first_rows(df, n, [PARTITION, OFFSET])


def first_of_each(df: DataFrame, key: str, order: Sequence[str] = (OFFSET,)) -> DataFrame:
    """Return the first row of each key: what a replayed topic holds without its repeats.

    The rows are reduced map side, so a key that is repeated often costs a row for each task. A row whose key is
    missing is no repeat of another: it stays, and is not grouped at all.
    """
    require_fields(df, [key, *order])
    absent = is_missing(F.col(key))
    first = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("_first")
    keyed = df.where(~absent).groupBy(F.col(key).alias("_of")).agg(first).select("_first.*")
    return keyed.unionByName(df.where(absent))


def keyed_order(
    df: DataFrame, key: str, order: Sequence[str], partitions: int | None = None, whole: bool = False
) -> DataFrame:
    """Lay rows out so that each key's rows follow one another in order.

    With ``whole`` all rows of a key are in one partition, which a hash of the key decides, as on a topic. One task
    then sorts the largest key, spilling to disk where its memory ends. Otherwise ranges of (key, order) are used: a
    key with a large share of the rows spans several neighbouring partitions instead of filling one.
    """
    require_fields(df, [key, *order])
    columns = [key, *order]
    by = [key] if whole else columns
    deal = df.repartition if whole else df.repartitionByRange
    dealt = deal(partitions, *by) if partitions else deal(*by)
    return dealt.sortWithinPartitions(*columns)
