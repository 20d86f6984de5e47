"""The summary queries. Each is one grouped aggregate, combined on the map side first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.text import loyalty_label
from weir.operators.validate import IS_VALID


def row_count(df: DataFrame, name: str) -> DataFrame:
    """Return one row with the number of rows, 0 for an empty table."""
    return df.agg(F.count("*").alias(name))


def run_counts(checked: DataFrame) -> DataFrame:
    """Return one row with the numbers of accepted and rejected messages."""
    return checked.agg(
        F.count_if(F.col(IS_VALID)).alias("accepted_count"), F.count_if(~F.col(IS_VALID)).alias("rejected_count")
    )


def revenue(column: str = "total") -> Column:
    """Sum money given as amounts or as stored text."""
    return F.round(F.sum(column), 2)


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Count rows by key, in key order."""
    return df.groupBy(key).agg(F.count("*").alias(name)).orderBy(key)


def revenue_by(df: DataFrame, key: str) -> DataFrame:
    """Count orders and sum revenue by key, highest revenue first; ties go by key."""
    totals = df.groupBy(key).agg(F.count("*").alias("order_count"), revenue().alias("revenue"))
    return totals.orderBy(F.desc("revenue"), F.asc(key))


def by_loyalty(df: DataFrame) -> DataFrame:
    """Count orders, sum revenue and discounts by the raw loyalty text, in descending order of it."""
    totals = df.groupBy("is_loyalty").agg(
        F.count("*").alias("order_count"),
        revenue().alias("revenue"),
        revenue("loyalty_discount").alias("discount_given"),
    )
    return totals.withColumn("label", loyalty_label(F.col("is_loyalty"))).orderBy(F.desc("is_loyalty"))


def run_stats(df: DataFrame, column: str = "total", by: tuple[str, ...] = ()) -> DataFrame:
    """Return count, total, mean, minimum and maximum of a column; no row when nothing was counted."""
    amount = F.col(column)
    stats = df.groupBy(*by).agg(
        F.count(amount).alias("count"),
        F.sum(amount).alias("total"),
        F.min(amount).alias("minimum"),
        F.max(amount).alias("maximum"),
    )
    mean = F.col("total").cast("double") / F.col("count")
    return stats.where(F.col("count") > 0).withColumn("mean", mean)


def cumulative_by(df: DataFrame, key: str, column: str = "total") -> DataFrame:
    """Return the revenue of each key in key order: what the live chart ends with."""
    return df.groupBy(key).agg(F.sum(column).alias("revenue")).orderBy(key)


def error_histogram(checked: DataFrame) -> DataFrame:
    """Count messages by the kind of error; of a missing field the kind names the field, values are left out."""
    found = checked.select(F.explode("errors").alias("text"))
    kind = F.when(F.col("text").startswith("Missing"), F.col("text")).otherwise(F.substring_index("text", ": ", 1))
    return found.groupBy(kind.alias("error")).agg(F.count("*").alias("message_count"))


def run_summary(accepted: DataFrame, column: str = "total") -> DataFrame:
    """Return one row: the messages and the revenue of a run, and the offsets that it spans."""
    offset = F.col("_kafka_offset")
    return accepted.agg(
        F.count("*").alias("accepted_count"),
        revenue(column).alias("revenue"),
        F.min(offset).alias("first_offset"),
        F.max(offset).alias("last_offset"),
    )


def by_day(accepted: DataFrame, moment: str = "datetime") -> DataFrame:
    """Count sales and sum revenue in windows of a day of the event's time."""
    at = F.window(F.try_to_timestamp(F.col(moment)), "1 day")
    daily = accepted.groupBy(at.alias("at")).agg(F.count("*").alias("sale_count"), revenue().alias("revenue"))
    return daily.select(F.date_format("at.start", "yyyy-MM-dd").alias("day"), "sale_count", "revenue")
