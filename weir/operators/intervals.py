"""Joins by time: a row with the interval that its moment lies in, or with the latest entry at or before it.

Moments are whole numbers, such as the day since 1970. Intervals have both ends inside. They are cut into buckets whose
width is the mean length of an interval, so all of them together fill at most three buckets for each interval,
however uneven they are. A row has one bucket, joins on key and bucket, and is compared with the exact ends
there: an equality join, never a nested loop, and no copy of a row.

The table of intervals is measured first. Within the bounds of a broadcast it is broadcast; beyond them the join shuffles by
key, bucket and a share of the rows, so a key that holds a third of all rows is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.contract import ENVELOPE, require_fields
from weir.operators.lookup import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, MAX_SALTS, SALTED_ROWS, Lookup, probe

#: Rows that the cut into buckets makes of an interval at most, on average.
BUCKETS_EACH = 3

_KEY, _BUCKET, _FROM, _TO, _SHARE = "_interval_key", "_interval_bucket", "_interval_from", "_interval_to", "_interval_share"
ENTRY = "_entry"


def day_number(moment: Column) -> Column:
    """The day of an ISO date or moment as a number, NULL where it is none; the date is the one that is written."""
    written = F.regexp_extract(F.trim(moment), r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.unix_date(F.try_to_date(written, "yyyy-MM-dd")).cast("long")


def interval_join(
    rows: DataFrame,
    intervals: DataFrame,
    on: str,
    at: Column,
    ends: tuple[str, str],
    values: Sequence[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join each row to the intervals of its key that its moment ``at`` lies in.

    Adds the columns ``values`` of the interval. An interval without a key or an end, or that ends before it starts, matches
    nothing; so does a row without a key or a moment. With intervals that don't overlap (``disjoint``) a row
    stays one row; with others it comes once for each.
    """
    require_fields(rows, [on])
    require_fields(intervals, [on, *ends, *values], "table of intervals")
    start, end = (F.col(name).cast("long") for name in ends)
    real = intervals.where(F.col(on).isNotNull() & (start <= end))
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (on, *values)]
    size = real.agg(
        F.count("*").alias("n"), F.sum(end - start + 1).alias("length"), F.sum(sum(widths, F.lit(48))).alias("bytes")
    ).first()
    width = max(1, -(-(size["length"] or 0) // max(1, size["n"])))
    cut = real.select(
        F.col(on).alias(_KEY), start.alias(_FROM), end.alias(_TO), *values,
        F.explode(F.sequence(_bucket(start, width), _bucket(end, width))).alias(_BUCKET),
    )
    placed = rows.withColumns({"_moment": at.cast("long"), "_place": _bucket(at.cast("long"), width)})
    matched = (F.col(on) == F.col(_KEY)) & (F.col("_place") == F.col(_BUCKET))
    matched &= F.col("_moment").between(F.col(_FROM), F.col(_TO))
    if BUCKETS_EACH * size["n"] <= max_rows and BUCKETS_EACH * (size["bytes"] or 0) <= max_bytes:
        cut = F.broadcast(cut)
    else:
        shares = max(1, min(MAX_SALTS, SALTED_ROWS // (BUCKETS_EACH * size["n"])))
        offset = [c for c in ENVELOPE[1:] if c in rows.columns]
        spread = F.xxhash64(*(F.col(f"`{c}`") for c in (offset or rows.columns)))
        placed = placed.withColumn("_share", F.pmod(spread, F.lit(shares)).cast("int"))
        cut = cut.withColumn(_SHARE, F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        matched &= F.col("_share") == F.col(_SHARE)
    joined = placed.join(cut, matched, how)
    return joined.drop("_moment", "_place", "_share", _KEY, _BUCKET, _FROM, _TO, _SHARE)


def _bucket(moment: Column, width: int) -> Column:
    return F.floor((moment - F.pmod(moment, F.lit(width))) / F.lit(width)).cast("long")


def disjoint(intervals: DataFrame, on: str, ends: tuple[str, str], values: Sequence[str], best: Sequence[Column]) -> DataFrame:
    """Cut overlapping intervals at each other's ends and keep, on each stretch, the one that ``best`` ranks highest.

    So a row's join needs no choice among several. The work is on the table of intervals: its stretches, at most two for
    each interval, times how many intervals lie over one another.
    """
    start, end = ends
    real = intervals.where(F.col(on).isNotNull() & (F.col(start) <= F.col(end)))
    edges = real.select(on, F.explode(F.array(F.col(start), F.col(end) + 1)).alias("_from")).distinct()
    following = F.lead("_from").over(Window.partitionBy(on).orderBy("_from"))
    stretches = edges.withColumn("_until", following - 1).where(F.col("_until").isNotNull())
    ranked = real.select(on, start, end, F.struct(*values).alias(ENTRY), F.struct(*best).alias("_rank"))
    covered = interval_join(stretches, ranked, on, F.col("_from"), ends, [ENTRY, "_rank"], "inner")
    chosen = covered.groupBy(on, "_from", "_until").agg(F.max_by(ENTRY, "_rank").alias(ENTRY))
    return chosen.select(on, F.col("_from").alias(start), F.col("_until").alias(end), f"{ENTRY}.*")


def as_of(rows: DataFrame, entries: DataFrame, on: str, at: Column, since: str, values: Sequence[str], version: str) -> DataFrame:
    """Join each row to its key's latest entry at or before its moment; NULL before the first one.

    An entry holds from ``since`` until the day before the next one of its key, over gaps of any length; of several
    of one day that with the highest ``version`` counts. Closed entries are intervals; each key's last one, which has
    no end, is a lookup of a row for each key.
    """
    require_fields(entries, [on, since, *values, version], "table of dated entries")
    dated = entries.where(F.col(on).isNotNull() & F.col(since).isNotNull())
    one = dated.groupBy(on, since).agg(F.max_by(F.struct(*values), version).alias(ENTRY))
    until = F.lead(since).over(Window.partitionBy(on).orderBy(since)) - 1
    ended = one.withColumn("_until", until)
    last = ended.where(F.col("_until").isNull()).select(on, F.struct(F.col(since).alias("since"), F.col(ENTRY).alias("entry")).alias("last"))
    found = probe(rows, Lookup.values(last, on, "last"), on).withColumnRenamed("_lookup_value", "_last")
    found = interval_join(found, ended.where(F.col("_until").isNotNull()), on, at, (since, "_until"), [ENTRY])
    entry = F.when(at.cast("long") >= F.col("_last.since"), F.col("_last.entry")).otherwise(F.col(ENTRY))
    return found.withColumns({name: entry[name] for name in values}).drop("_last", ENTRY)
