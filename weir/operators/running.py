"""Running values in message order, without one task seeing all rows.

A plain window over the whole order moves every row into one task. Here the offsets are cut into
buckets of fixed width instead, and the running value of a row is the value within its bucket
combined with the totals of all earlier buckets:

1. rows are shuffled by bucket and scanned within it (a window of at most ``width`` rows);
2. each bucket is reduced to one row of totals, by a second read of the measured columns only;
3. the totals are scanned the same way, in groups of ``width`` buckets, and then across groups;
4. the carried totals are joined back on the bucket, which the scanned rows are already
   partitioned and sorted by, so the large side is shuffled once in all.

No group exceeds ``width`` rows, however many rows one key has, because an offset is unique
within its partition. Sums of decimals make the result equal to the plain window's.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.contract import require_fields
from weir.operators.validate import IS_VALID

PARTITION, OFFSET = "_kafka_partition", "_kafka_offset"
WIDTH = 1 << 18

_PART, _BUCKET, _GROUP, _KEY = "_part", "_bucket", "_group", "_key"


@dataclass(frozen=True)
class Measure:
    """A running value: how rows enter it and how two totals of it combine."""

    kind: str
    column: Column

    def of_rows(self) -> Column:
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.column)

    def of_totals(self, name: str) -> Column:
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](F.col(name))

    def combine(self, left: Column, right: Column) -> Column:
        if self.kind == "min":
            return F.least(left, right)
        if self.kind == "max":
            return F.greatest(left, right)
        # NULL means no value so far, and stays so when neither side has one.
        return F.coalesce(left + right, left, right)


def running(
    df: DataFrame,
    measures: Mapping[str, Measure],
    keys: Sequence[str] = (),
    partition: str = PARTITION,
    offset: str = OFFSET,
    width: int = WIDTH,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add running values in the order (partition, offset), separately for each key if given.

    ``initial`` holds values carried in from earlier rows: the keys and one column per measure.
    It needs keys; a run over one global order can use a constant key.
    """
    require_fields(df, [*keys, partition, offset])
    # No slot column is NULL: a missing key is a key like any other, and plain equality lets the joins
    # reuse the partitioning of the windows.
    slotted = df.withColumns(
        {
            _PART: F.coalesce(F.col(partition).cast("long"), F.lit(-1)),
            _BUCKET: F.coalesce(F.expr(f"`{offset}` div {width}"), _no_place().cast("long")),
            _KEY: F.struct(*keys) if keys else F.lit(0),
        }
    )
    slots = [_PART, _BUCKET, _KEY]
    so_far = Window.partitionBy(*slots).orderBy(offset).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = slotted.withColumns({f"_in_{n}": m.of_rows().over(so_far) for n, m in measures.items()})

    # The totals read only the columns of the measures and are combined before they are shuffled: a second
    # narrow read costs less than carrying whole rows through an aggregate.
    totals = slotted.groupBy(*slots).agg(*(m.of_rows().alias(n) for n, m in measures.items()))
    carry = _carry(totals, measures, width, _state(initial, keys, measures))

    joined = scanned.join(carry, slots, "left")
    values = {n: m.combine(F.col(f"_before_{n}"), F.col(f"_in_{n}")) for n, m in measures.items()}
    spare = [*slots, *(f"_before_{n}" for n in measures), *(f"_in_{n}" for n in measures)]
    return joined.withColumns(values).drop(*spare)


def _carry(totals: DataFrame, measures: Mapping[str, Measure], width: int, state: DataFrame | None) -> DataFrame:
    """Return, for each bucket, the totals of all earlier buckets."""
    grouped = totals.withColumn(_GROUP, _slice(_BUCKET, width))
    group = [_PART, _GROUP, _KEY]
    groups = grouped.groupBy(*group).agg(*(m.of_totals(n).alias(n) for n, m in measures.items()))

    earlier = Window.partitionBy(_KEY).orderBy(_PART, _GROUP).rowsBetween(Window.unboundedPreceding, -1)
    far = groups.select(*group, *(m.of_totals(n).over(earlier).alias(f"_far_{n}") for n, m in measures.items()))
    if state is not None:
        far = far.join(state, _KEY, "left").withColumns(
            {f"_far_{n}": m.combine(F.col(f"_state_{n}"), F.col(f"_far_{n}")) for n, m in measures.items()}
        )

    beside = Window.partitionBy(*group).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    near = grouped.select(
        *group, _BUCKET, *(m.of_totals(n).over(beside).alias(f"_near_{n}") for n, m in measures.items())
    )
    return near.join(far, group, "left").select(
        _PART,
        _BUCKET,
        _KEY,
        *(m.combine(F.col(f"_far_{n}"), F.col(f"_near_{n}")).alias(f"_before_{n}") for n, m in measures.items()),
    )


def _no_place() -> Column:
    """Fail: a message without an offset has no place in the order."""
    return F.raise_error(F.lit("a message without an offset has no place in the order"))


def _slice(column: str, width: int) -> Column:
    """Number the slices of ``width`` consecutive values."""
    return F.coalesce(F.expr(f"`{column}` div {width}"), F.lit(-1).cast("long"))


def _state(initial: DataFrame | None, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame | None:
    """Return carried-in values by packed key."""
    if initial is None:
        return None
    if not keys:
        raise ValueError("carried-in values need keys")
    return initial.select(F.struct(*keys).alias(_KEY), *(F.col(n).alias(f"_state_{n}") for n in measures))


def stats_measures(column: str = "total") -> dict[str, Measure]:
    """The statistics a consumer keeps while messages arrive."""
    amount = F.col(column)
    return {
        "running_count": Measure("count", amount),
        "running_total": Measure("sum", amount),
        "running_min": Measure("min", amount),
        "running_max": Measure("max", amount),
    }


def with_mean(df: DataFrame) -> DataFrame:
    """Add the running mean of a frame that has the running count and total."""
    mean = F.try_divide(F.col("running_total").cast("double"), F.col("running_count"))
    return df.withColumn("running_mean", mean)


def running_stats(df: DataFrame, column: str = "total", keys: Sequence[str] = (), **options) -> DataFrame:
    """Add running count, total, mean, minimum and maximum of a column."""
    return with_mean(running(df, stats_measures(column), keys, **options))


def running_route_counts(checked: DataFrame, keys: Sequence[str] = (), **options) -> DataFrame:
    """Add the numbers of messages accepted and rejected so far."""
    measures = {
        "running_accepted": Measure("count", F.when(F.col(IS_VALID), True)),
        "running_rejected": Measure("count", F.when(~F.col(IS_VALID), True)),
    }
    return running(checked, measures, keys, **options)


def totals_by_offset(df: DataFrame, column: str = "total") -> DataFrame:
    """Return the chart series: partition, offset and amount."""
    return df.select(PARTITION, F.col(OFFSET).cast("long").alias(OFFSET), column)
