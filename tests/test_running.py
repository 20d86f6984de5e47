from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weir.operators import ordering
from weir.operators.running import OFFSET, PARTITION, Measure, running, running_route_counts, running_stats, stats_measures
from weir.plans.catalog import all_queries


@pytest.fixture(scope="module")
def events(spark):
    """Events in three partitions; one store holds a third of the rows and some have none."""
    store = F.when(F.col("event_id") % 3 == 0, "hot").when(F.col("event_id") % 11 == 0, None)
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.when(F.col("user_id") % 2 == 0, 0).otherwise(F.col("user_id") % 3).cast("int").alias(PARTITION),
        F.col("event_id").alias(OFFSET),
        F.col("value").cast("decimal(12,2)").alias("total"),
        store.otherwise(F.concat(F.lit("s"), F.col("user_id") % 5)).alias("store"),
        (F.col("event_id") % 4 > 0).alias("is_valid"),
    )


def plain(df, keys):
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(PARTITION, OFFSET)
    frame = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {
            "running_count": F.count("total").over(frame),
            "running_total": F.sum("total").over(frame),
            "running_min": F.min("total").over(frame),
            "running_max": F.max("total").over(frame),
        }
    )


def values(df, *columns):
    return sorted(map(tuple, df.select(PARTITION, OFFSET, *columns).collect()), key=lambda row: row[:2])


@pytest.mark.parametrize("keys", [[], ["store"], [PARTITION], ["store", "is_valid"]])
@pytest.mark.parametrize("width", [2, 7, 64, 1 << 16])
def test_running_values_equal_a_plain_window(events, keys, width):
    names = list(stats_measures())
    got = running_stats(events, keys=keys, width=width)
    assert got.columns == [*events.columns, *names, "running_mean"]
    assert values(got, *names) == values(plain(events, keys), *names)


def test_mean_is_total_over_count(events):
    for row in running_stats(events, width=50).collect():
        assert row["running_mean"] == float(row["running_total"]) / row["running_count"]


def test_rows_without_a_value_carry_the_values_so_far(spark):
    rows = [(0, 0, None), (0, 1, 5), (0, 2, None), (0, 3, 2), (1, 0, 9)]
    df = spark.createDataFrame(rows, f"{PARTITION} int, {OFFSET} long, total int")
    got = [tuple(r)[3:] for r in sorted(running_stats(df, width=2).collect())]
    assert got == [
        (0, None, None, None, None), (1, 5, 5, 5, 5.0), (1, 5, 5, 5, 5.0), (2, 7, 2, 5, 3.5), (3, 16, 2, 9, 16 / 3),
    ]


def test_route_counts(events):
    got = values(running_route_counts(events, width=9), "running_accepted", "running_rejected")
    accepted = rejected = 0
    expected = []
    for row in events.orderBy(PARTITION, OFFSET).collect():
        accepted, rejected = accepted + row["is_valid"], rejected + (not row["is_valid"])
        expected.append((row[PARTITION], row[OFFSET], accepted, rejected))
    assert got == sorted(expected)


def test_values_can_be_carried_in(events):
    measures = stats_measures()
    cut = 400
    early, late = events.where(F.col(OFFSET) < cut), events.where(F.col(OFFSET) >= cut)
    state = early.groupBy(PARTITION).agg(*(m.of_rows().alias(n) for n, m in measures.items()))
    both = running(early, measures, [PARTITION], width=16).union(
        running(late, measures, [PARTITION], width=16, initial=state)
    )
    assert values(both, *measures) == values(running(events, measures, [PARTITION]), *measures)
    with pytest.raises(ValueError, match="keys"):
        running(late, measures, initial=state)


@pytest.mark.parametrize("n", [0, 1, 17, 500, 999, 1000, 10_000])
def test_a_prefix_of_messages_is_exact(events, n):
    taken = ordering.first_messages(events, n)
    expected = sorted((r[PARTITION], r[OFFSET]) for r in events.collect())[:n]
    assert taken.columns == events.columns
    assert sorted((r[PARTITION], r[OFFSET]) for r in taken.collect()) == expected


@pytest.mark.parametrize("n", [0, 3, 250, 333, 10_000])
def test_a_replay_orders_nulls_first(events, n):
    rows = [(r["store"], r["total"], r[OFFSET]) for r in events.collect()]
    expected = sorted(rows, key=lambda r: [(v is not None, v) for v in r])[:n]
    got = ordering.first_rows(events, n, ["store", "total", OFFSET]).select("store", "total", OFFSET).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_equal_keys_are_cut_to_the_number(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    assert ordering.first_rows(rows, 500, ["k"]).groupBy("k").count().orderBy("k").collect() == [(0, 334), (1, 166)]


def test_the_second_read_is_narrow_and_no_row_is_aggregated_whole(events):
    wide = events.withColumn("note", F.col("store"))
    got = running(wide, stats_measures(), ["store"])
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("max(struct(") == 0


def test_a_message_without_an_offset_is_refused(events):
    lost = events.withColumn(OFFSET, F.when(F.col(OFFSET) != 7, F.col(OFFSET)))
    with pytest.raises(Exception, match="no place in the order"):
        running(lost, stats_measures()).collect()


def test_a_key_stays_in_order_across_neighbouring_partitions(spark, events):
    laid_out = ordering.keyed_order(events, "store", [PARTITION, OFFSET], 6)
    placed = laid_out.select(F.spark_partition_id().alias("p"), "store", PARTITION, OFFSET).collect()
    order = [((r["store"] or ""), r[PARTITION], r[OFFSET]) for r in placed]
    assert order == sorted(order) and len(order) == events.count()
    assert len({r["p"] for r in placed if r["store"] == "hot"}) > 1


@pytest.mark.parametrize("partitions", [None, 1, 6])
def test_a_whole_key_is_in_one_partition_in_order(spark, partitions):
    key = "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 5) END AS store"
    rows = spark.range(0, 3000, numPartitions=5).selectExpr(key, f"CAST(id % 4 AS int) AS {PARTITION}", f"3000 - id AS {OFFSET}")
    twice = rows.union(rows.where(f"{OFFSET} % 50 = 0"))
    placed = laid_out_in(spark, ordering.keyed_order(twice, "store", [PARTITION, OFFSET], partitions, whole=True))
    in_order(placed)
    assert sorted(map(str, (r[1:] for r in placed))) == sorted(map(str, map(tuple, twice.collect())))
    assert partitions == 1 or len({r[0] for r in placed}) > 1


def test_no_rows_to_lay_out(spark):
    empty = spark.createDataFrame([], f"store string, {OFFSET} long")
    assert ordering.keyed_order(empty, "store", [OFFSET], whole=True).collect() == []


def test_the_sales_of_a_region_are_in_one_partition(spark):
    laid_out = all_queries()["keyed_partition_order"](spark, "/root/testdata/sf0.001")
    placed = laid_out_in(spark, laid_out.select("region_id", PARTITION, OFFSET))
    in_order(placed)
    assert len({r[0] for r in placed}) > 1


def laid_out_in(spark, df):
    """The rows as they lie, each with its partition first."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return list(map(tuple, df.select(F.spark_partition_id(), "*").collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def in_order(placed):
    """Each key has one partition, and its rows follow one another there in the order of their places."""
    by_key = {}
    for at, (partition, key, *place) in enumerate(placed):
        by_key.setdefault(key, []).append((at, partition, place))
    for found in by_key.values():
        assert len({partition for _, partition, _ in found}) == 1
        assert [at for at, *_ in found] == list(range(found[0][0], found[0][0] + len(found)))
        assert [place for *_, place in found] == sorted(place for *_, place in found)


def test_the_large_side_is_shuffled_once_and_sorted_once(spark, events):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = running(events, {"n": Measure("count", F.lit(1))}, ["store"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan[plan.index("SortMergeJoin") :].split("+- Sort [_part")[0:2]
    assert sum(part.count("Exchange hashpartitioning(_part") for part in left) <= 1
    assert "SinglePartition" not in plan


def test_both_readers_of_the_totals_share_a_shuffle(spark, events):
    got = running(events, {"n": Measure("count", F.lit(1))}, ["store"])
    got.collect()
    assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()
