"""Where a broker's client puts messages, and their order there."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from weir.operators.running import OFFSET, PARTITION
from weir.plans.sales import SALES
from weir.sources import topics

SCHEMA = f"region_id string, note string, {PARTITION} int, {OFFSET} long"


def messages():
    rng = random.Random(8)
    keys = ["R-1"] * 6 + ["R-2", "é漢", "", "  ", None, "x" * 300]
    return [(rng.choice(keys), str(n), n % 3, n * 2 + n % 2) for n in range(400)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_keys_keep_their_order_in_one_partition(spark, partitions):
    rows = messages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    placed = topics.place(df, "region_id", partitions).collect()
    assert sorted(str(tuple(r[:4])) for r in placed) == sorted(map(str, rows))
    by_partition = defaultdict(list)
    for r in placed:
        by_partition[r["broker_partition"]].append(r)
        if r["region_id"] and r["region_id"].strip():
            assert r["broker_partition"] == zlib.crc32(r["region_id"].encode()) % partitions
    for found in by_partition.values():
        assert sorted(r["broker_offset"] for r in found) == list(range(len(found)))
        in_source = sorted(found, key=lambda r: (r[PARTITION], r[OFFSET]))
        assert [r["broker_offset"] for r in in_source] == list(range(len(found)))
    again = topics.place(df.repartition(2), "region_id", partitions).collect()
    assert sorted(map(str, again)) == sorted(map(str, placed))


def test_encoded_messages_carry_their_partition(spark):
    placed = topics.place(spark.createDataFrame(messages(), SCHEMA), "region_id", 3)
    assert topics.encode(placed, SALES).columns == ["key", "value", "partition"]
    assert topics.encode(placed.drop("broker_partition"), SALES).columns == ["key", "value"]


def test_nothing_to_place(spark):
    assert topics.place(spark.createDataFrame([], SCHEMA), "region_id", 3).collect() == []


def test_a_large_partition_spans_tasks(spark):
    df = spark.range(0, 4000).selectExpr("'R-1' AS region_id", "'' AS note", f"0 AS {PARTITION}", f"id AS {OFFSET}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = topics.place(df, "region_id", 3).selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1
