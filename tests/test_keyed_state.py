"""Running values of many keys: only touched keys are written, and a new run goes on where the last one ended."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from weir.streaming import keyed, runs

MANY = 20_000


def test_a_batch_writes_the_keys_it_touches_and_a_restart_goes_on(spark, tmp_path):
    path, out, mark = (str(tmp_path / name) for name in ("in", "out", "mark"))
    amount = (F.pmod(F.col("id") * 37, F.lit(1000)) / 100).cast("decimal(18,2)").alias("total")
    every = spark.range(MANY).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("_kafka_offset"), amount)
    ten = spark.range(MANY, MANY + 500).select(
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("k"), F.col("id") % 10)).alias("key"), F.col("id").alias("_kafka_offset"), amount
    )
    every.write.mode("append").parquet(path)
    stream = runs.stream_files(spark, path, every.schema)
    assert keyed.run_by_key(stream, ["key"], out, mark).updated == MANY
    ten.coalesce(1).write.mode("append").parquet(path)
    assert keyed.run_by_key(stream, ["key"], out, mark).updated == 10  # nine keys and the missing one
    so_far = Window.partitionBy("key").orderBy("_kafka_offset").rowsBetween(Window.unboundedPreceding, 0)
    expected = every.union(ten).select(
        "key", "_kafka_offset", "total", F.count("*").over(so_far).alias("running_count"),
        *(f("total").over(so_far).cast("decimal(18,2)").alias(n) for f, n in zip((F.sum, F.min, F.max), keyed.VALUES[1:])),
    )
    got = spark.read.parquet(out).select(expected.columns)
    assert got.count() == MANY + 500 and got.exceptAll(expected).count() == 0
    every.limit(1).write.mode("append").parquet(path)
    with pytest.raises(StreamingQueryException, match="came after"):
        keyed.run_by_key(stream, ["key"], out, mark)


def test_amounts_that_are_not_exact_are_refused(spark):
    with pytest.raises(TypeError, match="exact running values"):
        keyed.running_by_key(spark.createDataFrame([], "key string, _kafka_offset long, total double"), ["key"])
