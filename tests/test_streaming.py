from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weir.operators import aggregate
from weir.operators.enrich import enrich_coffee, enrich_sales
from weir.operators.route import Landing
from weir.operators.running import OFFSET, PARTITION, running, stats_measures
from weir.operators.validate import valid_rows
from weir.plans import tables
from weir.plans.catalog import Given
from weir.plans.coffee import COFFEE
from weir.plans.flows import consume
from weir.plans.sales import SALES
from weir.streaming import runs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return Given(spark, SF)


@pytest.fixture(scope="module")
def topic(given, tmp_path_factory):
    """Sales messages in files that arrive one after the other, each with later offsets."""
    path = str(tmp_path_factory.mktemp("topic"))
    count = given.sales.count()
    for part in range(5):
        first, last = count * part // 5, count * (part + 1) // 5
        slice_ = given.sales.where(F.col(OFFSET).between(first, last - 1))
        slice_.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(given, topic, max_files=1):
    return runs.stream_files(given.spark, topic, given.sales.schema, max_files=max_files)


def rows(df):
    return sorted(map(str, df.collect()))


def test_streamed_landing_equals_batch(given, topic, tmp_path):
    landing = Landing(given.spark, f"{tmp_path}/rows", SALES)
    landing.reset()
    runs.land(stream(given, topic), given.consume_sales, landing, f"{tmp_path}/checkpoint")
    batch = Landing(given.spark, f"{tmp_path}/batch", SALES)
    batch.reset()
    counts = batch.write(given.consume_sales(given.sales), 0)
    assert counts["accepted"] + counts["rejected"] == given.sales.count()
    assert rows(landing.accepted()) == rows(batch.accepted())
    assert rows(landing.rejected()) == rows(batch.rejected())

    # The same checkpoint adds nothing; a new one replays everything.
    runs.land(stream(given, topic), given.consume_sales, landing, f"{tmp_path}/checkpoint")
    assert landing.accepted().count() == counts["accepted"]
    again = Landing(given.spark, f"{tmp_path}/again", SALES)
    again.reset()
    runs.land(stream(given, topic), given.consume_sales, again, f"{tmp_path}/checkpoint-2")
    assert again.accepted().count() == counts["accepted"]


def test_a_failure_after_writing_a_batch_lands_it_once(given, topic, tmp_path):
    landing = Landing(given.spark, f"{tmp_path}/rows", SALES)
    landing.reset()
    seen = []

    def write(batch, batch_id):
        landing.write(given.consume_sales(batch), batch_id)
        seen.append(batch_id)
        if seen == [0, 1, 2]:
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        runs.run_batches(stream(given, topic), f"{tmp_path}/checkpoint", write)
    runs.run_batches(stream(given, topic), f"{tmp_path}/checkpoint", write)
    assert seen == [0, 1, 2, 2, 3, 4]
    landed = landing.accepted().select(OFFSET).union(landing.rejected().select(OFFSET))
    assert landed.count() == landed.distinct().count() == given.sales.count()


def test_streamed_enrichment_equals_batch(given, topic, tmp_path):
    rates = given.region_rates.stored(f"{tmp_path}/rates")
    enriched = valid_rows(consume(stream(given, topic), SALES, rates, enrich_sales)).drop("errors")
    runs.run_append(enriched, f"{tmp_path}/rows", f"{tmp_path}/checkpoint")
    assert rows(given.spark.read.parquet(f"{tmp_path}/rows")) == rows(given.accepted_sales().drop("errors"))


def test_streamed_statistics_equal_batch(given, topic, tmp_path):
    rates = given.region_rates.stored(f"{tmp_path}/rates")
    accepted = valid_rows(consume(stream(given, topic), SALES, rates, enrich_sales))
    runs.run_latest(aggregate.run_stats(accepted), f"{tmp_path}/all", f"{tmp_path}/c1")
    assert rows(runs.read_latest(given.spark, f"{tmp_path}/all")) == rows(aggregate.run_stats(given.accepted_sales()))
    runs.run_latest(aggregate.run_stats(accepted, by=("region_id",)), f"{tmp_path}/by", f"{tmp_path}/c2")
    by_region = aggregate.run_stats(given.accepted_sales(), by=("region_id",))
    assert rows(runs.read_latest(given.spark, f"{tmp_path}/by")) == rows(by_region)


def test_running_rows_continue_across_batches_and_restarts(given, topic, tmp_path):
    measures = stats_measures()
    rates = given.region_rates.stored(f"{tmp_path}/rates")
    accepted = valid_rows(consume(stream(given, topic), SALES, rates, enrich_sales))
    slim = accepted.select(PARTITION, OFFSET, "total")
    for _ in range(2):
        runs.run_running(slim, measures, [PARTITION], f"{tmp_path}/rows", f"{tmp_path}/state", f"{tmp_path}/checkpoint")
    names = [PARTITION, OFFSET, "total", *measures]
    expected = running(given.accepted_sales().select(PARTITION, OFFSET, "total"), measures, [PARTITION])
    assert rows(runs.read_batches(given.spark, f"{tmp_path}/rows").select(names)) == rows(expected.select(names))


def test_a_bounded_run_goes_on_at_the_next_message(given, topic, tmp_path):
    messages, taken = given.spark.read.parquet(topic), []

    def write(batch, batch_id):
        taken.append([(r[PARTITION], r[OFFSET]) for r in batch.select(PARTITION, OFFSET).collect()])

    for limit in (30, 1, 450, None, 10, None):
        runs.run_bounded(messages, limit, f"{tmp_path}/positions", write)
    expected = sorted((r[PARTITION], r[OFFSET]) for r in messages.collect())
    assert [len(t) for t in taken] == [30, 1, 450, len(expected) - 481]
    assert [m for t in taken for m in sorted(t)] == expected


def test_a_bounded_run_that_fails_takes_the_same_messages_again(given, topic, tmp_path):
    messages, seen = given.spark.read.parquet(topic), []

    def fail_once(batch, batch_id):
        seen.append((batch_id, sorted(r[OFFSET] for r in batch.collect())))
        if len(seen) == 1:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        runs.run_bounded(messages, 30, f"{tmp_path}/positions", fail_once)
    runs.run_bounded(messages, 30, f"{tmp_path}/positions", fail_once)
    assert seen[0] == seen[1] and seen[0][0] == 0 and len(seen[0][1]) == 30


def test_late_offsets_stop_a_running_stream(given, tmp_path):
    topic = str(tmp_path / "topic")
    for low, high in ((500, 999), (0, 499)):
        given.sales.where(F.col(OFFSET).between(low, high)).coalesce(1).write.mode("append").parquet(topic)
    slim = stream(given, topic).select(PARTITION, OFFSET, F.lit(1).cast("decimal(12,2)").alias("total"))
    with pytest.raises(Exception, match="came after"):
        runs.run_running(slim, stats_measures(), [PARTITION], f"{tmp_path}/rows", f"{tmp_path}/state", f"{tmp_path}/checkpoint")


def test_old_versions_and_states_are_removed(given, topic, tmp_path):
    slim = stream(given, topic).select(PARTITION, OFFSET, F.lit(1).cast("decimal(12,2)").alias("total"))
    runs.run_running(slim, stats_measures(), [PARTITION], f"{tmp_path}/rows", f"{tmp_path}/state", f"{tmp_path}/c1")
    runs.run_latest(slim.groupBy().agg(F.count("*").alias("n")), f"{tmp_path}/all", f"{tmp_path}/c2")
    assert runs.versions(given.spark, f"{tmp_path}/state") == [3, 4]
    assert len(runs.versions(given.spark, f"{tmp_path}/all")) == 2
    assert runs.read_latest(given.spark, f"{tmp_path}/all").first()["n"] == given.sales.count()


def test_cumulative_revenue_by_store(given, tmp_path):
    orders = tables.order_messages(runs.stream_files(given.spark, f"{SF}/orders.parquet", given.table("orders").schema))
    accepted = valid_rows(consume(orders, COFFEE, given.store_rates.stored(f"{tmp_path}/rates"), enrich_coffee))
    runs.run_latest(aggregate.cumulative_by(accepted, "store_id"), f"{tmp_path}/rows", f"{tmp_path}/checkpoint")
    batch = aggregate.cumulative_by(given.accepted_orders(), "store_id")
    assert rows(runs.read_latest(given.spark, f"{tmp_path}/rows")) == rows(batch)
