"""Streams in event time against batch answers: late, early and idle batches, sessions, replays, a restart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weir.streaming import events, runs

SCHEMA = "order_id string, customer string, datetime string, total double, _kafka_key string, _kafka_partition int, _kafka_offset long"


@pytest.fixture
def topic(spark, tmp_path):
    """A folder that messages arrive in, a batch a call, and the stream that reads it a batch at a time."""

    class Topic:
        path, offset = str(tmp_path / "topic"), 0

        def arrive(self, *rows: tuple) -> None:
            placed = [(*r, "k", 0, self.offset + i) for i, r in enumerate(rows)]
            self.offset += len(rows)
            spark.createDataFrame(placed, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

        def stream(self):
            return runs.stream_files(spark, self.path, spark.createDataFrame([], SCHEMA).schema, max_files=1)

        def batch(self):
            return spark.read.schema(SCHEMA).parquet(self.path)

    return Topic()


def sale(order, moment, customer="a", total=1.0):
    return (order, customer, moment if moment is None or "T" not in moment else f"2024-01-{moment}:00Z", total)


def sums():
    return {"n": F.count("*"), "revenue": F.sum("total")}


def daily(stream):
    return events.windowed(events.in_event_time(stream, "datetime", "1 day"), "1 day", sums())


def shown(df):
    return sorted((str(r["start"]), r["n"], r["revenue"]) for r in df.collect())


def test_windows_take_early_rows_and_leave_out_late_ones(spark, topic, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    topic.arrive(sale("1", "01T10:00"), sale("2", "05T10:00"), sale("3", "nonsense"), sale("4", None))  # one day early
    topic.arrive(sale("5", "04T23:00"))  # out of order, within the delay
    topic.arrive(sale("6", "02T10:00"), sale("7", "02T11:00"))  # later than the watermark of 4 January
    ran = events.run_changed(daily(topic.stream()), out, mark)
    expected = topic.batch().where("order_id not in ('6', '7')").groupBy(F.window(F.try_to_timestamp("datetime"), "1 day").alias("w"))
    expected = expected.agg(*(c.alias(n) for n, c in sums().items())).where("w is not null").select("w.start", "n", "revenue")
    assert shown(events.read_changed(spark, out, ["start"])) == shown(expected)
    assert ran.rows == 7 and ran.late == 1  # both late rows are one group of their task


def test_windows_close_once_and_an_idle_run_changes_nothing(spark, topic, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    topic.arrive(sale("1", "01T10:00"), sale("2", "01T11:00"))
    events.run_closed(daily(topic.stream()), out, mark)
    assert spark.read.schema("start timestamp, n long").parquet(out).count() == 0  # the day may still get rows
    assert events.run_closed(daily(topic.stream()), out, mark).rows == 0
    topic.arrive(sale("3", "04T10:00"))
    events.run_closed(daily(topic.stream()), out, mark)
    assert shown(spark.read.parquet(out)) == [("2024-01-01 00:00:00", 2, 2.0)]
    events.run_closed(daily(topic.stream()), out, mark)
    assert shown(spark.read.parquet(out)) == [("2024-01-01 00:00:00", 2, 2.0)]


def test_sessions_join_across_batches(spark, topic, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    topic.arrive(sale("1", "01T10:00"), sale("2", "01T11:00", "b"))
    topic.arrive(sale("3", "01T10:50"), sale("4", "01T10:25"))  # the second closes the gap
    topic.arrive(sale("5", "01T12:00"), sale("6", "09T00:00", "z"))
    timed = events.in_event_time(topic.stream(), "datetime", "1 day")
    events.run_closed(events.sessions(timed, "30 minutes", sums(), ["customer"]), out, mark)
    found = sorted((r["customer"], str(r["start"])[11:], str(r["end"])[11:], r["n"]) for r in spark.read.parquet(out).collect())
    assert found == [("a", "10:00:00", "11:20:00", 3), ("a", "12:00:00", "12:30:00", 1), ("b", "11:00:00", "11:30:00", 1)]


def test_a_replay_that_is_restarted_midway_adds_nothing(spark, topic, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    first = [sale("1", "01T10:00"), sale("2", "01T11:00"), sale(None, "01T12:00"), sale(None, "01T12:00"), sale(" ", "01T13:00")]
    distinct = lambda: events.without_repeats(events.in_event_time(topic.stream(), "datetime", "7 days"), "order_id")
    topic.arrive(*first)
    events.run_closed(distinct(), out, mark)
    topic.arrive(first[0], sale("3", "02T10:00"))  # the replay starts, with a new message among it
    events.run_closed(distinct(), out, mark)
    topic.arrive(first[1], sale("3", "02T10:00"), sale("4", "junk"), sale("4", "junk"))
    events.run_closed(distinct(), out, mark)
    found = sorted(str(r["order_id"]) for r in spark.read.parquet(out).collect())
    assert found == [" ", "1", "2", "3", "4", "4", "None", "None"]  # nothing is known of when 4 was
