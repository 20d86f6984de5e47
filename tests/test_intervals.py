"""Interval and as-of joins against comparing every row with every interval."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weir.functions.money import DECIMAL, PYTHON_FLOAT
from weir.operators import enrich, intervals
from weir.operators.lookup import Lookup
from weir.operators.route import Landing
from weir.plans.sales import SALES

RNG = random.Random(4)
WINDOWS = [("hot", s := RNG.randrange(100), s + RNG.choice([0, 1, 3, 30, -2]), i) for i in range(40)]
WINDOWS += [("b", 5, 5, 40), ("b", -400, 900, 41), (None, 0, 100, 42), ("b", None, 9, 43), ("b", 7, None, 44)]
ROWS = [(i, RNG.choice(["hot", "hot", "hot", "b", "none", None]), RNG.choice([None, *range(-5, 140)])) for i in range(600)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, code string, day long")


@pytest.fixture(scope="module")
def windows(spark):
    return spark.createDataFrame(WINDOWS, "code string, first long, last long, w long")


def covering(code, day):
    return [w for c, f, t, w in WINDOWS if None not in (c, f, t, code, day) and c == code and f <= day <= t]


@pytest.mark.parametrize("limit", [10_000, 0], ids=["broadcast", "shuffled and salted"])
def test_every_covering_interval_is_found(spark, rows, windows, limit, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(intervals, "SALTED_ROWS", 1000)
    try:
        found = intervals.interval_join(rows, windows, "code", F.col("day"), ("first", "last"), ["w"], max_rows=limit)
        got, plan = found.collect(), found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = [(i, c, d, w) for i, c, d in ROWS for w in covering(c, d) or [None]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and ("BroadcastHashJoin" in plan) == (limit > 0)


def test_overlaps_leave_the_best(rows, windows):
    apart = intervals.disjoint(windows, "code", ("first", "last"), ["w"], [F.col("w")])
    got = intervals.interval_join(rows, apart, "code", F.col("day"), ("first", "last"), ["w"])
    assert sorted((r["id"], r["w"] if r["w"] is not None else -1) for r in got.collect()) == [
        (i, max(covering(c, d), default=-1)) for i, c, d in ROWS
    ]


def test_an_empty_table_of_intervals_keeps_the_rows(rows, windows):
    got = intervals.interval_join(rows, windows.where("false"), "code", F.col("day"), ("first", "last"), ["w"])
    assert got.count() == len(ROWS) and got.where("w is not null").count() == 0


def test_the_latest_entry_counts(spark, rows):
    entries = [("hot", 3, 1.0, 1), ("hot", 3, 2.0, 5), ("hot", 3, 3.0, 4), ("hot", 90, 4.0, 1), ("b", 100, 5.0, 1), (None, 0, 6.0, 1), ("hot", None, 7.0, 1)]
    frame = spark.createDataFrame(entries, "code string, since long, rate double, version long")
    got = intervals.as_of(rows, frame, "code", F.col("day"), "since", ["rate"], "version")

    def plain(code, day):
        found = [(s, v, r) for c, s, r, v in entries if None not in (c, s, code, day) and c == code and s <= day]
        return max(found)[2] if found else None

    assert sorted((r["id"], str(r["rate"])) for r in got.collect()) == [(i, str(plain(c, d))) for i, c, d in ROWS]
    assert got.columns == ["id", "code", "day", "rate"]


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT], ids=["decimal", "python_float"])
def test_discounts_and_rates_in_both_policies(spark, policy):
    sales = spark.createDataFrame(
        [("1", "X", "2024-03-01T10:00:00Z", "CAD"), ("2", "X", "2024-03-02T23:59:59Z", "CAD"), ("3", "X", "2024-03-03T00:00:00Z", "USD"),
         ("4", "", "2024-03-01T10:00:00Z", "EUR"), ("5", None, None, None), ("6", "X", "junk", "CAD")],
        "order_id string, discount_code string, datetime string, currency_code string",
    )
    sales = sales.withColumns({"subtotal": F.lit("10.10").cast(policy.money_type), "total": F.lit("11.11").cast(policy.money_type)})
    codes = spark.createDataFrame(
        [("X", "2024-03-01", "2024-03-02", "25"), ("X", "2024-03-02", "2024-03-02", "50"), ("X", "2024-03-01", "2024-03-09", "bad")],
        "discount_code string, valid_from string, valid_to string, discount_pct string",
    )
    got = enrich.discounted(sales, codes, policy).orderBy("order_id").collect()
    assert [float(r["discount"]) for r in got] == [2.53 if policy is DECIMAL else round(10.1 * 0.25, 2), 5.05, 0, 0, 0, 0]
    assert [r["discount_pct"] for r in got] == [25, 50, None, None, None, None]
    rates = spark.createDataFrame(
        [("CAD", "2024-03-01", "0.75", 1), ("CAD", "2024-03-02", "n/a", 1), ("CAD", "2024-03-02", "", 2), ("USD", "2024-03-04", "1", 1)],
        "currency_code string, rate_date string, exchange_rate_to_usd string, version long",
    )
    got = enrich.in_usd(sales, rates, policy).orderBy("order_id").collect()
    assert [r["total_usd"] and float(r["total_usd"]) for r in got] == [8.33, 8.33, None, None, None, None]


def test_one_probe_brings_several_columns(spark):
    from weir.operators.lookup import with_columns_of

    table = spark.createDataFrame([("a", "1", None), ("b", "2", "y")], "k string, x string, y string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    got = with_columns_of(rows, Lookup.rows(table, "k", ["x", "y"]), "k", {"x": "x1", "y": "y1"})
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", "1", None), ("b", "2", "y"), ("c", None, None), (None, None, None)]))
    twice = table.union(spark.createDataFrame([("a", "9", "z")], table.schema))
    with pytest.raises(Exception, match="several values"):
        with_columns_of(rows, Lookup.rows(twice, "k", ["x", "y"]), "k", {"x": "x1"}).collect()


def test_batches_without_derived_columns_are_read_beside_those_with_them(spark, tmp_path):
    from weir.operators.validate import IS_VALID

    row = {f: "x" for f in SALES.fields} | {"unit_price": "10", "quantity": "2", "region_id": "R", "_kafka_key": "R"}
    messages = spark.createDataFrame([row]).withColumns({"_kafka_partition": F.lit(0), "_kafka_offset": F.lit(1).cast("long"), "errors": F.array().cast("array<string>"), IS_VALID: F.lit(True)})
    rates = Lookup.values(spark.createDataFrame([("R", "10")], "region_id string, tax_rate_pct string"), "region_id", "tax_rate_pct")
    old, new = Landing(spark, str(tmp_path), SALES), Landing(spark, str(tmp_path), SALES, extra=SALES.derived)
    old.write(messages, 0)
    landed = messages.withColumns({"subtotal": F.lit("7").cast("decimal(18,2)"), "tax_amount": F.lit("1").cast("decimal(18,2)"), "total": F.lit("8").cast("decimal(18,2)")})
    new.write(landed, 1)
    got = new.enriched(lambda df: enrich.enrich_sales(df, rates))
    assert sorted(float(r["total"]) for r in got.collect()) == [8.0, 22.0]  # the landed amount stays as it was
    assert old.accepted().count() == 2 and set(old.accepted().columns) == set(SALES.accepted_fields)


def test_a_run_is_summed_up_as_it_lands_and_a_retry_counts_once(spark, tmp_path):
    from weir.operators.validate import IS_VALID

    row = {f: "x" for f in SALES.fields} | {"_kafka_key": "R"}
    good = [("1.50", 5, True), ("2.25", 3, True), ("9.00", 1, False)]
    frames = [
        spark.createDataFrame([row]).withColumns({
            "total": F.lit(t).cast("decimal(26,2)"), "_kafka_partition": F.lit(0), "_kafka_offset": F.lit(o).cast("long"),
            "errors": F.array().cast("array<string>"), IS_VALID: F.lit(v),
        })
        for t, o, v in good
    ]
    landing = Landing(spark, str(tmp_path / "rows"), SALES, summarize=True)
    landing.write(frames[0], 0)
    for _ in range(2):
        assert landing.write(frames[1].union(frames[2]), 1) == {"accepted": 1, "rejected": 1}
    landing.write(frames[2], 2)  # nothing accepted
    Landing(spark, str(tmp_path / "rows"), SALES, summarize=True).write(frames[0], 0)  # another run
    rows = {r["run"]: r for r in landing.summary().collect()}
    own = rows[landing.run]
    assert len(rows) == 2 and (own["batch_count"], own["accepted_count"], own["rejected_count"]) == (3, 2, 2)
    assert (float(own["revenue"]), own["first_offset"], own["last_offset"]) == (3.75, 3, 5)


def test_ids_that_are_missing_are_no_repeats(spark):
    from weir.operators.ordering import first_of_each

    rows = spark.createDataFrame([(None, 1), (None, 2), ("", 3), (" ", 4), ("a", 6), ("a", 5)], "order_id string, _kafka_offset long")
    got = first_of_each(rows, "order_id").collect()
    assert sorted(r["_kafka_offset"] for r in got) == [1, 2, 3, 4, 5]


def test_a_feed_is_written_by_several_tasks_and_keeps_rows_without_an_order(spark, tmp_path):
    from weir.streaming import runs

    table = spark.range(4000).select(F.when(F.col("id") % 400 != 7, F.col("id")).alias("id"), F.lit("x").alias("v"))
    files = runs.write_in_turn(table, "id", str(tmp_path / "t"), 4, rows_each=300)
    assert files >= 3 and spark.read.parquet(str(tmp_path / "t")).count() == 4000
    seen = []
    stream = runs.stream_files(spark, str(tmp_path / "t"), table.schema, max_files=files)
    runs.run_batches(stream, str(tmp_path / "c"), lambda b, i: seen.append(b.agg(F.min("id"), F.max("id"), F.count("*"), F.count("id")).first()))
    assert len(seen) == 4 and sum(s[2] for s in seen) == 4000
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:])) and seen[0][2] - seen[0][3] == 10


def test_no_digit_is_lost_before_a_converted_total_is_rounded(spark):
    sales = spark.createDataFrame([("1", "CAD", "2024-03-01T10:00:00Z")], "order_id string, currency_code string, datetime string")
    sales = sales.withColumn("total", F.lit("146.39").cast(DECIMAL.money_type))
    rates = spark.createDataFrame(
        [("CAD", "2024-03-01", "0.912050", 1)], "currency_code string, rate_date string, exchange_rate_to_usd string, version long"
    )
    assert str(enrich.in_usd(sales, rates).first()["total_usd"]) == "133.51"  # 133.5149995
