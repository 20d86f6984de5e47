from __future__ import annotations

import pytest
from examples import REGION_TAX, SALE, rates, sale
from pyspark.sql import functions as F

from weir.operators import lookup as lookups
from weir.operators.contract import SchemaError, require_fields
from weir.operators.enrich import enrich_sales
from weir.operators.lookup import Lookup
from weir.operators.project import accepted_shape, consumed_shape, rejected_shape, required_only
from weir.operators.route import Landing, split
from weir.operators.validate import DirtyReference, check, reference_errors, require_clean, validate
from weir.plans.flows import consume
from weir.plans.sales import REGION_FIELDS, SALES
from weir.sources import records, topics

ENVELOPE = {"_kafka_key": "US-TX", "_kafka_partition": "0", "_kafka_offset": "42"}


def test_projections_fill_missing_fields_with_empty_text(frame):
    sparse = frame([{"order_id": "A-1"}])
    for shape, names in (
        (accepted_shape, SALES.accepted_fields), (rejected_shape, SALES.rejected_fields),
        (consumed_shape, SALES.consumed_fields),
    ):
        got = shape(sparse, SALES)
        assert got.columns == list(names)
        assert got.first().asDict() == {name: "A-1" if name == "order_id" else "" for name in names}
    assert required_only(frame([sale()]), SALES).columns == list(SALES.required)


def test_shapes_of_the_contract():
    assert SALES.consumed_fields[-6:] == ("subtotal", "tax_amount", "total", *ENVELOPE)
    assert SALES.rejected_fields == (*SALES.required, "validation_errors", *ENVELOPE)
    assert SALES.accepted_fields == (*SALES.required, *SALES.optional, *ENVELOPE)


def test_a_missing_column_is_named(frame):
    with pytest.raises(SchemaError, match="lacks region_id; available fields: order_id"):
        require_fields(frame([{"order_id": "1"}]), ["order_id", "region_id"])
    incomplete = frame([{k: v for k, v in SALE.items() if k != "device_type"}])
    with pytest.raises(SchemaError, match="device_type"):
        validate(incomplete, SALES, {k: Lookup.keys(frame([{"k": "1"}]), "k") for k in ("regions", "products")})


def test_reference_tables_are_checked(frame):
    good = {name: "x" for name in REGION_FIELDS}
    errors = reference_errors(frame([good, {**good, "timezone": " ", "region_name": None}]), "region_id", REGION_FIELDS, "regions")
    assert sorted(row["error"] for row in errors.collect()) == [
        "regions: missing required field region_name", "regions: missing required field timezone",
    ]
    with pytest.raises(DirtyReference, match="missing required field timezone"):
        require_clean(errors)
    require_clean(reference_errors(frame([good]), "region_id", REGION_FIELDS, "regions"))


@pytest.mark.parametrize("split_bytes", ["16", "1000", "100m"])
def test_the_last_record_of_a_key_wins_whatever_the_splits(spark, tmp_path, split_bytes):
    # The last file is the smallest and the first the largest; Spark reads large files first.
    for name, rows in (("1", "a,1\nb,2\nc,3\n" * 20 + "a,4\n"), ("2", "a,5\nb,6\n" * 5), ("3", "a,7\n")):
        (tmp_path / f"{name}.csv").write_text("k,v\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        table = records.read_records(spark, str(tmp_path), ["k", "v"], place=True)
        got = lookups.key_values(table, "k", "v", records.PLACE).collect()
        assert {r["k"]: r["v"] for r in got} == {"a": "7", "b": "6", "c": "3"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_values_that_differ_need_an_order(frame):
    table = frame([{"k": "a", "v": "1"}, {"k": "b", "v": "2"}, {"k": "a", "v": "3"}, {"k": "b", "v": "2"}])
    assert [tuple(r) for r in lookups.duplicate_report(table, "k", "v").collect()] == [("a", 2)]
    with pytest.raises(Exception, match="several values of v for k a"):
        lookups.key_values(table, "k", "v").collect()
    same = table.where("k = 'b'")
    assert [tuple(r) for r in lookups.key_values(same, "k", "v").collect()] == [("b", "2")]


def test_salts_follow_the_size(spark):
    table = spark.range(1000).select(F.col("id").cast("string").alias("k"), "id")
    assert Lookup.values(table, "k", "id").salts == lookups.MAX_SALTS


def test_key_set_drops_missing_keys(frame):
    table = frame([{"k": "a"}, {"k": "a"}, {"k": ""}, {"k": None}, {"k": "b"}])
    assert sorted(r["k"] for r in lookups.key_set(table, "k").collect()) == ["a", "b"]


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_a_large_lookup_gives_the_same_rows_as_a_small_one(spark, how):
    # One key holds a third of the rows, some keys are unknown, some missing.
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    table = spark.range(40).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    table = table.union(spark.createDataFrame([("hot", -1)], "k string, v long"))
    small, large = Lookup.values(table, "k", "v"), Lookup.values(table, "k", "v", max_rows=10)
    assert small.is_small and not large.is_small
    one, other = (lookups.probe(rows, side, "k", how) for side in (small, large))
    assert one.columns == other.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert "Broadcast" in one._jdf.queryExecution().executedPlan().toString()
    salted = lookups.probe(rows, large, "k", how, spread_by=["id"])
    assert sorted(map(str, salted.collect())) == sorted(map(str, one.collect()))


def test_a_hot_key_is_spread_over_several_groups(spark):
    rows = spark.range(4000).withColumn("k", F.lit("hot"))
    large = Lookup.values(spark.createDataFrame([("hot", 1)], "k string, v int"), "k", "v", max_rows=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookups.probe(rows, large, "k", spread_by=["id"], salts=16)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and "BroadcastHashJoin" not in plan
        assert joined.where("_lookup_value = 1").count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_a_large_lookup_is_never_broadcast(spark, tmp_path, how):
    # Its file is small, so by Spark's own estimate, which leaves out the salts' copies, it would be.
    spark.range(2000).select(F.col("id").cast("string").alias("k")).write.parquet(f"{tmp_path}/t")
    large = Lookup.keys(spark.read.parquet(f"{tmp_path}/t"), "k", max_rows=1000)
    rows = spark.range(3000).select("id", F.col("id").cast("string").alias("k"))
    joined = lookups.probe(rows, large, "k", how)
    found = joined.collect()
    assert len(found) == {"left": 3000, "left_semi": 2000, "left_anti": 1000}[how]
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_large_lookup_is_copied_a_bounded_number_of_times(spark):
    # 60 times sf0.1 has 1,200,000 products: 53 copies of each were 64 million rows.
    large = Lookup.keys(spark.range(1_200_000).select(F.col("id").cast("string").alias("k")), "k")
    assert not large.is_small and 1 < large.salts <= 8


def test_byte_size_also_bounds_a_broadcast(spark):
    wide = spark.createDataFrame([("a", "x" * 5000)], "k string, v string")
    assert not Lookup.values(wide, "k", "v", max_bytes=1000).is_small


def test_misses_are_counted_by_key(frame):
    df = frame([{"region_id": v} for v in ("US-TX", "X", "X", "Y", None)])
    report = lookups.miss_report(df, rates(frame, "region_id", REGION_TAX), "region_id")
    assert {r["region_id"]: r["miss_count"] for r in report.collect()} == {"X": 2, "Y": 1, None: 1}


def landing(spark, tmp_path, **options):
    land = Landing(spark, str(tmp_path / "landed"), SALES, **options)
    land.reset()
    return land


def checked(frame, *rows):
    return check(frame([{**row, **ENVELOPE} for row in rows]), SALES.required)


def test_landing_creates_clears_and_keeps_values(spark, frame, tmp_path):
    land = landing(spark, tmp_path)
    assert land.accepted().count() == land.rejected().count() == 0
    assert land.write(checked(frame, sale(order_id="A-1"), sale(order_id="A-2"), sale(customer_id="")), 0) == {
        "accepted": 2, "rejected": 1,
    }
    assert sorted((r["order_id"], r["region_id"], r["_kafka_offset"]) for r in land.accepted().collect()) == [
        ("A-1", "US-TX", 42), ("A-2", "US-TX", 42),
    ]
    assert land.rejected().first()["validation_errors"] == "Missing required field: customer_id"
    land.create()
    assert land.accepted().count() == 2
    land.reset()
    assert land.accepted().count() == land.rejected().count() == 0


def test_landing_a_batch_again_replaces_it(spark, frame, tmp_path):
    land = landing(spark, tmp_path)
    land.write(checked(frame, sale(order_id="A-1"), sale(customer_id="")), 0)
    land.write(checked(frame, sale(order_id="A-2")), 1)
    land.write(checked(frame, sale(order_id="A-3")), 0)
    assert sorted(r["order_id"] for r in land.accepted().collect()) == ["A-2", "A-3"]
    assert land.rejected().count() == 0


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_runs_never_replace_each_other(spark, frame, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        first, second = landing(spark, tmp_path), Landing(spark, str(tmp_path / "landed"), SALES)
        first.write(checked(frame, sale(order_id="A-1"), sale(customer_id="")), 0)
        second.create()
        second.write(checked(frame, sale(order_id="A-2")), 0)
        assert sorted(r["order_id"] for r in second.accepted().collect()) == ["A-1", "A-2"]
        # A retry without rejects leaves none behind, under either setting.
        first.write(checked(frame, sale(order_id="A-1")), 0)
        assert first.rejected().count() == 0 and first.accepted().count() == 2
        second.reset()
        assert first.accepted().count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_landing_an_empty_batch(spark, frame, tmp_path):
    land = landing(spark, tmp_path)
    assert land.write(checked(frame, sale()).where("false"), 0) == {"accepted": 0, "rejected": 0}
    assert land.accepted().count() == 0


def test_rejects_can_be_skipped(spark, frame, tmp_path):
    land = landing(spark, tmp_path, quarantine=False)
    land.write(checked(frame, sale(), sale(customer_id="")), 0)
    assert (land.accepted().count(), land.rejected().count()) == (1, 0)


def test_split_gives_both_shapes(frame):
    accepted, rejected = split(checked(frame, sale(), sale(quantity=None)), SALES)
    assert (accepted.count(), rejected.count()) == (1, 1)
    assert accepted.columns == list(SALES.accepted_fields) and rejected.columns == list(SALES.rejected_fields)


def test_consuming_never_fails_on_bad_numbers(frame):
    df = frame([{**sale(unit_price="n/a", quantity="x"), **ENVELOPE}, {**sale(), **ENVELOPE}])
    bad, good = consume(df, SALES, rates(frame, "region_id", REGION_TAX), enrich_sales).collect()
    assert bad["errors"] == ["Invalid quantity: 'x'", "Invalid unit_price: 'n/a'"] and not bad["is_valid"]
    assert good["is_valid"] and float(good["total"]) == 194.82


def test_csv_keeps_quotes_blanks_and_empty_fields(spark, frame, tmp_path):
    notes = ['said "hi", left', " padded ", "", "it's", "back\\slash", "a\nb", "a\r\nb", "a\\nb\\\\\n\\", '"\n"']
    rows = [sale(order_id=str(i), customer_note=note) for i, note in enumerate(notes)]
    path = str(tmp_path / "out")
    records.write_records(frame(rows).select(*SALES.fields), path)
    back = records.read_written(spark, path, SALES.fields).na.fill("")
    got = {r["order_id"]: r["customer_note"] for r in back.collect()}
    assert [got[str(i)] for i in range(len(notes))] == notes
    records.write_records(frame(rows[:1]).select(*SALES.fields), path, first=False)
    assert records.read_written(spark, path, SALES.fields).count() == len(notes) + 1
    records.write_records(frame(rows[:1]).select(*SALES.fields), path)
    assert records.read_written(spark, path, SALES.fields).count() == 1


def test_any_document_is_a_note(spark, tmp_path):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("string"), "text")
    records.write_records(texts, str(tmp_path / "out"))
    back = records.read_written(spark, str(tmp_path / "out"), ["doc_id", "text"])
    assert back.count() == texts.count() and records.count_records(spark, str(tmp_path / "out"), ["doc_id", "text"]) == texts.count()
    assert sorted(map(tuple, back.na.fill("").collect())) == sorted(map(tuple, texts.na.fill("").collect()))


def test_a_ragged_line_is_one_malformed_record(spark, tmp_path):
    (tmp_path / "r.csv").write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x\ny",2,3\n')
    rows = records.read_records(spark, str(tmp_path / "r.csv"), ["a", "b", "c"], multi_line=True)
    assert rows.count() == rows.select("a").count() == 4
    got = [tuple(r) for r in rows.collect()]
    assert ("1", "2", "3", None) in got and ("x\ny", "2", "3", None) in got
    assert sorted(r[3].strip() for r in got if r[3]) == ["4,5", "6,7,8,9"] and all(r[:3] == (None,) * 3 for r in got if r[3])


def test_csv_fields_are_found_by_name(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("b,extra,a\n2,9,1\n")
    table = records.read_records(spark, str(path), ["a", "b"])
    assert table.first().asDict() == {"a": "1", "b": "2", "extra": "9", records.MALFORMED: None}
    with pytest.raises(SchemaError, match="lacks c; available fields: b, extra, a"):
        records.read_records(spark, str(path), ["a", "c"])


def test_csv_files_that_differ_fail_the_read(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        records.read_records(spark, str(tmp_path), ["a", "b"]).collect()


def test_csv_stream(spark, tmp_path):
    from weir.streaming import runs

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "in" / "2.csv").write_text("a,b\n3,\n")
    stream = records.stream_records(spark, str(tmp_path / "in"), ["a", "b"], max_files=1)
    runs.run_append(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [("1", "2", None), ("3", None, None)]


def test_messages_survive_encoding(spark, frame):
    sent = [sale(customer_note='q"uo\\te', discount_code=None), sale(order_id="A-2", region_id="CA-ON")]
    encoded = topics.encode(frame(sent), SALES)
    assert encoded.columns == ["key", "value"]
    arrived = encoded.select("key", "value", F.lit(1).alias("partition"), F.lit(7).alias("offset"))
    back = topics.decode(arrived, SALES).collect()
    assert [row["_kafka_key"] for row in back] == ["US-TX", "CA-ON"]
    assert back[0]["customer_note"] == 'q"uo\\te' and back[0]["discount_code"] == ""
    assert all(row[topics.UNDECODED] is None and row["_kafka_offset"] == 7 for row in back)


@pytest.mark.parametrize("value", ['{"order_id":"x","quan', "[1]", "text", "", None, '"a"'])
def test_values_that_are_no_objects_are_rejected_not_fatal(spark, value):
    arrived = spark.createDataFrame([("k", value, 0, 1)], "key string, value string, partition int, offset long")
    row = check(topics.decode(arrived, SALES), SALES.required).first()
    assert row[topics.UNDECODED] == (value or "")
    assert row["order_id"] is None and not row["is_valid"] and len(row["errors"]) == len(SALES.required)


def test_an_empty_topic_stops_the_run(spark, frame):
    messages = frame([{**sale(), **ENVELOPE}])
    assert topics.require_messages(messages) is messages
    with pytest.raises(topics.EmptyTopic, match="empty"):
        topics.require_messages(messages.where("false"))
    assert topics.offsets_by_partition(messages).first()["message_count"] == 1


def test_parsing_happens_once_below_a_filter(spark):
    arrived = spark.createDataFrame([("k", "{}", 0, 1)], "key string, value string, partition int, offset long")
    checked_rows = check(topics.decode(arrived, SALES), SALES.required).where("is_valid")
    assert checked_rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_topics_need_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, "localhost:9092", "orders", stream=False)
