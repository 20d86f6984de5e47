from __future__ import annotations

import csv

import pytest
from pyspark.sql import functions as F
from examples import REGION_TAX, STORE_TAX, order, sale

from weir.functions.money import PYTHON_FLOAT
from weir.operators.validate import DirtyReference
from weir.plans import coffee, pipelines, sales
from weir.sources import records, topics


def write(path, fields, rows):
    with open(path, "w", newline="") as file:
        writer = csv.DictWriter(file, fields, restval="x")
        writer.writeheader()
        writer.writerows(rows)


@pytest.fixture
def data(tmp_path):
    """The files of both domains: three sales, one with a bad quantity, and four orders, two bad."""
    write(tmp_path / "regions.csv", sales.REGION_FIELDS, [{"region_id": k, "tax_rate_pct": v} for k, v in REGION_TAX.items()])
    write(tmp_path / "products.csv", sales.PRODUCT_FIELDS, [{"product_id": "P-5"}])
    write(tmp_path / "stores.csv", coffee.STORE_FIELDS, [{"store_id": k, "tax_rate_pct": v} for k, v in STORE_TAX.items()])
    write(tmp_path / "drinks.csv", coffee.DRINK_FIELDS, [{"drink_id": "D-1"}])
    fields = [*reversed(sales.SALES.fields)]
    write(
        tmp_path / "sales.csv",
        fields,
        [
            sale(),
            sale(order_id="A-2", region_id="CA-QC", unit_price="54.99", quantity="1", datetime="2026-05-04T08:28:00Z"),
            sale(order_id="A-3", quantity="0", datetime="2026-05-04T09:00:00Z"),
            sale(order_id="A-4", customer_note='for "my", team', datetime="2026-05-05T09:00:00Z"),
        ],
    )
    write(
        tmp_path / "coffee_orders.csv",
        coffee.COFFEE.required,
        [
            order(),
            order(order_id="B-2", size="venti", datetime="2026-06-18T07:10:00Z"),
            order(order_id="B-3", store_id="S-STL", unit_price="4.75", quantity="1", is_loyalty="true", size="medium",
                  datetime="2026-06-18T07:23:00Z"),
            order(order_id="B-4", payment_method="bitcoin", datetime="2026-06-18T07:30:00Z"),
        ],
    )
    return str(tmp_path)


def consume(spark, domain, data, out, **options):
    rates = pipelines.load_rates(spark, domain, data)
    read = pipelines.read_whole_topic if options.pop("whole", False) else pipelines.read_file_topic
    checkpoint = options.pop("checkpoint", f"{out}/checkpoint")
    return pipelines.run_consumer(read(spark, out), domain, rates, out, checkpoint, **options)


def values(df, *columns):
    return [tuple(float(v) if hasattr(v, "quantize") else v for v in row) for row in df.select(*columns).collect()]


def test_sales_from_file_to_report(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales_per_item"], str(tmp_path / "out")
    assert pipelines.run_producer(spark, domain, data, out, partitions=2) == {"sent": 3, "rejected": 1}
    rejected = records.read_written(spark, f"{out}/rejected", ["validation_errors"]).first()
    assert rejected["validation_errors"] == "Quantity must be at least 1: 0"
    assert consume(spark, domain, data, out) == {"consumed": 3, "skipped": 0}
    frames = pipelines.report(spark, domain, out)
    assert values(frames["by_region"], "region_id", "sale_count") == [("CA-QC", 1), ("US-TX", 2)]
    assert values(frames["run_stats"], "count", "total", "minimum", "maximum") == [(3, 452.86, 63.22, 194.82)]
    assert max(values(frames["running"], "running_count", "running_total")) == (3, 452.86)
    assert frames["accepted_table"].columns == list(sales.SALES.accepted_fields)
    table = records.read_written(spark, f"{out}/consumed/*/*", [*sales.SALES.consumed_fields, "total_per_item"])
    assert sorted(values(table, "order_id", "total", "total_per_item")) == [
        ("A-1", "194.82", "64.94"), ("A-2", "63.22", "63.22"), ("A-4", "194.82", "64.94"),
    ]
    notes = pipelines.landed(spark, domain, out).accepted().where("order_id = 'A-4'")
    assert notes.first()["customer_note"] == 'for "my", team'


def test_coffee_from_file_to_report(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["coffee"], str(tmp_path / "out")
    assert pipelines.run_producer(spark, domain, data, out) == {"sent": 2, "rejected": 2}
    assert consume(spark, domain, data, out, policy=PYTHON_FLOAT) == {"consumed": 2, "skipped": 0}
    frames = pipelines.report(spark, domain, out, PYTHON_FLOAT)
    assert values(frames["by_store"], "store_id", "order_count", "revenue") == [("S-DEN", 1, 17.76), ("S-STL", 1, 4.66)]
    assert values(frames["by_loyalty"], "label", "revenue", "discount_given") == [
        ("loyalty", 4.66, 0.48), ("non-loyalty", 17.76, 0.0),
    ]
    assert values(frames["cumulative"], "store_id", "revenue") == [("S-DEN", 17.76), ("S-STL", 4.66)]


def test_counts_bound_records_and_messages(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales"], str(tmp_path / "out")
    # The third record is rejected, and counts.
    assert pipelines.run_producer(spark, domain, data, out, count=3) == {"sent": 2, "rejected": 1}
    assert consume(spark, domain, data, out, limit=1, whole=True) == {"consumed": 1, "skipped": 0}
    assert values(pipelines.landed(spark, domain, out).accepted(), "order_id") == [("A-1",)]
    # The next run, without a bound, takes what is left and nothing twice.
    for _ in range(2):
        assert consume(spark, domain, data, out, whole=True, fresh=False) == {"consumed": 2, "skipped": 0}
    with pytest.raises(ValueError, match="bound a batch read"):
        consume(spark, domain, data, out, limit=1)


def test_line_breaks_and_ragged_lines_in_the_records(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales"], str(tmp_path / "out")
    note = sale(order_id="A-5", customer_note="two\nlines")
    with open(f"{data}/sales.csv", "a", newline="") as file:
        csv.DictWriter(file, [*reversed(sales.SALES.fields)]).writerow(note)
        file.write("only,three,fields\n")
    assert pipelines.run_producer(spark, domain, data, out) == {"sent": 4, "rejected": 2}
    errors = records.read_written(spark, f"{out}/rejected", ["validation_errors"]).select("validation_errors").collect()
    assert sorted(r[0].strip() for r in errors) == ["Malformed record: only,three,fields", "Quantity must be at least 1: 0"]
    consume(spark, domain, data, out)
    landed = pipelines.landed(spark, domain, out).accepted().where("order_id = 'A-5'").first()
    assert landed["customer_note"] == "two\nlines"


def test_an_empty_topic_stops_the_consumer(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales"], str(tmp_path / "out")
    pipelines.run_producer(spark, domain, data, out, count=0)
    with pytest.raises(topics.EmptyTopic):
        consume(spark, domain, data, out, whole=True)


def test_rejects_can_be_left_out(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales"], str(tmp_path / "out")
    pipelines.run_producer(spark, domain, data, out)
    broken = spark.read.parquet(f"{out}/topic").limit(1).withColumn("value", F.lit("{}")).withColumn("offset", F.lit(10**9).cast("long"))
    broken.write.mode("append").parquet(f"{out}/topic")
    assert consume(spark, domain, data, out, whole=True)["skipped"] == 1
    assert consume(spark, domain, data, f"{out}", whole=True, checkpoint=f"{out}/again", quarantine=False) == {"consumed": 3, "skipped": 0}


def test_a_fresh_run_clears_and_a_continued_one_adds_nothing(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales"], str(tmp_path / "out")
    assert pipelines.run_producer(spark, domain, data, out)["sent"] == 3
    for _ in range(2):
        counts = consume(spark, domain, data, out, checkpoint=f"{out}/checkpoint", fresh=False)
        assert counts == {"consumed": 3, "skipped": 0}
    counts = consume(spark, domain, data, out, checkpoint=f"{out}/another", fresh=True)
    assert counts == {"consumed": 3, "skipped": 0}
    assert records.read_written(spark, f"{out}/consumed/*/*", ["total"]).count() == 3


def test_bad_reference_rows_stop_the_producer(spark, data, tmp_path):
    with open(f"{data}/products.csv", "a") as file:
        file.write("P-6,,x,x,x,x\n")
    with pytest.raises(DirtyReference, match="products: missing required field product_name"):
        pipelines.run_producer(spark, pipelines.DOMAINS["sales"], data, str(tmp_path / "out"))


def test_no_rejects_and_no_records(spark, data, tmp_path):
    domain, out = pipelines.DOMAINS["sales"], str(tmp_path / "out")
    assert pipelines.run_producer(spark, domain, data, out, count=2) == {"sent": 2, "rejected": 0}
    assert pipelines.run_producer(spark, domain, data, out, count=0) == {"sent": 0, "rejected": 0}
