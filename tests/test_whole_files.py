"""End-to-end runs over the two domains' CSV files, if a folder with them is named.

``ORDER_DATA_DIR`` names a folder with sales.csv, regions.csv, products.csv, coffee_orders.csv,
stores.csv and drinks.csv.
"""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from weir.functions.money import DECIMAL, PYTHON_FLOAT
from weir.operators import aggregate
from weir.operators.enrich import enrich_coffee, enrich_sales
from weir.operators.lookup import Lookup
from weir.operators.validate import invalid_rows, reference_errors, require_clean, valid_rows, validate
from weir.plans import coffee, sales
from weir.plans.flows import consume, produce
from weir.sources import records, topics

FOLDER = os.environ.get("ORDER_DATA_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="ORDER_DATA_DIR is not set")


def load(spark, name, fields):
    return records.read_records(spark, f"{FOLDER}/{name}.csv", fields)


def reference(spark, name, key, fields):
    table = load(spark, name, fields)
    require_clean(reference_errors(table, key, fields, name))
    return table


def run(spark, contract, records_, references, rates, enricher, policy):
    """Publish, decode and consume: what a producer and a consumer do one after the other."""
    sent, _ = produce(records_, contract, references)
    arrived = sent.select("key", "value", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"))
    return valid_rows(consume(topics.decode(arrived, contract), contract, rates, enricher, policy))


@pytest.fixture(scope="module")
def sale_run(spark):
    regions = reference(spark, "regions", "region_id", sales.REGION_FIELDS)
    products = reference(spark, "products", "product_id", sales.PRODUCT_FIELDS)
    rows = load(spark, "sales", sales.SALES.fields)
    references = {"regions": Lookup.keys(regions, "region_id"), "products": Lookup.keys(products, "product_id")}
    rates = Lookup.values(regions, "region_id", "tax_rate_pct")
    return rows, references, rates


@pytest.fixture(scope="module")
def order_run(spark):
    stores = reference(spark, "stores", "store_id", coffee.STORE_FIELDS)
    drinks = reference(spark, "drinks", "drink_id", coffee.DRINK_FIELDS)
    rows = load(spark, "coffee_orders", coffee.COFFEE.required)
    references = {"stores": Lookup.keys(stores, "store_id"), "drinks": Lookup.keys(drinks, "drink_id")}
    rates = Lookup.values(stores, "store_id", "tax_rate_pct")
    return rows, references, rates


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT])
def test_sales(spark, sale_run, policy):
    rows, references, rates = sale_run
    accepted = run(spark, sales.SALES, rows, references, rates, enrich_sales, policy)
    stats = aggregate.run_stats(accepted).first()
    shown = [round(float(stats[name]), 2) for name in ("total", "mean", "minimum", "maximum")]
    assert (stats["count"], shown) == (178, [14665.36, 82.39, 32.39, 328.45])
    assert {r["region_id"]: r["sale_count"] for r in aggregate.count_by(accepted, "region_id", "sale_count").collect()} == {
        "CA-ON": 26, "CA-QC": 15, "MX-CMX": 15, "US-CA": 44, "US-MO": 39, "US-TX": 39,
    }


def grouped(df, key, *names):
    return {row[key]: tuple(round(float(row[name]), 2) for name in names) for row in df.collect()}


EXPECTED = {
    "python_float": {
        "store": {"S-DEN": (15, 139.67), "S-KC": (13, 96.14), "S-STL": (11, 81.69), "S-CHI": (7, 70.87), "S-AUS": (6, 47.78)},
        "size": {"large": (20, 212.65), "small": (19, 132.40), "medium": (13, 91.10)},
        "loyalty": {"true": (35, 283.32, 29.00), "false": (17, 152.83, 0.00)},
    },
    "decimal": {
        "store": {"S-DEN": (15, 139.66), "S-KC": (13, 96.14), "S-STL": (11, 81.69), "S-CHI": (7, 70.87), "S-AUS": (6, 47.79)},
        "size": {"large": (20, 212.66), "small": (19, 132.39), "medium": (13, 91.10)},
        "loyalty": {"true": (35, 283.31, 29.01), "false": (17, 152.84, 0.00)},
    },
}


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT])
def test_coffee(spark, order_run, policy):
    rows, references, rates = order_run
    rejected = invalid_rows(validate(rows, coffee.COFFEE, references)).collect()
    assert sorted((r["order_id"], r["errors"][0]) for r in rejected) == [
        ("ORD-1012", "Invalid size: 'venti'"), ("ORD-1033", "Invalid payment_method: 'bitcoin'"),
    ]
    accepted = run(spark, coffee.COFFEE, rows, references, rates, enrich_coffee, policy)
    stats = aggregate.run_stats(accepted).first()
    shown = [round(float(stats[name]), 2) for name in ("total", "mean", "minimum", "maximum")]
    assert (stats["count"], shown) == (52, [436.15, 8.39, 2.70, 17.76])
    expected = EXPECTED[policy.name]
    assert grouped(aggregate.revenue_by(accepted, "store_id"), "store_id", "order_count", "revenue") == expected["store"]
    assert grouped(aggregate.revenue_by(accepted, "size"), "size", "order_count", "revenue") == expected["size"]
    loyalty = aggregate.by_loyalty(accepted)
    assert grouped(loyalty, "is_loyalty", "order_count", "revenue", "discount_given") == expected["loyalty"]
