from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from examples import REGION_TAX, STORE_TAX, order, rates, sale
from pyspark.sql import functions as F

from weir.functions import money
from weir.functions.money import DECIMAL, PYTHON_FLOAT
from weir.operators.enrich import enrich_coffee, enrich_sales, enrich_sales_per_item


def test_python_rounding_matches_python(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 0.005, 0.015, 0.125, 0.375, 1.005, 2.675, 1.125, -0.125, -2.675, 1e15, -1e17, 33.335, 1e-9]
    values += [rng.randrange(10**9) / 1000 for _ in range(40_000)]
    values += [rng.randrange(-(10**7), 10**7) / 8 for _ in range(20_000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(20_000)]
    values += [rng.randrange(10**6) / 100 * (rng.randrange(2000) / 10000) for _ in range(40_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", money.python_round2(F.col("x")).alias("r")).collect():
        assert row["r"] == round(row["x"], 2), row["x"]


def test_python_rounding_matches_python_on_the_given_prices(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    product = F.col("l_extendedprice") * F.col("l_tax")
    for row in lines.select(product.alias("x"), money.python_round2(product).alias("r")).collect():
        assert row["r"] == round(row["x"], 2)


def test_decimal_rounding_is_half_up(spark):
    values = ["0.125", "0.135", "-0.125", "2.675", "1.005", "0.004999"]
    df = spark.createDataFrame([(Decimal(v),) for v in values], "x decimal(18,6)")
    got = [row[0] for row in df.select(DECIMAL.round2(F.col("x"))).collect()]
    assert got == [Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP) for v in values]


def amounts(df, *names):
    return [tuple(float(row[name]) for name in names) for row in df.collect()]


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT])
def test_golden_sales(frame, policy):
    df = frame([sale(), sale(region_id="CA-QC", unit_price="54.99", quantity="1")])
    enriched = enrich_sales_per_item(df, rates(frame, "region_id", REGION_TAX), policy)
    assert amounts(enriched, "subtotal", "tax_amount", "total", "total_per_item") == [
        (179.97, 14.85, 194.82, 64.94), (54.99, 8.23, 63.22, 63.22),
    ]


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT])
def test_golden_orders(frame, policy):
    df = frame([order(), order(store_id="S-STL", unit_price="4.75", quantity="1", is_loyalty="true")])
    enriched = enrich_coffee(df, rates(frame, "store_id", STORE_TAX), policy)
    assert amounts(enriched, "subtotal", "loyalty_discount", "tax_amount", "total") == [
        (16.50, 0.00, 1.26, 17.76), (4.75, 0.48, 0.39, 4.66),
    ]


def test_the_policies_differ_on_ties(frame):
    df = frame(
        [
            order(store_id="S-DEN", unit_price="3.75", quantity="3", is_loyalty="true"),
            order(store_id="S-AUS", unit_price="6.00", quantity="1", is_loyalty="false"),
        ]
    )
    table = rates(frame, "store_id", STORE_TAX)
    names = ("loyalty_discount", "tax_amount")
    assert [row[0] for row in amounts(enrich_coffee(df, table, DECIMAL), *names)] == [1.13, 0.0]
    assert [row[0] for row in amounts(enrich_coffee(df, table, PYTHON_FLOAT), *names)] == [1.12, 0.0]
    assert amounts(enrich_coffee(df, table, DECIMAL), *names)[1][1] == 0.50
    assert amounts(enrich_coffee(df, table, PYTHON_FLOAT), *names)[1][1] == 0.49


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT])
def test_enrichment_keeps_inputs_and_falls_back_to_the_default_rate(frame, policy):
    df = frame([{"message_id": "m", "region_id": "??", "quantity": "2", "unit_price": "10.00", "tax_rate_pct": "x"}])
    row = enrich_sales(df, rates(frame, "region_id", REGION_TAX), policy).first()
    assert (row["message_id"], row["region_id"], row["tax_rate_pct"]) == ("m", "??", "x")
    assert (float(row["subtotal"]), float(row["tax_amount"]), float(row["total"])) == (20.00, 1.60, 21.60)


def test_rate_of_a_percentage(spark):
    df = spark.createDataFrame([("7.5",), (None,)], "p string")
    assert [row[0] for row in df.select(PYTHON_FLOAT.rate(F.col("p"))).collect()] == [0.075, 0.08]
    assert [row[0] for row in df.select(DECIMAL.rate(F.col("p"))).collect()] == [Decimal("0.075"), Decimal("0.08")]


@pytest.mark.parametrize("policy", [DECIMAL, PYTHON_FLOAT])
def test_zero_quantity_and_numbers_that_do_not_parse(frame, policy):
    df = frame([sale(quantity="0"), sale(quantity=None), sale(unit_price="n/a"), sale(quantity="3000000000")])
    rows = enrich_sales_per_item(df, rates(frame, "region_id", REGION_TAX), policy).collect()
    assert [row["total_per_item"] for row in rows[:2]] == [0, 0]
    assert rows[2]["total"] is None and rows[3]["total"] is None


def test_the_widest_amounts_do_not_overflow(frame):
    df = frame([order(quantity=str(2**31 - 1), unit_price="999999999999.999999", store_id="S-CHI", is_loyalty="true")])
    row = enrich_coffee(df, rates(frame, "store_id", {"S-CHI": "999.9999"})).first()
    exact = Decimal(2**31 - 1) * Decimal("999999999999.999999")
    cents = Decimal("0.01")
    subtotal = exact.quantize(cents, ROUND_HALF_UP)
    discount = (subtotal * Decimal("0.10")).quantize(cents, ROUND_HALF_UP)
    tax = ((subtotal - discount) * Decimal("9.999999")).quantize(cents, ROUND_HALF_UP)
    assert (row["subtotal"], row["tax_amount"], row["total"]) == (subtotal, tax, subtotal - discount + tax)


def test_prices_keep_more_than_two_places_until_the_subtotal(frame):
    row = enrich_sales(frame([sale(unit_price="4.994", quantity="3")]), rates(frame, "region_id", REGION_TAX)).first()
    assert float(row["subtotal"]) == round(3 * 4.994, 2) == 14.98


def test_money_text(spark):
    df = spark.createDataFrame([(Decimal("1234567.50"),), (Decimal("0.05"),)], "x decimal(18,2)")
    assert [row[0] for row in df.select(money.money_text(F.col("x"))).collect()] == ["$1,234,567.50", "$0.05"]


def test_not_a_number_prices_are_quarantined_by_the_exact_policy(frame):
    from weir.operators.validate import check
    from weir.plans.flows import computable_rules

    df = frame([sale(unit_price=v) for v in ("nan", "inf", "n/a", "", " 5 ", "1e2")])
    rows = check(df, [], computable_rules(DECIMAL)).collect()
    assert [row["is_valid"] for row in rows] == [False, False, False, True, True, True]
    assert math.isclose(float(rows[0]["quantity"]), 3)


def test_python_rounding_holds_at_every_size(spark):
    values = [35184372088832.125, 2.0**45 + 0.375, 2.0**45 + 0.0078125, 2.0**46 + 0.015625, 2.0**46, 2.0**52 + 0.5, 1e17, 1e300, 0.125, 2.675]
    values += [2.0**45 + k * 2.0**-7 for k in range(200)]
    values += [-v for v in values]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", money.python_round2(F.col("x")).alias("r")).collect()
    assert [r["r"] for r in rows] == [round(v, 2) for v in values]


def test_a_price_is_kept_whole_or_refused(spark):
    texts = ["0.0000004", "1.1234567", "999999999999.999999", "1000000000000", "2.50", " 3 ", "", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(DECIMAL.price(F.col("t"))).collect()
    assert [None if r[0] is None else float(r[0]) for r in rows] == [None, None, 999999999999.999999, None, 2.5, 3.0, 0.0, None]
