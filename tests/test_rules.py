from __future__ import annotations

import pytest
from examples import keys, order, sale
from pyspark.sql import functions as F

from weir.functions import rules, text
from weir.operators.validate import check, fields_of, validate, with_error_text
from weir.plans.coffee import COFFEE
from weir.plans.sales import SALES


def outcomes(frame, rule, values):
    df = frame([{"n": str(i), "v": value} for i, value in enumerate(values)], ["n", "v"])
    rows = df.select("n", rule.outcome().alias("o"), rule.fails().alias("f")).collect()
    found = {int(row["n"]): row for row in rows}
    for row in rows:
        assert row["f"] is not None and row["f"] == (row["o"] is not None)
    return [found[i]["o"] for i in range(len(values))]


def test_required_treats_null_and_blank_as_missing(frame):
    missing = "Missing required field: v"
    assert outcomes(frame, rules.required("v"), ["x", "", None, "  ", "\t\n", " x", "!", "0", "é"]) == [
        None, missing, missing, missing, missing, None, None, None, None,
    ]


def test_allowed_rejects_missing_values(frame):
    rule = rules.allowed("v", ["small", "large"])
    assert outcomes(frame, rule, ["small", "venti", "", None, "Small"]) == [
        None, "Invalid v: 'venti'", "Invalid v: ''", "Invalid v: ''", "Invalid v: 'Small'",
    ]


@pytest.mark.parametrize(
    "value", ["2026-05-04T08:11:00Z", "2026-05-04 08:11", "2026-05-04T08:11:00.123+05:30", "2024-02-29T00:00:00Z"]
)
def test_datetime_accepts(frame, value):
    assert outcomes(frame, rules.iso_datetime("v"), [value]) == [None]


@pytest.mark.parametrize("value", ["2026", "2026-05-04", "2026-13-04T08:11:00Z", "2026-02-30T08:11:00Z", "x", "", None])
def test_datetime_rejects(frame, value):
    assert outcomes(frame, rules.iso_datetime("v"), [value]) == [f"Invalid v: '{value or ''}'"]


def test_positive_integer_texts(frame):
    big = "9" * 60
    assert outcomes(
        frame, rules.positive_integer("v"), ["1", " 4 ", "+2", "007", big, "0", "-1", "-0", "-" + big, "3.0", "two", "", None]
    ) == [
        None, None, None, None, "Quantity must be at most 2147483647: " + big,
        "Quantity must be at least 1: 0", "Quantity must be at least 1: -1", "Quantity must be at least 1: -0",
        "Quantity must be at least 1: -" + big,
        "Quantity must be an integer: 3.0", "Quantity must be an integer: two",
        "Quantity must be an integer: ", "Quantity must be an integer: ",
    ]


def test_boolean_text_is_strict_and_flags_are_lenient(frame, spark):
    assert outcomes(frame, rules.boolean_text("v"), ["true", "FALSE", " True ", "yes", "1", "", None]) == [
        None, None, None, "Invalid v: 'yes'", "Invalid v: '1'", "Invalid v: ''", "Invalid v: ''",
    ]
    values = ["true", "1", "YES", " y ", "T", "false", "0", "no", "", None, "on"]
    df = frame([{"n": str(i), "v": v} for i, v in enumerate(values)], ["n", "v"])
    got = {int(r["n"]): r["f"] for r in df.select("n", text.is_true_text(F.col("v")).alias("f")).collect()}
    assert [got[i] for i in range(len(values))] == [True] * 5 + [False] * 6


@pytest.mark.parametrize("value", ["plain", "it's", 'say "x"', "both ' and \"", "back\\slash", "line\nbreak\ttab", ""])
def test_quoted_shows_values_as_python_does(frame, value):
    assert frame([{"v": value}]).select(text.quoted(F.col("v"))).first()[0] == repr(value)


def test_missing_fields_hide_other_errors(frame):
    df = frame([sale(customer_id="", payment_method=None, quantity="two"), sale(quantity="two", device_type="")])
    references = {"regions": keys(frame, "region_id", "US-TX"), "products": keys(frame, "product_id", "P-5")}
    rows = validate(df, SALES, references).collect()
    assert rows[0]["errors"] == ["Missing required field: customer_id", "Missing required field: payment_method"]
    assert rows[1]["errors"] == ["Invalid device_type: ''", "Quantity must be an integer: two"]
    assert [row["is_valid"] for row in rows] == [False, False]


def test_sale_errors_come_in_contract_order(frame):
    bad = sale(
        region_id="R'9", product_id="?", device_type="x", payment_method="x", referral_source="x",
        currency_code="x", datetime="x", quantity="0", is_online="x", is_new_customer="x",
    )
    references = {"regions": keys(frame, "region_id", "US-TX"), "products": keys(frame, "product_id", "P-5")}
    checked = validate(frame([sale(), bad]), SALES, references)
    good, failed = checked.collect()
    assert good["is_valid"] and good["errors"] == []
    assert failed["errors"] == [
        'Unknown region_id: "R\'9"', "Unknown product_id: '?'", "Invalid device_type: 'x'", "Invalid payment_method: 'x'",
        "Invalid referral_source: 'x'", "Invalid currency_code: 'x'", "Invalid datetime: 'x'",
        "Quantity must be at least 1: 0", "Invalid is_online: 'x'", "Invalid is_new_customer: 'x'",
    ]
    assert checked.columns == [*SALES.fields, "errors", "is_valid"]
    assert with_error_text(checked).collect()[1]["validation_errors"] == "; ".join(failed["errors"])


def test_order_contract(frame):
    df = frame([order(), order(size="venti"), order(payment_method="bitcoin"), order(store_id="S-X", drink_id="D-X")])
    references = {"stores": keys(frame, "store_id", "S-DEN"), "drinks": keys(frame, "drink_id", "D-1")}
    assert [row["errors"] for row in validate(df, COFFEE, references).collect()] == [
        [], ["Invalid size: 'venti'"], ["Invalid payment_method: 'bitcoin'"],
        ["Unknown store_id: 'S-X'", "Unknown drink_id: 'D-X'"],
    ]


def test_a_user_rule_is_any_condition_and_message(frame):
    rule = rules.Rule("short_note", ("note",), lambda: F.length("note") > 3, lambda: F.lit("Note too long"))
    rows = check(frame([{"note": "abc"}, {"note": "abcd"}]), ["note"], [rule]).collect()
    assert [row["errors"] for row in rows] == [[], ["Note too long"]]
    assert fields_of([rule, rule]) == ("note",)


def test_a_quantity_is_one_that_the_consumer_can_price(frame):
    df = frame([{"v": t} for t in ("2147483647", "2147483648", "0", "1.0", "+7", "007")])
    rule = rules.positive_integer("v")
    assert [r[0] for r in df.select(rule.outcome()).collect()] == [
        None, "Quantity must be at most 2147483647: 2147483648", "Quantity must be at least 1: 0", "Quantity must be an integer: 1.0", None, None,
    ]


def test_a_moment_ends_with_its_text(frame):
    df = frame([{"v": t} for t in ("2026-05-04T08:11:00Z", "2026-05-04T08:11:00Z\n")])
    assert [r[0] is None for r in df.select(rules.iso_datetime("v").outcome()).collect()] == [True, False]
