"""Derived money fields."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions import money
from weir.functions.money import DECIMAL, MoneyPolicy
from weir.functions.text import is_missing, is_true_text
from weir.operators.intervals import as_of, day_number, disjoint, interval_join
from weir.operators.lookup import LOOKUP_VALUE, Lookup, probe

QUANTITY, PRICE, RATE, LOYAL, TAXABLE = "_quantity", "_price", "_rate", "_loyal", "_taxable"
USD_RATE, DISCOUNT_RATE = "_usd_rate", "_discount_rate"

# Fixed value: the share of the subtotal that loyalty members get off.
LOYALTY_DISCOUNT_RATE = "0.10"


@dataclass(frozen=True)
class Derived:
    """A derived field: its name and, given the policy, its amount before rounding."""

    name: str
    amount: Callable[[MoneyPolicy], Column]


def derive(df: DataFrame, steps: Sequence[Derived], policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add derived fields in order, each rounded to cents before the next one uses it."""
    for step in steps:
        df = policy.with_rounded(df, step.name, step.amount(policy))
    return df


def subtotal() -> Derived:
    """Quantity times unit price."""
    return Derived("subtotal", lambda policy: F.col(QUANTITY) * F.col(PRICE))


def loyalty_discount() -> Derived:
    """The loyalty share of the subtotal, 0 for others."""
    return Derived(
        "loyalty_discount",
        lambda policy: F.when(F.col(LOYAL), F.col("subtotal") * policy.constant(LOYALTY_DISCOUNT_RATE)).otherwise(
            policy.constant("0.0")
        ),
    )


def taxable() -> Derived:
    """The subtotal after the loyalty discount."""
    return Derived(TAXABLE, lambda policy: F.col("subtotal") - F.col("loyalty_discount"))


def tax_amount(base: str = "subtotal") -> Derived:
    """The tax on a base amount."""
    return Derived("tax_amount", lambda policy: F.col(base) * F.col(RATE))


def total(base: str = "subtotal") -> Derived:
    """The base amount with its tax."""
    return Derived("total", lambda policy: F.col(base) + F.col("tax_amount"))


def total_per_item() -> Derived:
    """The total for each unit, 0 when the quantity is 0."""
    return Derived(
        "total_per_item",
        lambda policy: F.when(F.col(QUANTITY) == 0, policy.constant("0.0")).otherwise(
            F.try_divide(F.col("total"), F.col(QUANTITY))
        ),
    )


SALE_STEPS = (subtotal(), tax_amount(), total())
ORDER_STEPS = (subtotal(), loyalty_discount(), taxable(), tax_amount(TAXABLE), total(TAXABLE))


def with_operands(df: DataFrame, lookup: Lookup, on: str, policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add the parsed quantity, price, tax rate and loyalty flag the derived fields compute with."""
    rated = probe(df, lookup, on)
    loyal = is_true_text(F.col("is_loyalty")) if "is_loyalty" in df.columns else F.lit(False)
    return rated.withColumns(
        {
            QUANTITY: money.quantity(F.col("quantity").cast("string")),
            PRICE: policy.price(F.col("unit_price").cast("string")),
            RATE: policy.rate(F.col(LOOKUP_VALUE)),
            LOYAL: loyal,
        }
    ).drop(LOOKUP_VALUE)


def enrich(
    df: DataFrame, lookup: Lookup, on: str, steps: Sequence[Derived], policy: MoneyPolicy = DECIMAL
) -> DataFrame:
    """Keep every input column and add the derived fields."""
    derived = derive(with_operands(df, lookup, on, policy), steps, policy)
    return derived.drop(QUANTITY, PRICE, RATE, LOYAL, TAXABLE)


def enrich_sales(df: DataFrame, rates: Lookup, policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add subtotal, tax_amount and total to sales."""
    return enrich(df, rates, "region_id", SALE_STEPS, policy)


def enrich_sales_per_item(df: DataFrame, rates: Lookup, policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add total_per_item as well."""
    return enrich(df, rates, "region_id", (*SALE_STEPS, total_per_item()), policy)


def enrich_coffee(df: DataFrame, rates: Lookup, policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add subtotal, loyalty_discount, tax_amount and total to coffee orders."""
    return enrich(df, rates, "store_id", ORDER_STEPS, policy)


def in_usd(df: DataFrame, rates: DataFrame, policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add total_usd: the total at the latest rate of its currency on or before the sale's day.

    ``rates`` has currency_code, rate_date, exchange_rate_to_usd and version. A sale before the first rate of its
    currency, without a day, or at a rate that does not parse, has no total_usd. An exact rate has up to 5 digits before
    the point and 6 after it, so that no digit of the product is lost before it is rounded.
    """
    rate = policy.price(F.col("exchange_rate_to_usd"))
    rate = rate.try_cast("decimal(11,6)") if policy.exact else rate
    dated = rates.select(
        "currency_code", day_number(F.col("rate_date")).alias("since"), rate.alias(USD_RATE),
        "version", is_missing(F.col("exchange_rate_to_usd")).alias("_absent"),
    ).where(F.col(USD_RATE).isNotNull() & ~F.col("_absent"))
    rated = as_of(df, dated, "currency_code", day_number(F.col("datetime")), "since", [USD_RATE], "version")
    return derive(rated, [Derived("total_usd", lambda _: F.col("total") * F.col(USD_RATE))], policy).drop(USD_RATE)


def discounted(df: DataFrame, codes: DataFrame, policy: MoneyPolicy = DECIMAL) -> DataFrame:
    """Add discount_pct and discount: what the sale's code takes off its subtotal on the sale's day.

    ``codes`` has discount_code, valid_from, valid_to and discount_pct. A code holds on both its first and its last day;
    where its windows overlap the highest percentage counts. Other sales have no percentage and a discount of 0.
    """
    windows = codes.select(
        "discount_code",
        day_number(F.col("valid_from")).alias("first"),
        day_number(F.col("valid_to")).alias("last"),
        policy.rate(F.col("discount_pct").try_cast("decimal(10,4)")).alias(DISCOUNT_RATE),
        F.col("discount_pct").try_cast("double").alias("discount_pct"),
    ).where(F.col("discount_pct").isNotNull())
    values = [DISCOUNT_RATE, "discount_pct"]
    apart = disjoint(windows, "discount_code", ("first", "last"), values, [F.col("discount_pct")])
    found = interval_join(df, apart, "discount_code", day_number(F.col("datetime")), ("first", "last"), values)
    off = F.col("subtotal") * F.col(DISCOUNT_RATE)
    step = Derived("discount", lambda policy: F.when(F.col(DISCOUNT_RATE).isNull(), policy.constant("0.0")).otherwise(off))
    return derive(found, [step], policy).drop(DISCOUNT_RATE)
