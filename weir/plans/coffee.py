"""The coffee domain: drink orders, keyed by store, taxed by store, with a loyalty discount."""

from __future__ import annotations

from weir.functions.rules import allowed, boolean_text, iso_datetime, known, positive_integer
from weir.operators.contract import Contract

# Field lists and allowed values of the coffee contract.
REQUIRED = (
    "order_id", "datetime", "store_id", "drink_id", "size",
    "unit_price", "quantity", "is_loyalty", "customer_id", "payment_method",
)
OPTIONAL = ("customer_note",)
DERIVED = ("subtotal", "loyalty_discount", "tax_amount", "total")
SIZES = ("small", "medium", "large")
PAYMENT_METHODS = ("credit_card", "apple_pay", "gift_card", "cash")
STORE_FIELDS = ("store_id", "store_name", "city", "state_code", "tax_rate_pct", "timezone")
DRINK_FIELDS = ("drink_id", "drink_name", "category", "base_price_usd", "is_seasonal")

COFFEE = Contract(
    name="coffee",
    key="store_id",
    required=REQUIRED,
    optional=OPTIONAL,
    derived=DERIVED,
    references={"store_id": "stores", "drink_id": "drinks"},
    rules=(
        known("store_id"),
        known("drink_id"),
        allowed("size", SIZES),
        allowed("payment_method", PAYMENT_METHODS),
        iso_datetime("datetime"),
        positive_integer("quantity"),
        boolean_text("is_loyalty"),
    ),
)
