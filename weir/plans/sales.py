"""The sales domain: course sales, keyed by region and taxed by region."""

from __future__ import annotations

from weir.functions.rules import allowed, boolean_text, iso_datetime, known, positive_integer
from weir.operators.contract import ENVELOPE, Contract

# Field lists and allowed values of the sales contract.
REQUIRED = (
    "order_id", "datetime", "region_id", "currency_code", "product_id",
    "unit_price", "quantity", "is_online", "customer_id", "payment_method",
)
OPTIONAL = ("is_new_customer", "device_type", "referral_source", "discount_code", "customer_note")
DERIVED = ("subtotal", "tax_amount", "total")
DEVICE_TYPES = ("mobile", "desktop", "tablet")
PAYMENT_METHODS = ("credit_card", "paypal", "apple_pay", "gift_card")
REFERRAL_SOURCES = ("organic", "paid_search", "email", "social")
CURRENCY_CODES = ("USD", "CAD", "MXN")
REGION_FIELDS = (
    "region_id", "region_name", "country_code", "country_name", "currency_code", "tax_rate_pct", "timezone",
)
PRODUCT_FIELDS = ("product_id", "product_name", "category", "level", "price_usd", "instructor")

# The device type, the referral source and the new-customer flag are optional fields that are
# checked all the same: an empty value is an invalid one.
SALES = Contract(
    name="sales",
    key="region_id",
    required=REQUIRED,
    optional=OPTIONAL,
    derived=DERIVED,
    references={"region_id": "regions", "product_id": "products"},
    stored=(*REQUIRED, *OPTIONAL, *ENVELOPE),
    rules=(
        known("region_id"),
        known("product_id"),
        allowed("device_type", DEVICE_TYPES),
        allowed("payment_method", PAYMENT_METHODS),
        allowed("referral_source", REFERRAL_SOURCES),
        allowed("currency_code", CURRENCY_CODES),
        iso_datetime("datetime"),
        positive_integer("quantity"),
        boolean_text("is_online"),
        boolean_text("is_new_customer"),
    ),
)
