"""Small messages used by several tests."""

from __future__ import annotations

SALE = {
    "order_id": "A-1",
    "datetime": "2026-05-04T08:11:00Z",
    "region_id": "US-TX",
    "currency_code": "USD",
    "product_id": "P-5",
    "unit_price": "59.99",
    "quantity": "3",
    "is_online": "true",
    "customer_id": "C-9",
    "payment_method": "paypal",
    "is_new_customer": "false",
    "device_type": "tablet",
    "referral_source": "paid_search",
    "discount_code": "",
    "customer_note": "",
}

ORDER = {
    "order_id": "B-1",
    "datetime": "2026-06-18T07:03:00Z",
    "store_id": "S-DEN",
    "drink_id": "D-1",
    "size": "large",
    "unit_price": "5.50",
    "quantity": "3",
    "is_loyalty": "false",
    "customer_id": "C-1",
    "payment_method": "cash",
}

# Tax percentages of the two domains.
REGION_TAX = {"US-MO": "8.00", "US-CA": "9.50", "US-TX": "8.25", "CA-ON": "13.00", "CA-QC": "14.975", "MX-CMX": "16.00"}
STORE_TAX = {"S-KC": "8.60", "S-STL": "9.18", "S-CHI": "10.25", "S-AUS": "8.25", "S-DEN": "7.65"}


def sale(**changes):
    return {**SALE, **changes}


def order(**changes):
    return {**ORDER, **changes}


def rates(frame, key, table):
    from weir.operators.lookup import Lookup

    rows = [{key: name, "tax_rate_pct": percent} for name, percent in table.items()]
    return Lookup.values(frame(rows), key, "tax_rate_pct")


def keys(frame, key, *values):
    from weir.operators.lookup import Lookup

    return Lookup.keys(frame([{key: value} for value in values]), key)
