"""The queries of the catalog as plain SQL over the given tables, written from their meaning.

The SQL spells the same messages as ``tables`` and answers each question with ordinary joins,
windows and aggregates. Money is decimal until the last step and a double in the result.
"""

from __future__ import annotations

# The fields of the two contracts and of the envelope.
SALES_REQUIRED = (
    "order_id", "datetime", "region_id", "currency_code", "product_id",
    "unit_price", "quantity", "is_online", "customer_id", "payment_method",
)
SALES_OPTIONAL = ("is_new_customer", "device_type", "referral_source", "discount_code", "customer_note")
COFFEE_REQUIRED = (
    "order_id", "datetime", "store_id", "drink_id", "size",
    "unit_price", "quantity", "is_loyalty", "customer_id", "payment_method",
)
ENVELOPE = ("_kafka_key", "_kafka_partition", "_kafka_offset")

MISSING = "Missing required field"


def _missing(fields: tuple[str, ...], alias: str = "m") -> str:
    cases = (f"CASE WHEN trim(coalesce({alias}.{f}, '')) = '' THEN '{MISSING}: {f}' END" for f in fields)
    return f"concat_ws('; ', {', '.join(cases)})"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, by its bits."""
    codes = f"list_transform(string_split({text}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    byte = "list_reduce(list_prepend(xor(c, d), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, d: {byte}))"


def _invalid(field: str, condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'Invalid {field}: ''' || {field} || '''' END"


def _not_in(field: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _invalid(field, f"{field} NOT IN ({listed})")


SHOWN_REGION = """CASE WHEN strpos(m.region_id, '''') > 0
    THEN '"' || m.region_id || '"' ELSE '''' || m.region_id || '''' END"""
BAD_REGION = f"CASE WHEN reg.region_id IS NULL THEN 'Unknown region_id: ' || {SHOWN_REGION} END"
BAD_PRODUCT = "CASE WHEN pro.product_id IS NULL THEN 'Unknown product_id: ''' || m.product_id || '''' END"
BAD_STORE = "CASE WHEN sto.store_id IS NULL THEN 'Unknown store_id: ''' || m.store_id || '''' END"
BAD_DRINK = "CASE WHEN dri.drink_id IS NULL THEN 'Unknown drink_id: ''' || m.drink_id || '''' END"
BAD_DEVICE = _not_in("device_type", "mobile", "desktop", "tablet")
BAD_PAYMENT = _not_in("payment_method", "credit_card", "paypal", "apple_pay", "gift_card")
BAD_REFERRAL = _not_in("referral_source", "organic", "paid_search", "email", "social")
BAD_CURRENCY = _not_in("currency_code", "USD", "CAD", "MXN")
BAD_SIZE = _not_in("size", "small", "medium", "large")
BAD_COFFEE_PAYMENT = _not_in("payment_method", "credit_card", "apple_pay", "gift_card", "cash")
BAD_DATETIME = _invalid(
    "datetime",
    "TRY_CAST(datetime AS TIMESTAMP) IS NULL OR NOT regexp_full_match(datetime, "
    "'[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?(Z|[+-][0-9]{2}:[0-9]{2})?')",
)
WHOLE = "regexp_full_match(trim(quantity), '[+-]?[0-9]+')"
BAD_QUANTITY = f"""CASE WHEN NOT {WHOLE} THEN 'Quantity must be an integer: ' || quantity
    WHEN CAST(trim(quantity) AS BIGINT) < 1 THEN 'Quantity must be at least 1: ' || quantity END"""
BAD_ONLINE = _invalid("is_online", "lower(trim(is_online)) NOT IN ('true', 'false')")
BAD_NEW = _invalid("is_new_customer", "lower(trim(is_new_customer)) NOT IN ('true', 'false')")
BAD_LOYALTY = _invalid("is_loyalty", "lower(trim(is_loyalty)) NOT IN ('true', 'false')")
NO_QUANTITY = _invalid("quantity", f"NOT {WHOLE}")
NO_PRICE = _invalid("unit_price", "TRY_CAST(unit_price AS DECIMAL(18,6)) IS NULL")

SALE_RULES = ", ".join(
    (
        BAD_REGION, BAD_PRODUCT, BAD_DEVICE, BAD_PAYMENT, BAD_REFERRAL,
        BAD_CURRENCY, BAD_DATETIME, BAD_QUANTITY, BAD_ONLINE, BAD_NEW,
    )
).replace("currency_code ", "m.currency_code ").replace("|| currency_code", "|| m.currency_code")
ORDER_RULES = ", ".join(
    (BAD_STORE, BAD_DRINK, BAD_SIZE, BAD_COFFEE_PAYMENT, BAD_DATETIME, BAD_QUANTITY, BAD_LOYALTY)
)

# Reference tables and sales messages.
SALES = f"""
reg AS (
  SELECT 'R-' || CAST(r_regionkey AS VARCHAR) AS region_id,
         CAST(8 + r_regionkey * 1.325 AS DECIMAL(7,4)) AS tax_rate_pct
  FROM region),
pro AS (
  SELECT 'P-' || CAST(p_partkey AS VARCHAR) AS product_id, p_type, p_size, p_name, p_brand, p_retailprice
  FROM part),
ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
msg AS (
  SELECT 'E-' || CAST(event_id AS VARCHAR) AS order_id,
         CASE k WHEN 0 THEN 'not-a-date' WHEN 9 THEN '2024-02-30T00:00:00Z'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS datetime,
         CASE WHEN k = 8 THEN 'R''9' ELSE 'R-' || CAST(user_id % 6 AS VARCHAR) END AS region_id,
         CASE WHEN k = 5 THEN 'EUR' WHEN user_id % 6 < 3 THEN 'USD' WHEN user_id % 6 = 3 THEN 'CAD'
              ELSE 'MXN' END AS currency_code,
         'P-' || CAST(user_id * 20 + k AS VARCHAR) AS product_id,
         CASE WHEN k = 7 THEN 'n/a' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
         CASE k WHEN 1 THEN '0' WHEN 2 THEN 'two' WHEN 12 THEN '3.0' WHEN 13 THEN ' 4 ' WHEN 14 THEN '-1'
                ELSE CAST(k % 5 + 1 AS VARCHAR) END AS quantity,
         CASE WHEN k % 2 = 0 THEN 'true' ELSE 'FALSE' END AS is_online,
         CASE k WHEN 3 THEN '' WHEN 10 THEN '  ' ELSE 'C-' || CAST(user_id AS VARCHAR) END AS customer_id,
         CASE WHEN k = 10 THEN '' WHEN event_type = 'click' THEN 'credit_card'
              WHEN event_type = 'view' THEN 'paypal' WHEN event_type = 'purchase' THEN 'apple_pay'
              WHEN event_type = 'signup' THEN 'gift_card' ELSE event_type END AS payment_method,
         CASE WHEN k = 4 THEN 'maybe' WHEN user_id % 3 = 0 THEN 'true' ELSE 'false' END AS is_new_customer,
         CASE WHEN k = 6 THEN '' WHEN k % 3 = 0 THEN 'mobile' WHEN k % 3 = 1 THEN 'desktop'
              ELSE 'tablet' END AS device_type,
         CASE WHEN k = 15 THEN 'billboard' WHEN k % 4 = 0 THEN 'organic' WHEN k % 4 = 1 THEN 'paid_search'
              WHEN k % 4 = 2 THEN 'email' ELSE 'social' END AS referral_source,
         CASE WHEN k % 10 < 3 THEN 'SPRING25' ELSE '' END AS discount_code,
         CASE k WHEN 16 THEN 'said "fast", then left'
                WHEN 17 THEN 'two' || chr(10) || 'lines, \\n and' || chr(13) || chr(10) || 'a \\ sign'
                ELSE '' END AS customer_note,
         CASE WHEN k = 8 THEN 'R''9' ELSE 'R-' || CAST(user_id % 6 AS VARCHAR) END AS _kafka_key,
         CAST(user_id % 4 AS INTEGER) AS _kafka_partition,
         CAST(event_id AS BIGINT) AS _kafka_offset
  FROM ev),
full_check AS (
  SELECT m.*, {_missing(SALES_REQUIRED)} AS missing, concat_ws('; ', {SALE_RULES}) AS other
  FROM msg m LEFT JOIN reg ON reg.region_id = m.region_id LEFT JOIN pro ON pro.product_id = m.product_id),
chk AS (
  SELECT *, CASE WHEN missing <> '' THEN missing ELSE other END AS validation_errors FROM full_check),
light AS (
  SELECT m.*, {_missing(SALES_REQUIRED)} AS missing, concat_ws('; ', {NO_QUANTITY}, {NO_PRICE}) AS other
  FROM msg m),
con AS (
  SELECT *, CASE WHEN missing <> '' THEN missing ELSE other END AS validation_errors FROM light),
c1 AS (
  SELECT con.*, CAST(trim(quantity) AS INTEGER) AS q,
         CAST(CAST(trim(quantity) AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS subtotal,
         CAST(COALESCE(reg.tax_rate_pct, 8) * 0.01 AS DECIMAL(10,6)) AS rate
  FROM con LEFT JOIN reg ON reg.region_id = con.region_id WHERE validation_errors = ''),
c2 AS (SELECT *, CAST(ROUND(subtotal * rate, 2) AS DECIMAL(18,2)) AS tax_amount FROM c1),
c3 AS (SELECT *, CAST(subtotal + tax_amount AS DECIMAL(18,2)) AS total FROM c2),
acc AS (
  SELECT *, CASE WHEN q = 0 THEN 0.0 ELSE CAST(
           (2 * abs(CAST(total * 100 AS BIGINT)) + abs(q)) // (2 * abs(q)) AS DOUBLE) / 100 END AS total_per_item
  FROM c3)"""


def _coffee(base: str) -> str:
    """Checks and amounts of coffee orders spelled by the CTE ``ord``."""
    return f"""
reg AS (SELECT 'D-' || CAST(r_regionkey AS VARCHAR) AS drink_id FROM region),
dri AS (SELECT drink_id FROM reg),
sto AS (
  SELECT 'S-' || CAST(n_nationkey AS VARCHAR) AS store_id,
         CAST(5 + n_nationkey * 0.255 AS DECIMAL(7,4)) AS tax_rate_pct
  FROM nation),
ord AS ({base}),
chk AS (
  SELECT m.*, concat_ws('; ', {ORDER_RULES}) AS validation_errors
  FROM ord m LEFT JOIN sto ON sto.store_id = m.store_id LEFT JOIN dri ON dri.drink_id = m.drink_id),
c1 AS (
  SELECT ord.*, sto.store_id IS NULL AS defaulted, lower(trim(is_loyalty)) IN ('true', '1', 'yes', 'y', 't') AS loyal,
         CAST(CAST(quantity AS DECIMAL(10,0)) * CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS subtotal,
         CAST(COALESCE(sto.tax_rate_pct, 8) * 0.01 AS DECIMAL(10,6)) AS tax_rate
  FROM ord LEFT JOIN sto ON sto.store_id = ord.store_id),
c2 AS (
  SELECT *, CAST(CASE WHEN loyal THEN ROUND(subtotal * 0.10, 2) ELSE 0 END AS DECIMAL(18,2)) AS loyalty_discount,
         CAST(ROUND(subtotal * tax_rate, 2) AS DECIMAL(18,2)) AS plain_tax
  FROM c1),
c3 AS (SELECT *, CAST(subtotal - loyalty_discount AS DECIMAL(18,2)) AS taxable FROM c2),
c4 AS (SELECT *, CAST(ROUND(taxable * tax_rate, 2) AS DECIMAL(18,2)) AS tax_amount FROM c3),
acc AS (SELECT *, CAST(taxable + tax_amount AS DECIMAL(18,2)) AS total FROM c4)"""


LINES = _coffee("""
  SELECT 'L-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
         'S-' || CAST(l_suppkey % 30 AS VARCHAR) AS store_id,
         'D-' || CAST(l_partkey % 6 AS VARCHAR) AS drink_id,
         CASE WHEN l_quantity <= 15 THEN 'small' WHEN l_quantity <= 30 THEN 'medium'
              WHEN l_quantity <= 45 THEN 'large' ELSE 'venti' END AS size,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity,
         CASE l_returnflag WHEN 'A' THEN 'true' WHEN 'N' THEN 'false' ELSE 'yes' END AS is_loyalty,
         'C-' || CAST(l_partkey AS VARCHAR) AS customer_id,
         CASE WHEN l_linenumber = 7 THEN 'bitcoin' WHEN l_linenumber % 4 = 0 THEN 'credit_card'
              WHEN l_linenumber % 4 = 1 THEN 'apple_pay' WHEN l_linenumber % 4 = 2 THEN 'gift_card'
              ELSE 'cash' END AS payment_method,
         '' AS customer_note,
         'S-' || CAST(l_suppkey % 30 AS VARCHAR) AS _kafka_key,
         CAST(l_suppkey % 4 AS INTEGER) AS _kafka_partition,
         CAST(l_orderkey AS BIGINT) AS _kafka_offset
  FROM lineitem""")

ORDERS = _coffee("""
  SELECT 'O-' || CAST(o_orderkey AS VARCHAR) AS order_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
         'S-' || CAST(o_custkey % 30 AS VARCHAR) AS store_id,
         'D-' || CAST(o_orderkey % 6 AS VARCHAR) AS drink_id,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'venti' WHEN '2' THEN 'large' WHEN '3' THEN 'medium'
              ELSE 'small' END AS size,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
         CAST(o_orderkey % 5 + 1 AS VARCHAR) AS quantity,
         CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'yes' END AS is_loyalty,
         'C-' || CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE o_custkey % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'apple_pay' WHEN 2 THEN 'gift_card'
              WHEN 3 THEN 'cash' ELSE 'bitcoin' END AS payment_method,
         '' AS customer_note,
         'S-' || CAST(o_custkey % 30 AS VARCHAR) AS _kafka_key,
         CAST(o_custkey % 4 AS INTEGER) AS _kafka_partition,
         CAST(o_orderkey AS BIGINT) AS _kafka_offset
  FROM orders""")


def _columns(*groups: tuple[str, ...]) -> str:
    return ", ".join(name for group in groups for name in group)


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


def sales(select: str) -> str:
    return f"WITH {SALES}\n{select}"


def lines(select: str) -> str:
    return f"WITH {LINES}\n{select}"


# The closing report is about a topic that holds the valid messages only.
_SENT = "(SELECT * EXCLUDE (validation_errors) FROM chk WHERE validation_errors = '') ord"


def reported_lines(select: str) -> str:
    return lines(select).replace("FROM ord LEFT JOIN sto", f"FROM {_SENT} LEFT JOIN sto")


def reported_orders(select: str) -> str:
    return orders(select).replace("FROM ord LEFT JOIN sto", f"FROM {_SENT} LEFT JOIN sto")


def reported_sales(select: str) -> str:
    valid = "(SELECT * EXCLUDE (missing, other, validation_errors) FROM chk WHERE validation_errors = '') m"
    return sales(select).replace("AS other\n  FROM msg m),", f"AS other\n  FROM {valid}),")


def orders(select: str) -> str:
    return f"WITH {ORDERS}\n{select}"


FIELDS = (*SALES_REQUIRED, *SALES_OPTIONAL)
SALE_AMOUNTS = _doubles("subtotal", "tax_amount", "total")
COFFEE_AMOUNTS = _doubles("subtotal", "loyalty_discount", "tax_amount", "total")
RUNNING = "OVER (ORDER BY _kafka_partition, _kafka_offset ROWS UNBOUNDED PRECEDING)"
KEYED = "OVER (PARTITION BY {} ORDER BY _kafka_partition, _kafka_offset ROWS UNBOUNDED PRECEDING)"
BRANCHES = "SELECT CASE WHEN validation_errors = '' THEN 'accepted' ELSE 'rejected' END AS route, COUNT(*) AS message_count"
REVENUE = "COUNT(*) AS order_count, CAST(SUM(total) AS DOUBLE) AS revenue"
STATS = """SELECT COUNT(*) AS count, CAST(SUM(total) AS DOUBLE) AS total, CAST(MIN(total) AS DOUBLE) AS minimum,
    CAST(MAX(total) AS DOUBLE) AS maximum, CAST(SUM(total) AS DOUBLE) / COUNT(*) AS mean FROM acc"""
LOYALTY = f"""SELECT is_loyalty, {REVENUE}, CAST(SUM(loyalty_discount) AS DOUBLE) AS discount_given,
    CASE WHEN lower(is_loyalty) = 'true' THEN 'loyalty' ELSE 'non-loyalty' END AS label FROM acc GROUP BY is_loyalty"""


def _outcome(*messages: str) -> str:
    return f"""SELECT order_id, errors = '' AS is_valid, errors AS validation_errors FROM (
        SELECT m.order_id, concat_ws('; ', {', '.join(messages)}) AS errors"""


def _running_sales(value: str, name: str) -> str:
    return sales(
        f"SELECT _kafka_partition, _kafka_offset, CAST(total AS DOUBLE) AS total, {value} AS {name} FROM acc"
    )


def _json(fields: tuple[str, ...]) -> str:
    def spelled(field: str) -> str:
        for sign, name in (("'\\'", "'\\\\'"), ("'\"'", "'\\\"'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'")):
            field = f"replace({field}, {sign}, {name})"
        return field

    escaped = (f"'\"{f}\":\"' || {spelled(f)} || '\"'" for f in fields)
    return "'{' || " + " || ',' || ".join(escaped) + " || '}'"


def _text_amounts(*names: str) -> str:
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in names)


def _missing_product(field: str, value: str) -> str:
    return (
        f"SELECT product_id AS record_key, 'products: missing required field {field}' AS error "
        f"FROM pro WHERE trim(coalesce({value}, '')) = ''"
    )


ORACLE: dict[str, str] = {
    # Sources
    "csv_scan": sales(f"SELECT {_columns(FIELDS)} FROM msg"),
    "csv_lookup": sales(
        "SELECT region_id, CASE WHEN region_id = 'R-0' THEN 9.75 ELSE CAST(tax_rate_pct AS DOUBLE) END AS tax_rate_pct FROM reg"
    ),
    "stream_scan_earliest": sales(f"SELECT {_columns(FIELDS, ENVELOPE)} FROM msg"),
    "stream_decode_envelope": sales(
        "SELECT "
        + ", ".join(f"CASE WHEN quantity = '2' THEN '' ELSE {f} END AS {f}" for f in FIELDS)
        + f", {_columns(ENVELOPE)}, missing = '' AND quantity <> '2' AS is_valid, quantity = '2' AS undecoded FROM light"
    ),
    "bounded_consume": sales(
        "SELECT order_id, _kafka_partition, _kafka_offset, missing = '' AS is_valid FROM light "
        "ORDER BY _kafka_partition, _kafka_offset LIMIT 1000"
    ),
    "topic_count_gate": sales(
        "SELECT _kafka_partition, COUNT(*) AS message_count, MIN(_kafka_offset) AS first_offset, "
        "MAX(_kafka_offset) AS last_offset FROM msg GROUP BY _kafka_partition"
    ),
    "replay_first_n": sales(
        "SELECT order_id, datetime, validation_errors = '' AS is_valid FROM chk ORDER BY datetime, order_id LIMIT 1000"
    ),
    "dim_key_set": sales("SELECT DISTINCT product_id FROM pro"),
    # Sinks
    "publish_keyed": sales(
        f"SELECT region_id AS key, {_json(FIELDS)} AS value FROM chk WHERE validation_errors = ''"
    ),
    "keyed_partition_order": sales(
        "SELECT region_id, _kafka_partition, _kafka_offset, order_id FROM chk WHERE validation_errors = ''"
    ),
    "keyed_publish_order": sales(
        "SELECT region_id, broker_partition, CAST(row_number() OVER (PARTITION BY broker_partition ORDER BY _kafka_partition, _kafka_offset) "
        "- 1 AS BIGINT) AS broker_offset, order_id "
        f"FROM (SELECT *, CAST({_crc32('region_id')} % 3 AS INTEGER) AS broker_partition FROM chk WHERE validation_errors = '')"
    ),
    "csv_append_sink": sales(
        f"SELECT {_columns(SALES_REQUIRED)}, {_text_amounts('subtotal', 'tax_amount', 'total')}, _kafka_key, "
        f"{_text_amounts('_kafka_partition', '_kafka_offset')} FROM acc"
    ),
    "rejected_csv_sink": sales(f"SELECT {_columns(SALES_REQUIRED)}, validation_errors FROM chk WHERE validation_errors <> ''"),
    "accepted_table_sink": sales(f"SELECT {_columns(FIELDS, ENVELOPE)} FROM acc"),
    "accepted_table_sink_coffee": orders(f"SELECT {_columns(COFFEE_REQUIRED, ENVELOPE)}, {COFFEE_AMOUNTS} FROM acc"),
    "rejected_table_sink": sales(
        f"SELECT {_columns(SALES_REQUIRED)}, validation_errors, {_columns(ENVELOPE)} FROM con WHERE validation_errors <> ''"
    ),
    "rejected_table_sink_coffee": orders(
        f"SELECT {_columns(COFFEE_REQUIRED)}, validation_errors, {_columns(ENVELOPE)} FROM chk WHERE validation_errors <> ''"
    ),
    "route_split": lines(f"{BRANCHES} FROM chk GROUP BY route"),
    "table_create": sales(f"{BRANCHES} FROM con GROUP BY route"),
    "table_reset": sales(f"{BRANCHES} FROM con GROUP BY route"),
    "output_reset": sales("SELECT COUNT(*) AS rejected_count FROM chk WHERE validation_errors <> ''"),
    "chart_series_table": sales("SELECT _kafka_partition, _kafka_offset, CAST(total AS DOUBLE) AS total FROM acc"),
    # Projections and filters
    "project_required": sales(f"SELECT {_columns(SALES_REQUIRED)} FROM msg"),
    "project_accepted": sales(f"SELECT {_columns(FIELDS, ENVELOPE)} FROM acc"),
    "project_rejected": sales(
        f"SELECT {_columns(SALES_REQUIRED)}, validation_errors, {_columns(ENVELOPE)} FROM chk WHERE validation_errors <> ''"
    ),
    "project_consumed": sales(f"SELECT {_columns(SALES_REQUIRED, ENVELOPE)}, {SALE_AMOUNTS} FROM acc"),
    "project_consumed_coffee": orders(f"SELECT {_columns(COFFEE_REQUIRED, ENVELOPE)}, {COFFEE_AMOUNTS} FROM acc"),
    "project_consumed_ext": sales(f"SELECT {_columns(SALES_REQUIRED, ENVELOPE)}, {SALE_AMOUNTS}, total_per_item FROM acc"),
    "star_extend": lines(
        f"SELECT {_columns(tuple(f for f in COFFEE_REQUIRED if f != 'quantity'), ENVELOPE)}, customer_note, "
        "CAST(quantity AS INTEGER) AS quantity, CAST(unit_price AS DOUBLE) AS price FROM ord"
    ),
    "filter_valid": lines("SELECT order_id, store_id, size, payment_method FROM chk WHERE validation_errors = ''"),
    "filter_invalid": lines("SELECT order_id, store_id, size, payment_method FROM chk WHERE validation_errors <> ''"),
    # Validation
    "val_required": sales("SELECT order_id, missing = '' AS is_valid, missing AS validation_errors FROM light"),
    "val_short_circuit": sales(
        "SELECT order_id, CASE WHEN missing = '' THEN 0 ELSE len(string_split(missing, '; ')) END AS missing_count, "
        "CASE WHEN missing <> '' OR other = '' THEN 0 ELSE len(string_split(other, '; ')) END AS other_count FROM chk"
    ),
    "val_ref_region": sales(_outcome(BAD_REGION) + " FROM msg m LEFT JOIN reg ON reg.region_id = m.region_id)"),
    "val_ref_product": sales(_outcome(BAD_PRODUCT) + " FROM msg m LEFT JOIN pro ON pro.product_id = m.product_id)"),
    "val_ref_store": lines(_outcome(BAD_STORE) + " FROM ord m LEFT JOIN sto ON sto.store_id = m.store_id)"),
    "val_ref_drink": lines(_outcome(BAD_DRINK) + " FROM ord m LEFT JOIN dri ON dri.drink_id = m.drink_id)"),
    "val_allowed": sales(_outcome(BAD_DEVICE, BAD_PAYMENT, BAD_REFERRAL, BAD_CURRENCY) + " FROM msg m)"),
    "val_datetime": sales(_outcome(BAD_DATETIME) + " FROM msg m)"),
    "val_positive_int": sales(_outcome(BAD_QUANTITY) + " FROM msg m)"),
    "val_quantity": sales(
        f"SELECT coalesce({BAD_QUANTITY}, '') AS error, COUNT(*) AS message_count FROM msg GROUP BY error"
    ),
    "val_boolean_text": sales(_outcome(BAD_ONLINE, BAD_NEW) + " FROM msg m)"),
    "val_error_list": sales("SELECT order_id, other = '' AS is_valid, other AS validation_errors FROM full_check"),
    "validate_sale": sales("SELECT order_id, validation_errors = '' AS is_valid, validation_errors FROM chk"),
    "validate_order": lines("SELECT order_id, validation_errors = '' AS is_valid, validation_errors FROM chk"),
    "validate_consumer_light": sales(
        "SELECT COUNT(*) FILTER (WHERE missing = '') AS accepted_count, "
        "COUNT(*) FILTER (WHERE missing <> '') AS rejected_count FROM light"
    ),
    "attach_errors": sales(f"SELECT {_columns(SALES_REQUIRED)}, validation_errors FROM chk WHERE validation_errors <> ''"),
    "validate_dimension": sales(
        " UNION ALL ".join(
            _missing_product(field, value)
            for field, value in (
                ("product_id", "product_id"),
                ("product_name", "p_name"),
                ("category", "CASE WHEN p_size = 13 THEN '' ELSE p_type END"),
                ("level", "CASE WHEN p_size = 21 THEN '' ELSE CAST(p_size AS VARCHAR) END"),
                ("price_usd", "CAST(p_retailprice AS VARCHAR)"),
                ("instructor", "p_brand"),
            )
        )
    ),
    "schema_gate": sales("SELECT region_id, COUNT(*) AS message_count FROM msg GROUP BY region_id"),
    # Joins
    "lookup_join_default": orders("SELECT order_id, store_id, CAST(tax_rate AS DOUBLE) AS tax_rate, defaulted FROM c1"),
    "lookup_miss_report": lines("SELECT store_id, COUNT(*) AS miss_count FROM c1 WHERE defaulted GROUP BY store_id"),
    "membership_semi": sales("SELECT order_id, product_id FROM msg WHERE product_id IN (SELECT product_id FROM pro)"),
    "membership_anti": sales("SELECT order_id, product_id FROM msg WHERE product_id NOT IN (SELECT product_id FROM pro)"),
    # Scalar functions and derived fields
    "parse_quantity": sales(
        f"SELECT order_id, {WHOLE} AS parsed, "
        f"CASE WHEN {WHOLE} THEN CAST(trim(quantity) AS INTEGER) ELSE 0 END AS quantity FROM msg"
    ),
    "parse_unit_price": sales(
        "SELECT order_id, unit_price <> 'n/a' AS parsed, "
        "CASE WHEN unit_price <> 'n/a' THEN CAST(unit_price AS DOUBLE) ELSE 0 END AS unit_price FROM msg"
    ),
    "parse_bool_text": lines("SELECT order_id, loyal AS is_loyalty FROM c1"),
    "derive_subtotal": lines(f"SELECT order_id, {_doubles('subtotal')} FROM c1"),
    "derive_tax_rate": lines(
        "SELECT store_id, CAST(tax_rate AS DOUBLE) AS tax_rate, COUNT(*) AS order_count FROM c1 GROUP BY ALL"
    ),
    "derive_tax_amount": lines("SELECT order_id, CAST(plain_tax AS DOUBLE) AS tax_amount FROM c2"),
    "derive_total": lines("SELECT order_id, CAST(subtotal + plain_tax AS DOUBLE) AS total FROM c2"),
    "derive_loyalty_discount": lines(f"SELECT order_id, {_doubles('loyalty_discount')} FROM c2"),
    "derive_taxable": lines(f"SELECT order_id, {_doubles('taxable')} FROM c3"),
    "derive_total_discounted": lines(f"SELECT order_id, {_doubles('total')} FROM acc"),
    "derive_total_per_item": sales("SELECT order_id, total_per_item FROM acc"),
    "round2": "SELECT l_orderkey, CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) "
    "AS DOUBLE) AS amount FROM lineitem",
    "money_format": lines("SELECT order_id, format('${:,.2f}', CAST(unit_price AS DOUBLE)) AS shown FROM ord"),
    "label_loyalty": lines(
        "SELECT is_loyalty, CASE WHEN lower(is_loyalty) = 'true' THEN 'loyalty' ELSE 'non-loyalty' END AS label, "
        "COUNT(*) AS order_count FROM ord GROUP BY is_loyalty"
    ),
    "error_text": sales(f"SELECT order_id, 'Unknown region_id: ' || {SHOWN_REGION} AS error FROM msg m"),
    "field_default": sales("SELECT order_id, customer_id, '' AS customer_note FROM msg"),
    "enrich_sales": sales(
        f"SELECT {_columns(tuple('acc.' + f for f in (*FIELDS, *ENVELOPE)))}, {SALE_AMOUNTS} "
        "FROM acc JOIN chk USING (order_id) WHERE chk.validation_errors = ''"
    ),
    "enrich_coffee": lines(f"SELECT order_id, store_id, {COFFEE_AMOUNTS} FROM acc"),
    "enrich_sales_per_item": sales(f"SELECT order_id, {SALE_AMOUNTS}, total_per_item FROM acc"),
    # Aggregations
    "agg_accepted_count": reported_lines("SELECT COUNT(*) AS accepted_count FROM acc"),
    "agg_rejected_count": lines("SELECT COUNT(*) AS rejected_count FROM chk WHERE validation_errors <> ''"),
    "agg_count_by_region": reported_sales("SELECT region_id, COUNT(*) AS sale_count FROM acc GROUP BY region_id ORDER BY region_id"),
    "agg_revenue_by_store": reported_lines(f"SELECT store_id, {REVENUE} FROM acc GROUP BY store_id ORDER BY revenue DESC"),
    "agg_revenue_by_size": reported_lines(f"SELECT size, {REVENUE} FROM acc GROUP BY size ORDER BY revenue DESC"),
    "agg_loyalty": reported_lines(f"{LOYALTY} ORDER BY is_loyalty DESC"),
    "agg_run_stats": reported_lines(STATS),
    "agg_run_counts": lines(
        "SELECT COUNT(*) FILTER (WHERE validation_errors = '') AS accepted_count, "
        "COUNT(*) FILTER (WHERE validation_errors <> '') AS rejected_count FROM chk"
    ),
    "agg_cumulative_by_key": reported_lines(
        "SELECT store_id, CAST(SUM(total) AS DOUBLE) AS revenue FROM acc GROUP BY store_id ORDER BY store_id"
    ),
    # Running values
    "running_total": _running_sales(f"CAST(SUM(acc.total) {RUNNING} AS DOUBLE)", "running_total"),
    "running_mean": _running_sales(
        f"CAST(SUM(acc.total) {RUNNING} AS DOUBLE) / COUNT(*) {RUNNING}", "running_mean"
    ),
    "running_min": _running_sales(f"CAST(MIN(acc.total) {RUNNING} AS DOUBLE)", "running_min"),
    "running_max": _running_sales(f"CAST(MAX(acc.total) {RUNNING} AS DOUBLE)", "running_max"),
    "running_count": _running_sales(f"COUNT(*) {RUNNING}", "running_count"),
    "running_accepted_rejected": sales(
        f"SELECT _kafka_partition, _kafka_offset, COUNT(*) FILTER (WHERE validation_errors = '') {RUNNING} "
        f"AS running_accepted, COUNT(*) FILTER (WHERE validation_errors <> '') {RUNNING} AS running_rejected FROM chk"
    ),
    "running_revenue_by_key": orders(
        "SELECT store_id, _kafka_partition, _kafka_offset, CAST(total AS DOUBLE) AS total, "
        f"CAST(SUM(acc.total) {KEYED.format('store_id')} AS DOUBLE) AS running_revenue FROM acc"
    ),
    "series_total_by_offset": sales("SELECT _kafka_partition, _kafka_offset, CAST(total AS DOUBLE) AS total FROM acc"),
    # Sorts and limits
    "sort_by_key": lines("SELECT store_id, COUNT(*) AS order_count FROM ord GROUP BY store_id ORDER BY store_id"),
    "sort_by_revenue_desc": reported_orders(
        f"SELECT store_id, {REVENUE} FROM acc GROUP BY store_id ORDER BY revenue DESC, store_id"
    ),
    "sort_by_flag_desc": reported_orders(f"{LOYALTY} ORDER BY is_loyalty DESC"),
    "limit_n": orders(
        "SELECT order_id, _kafka_partition, _kafka_offset FROM ord ORDER BY _kafka_partition, _kafka_offset LIMIT 1000"
    ),
    # Streams
    "stream_validate_route": sales(
        "SELECT order_id, CASE WHEN validation_errors = '' THEN 'accepted' ELSE 'rejected' END AS route, "
        "validation_errors FROM con"
    ),
    "stream_enrich": sales(f"SELECT {_columns(SALES_REQUIRED, ENVELOPE)}, {SALE_AMOUNTS} FROM acc"),
    "stream_running_stats": sales(STATS),
    "stream_running_rows": sales(
        "SELECT _kafka_partition, _kafka_offset, CAST(total AS DOUBLE) AS total, n AS running_count, "
        "CAST(s AS DOUBLE) AS running_total, CAST(lo AS DOUBLE) AS running_min, CAST(hi AS DOUBLE) AS running_max, "
        "CAST(s AS DOUBLE) / n AS running_mean FROM ("
        + "SELECT *, COUNT(*) {w} AS n, SUM(total) {w} AS s, MIN(total) {w} AS lo, MAX(total) {w} AS hi FROM acc)".format(
            w=KEYED.format("_kafka_partition")
        )
    ),
    "stream_running_rows_by_key": orders(
        "SELECT store_id, _kafka_offset, CAST(total AS DOUBLE) AS total, n AS running_count, CAST(s AS DOUBLE) AS running_total, "
        "CAST(lo AS DOUBLE) AS running_min, CAST(hi AS DOUBLE) AS running_max FROM (SELECT *, COUNT(*) {w} AS n, SUM(total) {w} AS s, "
        "MIN(total) {w} AS lo, MAX(total) {w} AS hi FROM acc)".format(w="OVER (PARTITION BY store_id ORDER BY _kafka_offset)")
    ),
    "stream_cumulative_by_key": orders(
        "SELECT store_id, CAST(SUM(total) AS DOUBLE) AS revenue FROM acc GROUP BY store_id"
    ),
    "stream_replay": sales(
        f"SELECT run, route, message_count FROM ({BRANCHES} FROM con GROUP BY route), (VALUES (1), (2)) runs(run)"
    ),
    "stream_run_bounded": sales(
        f"{BRANCHES} FROM (SELECT * FROM con ORDER BY _kafka_partition, _kafka_offset LIMIT 1000) GROUP BY route"
    ),
    # Further questions
    "ext_error_histogram": sales(
        "SELECT CASE WHEN e LIKE 'Missing%' THEN e ELSE split_part(e, ': ', 1) END AS error, COUNT(*) AS message_count "
        "FROM (SELECT unnest(string_split(validation_errors, '; ')) AS e FROM chk WHERE validation_errors <> '') GROUP BY 1"
    ),
    "ext_dedup_replay": sales("SELECT order_id, region_id, _kafka_partition, _kafka_offset FROM msg"),
    "ext_region_running_count": sales(
        f"SELECT region_id, _kafka_partition, _kafka_offset, COUNT(*) {KEYED.format('region_id')} AS running_count FROM acc"
    ),
    "ext_run_summary": reported_sales(
        "SELECT (SELECT COUNT(*) FROM acc) AS accepted_count, (SELECT COUNT(*) FROM chk WHERE validation_errors <> '') AS "
        "rejected_count, CAST(SUM(total) AS DOUBLE) AS revenue, MIN(_kafka_offset) AS first_offset, MAX(_kafka_offset) AS "
        "last_offset FROM acc"
    ),
    "ext_event_windows": reported_sales(
        "SELECT strftime(date_trunc('day', TRY_CAST(datetime AS TIMESTAMP)), '%Y-%m-%d') AS day, COUNT(*) AS sale_count, "
        "CAST(SUM(total) AS DOUBLE) AS revenue FROM acc GROUP BY 1"
    ),
    "ext_discount_window": sales(
        "SELECT a.order_id, a.discount_code, a.datetime, CAST(w.pct AS DOUBLE) AS discount_pct, CAST(a.subtotal AS DOUBLE) AS "
        "subtotal, CAST(COALESCE(ROUND(a.subtotal * CAST(w.pct * 0.01 AS DECIMAL(6,4)), 2), 0) AS DOUBLE) AS discount "
        "FROM acc a LEFT JOIN (SELECT order_id, MAX(pct) AS pct FROM acc JOIN (SELECT CASE WHEN n_nationkey % 5 < 3 THEN "
        "'SPRING25' ELSE 'CODE-' || CAST(n_nationkey AS VARCHAR) END AS code, DATE '2024-01-01' + CAST(n_nationkey * 7 % 28 AS INTEGER) "
        "AS f, DATE '2024-01-01' + CAST(CASE WHEN n_nationkey = 4 THEN n_nationkey * 7 % 28 - 2 ELSE n_nationkey * 7 % 28 + n_regionkey "
        "END AS INTEGER) AS t, CAST(n_nationkey % 4 * 5 + 5 AS DECIMAL(6,0)) AS pct FROM nation) c ON code = discount_code "
        "AND TRY_CAST(left(datetime, 10) AS DATE) BETWEEN f AND t GROUP BY order_id) w ON w.order_id = a.order_id"
    ),
    "ext_to_usd": sales(
        "SELECT order_id, currency_code, datetime, CAST(total AS DOUBLE) AS total, CAST(ROUND(total * x.rate, 2) AS DOUBLE) AS total_usd "
        "FROM acc LEFT JOIN (SELECT *, lead(d) OVER (PARTITION BY cur ORDER BY d) AS after FROM ("
        "SELECT CASE s_suppkey % 3 WHEN 0 THEN 'CAD' WHEN 1 THEN 'MXN' ELSE 'USD' END AS cur, "
        "DATE '2024-01-01' + CAST(s_suppkey * 5 % 29 + 1 AS INTEGER) AS d, "
        "arg_max(CAST(0.5 + s_acctbal / 10000 AS DECIMAL(12,6)), s_suppkey) AS rate FROM supplier GROUP BY 1, 2)) x "
        "ON cur = currency_code AND TRY_CAST(left(datetime, 10) AS DATE) >= d "
        "AND (after IS NULL OR TRY_CAST(left(datetime, 10) AS DATE) < after)"
    ),
    "ext_dim_sql_join": sales(
        "SELECT order_id, r_name AS region_name, r_name AS country_name, p_name AS product_name, CASE WHEN p_size = 13 THEN '' "
        "ELSE p_type END AS category, CAST(total AS DOUBLE) AS total FROM acc JOIN region ON region_id = 'R-' || CAST(r_regionkey AS "
        "VARCHAR) LEFT JOIN pro ON pro.product_id = acc.product_id"
    ),
    "ext_price_check": sales(
        "SELECT order_id, product_name, unit_price, price_usd, validation_errors = '' AS is_valid, validation_errors FROM ("
        "SELECT l.order_id, p_name AS product_name, unit_price, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price_usd, "
        f"CASE WHEN missing <> '' THEN missing ELSE concat_ws('; ', {NO_QUANTITY}, {NO_PRICE}, CASE WHEN "
        "abs(TRY_CAST(unit_price AS DECIMAL(18,6)) - CAST(p_retailprice AS DECIMAL(12,2))) > CAST(p_retailprice AS DECIMAL(12,2)) * 0.5 "
        "THEN 'Unlisted unit_price: ''' || unit_price || '''' END) END AS validation_errors "
        "FROM light l LEFT JOIN pro ON pro.product_id = l.product_id)"
    ),
    "ext_enriched_table": sales(f"SELECT order_id, region_id, {SALE_AMOUNTS} FROM acc"),
    "ext_event_windows_stream": sales(
        "SELECT strftime(date_trunc('day', TRY_CAST(datetime AS TIMESTAMP)), '%Y-%m-%d') AS day, COUNT(*) AS sale_count, "
        "CAST(SUM(total) AS DOUBLE) AS revenue FROM acc WHERE TRY_CAST(datetime AS TIMESTAMP) IS NOT NULL GROUP BY 1"
    ),
    "ext_event_sessions": sales(
        "SELECT customer_id, strftime(MIN(t), '%Y-%m-%dT%H:%M:%SZ') AS start, strftime(MAX(t) + INTERVAL 12 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS "
        "\"end\", COUNT(*) AS sale_count FROM (SELECT *, SUM(new) OVER (PARTITION BY customer_id ORDER BY t) AS s FROM ("
        "SELECT *, CASE WHEN lag(t) OVER w IS NULL OR t - lag(t) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM ("
        "SELECT customer_id, TRY_CAST(datetime AS TIMESTAMP) AS t FROM acc) WHERE t IS NOT NULL WINDOW w AS (PARTITION BY customer_id "
        "ORDER BY t))) GROUP BY customer_id, s HAVING MAX(t) + INTERVAL 12 HOUR <= "
        "(SELECT MAX(TRY_CAST(datetime AS TIMESTAMP)) FROM acc) - INTERVAL 2 DAY"
    ),
    "ext_dedup_replay_stream": sales(
        "SELECT order_id, region_id, _kafka_partition, _kafka_offset FROM msg UNION ALL SELECT order_id, region_id, _kafka_partition, "
        "_kafka_offset FROM msg WHERE TRY_CAST(datetime AS TIMESTAMP) IS NULL"
    ),
}
