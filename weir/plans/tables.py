"""Messages and reference tables seen in the given tables.

The given tables hold typed rows, while the pipeline works on text messages, some of them broken.
These views spell every row of a table as a message. Which messages are broken follows from the
row's own values (the counter in ``events.props``, quantities, flags), so every kind of error
occurs. Nothing is filtered: each row of a table is one message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso_text(moment: Column) -> Column:
    """Spell a time-zone-free moment as ``2024-01-31T10:20:30Z``, whatever the session's zone is."""
    shown = F.substring(moment.cast("string"), 1, 19)
    return F.concat(F.replace(shown, F.lit(" "), F.lit("T")), F.lit("Z"))


def _label(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def _money(column: Column) -> Column:
    return column.cast("decimal(12,2)").cast("string")


def _pick(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), index.cast("int") + 1)


def sales_messages(events: DataFrame) -> DataFrame:
    """Spell ``events`` as sales messages with their envelope. Works on batch and streams."""
    # As the output of a generator the counter is extracted once a row, however many fields and
    # later filters mention it.
    counter = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    numbered = events.select("event_id", "ts", "user_id", "event_type", "value", F.explode(F.array(counter)).alias("k"))
    k, user = F.col("k"), F.col("user_id")
    region = F.when(k == 8, "R'9").otherwise(_label("R-", user % 6))
    return numbered.select(
        _label("E-", F.col("event_id")).alias("order_id"),
        F.when(k == 0, "not-a-date")
        .when(k == 9, "2024-02-30T00:00:00Z")
        .otherwise(iso_text(F.col("ts")))
        .alias("datetime"),
        region.alias("region_id"),
        F.when(k == 5, "EUR").when(user % 6 < 3, "USD").when(user % 6 == 3, "CAD").otherwise("MXN").alias("currency_code"),
        _label("P-", user * 20 + k).alias("product_id"),
        F.when(k == 7, "n/a").otherwise(_money(F.col("value"))).alias("unit_price"),
        F.when(k == 1, "0")
        .when(k == 2, "two")
        .when(k == 12, "3.0")
        .when(k == 13, " 4 ")
        .when(k == 14, "-1")
        .otherwise((k % 5 + 1).cast("string"))
        .alias("quantity"),
        F.when(k % 2 == 0, "true").otherwise("FALSE").alias("is_online"),
        F.when(k == 3, "").when(k == 10, "  ").otherwise(_label("C-", user)).alias("customer_id"),
        F.when(k == 10, "")
        .when(F.col("event_type") == "click", "credit_card")
        .when(F.col("event_type") == "view", "paypal")
        .when(F.col("event_type") == "purchase", "apple_pay")
        .when(F.col("event_type") == "signup", "gift_card")
        .otherwise(F.col("event_type"))
        .alias("payment_method"),
        F.when(k == 4, "maybe").when(user % 3 == 0, "true").otherwise("false").alias("is_new_customer"),
        F.when(k == 6, "").otherwise(_pick(k % 3, "mobile", "desktop", "tablet")).alias("device_type"),
        F.when(k == 15, "billboard")
        .otherwise(_pick(k % 4, "organic", "paid_search", "email", "social"))
        .alias("referral_source"),
        F.when(k % 10 < 3, "SPRING25").otherwise("").alias("discount_code"),
        F.when(k == 16, 'said "fast", then left')
        .when(k == 17, "two\nlines, \\n and\r\na \\ sign")
        .otherwise("")
        .alias("customer_note"),
        region.alias("_kafka_key"),
        (user % 4).cast("int").alias("_kafka_partition"),
        F.col("event_id").cast("long").alias("_kafka_offset"),
    )


def order_messages(orders: DataFrame) -> DataFrame:
    """Spell ``orders`` as coffee orders, one message per order, in the order of their keys."""
    customer, key = F.col("o_custkey"), F.col("o_orderkey")
    status = F.col("o_orderstatus")
    store = _label("S-", customer % 30)
    return orders.select(
        _label("O-", key).alias("order_id"),
        iso_text(F.col("o_orderdate")).alias("datetime"),
        store.alias("store_id"),
        _label("D-", key % 6).alias("drink_id"),
        F.when(F.col("o_orderpriority").startswith("1"), "venti")
        .when(F.col("o_orderpriority").startswith("2"), "large")
        .when(F.col("o_orderpriority").startswith("3"), "medium")
        .otherwise("small")
        .alias("size"),
        _money(F.col("o_totalprice")).alias("unit_price"),
        (key % 5 + 1).cast("string").alias("quantity"),
        F.when(status == "F", "true").when(status == "O", "false").otherwise("yes").alias("is_loyalty"),
        _label("C-", customer).alias("customer_id"),
        _pick(customer % 5, "credit_card", "apple_pay", "gift_card", "cash", "bitcoin").alias("payment_method"),
        F.lit("").alias("customer_note"),
        store.alias("_kafka_key"),
        (customer % 4).cast("int").alias("_kafka_partition"),
        key.cast("long").alias("_kafka_offset"),
    )


def line_messages(lineitem: DataFrame) -> DataFrame:
    """Spell ``lineitem``, the largest table, as coffee orders. Offsets repeat, so no order here."""
    supplier, count = F.col("l_suppkey"), F.col("l_quantity")
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    store = _label("S-", supplier % 30)
    return lineitem.select(
        F.concat(_label("L-", F.col("l_orderkey")), _label("-", line)).alias("order_id"),
        iso_text(F.col("l_shipdate")).alias("datetime"),
        store.alias("store_id"),
        _label("D-", F.col("l_partkey") % 6).alias("drink_id"),
        F.when(count <= 15, "small").when(count <= 30, "medium").when(count <= 45, "large").otherwise("venti").alias("size"),
        _money(F.col("l_extendedprice")).alias("unit_price"),
        count.cast("int").cast("string").alias("quantity"),
        F.when(flag == "A", "true").when(flag == "N", "false").otherwise("yes").alias("is_loyalty"),
        _label("C-", F.col("l_partkey")).alias("customer_id"),
        F.when(line == 7, "bitcoin")
        .otherwise(_pick(line % 4, "credit_card", "apple_pay", "gift_card", "cash"))
        .alias("payment_method"),
        F.lit("").alias("customer_note"),
        store.alias("_kafka_key"),
        (supplier % 4).cast("int").alias("_kafka_partition"),
        F.col("l_orderkey").cast("long").alias("_kafka_offset"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regions of sales: the table ``region``."""
    key = F.col("r_regionkey")
    return table(spark, sf_dir, "region").select(
        _label("R-", key).alias("region_id"),
        F.col("r_name").alias("region_name"),
        _label("K-", key).alias("country_code"),
        F.col("r_name").alias("country_name"),
        F.lit("USD").alias("currency_code"),
        F.expr("cast(cast(8 + r_regionkey * 1.325 as decimal(7,4)) as string)").alias("tax_rate_pct"),
        F.lit("UTC").alias("timezone"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products of sales: the table ``part``, which grows with the data."""
    return table(spark, sf_dir, "part").select(
        _label("P-", F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") == 13, "").otherwise(F.col("p_type")).alias("category"),
        F.when(F.col("p_size") == 21, "  ").otherwise(F.col("p_size").cast("string")).alias("level"),
        _money(F.col("p_retailprice")).alias("price_usd"),
        F.col("p_brand").alias("instructor"),
    )


def _day(number: Column) -> Column:
    """The date that many days after the first day of the sales."""
    return F.date_add(F.lit("2024-01-01").cast("date"), number.cast("int")).cast("string")


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated rates of the sales' currencies: the table ``supplier``. Days have gaps, and some have several rates."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _pick(key % 3, "CAD", "MXN", "USD").alias("currency_code"),
        _day(key * 5 % 29 + 1).alias("rate_date"),
        F.expr("cast(cast(0.5 + s_acctbal / 10000 as decimal(12,6)) as string)").alias("exchange_rate_to_usd"),
        key.cast("long").alias("version"),
    )


def discount_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discount codes with the first and last day on which they hold: the table ``nation``. Windows overlap."""
    key = F.col("n_nationkey")
    first = key * 7 % 28
    return table(spark, sf_dir, "nation").select(
        F.when(key % 5 < 3, "SPRING25").otherwise(_label("CODE-", key)).alias("discount_code"),
        _day(first).alias("valid_from"),
        # One window ends before it starts, and some last one day.
        _day(F.when(key == 4, first - 2).otherwise(first + F.col("n_regionkey"))).alias("valid_to"),
        (key % 4 * 5 + 5).cast("string").alias("discount_pct"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stores of coffee orders: the table ``nation``. Orders name some stores it lacks."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        _label("S-", key).alias("store_id"),
        F.col("n_name").alias("store_name"),
        _label("City ", key).alias("city"),
        _label("T-", F.col("n_regionkey")).alias("state_code"),
        F.expr("cast(cast(5 + n_nationkey * 0.255 as decimal(7,4)) as string)").alias("tax_rate_pct"),
        F.lit("UTC").alias("timezone"),
    )


def drinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drinks of coffee orders: the table ``region``. Orders name one drink it lacks."""
    return table(spark, sf_dir, "region").select(
        _label("D-", F.col("r_regionkey")).alias("drink_id"), F.col("r_name").alias("drink_name")
    )
