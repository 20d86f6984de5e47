"""The queries over the given tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from weir.functions import money, rules, text
from weir.functions.money import DECIMAL
from weir.operators import aggregate, enrich, ordering, project, running, validate
from weir.operators.contract import ENVELOPE, ERROR_TEXT, Contract, require_fields
from weir.operators.lookup import (
    LOOKUP_VALUE,
    Lookup,
    flag_known,
    key_set,
    key_values,
    known_rows,
    miss_report,
    probe,
    unknown_rows,
    with_columns_of,
)
from weir.operators.route import ACCEPTED, REJECTED, ROUTE, Landing, branch_counts
from weir.plans import tables
from weir.plans.coffee import COFFEE
from weir.plans.flows import ask, computable_rules, consume, produce, storage_summary, with_computable
from weir.plans.sales import CURRENCY_CODES, DEVICE_TYPES, PAYMENT_METHODS, PRODUCT_FIELDS, REFERRAL_SOURCES, SALES
from weir.session import workspace
from weir.sources import records, topics
from weir.streaming import events, keyed, runs

# Fixed value: the prefix that the bounded queries take, which is their feature.
MAX_MESSAGES = 1000
# Partitions of a topic that is published to.
TOPIC_PARTITIONS = 3
# Batches of the streams.
STREAM_FILES = 4

KEY, PARTITION, OFFSET = ENVELOPE


class Given:
    """The given tables of one folder, as messages and reference tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def folder(self, name: str) -> str:
        return workspace(self.spark, name)

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    def stream(self, name: str, order: str) -> DataFrame:
        """The whole table as a stream of several batches: groups of files that arrive one after the other, in order."""
        table, path = self.table(name), self.folder(name)
        files = runs.write_in_turn(table, order, path, STREAM_FILES)
        return runs.stream_files(self.spark, path, table.schema, max_files=files)

    @cached_property
    def sales(self) -> DataFrame:
        return tables.sales_messages(self.table("events"))

    @cached_property
    def orders(self) -> DataFrame:
        return tables.order_messages(self.table("orders"))

    @cached_property
    def lines(self) -> DataFrame:
        return tables.line_messages(self.table("lineitem"))

    @cached_property
    def products(self) -> DataFrame:
        return tables.products(self.spark, self.sf_dir)

    @cached_property
    def region_keys(self) -> Lookup:
        return Lookup.keys(tables.regions(self.spark, self.sf_dir), "region_id")

    @cached_property
    def product_keys(self) -> Lookup:
        return Lookup.keys(self.products, "product_id")

    @cached_property
    def store_keys(self) -> Lookup:
        return Lookup.keys(tables.stores(self.spark, self.sf_dir), "store_id")

    @cached_property
    def drink_keys(self) -> Lookup:
        return Lookup.keys(tables.drinks(self.spark, self.sf_dir), "drink_id")

    @cached_property
    def region_rates(self) -> Lookup:
        return Lookup.values(tables.regions(self.spark, self.sf_dir), "region_id", "tax_rate_pct")

    @cached_property
    def store_rates(self) -> Lookup:
        return Lookup.values(tables.stores(self.spark, self.sf_dir), "store_id", "tax_rate_pct")

    @cached_property
    def sales_references(self) -> dict[str, Lookup]:
        return {"regions": self.region_keys, "products": self.product_keys}

    @cached_property
    def coffee_references(self) -> dict[str, Lookup]:
        return {"stores": self.store_keys, "drinks": self.drink_keys}

    def checked_sales(self) -> DataFrame:
        return validate.validate(self.sales, SALES, self.sales_references)

    def checked_lines(self) -> DataFrame:
        return validate.validate(self.lines, COFFEE, self.coffee_references)

    def consume_sales(self, messages: DataFrame) -> DataFrame:
        return consume(messages, SALES, self.region_rates, enrich.enrich_sales)

    @cached_property
    def fixed_region_rates(self) -> Lookup:
        return self.region_rates.stored(self.folder("rates"))

    def consume_sales_batch(self, messages: DataFrame) -> DataFrame:
        """Consume one batch of a stream with the copy of the rates that all batches use."""
        return consume(messages, SALES, self.fixed_region_rates, enrich.enrich_sales)

    def reported_sales(self) -> tuple[DataFrame, DataFrame]:
        """Both branches of a run whose topic holds the valid messages, as the closing report reads them.

        One check has the rules of the producer and of the consumer; only what passes is priced.
        """
        checked = validate.validate(self.sales, with_computable(SALES), self.sales_references)
        accepted = enrich.enrich_sales(validate.valid_rows(checked), self.region_rates)
        rejected = validate.with_error_text(validate.invalid_rows(checked))
        return project.accepted_shape(accepted, SALES), project.rejected_shape(rejected, SALES)

    def reported_lines(self) -> tuple[DataFrame, DataFrame]:
        checked = validate.validate(self.lines, with_computable(COFFEE), self.coffee_references)
        accepted = enrich.enrich_coffee(validate.valid_rows(checked), self.store_rates)
        rejected = validate.with_error_text(validate.invalid_rows(checked))
        return project.accepted_shape(accepted, COFFEE), project.rejected_shape(rejected, COFFEE)

    def reported_orders(self) -> DataFrame:
        checked = validate.validate(self.orders, with_computable(COFFEE), self.coffee_references)
        return enrich.enrich_coffee(validate.valid_rows(checked), self.store_rates)

    def consume_coffee(self, messages: DataFrame) -> DataFrame:
        return consume(messages, COFFEE, self.store_rates, enrich.enrich_coffee)

    def accepted_sales(self) -> DataFrame:
        return validate.valid_rows(self.consume_sales(self.sales))

    def accepted_orders(self) -> DataFrame:
        return validate.valid_rows(self.consume_coffee(self.orders))

    def accepted_lines(self) -> DataFrame:
        return validate.valid_rows(self.consume_coffee(self.lines))

    def consume_sales_stream(self) -> DataFrame:
        return self.consume_sales_batch(self.stream_sales())

    def consume_orders_stream(self) -> DataFrame:
        rates = self.store_rates.stored(self.folder("rates"))
        return consume(self.stream_orders(), COFFEE, rates, enrich.enrich_coffee)

    def stream_sales(self) -> DataFrame:
        return tables.sales_messages(self.stream("events", "event_id"))

    def stream_orders(self) -> DataFrame:
        return tables.order_messages(self.stream("orders", "o_orderkey"))


Query = Callable[[Given], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[run.__name__] = run
    return run


def plain(df: DataFrame) -> DataFrame:
    """Return exact decimals as doubles, which every engine prints alike."""
    exact = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in exact})


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Return every query as a function of the session and the folder of tables."""

    def bind(run: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(run(Given(spark, sf_dir)))

    return {name: bind(run) for name, run in QUERIES.items()}


# Sources


@query
def csv_scan(g: Given) -> DataFrame:
    path = g.folder("csv")
    records.write_records(project.project(g.sales, SALES.fields), path)
    return project.project(records.read_written(g.spark, path, SALES.fields), SALES.fields)


@query
def csv_lookup(g: Given) -> DataFrame:
    path = g.folder("regions")
    regions = tables.regions(g.spark, g.sf_dir)
    raised = regions.withColumn("tax_rate_pct", (F.col("tax_rate_pct").cast("double") + 1).cast("string"))
    first = regions.where("region_id = 'R-0'").withColumn("tax_rate_pct", F.lit("9.75"))
    for version, table in enumerate((raised, regions, first)):
        records.write_records(table, f"{path}/version-{version}")
    table = records.read_records(g.spark, f"{path}/*", regions.columns, place=True)
    latest = key_values(table, "region_id", "tax_rate_pct", records.PLACE)
    return latest.select("region_id", F.col("tax_rate_pct").cast("double"))


@query
def stream_scan_earliest(g: Given) -> DataFrame:
    path = g.folder("scan")
    messages = project.project(g.stream_sales(), [*SALES.fields, *ENVELOPE])
    runs.run_append(messages, f"{path}/rows", f"{path}/checkpoint")
    return g.spark.read.parquet(f"{path}/rows")


def _topic_records(messages: DataFrame) -> DataFrame:
    """Spell messages as topic records; those that ask for 2 items arrive cut off."""
    value = F.to_json(F.struct(*(text.or_empty(F.col(c)).alias(c) for c in SALES.fields)))
    arrived = F.when(F.col("quantity") == "2", F.substring(value, 1, 40)).otherwise(value)
    return messages.select(
        F.col(KEY).cast("binary").alias("key"),
        arrived.cast("binary").alias("value"),
        F.col(PARTITION).alias("partition"),
        F.col(OFFSET).alias("offset"),
    )


@query
def stream_decode_envelope(g: Given) -> DataFrame:
    path = g.folder("decode")
    decoded = topics.decode(_topic_records(g.stream_sales()), SALES)
    marked = decoded.withColumn("undecoded", F.col(topics.UNDECODED).isNotNull())
    checked = validate.validate_required(marked, SALES)
    shown = project.project(checked, [*SALES.fields, *ENVELOPE, validate.IS_VALID, "undecoded"])
    runs.run_append(shown, f"{path}/rows", f"{path}/checkpoint")
    return g.spark.read.parquet(f"{path}/rows")


@query
def bounded_consume(g: Given) -> DataFrame:
    taken = ordering.first_messages(g.sales, MAX_MESSAGES)
    return validate.validate_required(taken, SALES).select("order_id", PARTITION, OFFSET, validate.IS_VALID)


@query
def topic_count_gate(g: Given) -> DataFrame:
    return topics.offsets_by_partition(topics.require_messages(g.sales, "events"))


@query
def replay_first_n(g: Given) -> DataFrame:
    replayed = ordering.first_rows(g.sales, MAX_MESSAGES, ["datetime", "order_id"])
    checked = validate.validate(replayed, SALES, g.sales_references)
    return checked.select("order_id", "datetime", validate.IS_VALID)


@query
def dim_key_set(g: Given) -> DataFrame:
    return key_set(g.products, "product_id")


# Sinks


@query
def publish_keyed(g: Given) -> DataFrame:
    return produce(g.sales, SALES, g.sales_references)[0]


@query
def keyed_partition_order(g: Given) -> DataFrame:
    valid = validate.valid_rows(g.checked_sales())
    laid_out = ordering.keyed_order(valid, "region_id", [PARTITION, OFFSET], whole=True)
    return laid_out.select("region_id", PARTITION, OFFSET, "order_id")


@query
def keyed_publish_order(g: Given) -> DataFrame:
    placed = topics.place(validate.valid_rows(g.checked_sales()), "region_id", TOPIC_PARTITIONS)
    return placed.select("region_id", topics.BROKER_PARTITION, topics.BROKER_OFFSET, "order_id")


@query
def csv_append_sink(g: Given) -> DataFrame:
    path = g.folder("consumed")

    def append(batch: DataFrame, batch_id: int) -> None:
        accepted = validate.valid_rows(g.consume_sales_batch(batch))
        records.write_batch(project.consumed_shape(accepted, SALES), f"{path}/rows", "1", batch_id)

    runs.run_batches(g.stream_sales(), f"{path}/checkpoint", append)
    landed = records.read_written(g.spark, f"{path}/rows/*/*", SALES.consumed_fields)
    return project.consumed_shape(landed, SALES)


@query
def rejected_csv_sink(g: Given) -> DataFrame:
    path, fields = g.folder("rejected"), [*SALES.required, ERROR_TEXT]
    records.write_records(produce(g.sales, SALES, g.sales_references)[1], path)
    return project.project(records.read_written(g.spark, path, fields), fields)


def _landed(g: Given, contract: Contract, consumed: DataFrame) -> Landing:
    landing = Landing(g.spark, g.folder("landing"), contract)
    landing.reset()
    landing.write(consumed, 0)
    return landing


@query
def accepted_table_sink(g: Given) -> DataFrame:
    return _landed(g, SALES, g.consume_sales(g.sales)).accepted()


@query
def accepted_table_sink_coffee(g: Given) -> DataFrame:
    return _landed(g, COFFEE, g.consume_coffee(g.orders)).accepted()


@query
def rejected_table_sink(g: Given) -> DataFrame:
    return _landed(g, SALES, g.consume_sales(g.sales)).rejected()


@query
def rejected_table_sink_coffee(g: Given) -> DataFrame:
    return _landed(g, COFFEE, validate.validate(g.orders, COFFEE, g.coffee_references)).rejected()


def _branch_counts(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    sides = [side.select(F.lit(name).alias(ROUTE)) for side, name in ((accepted, ACCEPTED), (rejected, REJECTED))]
    return sides[0].union(sides[1]).groupBy(ROUTE).agg(F.count("*").alias("message_count"))


@query
def route_split(g: Given) -> DataFrame:
    return branch_counts(g.checked_lines())


@query
def table_create(g: Given) -> DataFrame:
    landing = Landing(g.spark, g.folder("created"), SALES)
    landing.create()
    landing.write(g.consume_sales(g.sales), 0)
    landing.create()
    return _branch_counts(landing.accepted(), landing.rejected())


@query
def table_reset(g: Given) -> DataFrame:
    landing = Landing(g.spark, g.folder("reset"), SALES)
    for batch_id in (0, 1):
        landing.reset()
        landing.write(g.consume_sales(g.sales), batch_id)
    return _branch_counts(landing.accepted(), landing.rejected())


@query
def output_reset(g: Given) -> DataFrame:
    path, fields = g.folder("output"), [*SALES.required, ERROR_TEXT]
    rejected = produce(g.sales, SALES, g.sales_references)[1]
    for _ in range(2):
        records.write_records(rejected, path, first=True)
    return aggregate.row_count(records.read_written(g.spark, path, fields), "rejected_count")


@query
def chart_series_table(g: Given) -> DataFrame:
    path = g.folder("series")
    running.totals_by_offset(g.accepted_sales()).write.parquet(path)
    return g.spark.read.parquet(path)


# Projections and filters


@query
def project_required(g: Given) -> DataFrame:
    return project.required_only(g.sales, SALES)


@query
def project_accepted(g: Given) -> DataFrame:
    return project.accepted_shape(g.accepted_sales(), SALES)


@query
def project_rejected(g: Given) -> DataFrame:
    rejected = validate.with_error_text(validate.invalid_rows(g.checked_sales()))
    return project.rejected_shape(rejected, SALES)


@query
def project_consumed(g: Given) -> DataFrame:
    return project.consumed_shape(g.accepted_sales(), SALES)


@query
def project_consumed_coffee(g: Given) -> DataFrame:
    return project.consumed_shape(g.accepted_orders(), COFFEE)


@query
def project_consumed_ext(g: Given) -> DataFrame:
    consumed = consume(g.sales, SALES, g.region_rates, enrich.enrich_sales_per_item)
    return project.consumed_shape(validate.valid_rows(consumed), SALES, ["total_per_item"])


@query
def star_extend(g: Given) -> DataFrame:
    return project.extend(
        project.project(g.lines, [*COFFEE.fields, *ENVELOPE]),
        {"quantity": money.quantity(F.col("quantity")), "price": DECIMAL.price(F.col("unit_price"))},
    )


@query
def filter_valid(g: Given) -> DataFrame:
    return validate.valid_rows(g.checked_lines()).select("order_id", "store_id", "size", "payment_method")


@query
def filter_invalid(g: Given) -> DataFrame:
    return validate.invalid_rows(g.checked_lines()).select("order_id", "store_id", "size", "payment_method")


# Validation


def _outcomes(df: DataFrame, *checks: rules.Rule) -> DataFrame:
    checked = validate.check(df, (), checks)
    return validate.with_error_text(checked).select("order_id", validate.IS_VALID, ERROR_TEXT)


@query
def val_required(g: Given) -> DataFrame:
    checked = validate.with_error_text(validate.validate_required(g.sales, SALES))
    return checked.select("order_id", validate.IS_VALID, ERROR_TEXT)


@query
def val_short_circuit(g: Given) -> DataFrame:
    missing = F.filter(validate.ERRORS, lambda message: message.startswith("Missing required field"))
    return g.checked_sales().select(
        "order_id",
        F.size(missing).cast("long").alias("missing_count"),
        (F.size(validate.ERRORS) - F.size(missing)).cast("long").alias("other_count"),
    )


@query
def val_ref_region(g: Given) -> DataFrame:
    return _outcomes(flag_known(g.sales, g.region_keys, "region_id"), rules.known("region_id"))


@query
def val_ref_product(g: Given) -> DataFrame:
    return _outcomes(flag_known(g.sales, g.product_keys, "product_id"), rules.known("product_id"))


@query
def val_ref_store(g: Given) -> DataFrame:
    return _outcomes(flag_known(g.lines, g.store_keys, "store_id"), rules.known("store_id"))


@query
def val_ref_drink(g: Given) -> DataFrame:
    return _outcomes(flag_known(g.lines, g.drink_keys, "drink_id"), rules.known("drink_id"))


@query
def val_allowed(g: Given) -> DataFrame:
    return _outcomes(
        g.sales,
        rules.allowed("device_type", DEVICE_TYPES),
        rules.allowed("payment_method", PAYMENT_METHODS),
        rules.allowed("referral_source", REFERRAL_SOURCES),
        rules.allowed("currency_code", CURRENCY_CODES),
    )


@query
def val_datetime(g: Given) -> DataFrame:
    return _outcomes(g.sales, rules.iso_datetime("datetime"))


@query
def val_positive_int(g: Given) -> DataFrame:
    return _outcomes(g.sales, rules.positive_integer("quantity"))


@query
def val_quantity(g: Given) -> DataFrame:
    outcome = F.coalesce(rules.positive_integer("quantity").outcome(), F.lit(""))
    return g.sales.groupBy(outcome.alias("error")).agg(F.count("*").alias("message_count"))


@query
def val_boolean_text(g: Given) -> DataFrame:
    return _outcomes(g.sales, rules.boolean_text("is_online"), rules.boolean_text("is_new_customer"))


@query
def val_error_list(g: Given) -> DataFrame:
    flagged = flag_known(g.sales, g.region_keys, "region_id")
    flagged = flag_known(flagged, g.product_keys, "product_id")
    return _outcomes(flagged, *SALES.rules)


@query
def validate_sale(g: Given) -> DataFrame:
    return validate.with_error_text(g.checked_sales()).select("order_id", validate.IS_VALID, ERROR_TEXT)


@query
def validate_order(g: Given) -> DataFrame:
    return validate.with_error_text(g.checked_lines()).select("order_id", validate.IS_VALID, ERROR_TEXT)


@query
def validate_consumer_light(g: Given) -> DataFrame:
    return aggregate.run_counts(validate.validate_required(g.sales, SALES))


@query
def attach_errors(g: Given) -> DataFrame:
    return produce(g.sales, SALES, g.sales_references)[1]


@query
def validate_dimension(g: Given) -> DataFrame:
    return validate.reference_errors(g.products, "product_id", PRODUCT_FIELDS, "products")


@query
def schema_gate(g: Given) -> DataFrame:
    gated = require_fields(g.sales, [*SALES.fields, SALES.key], "events")
    return aggregate.count_by(gated, SALES.key, "message_count")


# Joins


@query
def lookup_join_default(g: Given) -> DataFrame:
    rated = probe(g.orders, g.store_rates, "store_id")
    return rated.select(
        "order_id",
        "store_id",
        DECIMAL.rate(F.col(LOOKUP_VALUE)).alias("tax_rate"),
        F.col(LOOKUP_VALUE).isNull().alias("defaulted"),
    )


@query
def lookup_miss_report(g: Given) -> DataFrame:
    return miss_report(g.lines, g.store_rates, "store_id")


@query
def membership_semi(g: Given) -> DataFrame:
    return known_rows(g.sales, g.product_keys, "product_id").select("order_id", "product_id")


@query
def membership_anti(g: Given) -> DataFrame:
    return unknown_rows(g.sales, g.product_keys, "product_id").select("order_id", "product_id")


# Scalar functions and derived fields


def _parsed(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.select("order_id", value.isNotNull().alias("parsed"), F.coalesce(value, F.lit(0)).alias(name))


@query
def parse_quantity(g: Given) -> DataFrame:
    return _parsed(g.sales, money.quantity(F.col("quantity")), "quantity")


@query
def parse_unit_price(g: Given) -> DataFrame:
    return _parsed(g.sales, DECIMAL.price(F.col("unit_price")), "unit_price")


@query
def parse_bool_text(g: Given) -> DataFrame:
    return g.lines.select("order_id", text.is_true_text(F.col("is_loyalty")).alias("is_loyalty"))


def _derived(df: DataFrame, lookup: Lookup, on: str, *steps: enrich.Derived) -> DataFrame:
    derived = enrich.derive(enrich.with_operands(df, lookup, on), steps)
    last = steps[-1].name
    return derived.select("order_id", F.col(last).alias(last.lstrip("_")))


@query
def derive_subtotal(g: Given) -> DataFrame:
    return _derived(g.lines, g.store_rates, "store_id", enrich.subtotal())


@query
def derive_tax_rate(g: Given) -> DataFrame:
    operands = enrich.with_operands(g.lines, g.store_rates, "store_id")
    rates = operands.groupBy("store_id", F.col(enrich.RATE).alias("tax_rate"))
    return rates.agg(F.count("*").alias("order_count"))


@query
def derive_tax_amount(g: Given) -> DataFrame:
    return _derived(g.lines, g.store_rates, "store_id", enrich.subtotal(), enrich.tax_amount())


@query
def derive_total(g: Given) -> DataFrame:
    return _derived(g.lines, g.store_rates, "store_id", *enrich.SALE_STEPS)


@query
def derive_loyalty_discount(g: Given) -> DataFrame:
    return _derived(g.lines, g.store_rates, "store_id", enrich.subtotal(), enrich.loyalty_discount())


@query
def derive_taxable(g: Given) -> DataFrame:
    return _derived(g.lines, g.store_rates, "store_id", *enrich.ORDER_STEPS[:3])


@query
def derive_total_discounted(g: Given) -> DataFrame:
    return _derived(g.lines, g.store_rates, "store_id", *enrich.ORDER_STEPS)


@query
def derive_total_per_item(g: Given) -> DataFrame:
    steps = (*enrich.SALE_STEPS, enrich.total_per_item())
    return _derived(g.accepted_sales(), g.region_rates, "region_id", *steps)


@query
def round2(g: Given) -> DataFrame:
    price, tax = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_tax").cast("decimal(4,2)")
    return g.table("lineitem").select("l_orderkey", DECIMAL.round2(price * tax).alias("amount"))


@query
def money_format(g: Given) -> DataFrame:
    return g.lines.select("order_id", money.money_text(DECIMAL.price(F.col("unit_price"))).alias("shown"))


@query
def label_loyalty(g: Given) -> DataFrame:
    label = text.loyalty_label(F.col("is_loyalty")).alias("label")
    return g.lines.groupBy("is_loyalty", label).agg(F.count("*").alias("order_count"))


@query
def error_text(g: Given) -> DataFrame:
    return g.sales.select("order_id", text.complaint("Unknown region_id", F.col("region_id")).alias("error"))


@query
def field_default(g: Given) -> DataFrame:
    return project.project(g.sales.select("order_id", "customer_id"), ["order_id", "customer_id", "customer_note"])


@query
def enrich_sales(g: Given) -> DataFrame:
    enriched = g.consume_sales(validate.valid_rows(g.checked_sales()))
    return validate.valid_rows(enriched).drop(validate.ERRORS, validate.IS_VALID)


@query
def enrich_coffee(g: Given) -> DataFrame:
    enriched = enrich.enrich_coffee(g.lines, g.store_rates)
    return enriched.select("order_id", "store_id", *COFFEE.derived)


@query
def enrich_sales_per_item(g: Given) -> DataFrame:
    consumed = consume(g.sales, SALES, g.region_rates, enrich.enrich_sales_per_item)
    return validate.valid_rows(consumed).select("order_id", *SALES.derived, "total_per_item")


# Aggregations


@query
def agg_accepted_count(g: Given) -> DataFrame:
    return storage_summary(*g.reported_lines(), COFFEE)["accepted"]


@query
def agg_rejected_count(g: Given) -> DataFrame:
    return storage_summary(*g.reported_lines(), COFFEE)["rejected"]


@query
def agg_count_by_region(g: Given) -> DataFrame:
    return storage_summary(*g.reported_sales(), SALES)["by_region"]


def _coffee_summary(g: Given, question: str) -> DataFrame:
    return storage_summary(*g.reported_lines(), COFFEE)[question]


@query
def agg_revenue_by_store(g: Given) -> DataFrame:
    return _coffee_summary(g, "by_store")


@query
def agg_revenue_by_size(g: Given) -> DataFrame:
    return _coffee_summary(g, "by_size")


@query
def agg_loyalty(g: Given) -> DataFrame:
    return _coffee_summary(g, "by_loyalty")


@query
def agg_run_stats(g: Given) -> DataFrame:
    return aggregate.run_stats(g.reported_lines()[0])


@query
def agg_run_counts(g: Given) -> DataFrame:
    return aggregate.run_counts(g.checked_lines())


@query
def agg_cumulative_by_key(g: Given) -> DataFrame:
    return aggregate.cumulative_by(g.reported_lines()[0], "store_id")


# Running values


def _running_sales(g: Given, *columns: str) -> DataFrame:
    return running.running_stats(g.accepted_sales()).select(PARTITION, OFFSET, "total", *columns)


@query
def running_total(g: Given) -> DataFrame:
    return _running_sales(g, "running_total")


@query
def running_mean(g: Given) -> DataFrame:
    return _running_sales(g, "running_mean")


@query
def running_min(g: Given) -> DataFrame:
    return _running_sales(g, "running_min")


@query
def running_max(g: Given) -> DataFrame:
    return _running_sales(g, "running_max")


@query
def running_count(g: Given) -> DataFrame:
    return _running_sales(g, "running_count")


@query
def running_accepted_rejected(g: Given) -> DataFrame:
    counted = running.running_route_counts(g.checked_sales())
    return counted.select(PARTITION, OFFSET, "running_accepted", "running_rejected")


@query
def running_revenue_by_key(g: Given) -> DataFrame:
    stats = running.running_stats(g.accepted_orders(), keys=["store_id"])
    return stats.select("store_id", PARTITION, OFFSET, "total", F.col("running_total").alias("running_revenue"))


@query
def series_total_by_offset(g: Given) -> DataFrame:
    return running.totals_by_offset(g.accepted_sales())


# Sorts and limits


@query
def sort_by_key(g: Given) -> DataFrame:
    return aggregate.count_by(g.lines, "store_id", "order_count")


@query
def sort_by_revenue_desc(g: Given) -> DataFrame:
    return aggregate.revenue_by(g.reported_orders(), "store_id")


@query
def sort_by_flag_desc(g: Given) -> DataFrame:
    return aggregate.by_loyalty(g.reported_orders())


@query
def limit_n(g: Given) -> DataFrame:
    return ordering.first_messages(g.orders, MAX_MESSAGES).select("order_id", PARTITION, OFFSET)


# Streams


@query
def stream_validate_route(g: Given) -> DataFrame:
    path = g.folder("route")
    landing = Landing(g.spark, f"{path}/rows", SALES)
    landing.reset()
    runs.land(g.stream_sales(), g.consume_sales_batch, landing, f"{path}/checkpoint")
    accepted = landing.accepted().select("order_id", F.lit(ACCEPTED).alias(ROUTE), F.lit("").alias(ERROR_TEXT))
    return accepted.union(landing.rejected().select("order_id", F.lit(REJECTED), ERROR_TEXT))


@query
def stream_enrich(g: Given) -> DataFrame:
    path = g.folder("enrich")
    enriched = validate.valid_rows(g.consume_sales_stream())
    runs.run_append(project.consumed_shape(enriched, SALES), f"{path}/rows", f"{path}/checkpoint")
    return g.spark.read.parquet(f"{path}/rows")


@query
def stream_running_stats(g: Given) -> DataFrame:
    path = g.folder("stats")
    stats = aggregate.run_stats(validate.valid_rows(g.consume_sales_stream()))
    runs.run_latest(stats, f"{path}/rows", f"{path}/checkpoint")
    return runs.read_latest(g.spark, f"{path}/rows")


@query
def stream_running_rows(g: Given) -> DataFrame:
    path = g.folder("running")
    accepted = validate.valid_rows(g.consume_sales_stream())
    measures = running.stats_measures()
    runs.run_running(
        accepted.select(PARTITION, OFFSET, "total"), measures, [PARTITION], f"{path}/rows", f"{path}/state",
        f"{path}/checkpoint",
    )
    return runs.running_stats_rows(g.spark, f"{path}/rows")


@query
def stream_running_rows_by_key(g: Given) -> DataFrame:
    path = g.folder("keyed")
    accepted = validate.valid_rows(g.consume_orders_stream())
    keyed.run_by_key(accepted, ["store_id"], f"{path}/rows", f"{path}/checkpoint")
    return g.spark.read.parquet(f"{path}/rows")


@query
def stream_cumulative_by_key(g: Given) -> DataFrame:
    path = g.folder("cumulative")
    accepted = validate.valid_rows(g.consume_orders_stream())
    runs.run_latest(aggregate.cumulative_by(accepted, "store_id"), f"{path}/rows", f"{path}/checkpoint")
    return runs.read_latest(g.spark, f"{path}/rows")


@query
def stream_replay(g: Given) -> DataFrame:
    path = g.folder("replay")
    counts = []
    for run in (1, 2):
        landing = Landing(g.spark, f"{path}/run-{run}", SALES)
        landing.reset()
        runs.land(g.stream_sales(), g.consume_sales_batch, landing, f"{path}/checkpoint-{run}")
        sides = _branch_counts(landing.accepted(), landing.rejected())
        counts.append(sides.select(F.lit(run).alias("run"), ROUTE, "message_count"))
    return counts[0].union(counts[1])


@query
def stream_run_bounded(g: Given) -> DataFrame:
    path = g.folder("bounded")
    landing = Landing(g.spark, f"{path}/rows", SALES)
    landing.reset()

    def take(batch: DataFrame, batch_id: int) -> None:
        landing.write(g.consume_sales_batch(batch), batch_id)

    # Three runs of one consumer: each goes on where the one before stopped.
    for limit in (MAX_MESSAGES // 4, MAX_MESSAGES // 2, MAX_MESSAGES // 4):
        runs.run_bounded(g.sales, limit, f"{path}/positions", take)
    return _branch_counts(landing.accepted(), landing.rejected())


# Further questions


@query
def ext_error_histogram(g: Given) -> DataFrame:
    return aggregate.error_histogram(g.checked_sales())


@query
def ext_dedup_replay(g: Given) -> DataFrame:
    """A topic that holds every message twice, the second time at later offsets."""
    end = g.sales.agg(F.max(OFFSET)).first()[0] or 0
    again = g.sales.withColumn(OFFSET, F.col(OFFSET) + F.lit(end + 1))
    first = ordering.first_of_each(g.sales.unionByName(again), "order_id")
    return first.select("order_id", "region_id", PARTITION, OFFSET)


@query
def ext_region_running_count(g: Given) -> DataFrame:
    counted = running.running(g.accepted_sales(), {"running_count": running.Measure("count", F.lit(1))}, ["region_id"])
    return counted.select("region_id", PARTITION, OFFSET, "running_count")


@query
def ext_run_summary(g: Given) -> DataFrame:
    """What a run observed in one pass: what the producer turned away, and what landed in two batches, the second one retried."""
    landing, turned_away = Landing(g.spark, g.folder("summary"), SALES, summarize=True), {}
    for batch_id in (0, 1, 1):
        seen = Observation()
        part = g.checked_sales().where(F.col(PARTITION) % 2 == batch_id)
        part = part.observe(seen, F.count_if(~F.col(validate.IS_VALID)).alias(REJECTED))
        landing.write(g.consume_sales(validate.valid_rows(part).drop(validate.ERRORS, validate.IS_VALID)), batch_id)
        turned_away[batch_id] = seen.get[REJECTED]
    landed = landing.summary().select("accepted_count", "revenue", "first_offset", "last_offset")
    return landed.withColumn("rejected_count", F.lit(sum(turned_away.values())).cast("long"))


@query
def ext_event_windows(g: Given) -> DataFrame:
    sent = validate.valid_rows(g.checked_sales()).drop(validate.ERRORS, validate.IS_VALID)
    return aggregate.by_day(validate.valid_rows(g.consume_sales(sent)))


@query
def ext_discount_window(g: Given) -> DataFrame:
    priced = enrich.discounted(g.accepted_sales(), tables.discount_codes(g.spark, g.sf_dir))
    return priced.select("order_id", "discount_code", "datetime", "discount_pct", "subtotal", "discount")


@query
def ext_to_usd(g: Given) -> DataFrame:
    priced = enrich.in_usd(g.accepted_sales(), tables.exchange_rates(g.spark, g.sf_dir))
    return priced.select("order_id", "currency_code", "datetime", "total", "total_usd")


#: Accepted sales beside their region and product, as a user of the landed tables asks for them.
SALES_BY_DIMENSION = """
SELECT a.order_id, r.region_name, r.country_name, p.product_name, p.category, a.total
FROM {accepted} a JOIN {regions} r ON r.region_id = a.region_id LEFT JOIN {products} p ON p.product_id = a.product_id
"""


@query
def ext_dim_sql_join(g: Given) -> DataFrame:
    regions = tables.regions(g.spark, g.sf_dir)
    return ask(g.spark, SALES_BY_DIMENSION, accepted=g.accepted_sales(), regions=regions, products=g.products)


@query
def ext_price_check(g: Given) -> DataFrame:
    listed = Lookup.rows(g.products, "product_id", ["price_usd", "product_name"])
    named = with_columns_of(g.sales, listed, "product_id", {"price_usd": "price_usd", "product_name": "product_name"})
    near = rules.near_listed("unit_price", "price_usd", money.DECIMAL.price, "0.5")
    checked = validate.check(named, SALES.required, [*computable_rules(DECIMAL), near])
    shown = validate.with_error_text(checked)
    return shown.select("order_id", "product_name", "unit_price", "price_usd", validate.IS_VALID, ERROR_TEXT)


@query
def ext_enriched_table(g: Given) -> DataFrame:
    """Sales of even partitions were landed before the derived columns were, the others after."""
    path = g.folder("enriched")
    before, after = Landing(g.spark, path, SALES), Landing(g.spark, path, SALES, extra=SALES.derived)
    after.reset()
    consumed = g.consume_sales(g.sales)
    early = F.col(PARTITION) % 2 == 0
    before.write(consumed.where(early), 0)
    after.write(consumed.where(~early), 0)
    landed = after.enriched(lambda df: enrich.enrich_sales(df, g.region_rates))
    return landed.select("order_id", "region_id", *SALES.derived)


# Longer than the given tables last, so that no sale is late.
WATERMARK = "60 days"


@query
def ext_event_windows_stream(g: Given) -> DataFrame:
    path = g.folder("windows")
    accepted = validate.valid_rows(g.consume_sales_stream())
    amounts = {"sale_count": F.count("*"), "revenue": aggregate.revenue()}
    daily = events.windowed(events.in_event_time(accepted, "datetime", WATERMARK), "1 day", amounts)
    events.run_changed(daily, f"{path}/rows", f"{path}/checkpoint")
    found = events.read_changed(g.spark, f"{path}/rows", ["start"])
    return found.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "sale_count", "revenue")


@query
def ext_event_sessions(g: Given) -> DataFrame:
    """Customers' runs of sales, those that the watermark has closed by the end of the table."""
    path = g.folder("sessions")
    accepted = validate.valid_rows(g.consume_sales_stream())
    timed = events.in_event_time(accepted, "datetime", "2 days")
    events.run_closed(events.sessions(timed, "12 hours", {"sale_count": F.count("*")}, ["customer_id"]), f"{path}/rows", f"{path}/checkpoint")
    found = g.spark.read.parquet(f"{path}/rows")
    return found.select("customer_id", tables.iso_text(F.col("start")).alias("start"), tables.iso_text(F.col("end")).alias("end"), "sale_count")


@query
def ext_dedup_replay_stream(g: Given) -> DataFrame:
    """A topic that is replayed whole: the table arrives twice, and the second run goes on from the first one's state."""
    path, table = g.folder("replayed"), g.table("events")
    for _ in range(2):
        files = runs.write_in_turn(table, "event_id", f"{path}/topic", 2)
        messages = tables.sales_messages(runs.stream_files(g.spark, f"{path}/topic", table.schema, max_files=files))
        once = events.without_repeats(events.in_event_time(messages, "datetime", WATERMARK), "order_id")
        events.run_closed(once.select("order_id", "region_id", PARTITION, OFFSET), f"{path}/rows", f"{path}/checkpoint")
    return g.spark.read.parquet(f"{path}/rows")
