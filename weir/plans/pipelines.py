"""Whole runs of a domain: publish its records to a topic, consume the topic, report.

The topic may be a Kafka topic (see ``sources.topics``) or a folder of parquet files with the same
four columns, which is what the file runs here use.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weir.functions.money import DECIMAL, MoneyPolicy
from weir.operators import aggregate, enrich, running
from weir.operators.contract import ENVELOPE, ERROR_TEXT, Contract
from weir.operators.lookup import Lookup
from weir.operators.ordering import first_rows
from weir.operators.project import accepted_shape, consumed_shape, project
from weir.operators.route import Landing
from weir.operators.validate import (
    ERRORS,
    IS_VALID,
    invalid_rows,
    reference_errors,
    require_clean,
    valid_rows,
    validate,
    with_error_text,
)
from weir.plans import coffee, sales
from weir.plans.flows import Enricher, consume, storage_summary
from weir.session import workspace
from weir.sources import records, topics
from weir.streaming import runs

# The order in which records are replayed: the time of the event, then its id.
REPLAY_ORDER = ["datetime", "order_id"]


@dataclass(frozen=True)
class Reference:
    """A reference file: its key and the fields every row must have."""

    key: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Domain:
    """What a run needs to know: the contract, the files and the derived fields."""

    contract: Contract
    events: str
    references: Mapping[str, Reference]
    rates: str
    enricher: Enricher
    extra: tuple[str, ...] = ()

    @property
    def stored(self) -> Contract:
        """The contract whose accepted table also keeps the derived fields."""
        fields = (*self.contract.fields, *self.contract.derived, *self.extra, *ENVELOPE)
        return replace(self.contract, derived=(*self.contract.derived, *self.extra), stored=fields)


_SALES_REFERENCES = {
    "regions": Reference("region_id", sales.REGION_FIELDS),
    "products": Reference("product_id", sales.PRODUCT_FIELDS),
}
_COFFEE_REFERENCES = {
    "stores": Reference("store_id", coffee.STORE_FIELDS),
    "drinks": Reference("drink_id", coffee.DRINK_FIELDS),
}

DOMAINS = {
    "sales": Domain(sales.SALES, "sales", _SALES_REFERENCES, "regions", enrich.enrich_sales),
    "sales_per_item": Domain(
        sales.SALES, "sales", _SALES_REFERENCES, "regions", enrich.enrich_sales_per_item, ("total_per_item",)
    ),
    "coffee": Domain(coffee.COFFEE, "coffee_orders", _COFFEE_REFERENCES, "stores", enrich.enrich_coffee),
}


def load_references(spark: SparkSession, domain: Domain, data_dir: str) -> dict[str, DataFrame]:
    """Read the reference files, and stop the run if any row lacks a required field."""
    tables = {
        name: records.read_records(spark, f"{data_dir}/{name}.csv", reference.fields)
        for name, reference in domain.references.items()
    }
    errors = [
        reference_errors(tables[name], reference.key, reference.fields, name)
        for name, reference in domain.references.items()
    ]
    require_clean(reduce(DataFrame.unionByName, errors))
    return tables


def load_rates(spark: SparkSession, domain: Domain, data_dir: str) -> Lookup:
    """Read the tax percentages by key."""
    reference = domain.references[domain.rates]
    fields = [reference.key, "tax_rate_pct"]
    table = records.read_records(spark, f"{data_dir}/{domain.rates}.csv", fields, place=True)
    return Lookup.values(table, reference.key, "tax_rate_pct", records.PLACE)


def run_producer(
    spark: SparkSession,
    domain: Domain,
    data_dir: str,
    out_dir: str,
    count: int | None = None,
    partitions: int = 1,
    multi_line: bool = True,
) -> dict[str, int]:
    """Validate records, publish the valid ones to ``out_dir/topic`` and list the others.

    ``count`` bounds the records that are read, valid or not. Returns how many were sent and
    rejected. Offsets grow along the replay order; they have gaps, as those of a topic may. The records are
    read and checked once: both branches are written in one job and go on from there. ``multi_line`` admits line breaks
    in the records' texts, for which each file is read by one task.
    """
    contract = domain.contract
    tables = load_references(spark, domain, data_dir)
    references = {name: Lookup.keys(tables[name], reference.key) for name, reference in domain.references.items()}
    rows = records.read_records(spark, f"{data_dir}/{domain.events}.csv", contract.required, multi_line)
    if count is not None:
        rows = first_rows(rows, count, REPLAY_ORDER)
    checked = with_error_text(records.mark_malformed(validate(rows, contract, references)))

    counts, staged = Observation(), workspace(spark, "checked")
    observed = checked.drop(ERRORS).observe(
        counts, F.count_if(F.col(IS_VALID)).alias("sent"), F.count_if(~F.col(IS_VALID)).alias("rejected")
    )
    observed.write.partitionBy(IS_VALID).parquet(staged)
    both = spark.read.schema(observed.schema).parquet(staged)

    ordered = valid_rows(both).orderBy(*REPLAY_ORDER)
    encoded = topics.encode(ordered, contract).withColumns(
        {"partition": F.pmod(F.hash("key"), F.lit(partitions)), "offset": F.monotonically_increasing_id()}
    )
    encoded.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out_dir}/topic")
    records.write_records(project(invalid_rows(both), [*contract.required, ERROR_TEXT]), f"{out_dir}/rejected")
    return counts.get


def read_file_topic(spark: SparkSession, out_dir: str, max_files: int | None = None) -> DataFrame:
    """Read the topic a producer run left as a stream, from its beginning."""
    topic = spark.read.parquet(f"{out_dir}/topic")
    return runs.stream_files(spark, f"{out_dir}/topic", topic.schema, max_files=max_files)


def read_whole_topic(spark: SparkSession, out_dir: str) -> DataFrame:
    """Read the topic a producer run left as it stands."""
    return spark.read.parquet(f"{out_dir}/topic")


def run_consumer(
    topic: DataFrame,
    domain: Domain,
    rates: Lookup,
    out_dir: str,
    checkpoint: str,
    limit: int | None = None,
    policy: MoneyPolicy = DECIMAL,
    fresh: bool = True,
    quarantine: bool = True,
) -> dict[str, int]:
    """Consume topic records: check, enrich, land both branches, write the CSV.

    ``topic`` is a stream, or a batch read of the whole topic, which must not be empty. ``limit`` bounds the messages
    that a run takes from a batch read; the next run with the same ``checkpoint`` goes on at the next message. ``fresh``
    clears the outputs of earlier runs first and belongs with a new checkpoint; without
    it the run continues where the checkpoint stands. ``quarantine`` stores rejected messages instead of skipping them.
    """
    contract, spark = domain.contract, topic.sparkSession
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]  # the same checkpoint continues the same run
    landing = Landing(spark, f"{out_dir}/landed", domain.stored, quarantine, policy, run)
    if fresh:
        landing.reset()
        records.clear_batches(landing.accepted(), f"{out_dir}/consumed")
    else:
        landing.create()
    fixed = rates.stored(f"{checkpoint}-rates")

    def each(batch: DataFrame, batch_id: int) -> None:
        consumed = consume(batch, contract, fixed, domain.enricher, policy).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            landing.write(consumed, batch_id)
            accepted = consumed_shape(valid_rows(consumed), contract, domain.extra)
            records.write_batch(accepted, f"{out_dir}/consumed", run, batch_id)
        finally:
            consumed.unpersist()

    messages = topics.decode(topic, contract)
    if not topic.isStreaming:
        topics.require_messages(topic)
        runs.run_bounded(messages, limit, f"{checkpoint}-positions", each)
    elif limit is None:
        runs.run_batches(messages, checkpoint, each)
    else:
        raise ValueError("a stream's checkpoint passes whole batches; bound a batch read of the topic instead")
    return {"consumed": landing.accepted().count(), "skipped": landing.rejected().count()}


def landed(spark: SparkSession, domain: Domain, out_dir: str, policy: MoneyPolicy = DECIMAL) -> Landing:
    """Return what a consumer run landed; its accepted table has the derived fields."""
    return Landing(spark, f"{out_dir}/landed", domain.stored, policy=policy)


def report(spark: SparkSession, domain: Domain, out_dir: str, policy: MoneyPolicy = DECIMAL) -> dict[str, DataFrame]:
    """Answer the closing questions about a consumer run, one frame for each."""
    landing = landed(spark, domain, out_dir, policy)
    accepted, rejected = landing.accepted(), landing.rejected()
    summary = storage_summary(accepted, rejected, domain.contract)
    return {
        **summary,
        "run_stats": aggregate.run_stats(accepted),
        "running": running.running_stats(accepted),
        "series": running.totals_by_offset(accepted),
        "cumulative": aggregate.cumulative_by(accepted, domain.contract.key),
        "accepted_table": accepted_shape(accepted, domain.contract),
    }
