"""Two branches, one pass: accepted and rejected messages land together, batch by batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from weir.functions.money import DECIMAL, MoneyPolicy
from weir.operators.contract import Contract
from weir.operators.project import accepted_shape, rejected_shape
from weir.operators.validate import IS_VALID, invalid_rows, valid_rows, with_error_text

ROUTE, BATCH, RUN = "route", "batch_id", "run"
ACCEPTED, REJECTED = "accepted", "rejected"
SUMMARY = StructType(
    [
        StructField(ACCEPTED, LongType()),
        StructField(REJECTED, LongType()),
        StructField("revenue", DECIMAL.money_type),
        StructField("first_offset", LongType()),
        StructField("last_offset", LongType()),
    ]
)


def split(checked: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Return the accepted and rejected branches in the shapes of their tables."""
    rejected = with_error_text(invalid_rows(checked))
    return accepted_shape(valid_rows(checked), contract), rejected_shape(rejected, contract)


def branch_counts(checked: DataFrame) -> DataFrame:
    """Return how many messages each branch gets, in one pass over them."""
    route = F.when(F.col(IS_VALID), ACCEPTED).otherwise(REJECTED).alias(ROUTE)
    return checked.groupBy(route).agg(F.count("*").alias("message_count"))


@dataclass(frozen=True)
class Landing:
    """A folder of landed messages: ``run=R/batch_id=N/route=accepted|rejected``.

    A batch is checked and written once, with both branches going to their own folder in the
    same job. Writing batch N of a run again replaces that batch and nothing else, so a batch that is
    retried after a failure lands once. Each ``Landing`` is a run of its own unless ``run`` says which one it
    continues, so the batches of one run never replace those of another.
    """

    spark: SparkSession
    path: str
    contract: Contract
    quarantine: bool = True
    policy: MoneyPolicy = DECIMAL
    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    #: Columns that batches carry beside those of the contract's tables. Batches that were landed without them stay as they
    #: are: a read fills the columns with NULL there.
    extra: tuple[str, ...] = ()
    #: Keep a row for each batch of what was observed while it was written; a batch that is written again replaces its row.
    summarize: bool = False

    def write(self, checked: DataFrame, batch_id: int) -> dict[str, int]:
        """Land one batch and return the numbers of accepted and rejected messages."""
        counts = Observation()
        measures = [F.count_if(F.col(IS_VALID)).alias(ACCEPTED), F.count_if(~F.col(IS_VALID)).alias(REJECTED)]
        if self.summarize:
            measures += self._measures()
        observed = with_error_text(checked).observe(counts, *measures)
        kept = observed if self.quarantine else valid_rows(observed)
        route = F.when(F.col(IS_VALID), ACCEPTED).otherwise(REJECTED).alias(ROUTE)
        shaped = kept.select(*(self._stored(kept, field) for field in self._fields()), route)
        writer = shaped.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(ROUTE).parquet(f"{self.path}/{RUN}={self.run}/{BATCH}={batch_id}")
        found = counts.get
        if self.summarize:
            row = self.spark.createDataFrame([tuple(found[name] for name in SUMMARY.names)], SUMMARY).coalesce(1)
            row.write.mode("overwrite").parquet(f"{self._summaries}/{RUN}={self.run}/{BATCH}={batch_id}")
        return {name: found[name] for name in (ACCEPTED, REJECTED)}

    def summary(self) -> DataFrame:
        """Read one row for each run that was summarized: what its batches observed, each batch once."""
        kept = StructType([*SUMMARY.fields, StructField(RUN, StringType()), StructField(BATCH, LongType())])
        batches = self.spark.read.schema(kept).option("basePath", self._summaries).parquet(self._summaries)
        return batches.groupBy(RUN).agg(
            F.count("*").alias("batch_count"),
            F.sum(ACCEPTED).alias("accepted_count"),
            F.sum(REJECTED).alias("rejected_count"),
            F.sum("revenue").cast(DECIMAL.money_type).alias("revenue"),
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
        )

    @property
    def _summaries(self) -> str:
        return f"{self.path.rstrip('/')}-summary"

    def _measures(self) -> list[Column]:
        """What a summary holds beside the counts, observed in the pass that writes the batch."""
        accepted = F.col(IS_VALID)
        offset = F.when(accepted, F.col("_kafka_offset").cast("long"))
        return [
            F.sum(F.when(accepted, F.col("total").cast(DECIMAL.money_type))).cast(DECIMAL.money_type).alias("revenue"),
            F.min(offset).alias("first_offset"),
            F.max(offset).alias("last_offset"),
        ]

    def accepted(self) -> DataFrame:
        """Read the accepted table."""
        return accepted_shape(self._read(ACCEPTED), self.contract)

    def enriched(self, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Read the accepted table with its extra columns.

        What a batch did not land is derived as it is read; amounts that were landed are kept as they were.
        """
        stored = {name: f"_landed_{name}" for name in self.extra}
        landed = self._read(ACCEPTED).withColumnsRenamed(stored)
        derived = derive(landed)
        filled = {name: F.coalesce(F.col(was), F.col(name)) for name, was in stored.items()}
        names = list(dict.fromkeys((*self.contract.accepted_fields, *self.extra)))
        return derived.withColumns(filled).select(*names)

    def rejected(self) -> DataFrame:
        """Read the rejected table."""
        return rejected_shape(self._read(REJECTED), self.contract)

    def create(self) -> None:
        """Make both tables readable, leaving rows that are already there."""
        self._write_nothing("append")

    def reset(self) -> None:
        """Start a run with empty tables."""
        self._write_nothing("overwrite")

    def _fields(self) -> list[StructField]:
        """The columns of both tables, each once."""
        kinds = {field.name: field.dataType for field in self.contract.envelope_schema.fields}
        kinds |= {name: self.policy.money_type for name in self.contract.derived}
        names = dict.fromkeys((*self.contract.accepted_fields, *self.contract.rejected_fields, *self.extra))
        return [StructField(name, kinds.get(name, StringType())) for name in names]

    def _schema(self) -> StructType:
        places = [StructField(RUN, StringType()), StructField(BATCH, LongType()), StructField(ROUTE, StringType())]
        return StructType([*self._fields(), *places])

    def _read(self, route: str) -> DataFrame:
        landed = self.spark.read.schema(self._schema()).option("basePath", self.path).parquet(self.path)
        return landed.where(F.col(ROUTE) == route)

    def _write_nothing(self, mode: str) -> None:
        nothing = self.spark.createDataFrame([], self._schema())
        writer = nothing.write.mode(mode).option("partitionOverwriteMode", "static")
        writer.partitionBy(RUN, BATCH, ROUTE).parquet(self.path)

    @staticmethod
    def _stored(df: DataFrame, field: StructField) -> Column:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        typed = value.cast(field.dataType)
        return (F.coalesce(typed, F.lit("")) if isinstance(field.dataType, StringType) else typed).alias(field.name)
