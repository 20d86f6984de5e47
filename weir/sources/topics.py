"""Keyed JSON messages and the topics that carry them.

The column logic (``encode``, ``decode``) is separate from the connector, so that files carrying
the same columns can stand in for a topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from weir.functions.text import or_empty
from weir.operators.contract import Contract, require_fields
from weir.operators.running import OFFSET, PARTITION, Measure, running

UNDECODED = "undecoded_value"
BROKER_PARTITION, BROKER_OFFSET = "broker_partition", "broker_offset"
_BROKEN = "_broken"


class EmptyTopic(ValueError):
    """There is nothing to consume."""


def encode(df: DataFrame, contract: Contract) -> DataFrame:
    """Return the messages to publish: the key and all message fields as JSON, both as text.

    Messages that were placed also carry their partition, under the name that the connector obeys.
    """
    require_fields(df, [contract.key], contract.name)
    present = [name for name in contract.fields if name in df.columns]
    value = F.to_json(F.struct(*(or_empty(F.col(name)).alias(name) for name in present)))
    placed = [F.col(BROKER_PARTITION).alias("partition")] if BROKER_PARTITION in df.columns else []
    return df.select(or_empty(F.col(contract.key)).alias("key"), value.alias("value"), *placed)


def broker_partition(key: Column, partitions: int, without_key: Column) -> Column:
    """The partition in which a client of the broker puts a key: the CRC-32 of its bytes, modulo the partitions.

    A client deals messages without a key at random; here the CRC-32 of ``without_key`` decides, so that a retry agrees.
    """
    text = or_empty(key)
    return F.pmod(F.crc32(F.when(text == "", without_key.cast("string")).otherwise(text)), F.lit(partitions)).cast("int")


def place(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Add the broker's partition of each message and its offset there, in the order (partition, offset) of the source.

    Offsets are gapless from 0, so each key's messages keep their order in the one partition that the key has. They
    come from two-level running counts and the rows are laid out by ranges of their place: a partition that holds most
    of the messages spans several tasks. A frame that is empty stays so; source places must be unique.
    """
    require_fields(df, [key, PARTITION, OFFSET])
    source = F.concat_ws(":", F.col(PARTITION).cast("string"), F.col(OFFSET).cast("string"))
    dealt = df.withColumn(BROKER_PARTITION, broker_partition(F.col(key), partitions, source))
    counted = running(dealt, {BROKER_OFFSET: Measure("count", F.lit(True))}, [BROKER_PARTITION])
    placed = counted.withColumn(BROKER_OFFSET, F.col(BROKER_OFFSET) - 1)
    ends = [BROKER_PARTITION, BROKER_OFFSET]
    return placed.repartitionByRange(*ends).sortWithinPartitions(*ends)


def decode(records: DataFrame, contract: Contract) -> DataFrame:
    """Return message fields and envelope of consumed records.

    A value that is no JSON object does not fail the run. Its fields are NULL, which the
    required check rejects, and the raw text is kept in ``undecoded_value``.
    """
    text = F.col("value").cast("string")
    schema = StructType([*contract.schema.fields, StructField(_BROKEN, StringType())])
    payload = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    # As the output of a generator the fields are columns of their own: a later filter on them
    # stays above the parse instead of repeating it for every field it names.
    parsed = records.select("key", "value", "partition", "offset", F.inline(F.array(payload)))
    broken = F.col(_BROKEN).isNotNull() | text.isNull() | (F.trim(text) == "")
    return parsed.select(
        *(F.when(~broken, F.col(name)).alias(name) for name in contract.fields),
        F.col("key").cast("string").alias("_kafka_key"),
        F.col("partition").cast("int").alias(PARTITION),
        F.col("offset").cast("long").alias(OFFSET),
        F.when(broken, or_empty(text)).alias(UNDECODED),
    )


def read_topic(
    spark: SparkSession, servers: str, topic: str, stream: bool = True, max_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Read a topic from its first offset on, whatever was consumed before.

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest").options(**options)
    if stream and max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def write_topic(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish encoded messages; the connector places each key in one partition."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).options(**options).save()


def stream_to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Return the writer that publishes a stream of encoded messages."""
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint)


def offsets_by_partition(messages: DataFrame) -> DataFrame:
    """Return the message count and the first and last offset of each partition."""
    return messages.groupBy(PARTITION).agg(
        F.count("*").alias("message_count"), F.min(OFFSET).alias("first_offset"), F.max(OFFSET).alias("last_offset")
    )


def require_messages(messages: DataFrame, label: str = "topic") -> DataFrame:
    """Return ``messages`` unchanged, or stop the run when there are none. Reads one row."""
    if messages.isEmpty():
        raise EmptyTopic(f"{label} is empty; run the producer first")
    return messages
