"""Running values of very many keys: state in a store that a batch touches only where it has rows.

``runs.run_running`` writes the totals of all keys again with each batch, which suits keys that are few, such as the partitions of a
topic. Here the totals of a key are a value in a RocksDB state store with checkpoints of what changed, so a batch
that has rows of ten keys reads and writes ten values however many keys there are.

A key's rows of one batch are held by one task as two columns of whole numbers, 16 bytes a row; how many there can be
is bounded by what the source admits to a batch. This is the only operator beside ``weir.llm`` that runs Python on executors:
Spark has no other interface to keyed state of one's own.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DecimalType, LongType, StructField, StructType

from weir.operators.contract import require_fields
from weir.operators.running import OFFSET
from weir.streaming.events import Ran, ran

# The class travels to the executors by value, so no file has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The names that a batch has on the executors; there none may start with an underscore.
PLACE, CENTS = "place", "cents"
VALUES = ("running_count", "running_total", "running_min", "running_max")


class Totals(StatefulProcessor):
    """Count, sum, least and greatest amount of a key so far, and the last offset that they hold."""

    def __init__(self, keys: list[str]) -> None:
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("totals", "n long, total long, low long, high long, last long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(part[PLACE].to_numpy(np.int64), part[CENTS].to_numpy(np.int64)) for part in rows]
        offsets, cents = (np.concatenate(side) for side in zip(*parts, strict=True))
        order = offsets.argsort(kind="stable")
        offsets, cents = offsets[order], cents[order]
        n, total, low, high, last = self.state.get() if self.state.exists() else (0, 0, cents[0], cents[0], offsets[0] - 1)
        if offsets[0] <= last:
            raise ValueError(f"offset {offsets[0]} came after {last} for {key}")
        count, sums = n + np.arange(1, len(cents) + 1), total + cents.cumsum()
        lows, highs = np.minimum.accumulate(np.minimum(cents, low)), np.maximum.accumulate(np.maximum(cents, high))
        self.state.update(tuple(int(x[-1]) for x in (count, sums, lows, highs, offsets)))
        columns = dict(zip((PLACE, CENTS, *VALUES), (offsets, cents, count, sums, lows, highs), strict=True))
        yield pd.DataFrame({name: [value] * len(cents) for name, value in zip(self.keys, key, strict=True)} | columns)

    def close(self) -> None:
        pass


def running_by_key(stream: DataFrame, keys: list[str], amount: str = "total") -> DataFrame:
    """Each row's key, offset and amount with the key's running values in the order of the offsets.

    The amount is money with two decimals; a row without one, or without an offset, stops the run, and so does one whose
    offset is not after those of its key that are done. A missing key is a key like any other.
    """
    require_fields(stream, [*keys, OFFSET, amount])
    kind = stream.schema[amount].dataType
    if not isinstance(kind, DecimalType) or kind.scale != 2:
        raise TypeError(f"{amount} is {kind.simpleString()}; exact running values need a decimal with two digits")
    cents = F.coalesce((F.col(amount) * 100).cast("long"), F.raise_error(F.lit("a message without an amount")).cast("long"))
    place = F.coalesce(F.col(OFFSET).cast("long"), F.raise_error(F.lit("a message without an offset")).cast("long"))
    names = [f"key_{i}" for i in range(len(keys))]
    rows = stream.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), place.alias(PLACE), cents.alias(CENTS))
    long = LongType()
    schema = StructType([*(rows.schema[n] for n in names), *(StructField(n, long) for n in (PLACE, CENTS, *VALUES))])
    found = rows.groupBy(*names).transformWithStateInPandas(Totals(names), schema, "Append", "None")
    found = found.withColumnsRenamed({**dict(zip(names, keys)), PLACE: OFFSET})
    money = {name: (F.col(name) / 100).cast(kind) for name in VALUES[1:]}
    return found.withColumns({amount: (F.col(CENTS) / 100).cast(kind), **money}).drop(CENTS)


def run_by_key(stream: DataFrame, keys: list[str], path: str, checkpoint: str, amount: str = "total") -> Ran:
    """Append every row with its key's running values, which go on where the checkpoint's state ends."""
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        query = (
            running_by_key(stream, keys, amount)
            .writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        return ran(query)
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
