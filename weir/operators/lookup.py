"""Reference tables, and the joins that probe them.

A reference table is broadcast only after its rows and bytes were counted and found small. A
larger one is joined by shuffle, with the probing side salted so that a key holding a large
share of all rows is worked on by several tasks; adaptive execution splits further at run time.
Such a join is asked for by name: the planner's estimate knows nothing of the salts' copies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.rules import KNOWN_FLAG
from weir.functions.text import is_missing
from weir.operators.contract import ENVELOPE, require_fields

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
SALTED_ROWS = 8_000_000
MAX_SALTS = 256

_KEY, _ROW = "_lookup_key", "_lookup_row"
LOOKUP_VALUE = "_lookup_value"


@dataclass(frozen=True)
class Lookup:
    """A reference table reduced to one row per key: ``_lookup_key`` and ``_lookup_value``.

    ``source`` holds the same columns before the reduction; its size bounds the lookup's.
    """

    frame: DataFrame
    source: DataFrame
    max_rows: int = MAX_BROADCAST_ROWS
    max_bytes: int = MAX_BROADCAST_BYTES

    @classmethod
    def keys(cls, table: DataFrame, key: str, **limits: int) -> Lookup:
        """Return the set of keys of a reference table, each with the value true."""
        keys = key_set(table, key).select(F.col(key).alias(_KEY), F.lit(True).alias(LOOKUP_VALUE))
        return cls(keys, table.select(key), **limits)

    @classmethod
    def values(cls, table: DataFrame, key: str, value: str, order: str | None = None, **limits: int) -> Lookup:
        """Return the key to value map of a reference table; see ``key_values`` for keys that repeat."""
        pairs = key_values(table, key, value, order).select(F.col(key).alias(_KEY), F.col(value).alias(LOOKUP_VALUE))
        return cls(pairs, table.select(key, value), **limits)

    @classmethod
    def rows(cls, table: DataFrame, key: str, columns: Sequence[str], order: str | None = None, **limits: int) -> Lookup:
        """Return the key to row map of a reference table: several values of a key, from one probe."""
        require_fields(table, [key, *columns], "reference table")
        whole = F.struct(*columns).alias(_ROW)
        return cls.values(table.select(key, whole, *([order] if order else [])), key, _ROW, order, **limits)

    def stored(self, path: str) -> Lookup:
        """Write the reduced table once and read it from there.

        A stream joins one fixed copy: every micro-batch and every retry sees the same entries.
        """
        self.frame.write.mode("overwrite").parquet(path)
        fixed = self.frame.sparkSession.read.parquet(path)
        return Lookup(fixed, fixed, self.max_rows, self.max_bytes)

    @property
    def is_small(self) -> bool:
        """Whether the table may be broadcast."""
        rows, size = self.measured
        return rows <= self.max_rows and size <= self.max_bytes

    @property
    def salts(self) -> int:
        """Shares of each key in a join by shuffle.

        The table is written out once for each share, so a large one has few; adaptive execution splits a skewed
        partition of the probing side further.
        """
        return max(1, min(MAX_SALTS, SALTED_ROWS // max(1, self.measured[0])))

    @cached_property
    def measured(self) -> tuple[int, int]:
        """Rows and bytes, measured once in one parallel pass that brings back two numbers."""
        widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in self.source.columns]
        size = self.source.agg(F.count("*").alias("n"), F.sum(sum(widths, F.lit(16))).alias("b")).first()
        return size["n"], size["b"] or 0


def key_set(table: DataFrame, key: str) -> DataFrame:
    """Return the distinct, non-missing keys of a reference table."""
    require_fields(table, [key], "reference table")
    return table.select(F.col(key).cast("string").alias(key)).where(~is_missing(F.col(key))).distinct()


def key_values(table: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """Return one value per key.

    ``order`` names the column that tells which of several rows of a key is the last, such as a version or
    the place of a record in its files (``records.PLACE``); that one wins. Without it rows of a key that
    differ stop the job: which of them a parallel read sees last says nothing.
    """
    require_fields(table, [key, value, *([order] if order else [])], "reference table")
    keyed = table.withColumn(key, F.col(key).cast("string"))
    if order:
        return keyed.groupBy(key).agg(F.max_by(value, order).alias(value))
    lows, highs = F.min(F.struct(value)), F.max(F.struct(value))
    unclear = F.raise_error(F.concat(F.lit(f"several values of {value} for {key} "), F.coalesce(F.first(key), F.lit("NULL"))))
    return keyed.groupBy(key).agg(F.when(lows == highs, F.max(value)).otherwise(unclear).alias(value))


def duplicate_report(table: DataFrame, key: str, value: str) -> DataFrame:
    """Return the keys that have several values, with their number."""
    counted = table.groupBy(F.col(key).cast("string").alias(key)).agg(F.count_distinct(F.struct(value)).alias("value_count"))
    return counted.where(F.col("value_count") > 1)


def probe(
    df: DataFrame,
    lookup: Lookup,
    on: str,
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Join ``df`` to a lookup on the column ``on``, keeping every row of ``df`` once at most.

    ``spread_by`` names columns that differ between the rows of one key: by default the offset of
    a message, which no other has, or else all columns. They decide which of the ``salts`` shares of
    a key a row belongs to. The share follows from the row alone, so a task that is run again
    places its rows as before.
    """
    require_fields(df, [on])
    if lookup.is_small:
        side = F.broadcast(lookup.frame)
        return df.join(side, df[on] == side[_KEY], how).drop(_KEY)
    salts = salts or lookup.salts
    offset = [c for c in ENVELOPE[1:] if c in df.columns]
    spread = F.xxhash64(*(F.col(c) for c in (spread_by or offset or df.columns)))
    salted = df.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    shares = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    side = lookup.frame.withColumn("_share", shares).hint("merge")
    matched = (salted[on] == side[_KEY]) & (salted["_salt"] == side["_share"])
    return salted.join(side, matched, how).drop(_KEY, "_share", "_salt")


def with_columns_of(df: DataFrame, lookup: Lookup, on: str, names: Mapping[str, str]) -> DataFrame:
    """Add columns of the key's row (see ``Lookup.rows``) under new names, NULL where the key is unknown."""
    found = probe(df, lookup, on)
    return found.withColumns({out: F.col(LOOKUP_VALUE)[name] for name, out in names.items()}).drop(LOOKUP_VALUE)


def flag_known(df: DataFrame, lookup: Lookup, on: str) -> DataFrame:
    """Add the flag that the rule ``known(on)`` reads: true for a known key, NULL otherwise."""
    return probe(df, lookup, on).withColumnRenamed(LOOKUP_VALUE, KNOWN_FLAG + on)


def known_rows(df: DataFrame, lookup: Lookup, on: str) -> DataFrame:
    """Keep the rows whose key the reference table has."""
    return probe(df, lookup, on, "left_semi")


def unknown_rows(df: DataFrame, lookup: Lookup, on: str) -> DataFrame:
    """Keep the rows whose key the reference table lacks, rows without a key included."""
    return probe(df, lookup, on, "left_anti")


def miss_report(df: DataFrame, lookup: Lookup, on: str) -> DataFrame:
    """Count, by key, the rows that fall back to the default for want of a lookup entry.

    Rows are counted by key before the lookup is probed, so the join sees each key once.
    """
    counted = df.groupBy(F.col(on)).agg(F.count("*").alias("miss_count"))
    return probe(counted, lookup, on, "left_anti")
