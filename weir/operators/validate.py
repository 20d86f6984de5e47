"""Apply a contract to messages, batch or streaming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.rules import KNOWN_FLAG, Rule, required
from weir.functions.text import any_missing, is_missing
from weir.operators.contract import ERROR_TEXT, Contract, require_fields
from weir.operators.lookup import Lookup, flag_known

ERRORS = "errors"
IS_VALID = "is_valid"


class DirtyReference(ValueError):
    """A reference table has rows that break its own contract."""


def passes(conditions: Sequence[Column]) -> Column:
    """True when none of the failure conditions holds; stops at the first that does.

    The cases make one predicate that is not split up. Split into its parts, a filter on it would
    have the optimizer rewrite every part for every projection below, which takes seconds.
    """
    verdict = F.when(conditions[0], False)
    for condition in conditions[1:]:
        verdict = verdict.when(condition, False)
    return verdict.otherwise(True)


def messages_of(rules: Sequence[Rule], failed: Sequence[Column]) -> Column:
    """Return the messages of the failed rules, in rule order."""
    outcomes = [F.when(condition, rule.message()) for rule, condition in zip(rules, failed)]
    return F.array_compact(F.array(*outcomes).cast("array<string>"))


def check(df: DataFrame, required_fields: Sequence[str], rules: Sequence[Rule] = ()) -> DataFrame:
    """Add ``errors`` and ``is_valid``.

    A row that lacks required fields reports only those; the other rules assume they are there.
    Each condition is a column of its own that both results read, so it is evaluated once.
    ``is_valid`` does not need ``errors``: plans that only filter never build messages.
    """
    require_fields(df, [*required_fields, *(f for rule in rules for f in rule.fields)])
    conditions = {f"_fails_{i}": rule.fails() for i, rule in enumerate(rules)}
    incomplete = any_missing([F.col(name) for name in required_fields])
    decided = df.withColumns({"_incomplete": incomplete, **conditions})
    failed = [F.col(name) for name in conditions]

    must_have = [required(name) for name in required_fields]
    missing = messages_of(must_have, [rule.fails() for rule in must_have])
    errors = F.when(F.col("_incomplete"), missing).otherwise(messages_of(rules, failed))
    results = {ERRORS: errors, IS_VALID: passes([F.col("_incomplete"), *failed])}
    return decided.withColumns(results).drop("_incomplete", *conditions)


def validate(df: DataFrame, contract: Contract, references: Mapping[str, Lookup]) -> DataFrame:
    """Apply the whole contract. ``references`` maps reference table names to their keys."""
    flagged = require_fields(df, contract.required, contract.name)
    for field, table in contract.references.items():
        flagged = flag_known(flagged, references[table], field)
    checked = check(flagged, contract.required, contract.rules)
    return checked.drop(*(KNOWN_FLAG + field for field in contract.references))


def validate_required(df: DataFrame, contract: Contract) -> DataFrame:
    """Apply the check a consumer repeats: the required fields only."""
    return check(df, contract.required)


def valid_rows(df: DataFrame) -> DataFrame:
    """Keep the rows that passed."""
    return df.where(F.col(IS_VALID))


def invalid_rows(df: DataFrame) -> DataFrame:
    """Keep the rows that failed."""
    return df.where(~F.col(IS_VALID))


def error_text(errors: Column) -> Column:
    """Join the messages of a row into one text."""
    return F.concat_ws("; ", errors)


def with_error_text(df: DataFrame) -> DataFrame:
    """Add the messages as the text column of the rejected outputs."""
    return df.withColumn(ERROR_TEXT, error_text(F.col(ERRORS)))


def reference_errors(table: DataFrame, key: str, required_fields: Sequence[str], label: str) -> DataFrame:
    """Return one row per missing required field of a reference table row."""
    require_fields(table, required_fields, label)
    missing = [
        F.when(is_missing(F.col(name)), F.lit(f"{label}: missing required field {name}")) for name in required_fields
    ]
    return table.select(
        F.col(key).cast("string").alias("record_key"), F.explode(F.array_compact(F.array(*missing))).alias("error")
    )


def require_clean(errors: DataFrame, shown: int = 20) -> None:
    """Stop the run when reference tables have errors; says how many there are and shows up to ``shown``."""
    found = [f"{row['error']} ({row['record_key']})" for row in errors.limit(shown).collect()]
    if found:
        raise DirtyReference(f"{errors.count()} errors: " + "; ".join(found))


def fields_of(rules: Iterable[Rule]) -> tuple[str, ...]:
    """Return the fields that rules read, each once, in order."""
    return tuple(dict.fromkeys(name for rule in rules for name in rule.fields))
