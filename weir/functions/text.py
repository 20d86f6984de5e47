"""Text expressions. Missing means NULL or blank throughout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the texts that count as a true flag when an order is priced.
TRUE_TEXTS = ["true", "1", "yes", "y", "t"]

# Fixed value: the accepted shape of a timestamp text.
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?\z"

_BLANKS = " \t\n\r\f\x0b"


def stripped(column: Column) -> Column:
    """Strip surrounding white space, not only the plain spaces SQL ``trim`` removes."""
    return F.trim(column, F.lit(_BLANKS))


def or_empty(column: Column) -> Column:
    """Return the column as text, with the empty string for NULL."""
    return F.coalesce(column.cast("string"), F.lit(""))


def is_missing(column: Column) -> Column:
    """True for NULL and for blank text; never NULL.

    Text below ``!`` is empty or begins with a blank, so other text is told apart by one
    comparison, evaluates the column once and is never stripped.
    """
    return (F.coalesce(column, F.lit("")) < "!") & (column.isNull() | (stripped(column) == ""))


def any_missing(columns: Sequence[Column]) -> Column:
    """True when at least one of the columns is missing.

    The smallest text decides whether any can be; only then is each looked at. This keeps the
    generated code of wide contracts small enough to be compiled.
    """
    if len(columns) < 2:
        return is_missing(columns[0]) if columns else F.lit(False)
    texts = [F.coalesce(column, F.lit("")) for column in columns]
    return (F.least(*texts) < "!") & F.exists(F.array(*texts), lambda value: stripped(value) == "")


def quoted(column: Column) -> Column:
    """Return the value as it appears in a message: quoted the way Python shows a string."""
    value = or_empty(column)
    single, double = value.contains("'"), value.contains('"')
    mark = F.when(single & ~double, '"').otherwise("'")
    body = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    body = F.replace(body, F.lit("'"), F.when(single & double, "\\'").otherwise("'"))
    return F.concat(mark, body, mark)


def complaint(label: str, column: Column) -> Column:
    """Return ``label: 'value'``."""
    return F.concat(F.lit(f"{label}: "), quoted(column))


def is_true_text(column: Column) -> Column:
    """Parse a flag text leniently; anything unknown or missing is false."""
    return F.lower(stripped(or_empty(column))).isin(TRUE_TEXTS)


def is_boolean_text(column: Column) -> Column:
    """True when the text is exactly a boolean, in any case."""
    return F.lower(stripped(or_empty(column))).isin("true", "false")


def is_whole_number(column: Column) -> Column:
    """True when the text is a whole number of any size."""
    return stripped(or_empty(column)).rlike(r"^[+-]?\d+$")


def is_positive_whole_number(column: Column) -> Column:
    """True when the text is a whole number of at least 1, of any size."""
    return stripped(or_empty(column)).rlike(r"^[+]?0*[1-9]\d*$")


def is_countable(column: Column) -> Column:
    """True when the text is a positive whole number that every step of a run can hold: up to 32 bits."""
    return F.coalesce(stripped(or_empty(column)).try_cast("int") >= 1, F.lit(False)) & is_positive_whole_number(column)


def is_iso_datetime(column: Column) -> Column:
    """True when the text has the accepted shape and names a real moment."""
    return F.coalesce(column.rlike(ISO_DATETIME) & F.try_to_timestamp(column).isNotNull(), F.lit(False))


def loyalty_label(column: Column) -> Column:
    """Name a loyalty group by its raw flag text."""
    return F.when(F.lower(or_empty(column)) == "true", "loyalty").otherwise("non-loyalty")
