"""Money arithmetic under two rounding policies.

``DECIMAL`` (the default) computes in exact decimals and rounds half up. ``PYTHON_FLOAT`` computes
in binary doubles and reproduces Python's ``round(x, 2)`` bit for bit. Both are plain Column
expressions, so they stay inside generated code.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType

from weir.functions.text import is_missing

# Fixed value: the tax fraction of a key the lookup does not know.
DEFAULT_TAX_RATE = "0.08"

# Wide enough that an INT quantity times any DECIMAL(18,6) price, taxed at below 1000 percent,
# cannot overflow, and that MONEY times RATE still fits 38 digits without losing scale.
PRICE_TYPE = "decimal(18,6)"
PERCENT_TYPE = "decimal(7,4)"
RATE_TYPE = "decimal(10,6)"
MONEY_TYPE = DecimalType(26, 2)

# From this size on doubles lie more than a cent apart, so a double is its own nearest rounded value.
_CENTS_LIMIT = float(1 << 46)
_SPLIT = float((1 << 27) + 1)


def python_round2(x: Column) -> Column:
    """Round a double to 2 places exactly as Python does: half to even on the binary value.

    ``x * 100`` is computed together with its rounding error (Dekker's exact product), so the
    comparison of the fraction with one half is exact and not fooled by values such as 2.675.
    """
    size = F.abs(x)
    scaled = size * 100.0
    carried = size * _SPLIT
    high = carried - (carried - size)
    error = (high * 100.0 - scaled) + (size - high) * 100.0
    whole = F.floor(scaled).cast("double")
    over_half = ((scaled - whole) - 0.5) + error
    up = (over_half > 0) | ((over_half == 0) & (whole % 2 == 1))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / 100.0
    return F.when(size < _CENTS_LIMIT, F.when(x < 0, -rounded).otherwise(rounded)).otherwise(x)


@dataclass(frozen=True)
class MoneyPolicy:
    """How money is parsed, multiplied and rounded."""

    name: str
    exact: bool

    def price(self, text: Column) -> Column:
        """Parse a price text; 0 when missing, NULL when it is no number. Casts ignore outer blanks.

        Exact prices have up to 12 digits before the point and 6 after it. One that needs more is NULL, so its row
        is quarantined instead of being priced with other digits.
        """
        parsed = _number(text, self._price_type)
        if not self.exact:
            return parsed
        return F.when(~F.coalesce(text.try_cast("decimal(38,18)") != parsed, F.lit(False)), parsed)

    def rate(self, percent: Column) -> Column:
        """Turn a looked-up percentage into a fraction, with the default for a miss."""
        if self.exact:
            fraction = percent.cast(PERCENT_TYPE) * F.lit(Decimal("0.01"))
            return F.coalesce(fraction.cast(RATE_TYPE), F.lit(Decimal(DEFAULT_TAX_RATE)).cast(RATE_TYPE))
        return F.coalesce(percent.cast("double") / 100.0, F.lit(float(DEFAULT_TAX_RATE)))

    def constant(self, value: str) -> Column:
        """Return a literal in the policy's number type."""
        return F.lit(Decimal(value)) if self.exact else F.lit(float(value))

    def round2(self, amount: Column) -> Column:
        """Round to cents."""
        return F.round(amount, 2).cast(MONEY_TYPE) if self.exact else python_round2(amount)

    def with_rounded(self, df: DataFrame, name: str, amount: Column) -> DataFrame:
        """Add a rounded column; the unrounded one is a column of its own first.

        The double policy names its argument many times, and a separate projection keeps
        nested amounts from being written out again at each mention.
        """
        if self.exact:
            return df.withColumn(name, self.round2(amount))
        return df.withColumn("_unrounded", amount).withColumn(name, self.round2(F.col("_unrounded"))).drop("_unrounded")

    @property
    def money_type(self) -> DataType:
        """The type of rounded amounts."""
        return MONEY_TYPE if self.exact else DoubleType()

    @property
    def _price_type(self) -> str:
        return PRICE_TYPE if self.exact else "double"


DECIMAL = MoneyPolicy("decimal", exact=True)
PYTHON_FLOAT = MoneyPolicy("python_float", exact=False)


def quantity(text: Column) -> Column:
    """Parse a quantity text; 0 when missing, NULL when it is no 32-bit whole number."""
    return _number(text, "int")


def _number(text: Column, kind: str) -> Column:
    # Text that parses is not looked at again: whether it is missing matters only when it does not.
    return F.coalesce(text.try_cast(kind), F.when(is_missing(text), F.lit("0").cast(kind)))


def money_text(amount: Column) -> Column:
    """Show an amount as ``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))
