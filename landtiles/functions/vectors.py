"""Column expressions on arrays and text fields."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(scores: Column) -> Column:
    """Position, from 0, of the first largest element; NaN counts as largest.

    NULL for an empty or missing array.
    """
    return F.array_position(scores, F.array_max(scores)) - 1


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double, NULL where the denominator is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def three_decimals(value: Column, undefined: str = "Undefined") -> Column:
    return F.coalesce(decimals(value, 3), F.lit(undefined))


def decimals(value: Column, places: int) -> Column:
    """Text with this many decimals, NULL for NULL.

    Rounds the exact binary value and ties to even, so 0.0625 becomes 0.062. The one
    value that Java takes for a tie with zero, 0.0005 for three places, is set by hand.
    """
    half = f"5e-{places + 1}"
    rounded = float(f"1e-{places}") if Decimal(float(half)) > Decimal(half) else 0.0
    exact = F.when(value == float(half), F.lit(rounded)).otherwise(value)
    return F.call_function("format_number", exact, F.lit("0." + "0" * places))


def required(value: Column, what: str) -> Column:
    """The value itself; a missing one ends the job."""
    return F.coalesce(value, F.raise_error(F.lit(f"missing {what}")))


def two_fields(line: Column, separator: str) -> Column:
    """Array of the two fields of a line; any other number of fields ends the job."""
    stripped = F.regexp_replace(line, r"^\s+|\s+$", "")
    fields = F.split(stripped, separator)
    return F.when(F.size(fields) == 2, fields).otherwise(
        F.raise_error(F.concat(F.lit("expected two fields: "), stripped)).cast("array<string>")
    )


def hash_fraction(key: Column) -> Column:
    """Number in [0, 1) that depends on the text only, alike on every run and engine."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(
        float(2**32)
    )
