"""Number parsing and division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import _col

# What the casts accept at most. Text outside these shapes never reaches a cast: a cast that fails
# raises and catches an exception inside, at a hundred times the cost of this test.
_BLANKS = r"[\x00-\x20]*"
_WHOLE = f"^{_BLANKS}[+-]?[0-9]+{_BLANKS}$"
_FRACTION = f"^{_BLANKS}[+-]?(?:[0-9.][0-9.eE+-]*[dDfF]?|(?i:nan|inf|infinity)){_BLANKS}$"
_SHAPES = {
    "tinyint": _WHOLE, "smallint": _WHOLE, "int": _WHOLE, "bigint": _WHOLE,
    "float": _FRACTION, "double": _FRACTION, "decimal": _FRACTION,
}

# What operands of an exact division are read as: 20 digits before the point, 18 behind.
EXACT = "decimal(38,18)"

# Fixed value: marks text that was present but not a number.
NOT_A_NUMBER_MARK = -1.0


def read_as(c, to: str) -> Column:
    """Text to a type, null when it does not fit; cheap for text that does not."""
    c = _col(c)
    shape = _SHAPES.get(to.lower().split("(")[0].strip())
    return F.when(c.cast("string").rlike(shape), c.try_cast(to)) if shape else c.try_cast(to)


def decimal_cleanup(c) -> Column:
    """Double from text; words or inner spaces give -1.0, other junk null, ''/null null."""
    c = F.nullif(_col(c), F.lit(""))
    words = F.contains(F.trim(c), F.lit(" ")) | c.rlike("^[a-zA-Z]+$")
    return F.when(words, F.lit(NOT_A_NUMBER_MARK)).otherwise(read_as(c, "double"))


def divide(a, b, to: str = "double") -> Column:
    """Quotient of two numbers or number texts; null when the divisor is zero or unreadable.

    A decimal quotient is made of decimals, so no digit goes by way of a double.
    """
    kind = EXACT if to.lower().startswith("decimal") else "double"
    return F.try_divide(read_as(a, kind), read_as(b, kind)).cast(to)


def empty_to_double(c) -> Column:
    return read_as(F.nullif(_col(c), F.lit("")), "double")


def lit_typed(value, to: str) -> Column:
    return F.lit(value).cast(to)
