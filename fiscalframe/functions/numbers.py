"""Number reading and rounding on binary doubles.

Rounding looks at the exact binary value and sends ties to the even digit;
``format_number`` with a pattern does that, ``round`` and ``bround`` do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalframe.functions.text import strip

# Repeats stand on single character classes only: Java matches repeated groups
# by recursion, and texts can be long. An underscore must be followed by a digit.
_DIGITS = "[0-9][0-9_]*"
_NUMBER = rf"^(?!.*_(?![0-9]))[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?\z"


def read_double(text: Column) -> Column:
    """A decimal literal, white space around it allowed, as DOUBLE, else NULL.

    A plain ``try_cast`` would also take ``1.5d`` or ``1f``; ``1_000`` is a
    number here. ``nan`` and ``inf`` are not read as numbers.
    """

    def literal(t: Column) -> Column:
        return F.when(t.rlike(_NUMBER), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))

    # Stripping costs more than reading, and few texts need it.
    return F.coalesce(literal(text), literal(strip(text)))


def one_decimal(x: Column) -> Column:
    return F.call_function("format_number", x, F.lit("0.0")).try_cast("double")


def two_decimal_text(x: Column) -> Column:
    return F.call_function("format_number", x, F.lit("0.00"))


def two_decimals(x: Column) -> Column:
    return two_decimal_text(x).try_cast("double")
