"""Quantity and total repair, money formatting and warning flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.functions.numbers import one_decimal, read_double, two_decimal_text, two_decimals
from fiscalframe.functions.text import let

# Thresholds of the repair rules and warnings.
LOST_POINT_FROM = 1000
TOTAL_TOLERANCE = 0.01
LARGEST_CORRECTION = 100
SUSPICIOUS_ABOVE = 50
HIGH_PRICE_ABOVE = 500

LOST_POINT = "ocr_quantity"
NEW_QUANTITY = "quantity"
NEW_TOTAL = "line_total"


def total_is_off(quantity: Column, unit_price: Column, line_total: Column) -> Column:
    """Binary doubles on purpose: 1.19 against 1.18 counts as off."""
    return F.abs(line_total - quantity * unit_price) > TOTAL_TOLERANCE


def is_suspicious_quantity(quantity: Column, above: float = SUSPICIOUS_ABOVE) -> Column:
    return quantity > above


def is_high_price(unit_price: Column, above: float = HIGH_PRICE_ABOVE) -> Column:
    return unit_price > above


def _without_lost_point(quantity: Column) -> Column:
    return F.when(quantity >= LOST_POINT_FROM, one_decimal(quantity / 1000)).otherwise(quantity)


def _implied_quantity(quantity: Column, unit_price: Column, line_total: Column) -> Column:
    """The quantity that total and price imply, where the total is off and it is a likely one."""
    implied = F.when(unit_price > 0, one_decimal(F.try_divide(line_total, unit_price)))
    off = total_is_off(quantity, unit_price, line_total)
    return F.when(off & (implied > 0) & (implied <= LARGEST_CORRECTION), implied)


def _repaired(given: Column, quantity: Column, implied: Column, unit_price: Column, line_total: Column) -> Column:
    fixed_quantity = implied.isNotNull()
    fixed_total = total_is_off(quantity, unit_price, line_total) & ~fixed_quantity
    new_quantity = F.coalesce(implied, quantity)
    return F.struct(
        new_quantity.alias("quantity"),
        two_decimals(unit_price).alias("unit_price"),
        two_decimals(F.when(fixed_total, quantity * unit_price).otherwise(line_total)).alias("line_total"),
        F.array_compact(
            F.array(
                F.when(given >= LOST_POINT_FROM, F.lit(LOST_POINT)),
                F.when(fixed_quantity, F.lit(NEW_QUANTITY)),
                F.when(fixed_total, F.lit(NEW_TOTAL)),
            )
        ).alias("repair"),
        is_suspicious_quantity(new_quantity).alias("suspicious_quantity"),
        is_high_price(unit_price).alias("high_price"),
    )


def repair(quantity: Column, unit_price: Column, line_total: Column) -> Column:
    """Struct of the repaired numbers, the repairs made and the warnings; for use on array elements.

    1. A quantity of 1000 or more lost its decimal point: divide by 1000.
    2. If the total is off, take the quantity that total and price imply,
       provided it lies in (0, 100]; otherwise recompute the total.
    3. Price and total are rounded to two decimals.
    """

    def decide(q: Column) -> Column:
        return F.struct(q.alias("q"), _implied_quantity(q, unit_price, line_total).alias("implied"))

    return let(
        let(_without_lost_point(quantity), decide),
        lambda s: _repaired(quantity, s["q"], s["implied"], unit_price, line_total),
    )


def repair_items(df: DataFrame) -> DataFrame:
    """Replace quantity, unit_price and line_total by their repaired values.

    Adds ``repair``, ``suspicious_quantity`` and ``high_price``. The same rules
    as ``repair``, a column for each step, so that all of it is compiled.
    """
    price, total = F.col("unit_price"), F.col("line_total")
    step = df.withColumn("_q", _without_lost_point(F.col("quantity")))
    step = step.withColumn("_implied", _implied_quantity(F.col("_q"), price, total))
    fixed = step.withColumn("_fixed", _repaired(F.col("quantity"), F.col("_q"), F.col("_implied"), price, total))
    names = ("quantity", "unit_price", "line_total", "repair", "suspicious_quantity", "high_price")
    return fixed.withColumns({n: F.col(f"_fixed.{n}") for n in names}).drop("_q", "_implied", "_fixed")


def money_text(text: Column) -> Column:
    """Two-decimal text of a money string; ``""`` and ``"null"`` stay as they are.

    Anything else that is not a number becomes ``0.00``.
    """
    formatted = F.coalesce(two_decimal_text(read_double(text)), F.lit("0.00"))
    return F.when(text.isNull() | text.isin("", "null"), text).otherwise(formatted)
