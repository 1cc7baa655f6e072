"""Run summary and quality figures of an item table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalframe.operators.repair import SUSPICIOUS_ABOVE, is_suspicious_quantity, total_is_off
from fiscalframe.operators.states import SUMMARY, compare_states, paid, ratio, receipt_states, summary_figures
from fiscalframe.schema import COLUMNS, money

def run_summary(items: DataFrame, files: DataFrame) -> DataFrame:
    """One row: receipts, rows, rows per receipt, filled columns, success rate, cost.

    A missing filename counts as one receipt. ``files`` is the list of images
    the run was asked to process. A receipt is a success if it has no row with
    an ``error``; without that column all are. One aggregation per receipt and
    one over the receipts.
    """
    return summary_figures(receipt_states(items, tuple(SUMMARY)), files)


def receipt_names(items: DataFrame) -> DataFrame:
    return items.select("filename").distinct()


def fill_rates(items: DataFrame, by: Sequence[str] = (), columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Share of rows in which each column is filled, one row per column.

    All columns in one aggregation over the table.
    """
    rates = items.groupBy(*by).agg(*[ratio(F.count(c), F.count("*")).alias(c) for c in columns])
    return rates.unpivot(list(by), list(columns), "metric", "value")


def math_accuracy(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of items whose quantity times price gives the total."""
    exact = ~total_is_off(F.col("quantity"), F.col("unit_price"), F.col("line_total"))
    known = F.col("item_name").isNotNull()
    return items.groupBy(*by).agg(ratio(F.count_if(known & exact), F.count_if(known)).alias("math_accuracy"))


def suspicious_rate(items: DataFrame, above: float = SUSPICIOUS_ABOVE, by: Sequence[str] = ()) -> DataFrame:
    hits = F.count_if(is_suspicious_quantity(F.col("quantity"), above))
    return items.groupBy(*by).agg(ratio(hits, F.count("quantity")).alias("suspicious_rate"))


def payment_failures(items: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of receipts on which no payment method has an amount above zero."""
    receipts = items.groupBy(*by, "filename").agg(F.max(paid()).alias("_paid"))
    return receipts.groupBy(*by).agg(ratio(F.count_if(~F.col("_paid")), F.count("*")).alias("payment_failure_rate"))


def compare_extractors(tables: dict[str, DataFrame], columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Metrics of two extractors side by side: columns metric, both names, difference.

    Fill rates of the columns, mathematical accuracy, suspicious quantities,
    payment failures and items per receipt. One aggregation per receipt, with
    sums only, and one over the receipts.
    """
    (name_a, a), (name_b, b) = tables.items()
    return compare_states({name_a: receipt_states(a, columns), name_b: receipt_states(b, columns)})


def reconcile_receipts(items: DataFrame) -> DataFrame:
    """Per receipt: number of items, exact sum of totals, printed subtotal, gap."""
    per_receipt = items.groupBy("filename").agg(
        F.count("item_name").alias("n_items"),
        F.sum(F.col("line_total").try_cast("decimal(28,2)")).alias("items_total"),
        F.max(money(F.col("subtotal"))).alias("subtotal"),
    )
    return per_receipt.withColumn("gap", F.col("items_total") - F.col("subtotal"))


def items_per_receipt(items: DataFrame) -> DataFrame:
    """How many receipts have 0, 1, 2, ... items."""
    sizes = items.groupBy("filename").agg(F.count("item_name").alias("n_items"))
    return sizes.groupBy("n_items").agg(F.count("*").alias("n_receipts"))
