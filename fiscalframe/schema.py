"""The 30-column receipt-item layout and its typed layer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output column names, in output order.
COLUMNS = (
    "filename",
    "store_name",
    "store_address",
    "store_code",
    "taxpayer_name",
    "tax_id",
    "receipt_number",
    "cashier_name",
    "date",
    "time",
    "item_name",
    "quantity",
    "unit_price",
    "line_total",
    "subtotal",
    "vat_18_percent",
    "total_tax",
    "cashless_payment",
    "cash_payment",
    "bonus_payment",
    "advance_payment",
    "credit_payment",
    "queue_number",
    "cash_register_model",
    "cash_register_serial",
    "fiscal_id",
    "fiscal_registration",
    "refund_amount",
    "refund_date",
    "refund_time",
)

PAYMENTS = tuple(c for c in COLUMNS if c.endswith("_payment"))
NUMBERS = ("quantity", "unit_price", "line_total")
TOTALS = ("subtotal", "vat_18_percent", "total_tax")
# Money columns that stay text in the text layer.
TEXT_MONEY = (*TOTALS, *PAYMENTS, "refund_amount")

TEXT_LAYER = T.StructType(
    [T.StructField(c, T.DoubleType() if c in NUMBERS else T.StringType()) for c in COLUMNS]
)


def conform(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Exactly the 30 columns in order: missing ones null, others dropped.

    Names in ``extra`` (audit columns, say) are kept behind them.
    """
    present = set(df.columns)
    fixed = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TEXT_LAYER
    ]
    return df.select(*fixed, *extra)


def unite(*parts: DataFrame) -> DataFrame:
    """Append the results of several extractors; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def money(text: Column) -> Column:
    return text.try_cast(T.DecimalType(18, 2))


def local_timestamp(date: Column, time: Column) -> Column:
    """``DD.MM.YYYY`` and ``HH:MM[:SS]`` to TIMESTAMP_NTZ; NULL for impossible values."""

    def part(text: Column, start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    seconds = F.coalesce(F.substring(time, 7, 2).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)"))
    return F.try_make_timestamp_ntz(
        part(date, 7, 4), part(date, 4, 2), part(date, 1, 2), part(time, 1, 2), part(time, 4, 2), seconds
    )


def typed(df: DataFrame) -> DataFrame:
    """Typed layer over the text layer: exact money and timestamps beside the date strings."""
    casts = {c: money(F.col(c)) for c in TEXT_MONEY if c in df.columns}
    return df.withColumns(
        {
            **casts,
            "sold_at": local_timestamp(F.col("date"), F.col("time")),
            "refunded_at": local_timestamp(F.col("refund_date"), F.col("refund_time")),
        }
    )
