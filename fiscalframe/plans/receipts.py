"""From receipt text to the item table by patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalframe.operators.fields import extract_header
from fiscalframe.operators.items import explode_items
from fiscalframe.schema import conform


def parse_receipts(ocr: DataFrame) -> DataFrame:
    """``(filename, text[, ocr_error])`` to 30 columns plus ``line_no`` and ``error``.

    Row-local from end to end: no shuffle, works on streams too.
    """
    inputs = [c for c in ("filename", "text", "ocr_error") if c in ocr.columns]
    return conform(explode_items(extract_header(ocr.select(*inputs))), extra=("line_no", "error"))


def parse_items(ocr: DataFrame) -> DataFrame:
    """Only the items: filename, line_no, name and numbers, no header work."""
    found = explode_items(ocr.select("filename", "text"))
    return found.filter(F.col("line_no").isNotNull()).drop("error")
