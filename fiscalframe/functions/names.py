"""Item and company name clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalframe.functions.text import collapse, strip

# Prefixes printed before an item name, removed in this order.
ITEM_PREFIXES = (
    r'v?ƏDV[:\s]*\d+[:\s]*',
    r'"?ƏDV[:\s]*\d+[:\s]*',
    r'ƏDV-dən\s+azad\s+',
    r'Ticarət\s+əlavəsi[:\s]*\d*\s*',
)
# Fixed value: lines starting so are tax notes, not items.
TAX_NOTE = "*ƏDV"

QUOTES = "[\"']"

# Taking the prefixes away one after another is the same as matching them as a
# chain of optional parts, in one pass.
NAME_START = "".join(f"(?:{prefix})?" for prefix in ITEM_PREFIXES)
# What a prefix or a quote starts with; other names are no match at their start, which is cheaper than an empty one.
NAME_MARK = "(?=[vƏT\"'])"


def clean_item_name(name: Column, quote_runs: bool = False) -> Column:
    """Drop tax prefixes and edge quotes, collapse spaces; NULL gives ``''``.

    One quote goes at each end, or the whole run of them with ``quote_runs``.
    """
    first, last = (f"{QUOTES}*", f"{QUOTES}+") if quote_runs else (f"{QUOTES}?", QUOTES)
    edges = rf"(?dU)\A{NAME_START}{first}|{last}$"
    return strip(collapse(F.regexp_replace(F.coalesce(name, F.lit("")), edges, "")))


def clean_company_name(name: Column) -> Column:
    """Remove every quote and collapse spaces."""
    return collapse(F.regexp_replace(name, f"{QUOTES}+", ""))


def is_item_line(stripped: Column) -> Column:
    """A non-blank line that is not a tax note."""
    return (stripped != "") & ~F.startswith(stripped, F.lit(TAX_NOTE))
