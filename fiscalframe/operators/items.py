"""Item lines: the walk over a receipt's item block, as one Column expression.

A line either holds a whole item, or is tried together with the next line
(names wrap), or is passed over. Read left to right, that is what one regular
expression with ordered alternatives does when all its matches are replaced,
so the walk needs no running state and stays linear in the text. It rewrites
the block into one line per step, ``name|quantity|price|total``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.functions.names import NAME_MARK, NAME_START, QUOTES, TAX_NOTE
from fiscalframe.functions.text import INLINE_SPACE, capture, let, runs

# The block's first line and the lines that end it.
ITEM_BLOCK = r"Məhsulun adı\s+Say\s+Qiymət\s+Cəmi\s*\n(.*?)\n(?:-+\s*\nCəmi|Cəmi\s+\d+\.\d{2})"

NO_ITEMS = "Item parsing failed"
NO_TEXT = "Text missing"

# Code points that never occur in text: between the parts of a step, and where
# two lines were joined.
_BAR, _JOINT = "\ufdd0", "\ufdd1"

# The walk reads blocks whose inline white space is collapsed to single blanks:
# a character is quicker to test than a class, and fewer ways have to be tried.
_N = r"([\d.]+)"
_STEPS = (
    # name (unit) quantity price total; the unit holds no closing bracket, so it
    # opens behind the last but one, if there is one
    rf"(?=[^\n(]*+\()((?:[^\n]*\)|[^\n])[^()\n]*?) ?\([^)\n]+\) {_N} {_N} {_N}$",
    # name quantity price total
    rf"([^\n]+?) {_N} {_N} {_N}$",
    # The same over two lines: torn inside or behind the name, ...
    rf"([^\n]+)\n(?:([^\n]+?) )?{_N} {_N} {_N}$",
    # ... before the price, ...
    rf"([^\n]+?) {_N}\n{_N} {_N}$",
    # ... or before the total.
    rf"([^\n]+?) {_N} {_N}\n{_N}$",
    # Anything else.
    r"[^\n]+$",
)
# Which group of which alternative holds what; groups that took no part are empty.
_AS_PARTS = _BAR.join((f"$1$5$9$14$18{_JOINT}$10", "$2$6$11$15$19", "$3$7$12$16$20", "$4$8$13$17$21"))


def _collapsed(block: Column) -> Column:
    for mark in (_BAR, _JOINT):
        block = F.replace(block, F.lit(mark), F.lit(""))
    return F.regexp_replace(block, f"(?dU){runs(INLINE_SPACE)}", " ")


def item_block(text: Column) -> Column:
    """The stripped lines of the item block without tax notes, white space collapsed; a blank line can only stand at either end."""
    block = F.concat(F.lit("\n"), _collapsed(capture(text, ITEM_BLOCK, flags="msdU")), F.lit("\n"))
    for around in (" \n", "\n "):
        block = F.replace(block, F.lit(around), F.lit("\n"))
    return F.regexp_replace(F.regexp_replace(block, rf"(?d)\n\Q{TAX_NOTE}\E[^\n]*+", ""), r"\n\n+", "\n")


def _steps(block: Column) -> Column:
    """One line per step, with item names cleaned except for blanks at their ends."""
    walked = F.regexp_replace(block, f"(?mdU)^(?:{'|'.join(_STEPS)})", _AS_PARTS)
    # A joint at the end of a name joins nothing.
    joined = F.replace(F.replace(walked, F.lit(_JOINT + _BAR), F.lit(_BAR)), F.lit(_JOINT), F.lit(" "))
    return F.regexp_replace(joined, rf"(?mdU)^{NAME_MARK}{NAME_START}{QUOTES}?|{QUOTES}(?={_BAR})", "")


def _unreadable(item: Column) -> Column:
    return item["quantity"].isNull() | item["unit_price"].isNull() | item["line_total"].isNull()


def items_from_block(block: Column) -> Column:
    """ARRAY of (item_name, quantity, unit_price, line_total) in line order, from collapsed lines.

    The first number that cannot be read (``1.2.3``) ends the receipt's list;
    items before it stay. Items whose cleaned name is empty are left out.
    """
    parts = F.transform(F.split(_steps(block), "\n"), lambda step: F.split(step, _BAR))

    def read(p: Column) -> Column:
        numbers = [p[i + 1].try_cast("double").alias(n) for i, n in enumerate(("quantity", "unit_price", "line_total"))]
        return F.struct(F.trim(p[0]).alias("item_name"), *numbers)

    def up_to_first_bad(items: Column) -> Column:
        first_bad = F.array_position(F.transform(items, _unreadable), F.lit(True))
        kept = F.when(first_bad > 0, F.slice(items, F.lit(1), F.greatest(first_bad - 1, F.lit(0)).cast("int")))
        return F.filter(kept.otherwise(items), lambda i: i["item_name"] != "")

    return let(F.transform(F.filter(parts, lambda p: F.get(p, F.lit(1)) != ""), read), up_to_first_bad)


def items_from_lines(lines: Column) -> Column:
    """The same from an array of stripped lines."""
    return items_from_block(_collapsed(F.array_join(lines, "\n")))


def items_from_text(text: Column) -> Column:
    return items_from_block(item_block(text))


def explode_items(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per item; a receipt without items gives one row with ``error``.

    A row whose text is null takes its message from ``ocr_error`` if there is
    one. The text itself is not carried on.
    """
    given = [F.col("ocr_error")] if "ocr_error" in df.columns else []
    failed = F.coalesce(*given, F.lit(NO_TEXT))
    carried = [c for c in df.columns if c not in (text, "ocr_error")]
    located = df.select(
        *carried,
        F.when(F.col(text).isNull(), failed).otherwise(F.lit(NO_ITEMS)).alias("_if_empty"),
        items_from_text(F.col(text)).alias("_items"),
    )
    rows = located.select(*carried, "_if_empty", F.posexplode_outer("_items").alias("line_no", "_item"))
    return rows.select(
        *carried,
        "line_no",
        "_item.item_name",
        "_item.quantity",
        "_item.unit_price",
        "_item.line_total",
        F.when(F.col("line_no").isNull(), F.col("_if_empty")).alias("error"),
    )
