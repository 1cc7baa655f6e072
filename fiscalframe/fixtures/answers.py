"""Model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.fixtures.slips import cents_text, order_cents, order_item_name, order_key, order_quantity, positions


def order_filename() -> Column:
    return F.concat(order_key(), F.lit(".jpeg"))


def _objects(suffix: str) -> Column:
    """JSON texts of an order's 0 to 4 items.

    Quantities lose their decimal point where order key plus position is a
    multiple of 9; every 13th order starts with an item a second validation
    changes again.
    """

    def one(i: Column) -> Column:
        odd = (F.col("o_orderkey") % 13 == 0) & (i == 1)
        q, c = order_quantity(i), order_cents(i)
        lost = (F.col("o_orderkey") + i) % 9 == 0
        quantity = F.when(odd, F.lit("1500000")).when(lost, F.concat(q.cast("string"), F.lit("000"))).otherwise(q.cast("string"))
        return F.to_json(
            F.struct(
                order_filename().alias("filename"),
                F.concat(F.lit("Mağaza "), F.col("o_custkey").cast("string")).alias("store_name"),
                F.date_format("o_orderdate", "dd.MM.yyyy").alias("date"),
                F.concat(F.lit('"ƏDV: 189: '), order_item_name(i), F.lit(suffix)).alias("item_name"),
                quantity.alias("quantity"),
                F.when(odd, F.lit(1.0)).otherwise(c / 100).alias("unit_price"),
                F.when(odd, F.lit("1500")).otherwise(cents_text(q * c)).alias("line_total"),
                F.when(F.col("o_orderkey") % 4 == 0, F.lit("N/A")).otherwise(F.col("o_totalprice").cast("string")).alias("subtotal"),
            )
        )

    return F.transform(positions(F.col("o_orderkey") % 5), one)


def _array(objects: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(objects, ", "), F.lit("]"))


def order_answers(orders: DataFrame) -> DataFrame:
    """``(filename, attempt, response)``, two or three attempts per order.

    First attempt by customer key % 7: strict, two fences, prose, cut off in
    the last object, refusal, bare object. The second attempt is strict with
    names ending in ``II``, except after a bare object, where it is a refusal
    and the third is strict.
    """
    first = _objects("")
    style = F.col("o_custkey") % 7
    n = F.size(first)
    cut = F.concat(
        F.lit("["),
        F.array_join(F.slice(first, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "),
        F.lit(', {"item_name": "kəsik'),
    )
    answer = (
        F.when(style == 0, _array(first))
        .when(style == 1, F.concat(F.lit("```json\n"), _array(first), F.lit("\n```")))
        .when(style == 2, F.concat(F.lit("```\n"), _array(first), F.lit("\n```\n")))
        .when(style == 3, F.concat(F.lit("Here are the items:\n"), _array(first), F.lit("\nThat is all.")))
        .when(style == 4, cut)
        .when(style == 5, F.lit("I cannot read this receipt."))
        .otherwise(F.lit('{"item_name": "Su", "quantity": 1, "unit_price": 1, "line_total": 1}'))
    )
    again = _array(_objects(" II"))

    def attempt(number: int, text: Column) -> Column:
        return F.struct(F.lit(number).alias("attempt"), text.alias("response"))

    attempts = F.array(
        attempt(0, answer),
        attempt(1, F.when(style == 6, F.lit("Sorry.")).otherwise(again)),
        attempt(2, F.when(style == 6, again)),
    )
    rows = orders.select(order_filename().alias("filename"), F.explode(attempts).alias("a"))
    return rows.select("filename", "a.attempt", "a.response").filter(F.col("response").isNotNull())


#: What stands in an item's field when it is not usable, in JSON, and why it is rejected.
UNUSABLE = (
    ("null", "missing"),
    ('""', "missing"),
    ('"N/A"', "missing"),
    ('"null"', "missing"),
    ('["x"]', "unreadable"),
)
FIELDS = ("item_name", "quantity", "unit_price", "line_total")


def flawed_answers(lineitem: DataFrame) -> DataFrame:
    """``(filename, attempt, response)``: per line item two objects, of which the first has one unusable field.

    Which field, by part key % 4; what stands there, by supplier key % 5. The
    name of the second is in runs of quotes behind a tax prefix. Every
    seventh answer also holds something that is no object.
    """
    field = F.col("l_partkey") % 4
    bad = F.element_at(F.array(*[F.lit(u) for u, _ in UNUSABLE]), (F.col("l_suppkey") % 5 + 1).cast("int"))
    good = ('"Su"', "2", "0.5", "1.0")
    flawed = [F.concat(F.lit(f'"{f}": '), F.when(field == i, bad).otherwise(F.lit(good[i]))) for i, f in enumerate(FIELDS)]
    name = F.concat(F.lit("ƏDV: 18 '\\\"\\\"Mal "), F.col("l_partkey").cast("string"), F.lit("\\\"'\\\""))
    fine = F.concat(F.lit('"item_name": "'), name, F.lit('", "quantity": "3", "unit_price": " 0.50 ", "line_total": 1.5'))
    stray = F.when(F.col("l_orderkey") % 7 == 0, F.lit(", 17"))
    response = F.concat(F.lit("[{"), F.concat_ws(", ", *flawed), F.lit("}, {"), fine, F.lit("}"), F.coalesce(stray, F.lit("")), F.lit("]"))
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return lineitem.select(key.alias("filename"), F.lit(0).alias("attempt"), response.alias("response"))


def emptied_answers(orders: DataFrame) -> DataFrame:
    """Torn answers with one name that the second validation empties, one that the first does, and one that stays."""

    def one(name: str) -> str:
        return f'{{"item_name": "{name}", "quantity": 1, "unit_price": 2, "line_total": 2}}'

    torn = f'[{one("ƏDV 1 ƏDV 2 ƏDV 3")}, {one("ƏDV: 1")}, {one("ok")}, {{"item_name": "kəs'
    return orders.select(order_filename().alias("filename"), F.lit(0).alias("attempt"), F.lit(torn).alias("response"))
