"""Receipt text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_HEADER = "Məhsulun adı Say Qiymət Cəmi"


def order_key(column: str = "o_orderkey") -> Column:
    return F.lpad(F.col(column).cast("string"), 12, "0")


def cents_text(cents: Column) -> Column:
    whole = (cents - F.pmod(cents, F.lit(100))) / 100
    return F.concat(whole.cast("bigint").cast("string"), F.lit("."), F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))


def _two(column: str) -> Column:
    return F.call_function("format_number", F.col(column), F.lit("0.00"))


def _labelled(label: str, value: Column, shown: Column | None = None) -> Column:
    line = F.concat(F.lit(label), value)
    return line if shown is None else F.when(shown, line)


def order_quantity(i: Column) -> Column:
    return (F.col("o_orderkey") + i) % 40 + 1


def order_cents(i: Column) -> Column:
    return (F.col("o_custkey") * 7 + i * 13) % 2000 + 5


def order_item_name(i: Column) -> Column:
    return F.concat(F.lit("Mal "), (F.col("o_custkey") + i).cast("string"), F.lit(" A"))


def positions(n: Column) -> Column:
    """1..n, empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n.cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )


def order_slips(orders: DataFrame) -> DataFrame:
    """``(filename, text)``: a complete receipt per order, with 0 to 5 items.

    By key: tax number and register lines missing (% 11), spelling of the
    fiscal number's label (% 3), payment method by customer (% 6, one of them
    none), refund on status P.
    """
    key = order_key()
    n = F.col("o_orderkey")
    whole = n % 11 != 0
    pay = F.col("o_custkey") % 6
    price = _two("o_totalprice")
    clock = F.concat_ws(":", *[F.lpad((n * m % d).cast("string"), 2, "0") for m, d in ((1, 24), (1, 60), (7, 60))])

    def item_line(i: Column) -> Column:
        q, c = order_quantity(i), order_cents(i)
        return F.concat(order_item_name(i), F.lit(" "), q.cast("string"), F.lit(".000 "), cents_text(c), F.lit(" "), cents_text(q * c))

    indexes = positions(n % 6)
    total = F.aggregate(indexes, F.lit(0).cast("bigint"), lambda a, i: a + order_quantity(i) * order_cents(i))
    cashier = F.when(F.col("o_orderstatus") == "F", "Aygün").when(F.col("o_orderstatus") == "O", "Rəşad").otherwise("Leyla Məmmədova")
    refunded = F.col("o_orderstatus") == "P"
    fiscal_label = F.when(n % 3 == 0, "Fiskal İD: ").when(n % 3 == 1, "Fiskal ID: ").otherwise("FISKAL İD: ")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit('Vergi ödəyicisinin adı: "Mağaza  '), F.col("o_custkey").cast("string"), F.lit('" MMC')),
        _labelled("VÖEN: ", (F.col("o_custkey") + 1000000000).cast("string"), whole),
        _labelled("Obyektin ünvanı: Bakı, ", F.col("o_orderpriority")),
        _labelled("Obyektin kodu: ", F.concat_ws("-", F.col("o_custkey").cast("string"), (n % 9).cast("string"))),
        _labelled("Satış çeki № ", n.cast("string")),
        F.concat(F.lit("Kassir: "), cashier, F.lit(" Tarix: "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(" Vaxt: "), clock),
        F.lit(ITEM_HEADER),
        F.array_join(F.transform(indexes, item_line), "\n"),
        F.lit("-----------"),
        _labelled("Cəmi ", cents_text(total)),
        _labelled("ƏDV 18% = ", cents_text(n % 500)),
        _labelled("Toplam vergi = ", cents_text(n % 700), whole),
        _labelled("Nağdsız: ", price, pay == 0),
        _labelled("Nağd: ", price, pay == 1),
        _labelled("Bonus: ", price, pay == 2),
        _labelled("Avans (beh): ", price, pay == 3),
        _labelled("Nisyə: ", price, pay == 4),
        _labelled("Növbə ərzində vurulmuş çek sayı: ", (n % 1000).cast("string")),
        _labelled("NKA-nın modeli: Model ", (F.col("o_custkey") % 50).cast("string"), whole),
        _labelled("NKA-nın zavod nömrəsi: SN", F.col("o_custkey").cast("string"), whole),
        F.concat(fiscal_label, key),
        _labelled("NMQ-nin qeydiyyat nömrəsi: R", n.cast("string"), whole),
        _labelled("Geri qaytarılan məbləğ: ", price, refunded),
        F.when(
            refunded,
            F.concat(F.lit("Geri qaytarılma tarixi: "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(" "), F.substring(clock, 1, 5)),
        ),
    )
    return orders.select(F.concat(key, F.lit(".jpeg")).alias("filename"), text.alias("text"))


def line_filename() -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def line_slips(lineitem: DataFrame, style: str = "plain") -> DataFrame:
    """``(filename, text)``: an item block per line item, goods first, then a discount line.

    Styles: ``plain``; ``units`` (goods with a unit on every second line
    number); ``wrapped`` (names over two lines, number columns torn apart,
    a stray line swallowing the item after it); ``tax`` (tax notes and tax
    prefixes); ``bad`` (an unreadable number before the last item); ``bare``
    (on every third order a name that is only a prefix, in quotes on some).
    """
    key, part = F.col("l_orderkey"), F.col("l_partkey").cast("string")
    qty = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".000"))
    price = _two("l_extendedprice")
    discount = _two("l_discount")
    numbers = F.concat_ws(" ", qty, price, price)
    name = F.concat(F.lit("Mal "), part, F.lit(" "), F.col("l_returnflag"))
    goods = F.concat_ws(" ", name, numbers)
    rebate = F.concat_ws(" ", F.lit("Endirim K 1.000"), discount, discount)
    note = F.lit("*ƏDV 18%")
    if style == "plain":
        lines = [goods, rebate]
    elif style == "units":
        unit = F.when(F.col("l_linenumber") % 2 == 0, F.lit("(ədəd)"))
        lines = [F.concat_ws(" ", name, unit, numbers), rebate]
    elif style == "wrapped":
        torn = (
            F.when(key % 5 == 0, F.concat_ws("\n", F.concat(F.lit("Mal "), part), F.concat_ws(" ", F.col("l_returnflag"), numbers)))
            .when(key % 5 == 1, F.concat_ws("\n", F.concat_ws(" ", name, qty), F.concat_ws(" ", price, price)))
            .when(key % 5 == 2, F.concat_ws("\n", F.concat_ws(" ", name, qty, price), price))
            .when(key % 5 == 3, F.concat_ws("\n", F.lit("qırıq"), F.concat_ws(" ", name, F.lit("(kq)"), numbers)))
            .otherwise(goods)
        )
        lines = [torn, rebate, F.lit("son")]
    elif style == "tax":
        prefix = F.when(key % 3 == 0, F.lit("vƏDV: 189: ")).when(key % 3 == 1, F.lit("ƏDV-dən azad ")).otherwise("")
        lines = [note, F.concat(prefix, goods), F.lit("  "), note, F.concat(F.lit("\t"), rebate)]
    elif style == "bad":
        bad = F.when(key % 4 == 0, F.lit("Çay 1.2.3 1.00 1.00"))
        lines = [goods, bad, rebate]
    elif style == "bare":
        prefix = F.when(key % 2 == 0, F.lit("vƏDV: 189:")).otherwise(F.lit("\"ƏDV 18"))
        lines = [F.when(key % 3 == 0, F.concat_ws(" ", prefix, numbers)).otherwise(goods), rebate]
    else:
        raise ValueError(f"unknown style {style!r}")
    text = F.concat_ws("\n", F.lit(ITEM_HEADER), *lines, F.concat(F.lit("Cəmi "), price))
    return lineitem.select(line_filename().alias("filename"), text.alias("text"))


def spelled_slips(orders: DataFrame) -> DataFrame:
    """``(filename, text)``: headers in the spellings that readings of a receipt have, and a total that may not add up.

    The address behind ``fani``, the store code behind ``ÖV ... obyektin kodu``
    (with another ``ÖV`` before it on some), the receipt number behind ``#``
    or a Cyrillic letter, the fiscal number in small letters. The printed
    total is one unit too high on every fifth order.
    """
    n, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    code = F.concat_ws("-", cust, (n % 9).cast("string"))
    number = F.when(n % 3 == 0, "Satış çeki # ").when(n % 3 == 1, "Satış çeki М ").otherwise("Satışçeki №")
    cents = order_quantity(F.lit(1)) * order_cents(F.lit(1))
    item = F.concat(F.lit("Mal "), order_quantity(F.lit(1)).cast("string"), F.lit(".000 "), cents_text(order_cents(F.lit(1))), F.lit(" "), cents_text(cents))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Obyektin fani: "), F.col("o_orderpriority")),
        F.when(n % 2 == 0, F.concat(F.lit("ÖV qeyd\nÖV obyektin kodu: "), code)).otherwise(F.concat(F.lit("Obyektin  kodu "), code)),
        F.concat(number, n.cast("string")),
        F.lit(ITEM_HEADER),
        item,
        F.concat(F.lit("Cəmi "), cents_text(cents + F.when(n % 5 == 0, 100).otherwise(0))),
        F.concat(F.lit("fiskal id: "), order_key()),
    )
    return orders.select(F.concat(order_key(), F.lit(".jpeg")).alias("filename"), text.alias("text"))
