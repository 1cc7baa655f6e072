"""Receipt text: header rules, the item walk and fallback rows."""

import random
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fiscalframe.functions.text import collapse, strip
from fiscalframe.operators.fields import HEADER_RULES, FieldRule, extract_fields, extract_header
from fiscalframe.operators.items import item_block, items_from_lines, items_from_text
from fiscalframe.plans.receipts import parse_receipts
from fiscalframe.schema import COLUMNS, PAYMENTS, conform, local_timestamp, typed, unite

HEAD = "Məhsulun adı Say Qiymət Cəmi\n"


def block(*lines):
    return HEAD + "\n".join(lines) + "\nCəmi 9.99\n"


def items(column, text):
    return [tuple(i) for i in column(items_from_text(F.lit(text)))]


ITEM_LINES = [
    (["SIRAB QAZSIZ SU PET 2.000 0.59 1.18"], [("SIRAB QAZSIZ SU PET", 2.0, 0.59, 1.18)]),
    (['Paket Araz 31"60 5 K 1.000 0.05 0.05'], [('Paket Araz 31"60 5 K', 1.0, 0.05, 0.05)]),
    (["BIQ BON QOVYAD QRİL 1.000 2.10 2.10"], [("BIQ BON QOVYAD QRİL", 1.0, 2.1, 2.1)]),
    (["Su (ədəd) 1.000 0.50 0.50"], [("Su", 1.0, 0.5, 0.5)]),
    (["Su (a) (b) 1 2 3"], [("Su (a)", 1.0, 2.0, 3.0)]),
    (["Uzun ad", "davamı 1.000 3.00 3.00"], [("Uzun ad davamı", 1.0, 3.0, 3.0)]),
    (["Uzun ad", "1.000 3.00 3.00"], [("Uzun ad", 1.0, 3.0, 3.0)]),
    (["Ad 1.000", "3.00 3.00"], [("Ad", 1.0, 3.0, 3.0)]),
    (["Ad 1.000 3.00", "3.00"], [("Ad", 1.0, 3.0, 3.0)]),
    (["ƏDV: 18 Ad 1.000 3.00", "3.00"], [("Ad", 1.0, 3.0, 3.0)]),
    (["qırıq", "Su (ədəd) 1.000 0.50 0.50"], [("qırıq Su (ədəd)", 1.0, 0.5, 0.5)]),
    (["a", "b", "Su 1 2 3"], [("b Su", 1.0, 2.0, 3.0)]),
    (["-----", "Su 1 2 3"], [("----- Su", 1.0, 2.0, 3.0)]),
    (["Su 1 1 1", "Çay 1.2.3 1.00 1.00", "Un 1 1 1"], [("Su", 1.0, 1.0, 1.0)]),
    (["Çay . 1.00 1.00", "Un 1 1 1"], []),
    (["ƏDV: 18 1 1 1", "Un 5. .5 2"], [("Un", 5.0, 0.5, 2.0)]),
    (["Su 1 1 1", "son sətir"], [("Su", 1.0, 1.0, 1.0)]),
    (["", "  *ƏDV 18%", "Uzun", "*ƏDV", "\tad 1 1 1  "], [("Uzun ad", 1.0, 1.0, 1.0)]),
    (["vƏDV: 189: Çörək 1 1 1", "'Su' 1 1 1"], [("Çörək", 1.0, 1.0, 1.0), ("Su", 1.0, 1.0, 1.0)]),
    (['""Su"" 1 1 1'], [('"Su"', 1.0, 1.0, 1.0)]),
    (["1 2 3 4"], [("1", 2.0, 3.0, 4.0)]),
    (["1 2 3", "4"], [("1", 2.0, 3.0, 4.0)]),
]


def test_item_lines(spark):
    df = spark.createDataFrame([(n, block(*lines)) for n, (lines, _) in enumerate(ITEM_LINES)], "n int, text string")
    for row in df.select("n", items_from_text(F.col("text")).alias("items")).collect():
        lines, expected = ITEM_LINES[row["n"]]
        assert [tuple(i) for i in row["items"]] == expected, lines


def test_walk_reads_collapsed_lines(column):
    """White space of any kind is gone before the walk: runs, edges of lines, blank lines and tax notes."""
    lines = ["\u3000\t", " Su  (kq)\u00a0\x1c1 1\t1 ", "*ƏDV 18%", " \r", "\u2003*ƏDV", "uzun \u2028 ", "\tad 1  1 1\r"]
    text = block(*lines)
    assert column(item_block(F.lit(text))).strip("\n").split("\n") == ["Su (kq) 1 1 1", "uzun", "ad 1 1 1"]
    assert items(column, text) == [("Su", 1.0, 1.0, 1.0), ("uzun ad", 1.0, 1.0, 1.0)]


def test_block_ends(column):
    assert items(column, HEAD + "Su 1 1 1\n-----\nCəmi\nUn 1 1 1\nCəmi 2.00") == [("Su", 1.0, 1.0, 1.0)]
    assert items(column, HEAD + "Su 1 1 1\nCəmi 5\nUn 1 1 1\nCəmi 2.00")[-1] == ("Cəmi 5 Un", 1.0, 1.0, 1.0)
    assert items(column, HEAD + "Su 1 1 1\n") == []
    assert items(column, "no block") == []


def walk(lines):
    """Brute force over words: three numbers at the end, after at least one word."""

    def number_tail(words):
        return len(words) > 3 and all(set(w) <= set("0123456789.") for w in words[-3:])

    found, at = [], 0
    while at < len(lines):
        alone, pair = lines[at].split(), " ".join(lines[at : at + 2]).split()
        if number_tail(alone):
            taken, step = alone, 1
            opened = [k for k, w in enumerate(alone[:-3]) if w == "(u)"]
            if opened and opened[-1] == len(alone) - 4 and len(alone) > 4:
                taken = alone[:-4] + alone[-3:]
        elif at + 1 < len(lines) and number_tail(pair):
            taken, step = pair, 2
        else:
            taken, step = None, 1
        if taken:
            try:
                found.append((" ".join(taken[:-3]), *map(float, taken[-3:])))
            except ValueError:
                break
        at += step
    return found


def test_walk_against_brute_force(spark):
    rng = random.Random(7)
    words = ["Su", "ad", "(u)", "1.0", "2", ".5", "3.25", "9", "1.2.3", "x1"]
    weights = [4, 3, 1, 5, 5, 3, 3, 3, 0.3, 1]
    receipts = [
        [" ".join(rng.choices(words, weights, k=rng.randint(1, 6))) for _ in range(rng.randint(0, 9))] for _ in range(3000)
    ]
    rows = [(i, r) for i, r in enumerate(receipts)]
    df = spark.createDataFrame(rows, "i int, lines array<string>")
    got = df.select("i", items_from_lines(F.col("lines")).alias("items")).collect()
    for row in got:
        assert [tuple(x) for x in row["items"]] == walk(receipts[row["i"]]), receipts[row["i"]]


def test_unit_lines_against_python_re(spark):
    """Lines of brackets, blanks and numbers: the unit rule finds what its plain form does."""
    plain = re.compile(r"(.+?)\s*\([^)]+\)\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)\Z")
    bare = re.compile(r"(.+?)\s+([\d.]+)\s+([\d.]+)\s+([\d.]+)\Z")
    rng = random.Random(9)
    lines = []
    for _ in range(6000):
        body = "".join(rng.choice("a() )(b") for _ in range(rng.randint(1, 12))).strip()
        lines.append(body + rng.choice([" 1 2 3", " 1 2 3", "1 2 3", " 1 2"]))
    df = spark.createDataFrame([(i, [x.strip()]) for i, x in enumerate(lines)], "i int, lines array<string>")
    for row in df.select("i", items_from_lines(F.col("lines")).alias("items")).collect():
        line = lines[row["i"]].strip()
        m = plain.match(line) or bare.match(line)
        name = " ".join(m[1].split()) if m else ""
        assert [x["item_name"] for x in row["items"]] == ([name] if name else []), line


@pytest.mark.parametrize("text", ["ÖV " * 340_000, HEAD + "(" * 1_000_000 + " 1 1 1\nCəmi 1.00", HEAD + "(" * 500_000 + "x) y) 1 1 1\nCəmi 1.00"])
def test_time_grows_with_the_text(spark, text):
    df = spark.createDataFrame([("r", text)], "filename string, text string").cache()
    df.count()
    parsed = parse_receipts(df).select("store_code", "item_name", "error")
    parsed.collect()
    start = time.perf_counter()
    parsed.collect()
    assert time.perf_counter() - start < 1


def test_long_block_is_read_whole(column):
    lines = [f"Mal {i} A 1.000 {i}.00 {i}.00" for i in range(5000)]
    got = items(column, block(*lines))
    assert len(got) == 5000 and got[-1] == ("Mal 4999 A", 1.0, 4999.0, 4999.0)


RECEIPT = """ARAZ
Obyektin ünvanı: Bakı ş., Nizami 5
ÖV-nin ünvanı
obyektin kodu: 12-34
Vergi ödəyicisinin adı: "ARAZ  MARKET" MMC
VÖEN: 1234567891
Satış çeki № 0042
Kassir: Aygün M. Tarix: 31.01.2024 Vaxt: 10:11:12
Məhsulun adı Say Qiymət Cəmi
Su (ədəd) 2.000 0.59 1.18
Cəmi 1.18
*ƏDV 18% = 0.18
Toplam vergi = 0.18
Nağdsız: 1.00
Bonus: 0.18
Avans (beh): 0.00
Növbə ərzində vurulmuş çek sayı: 7
NKA-nın modeli: M 5
NKA-nın zavod nömrəsi:
S/1
Fiskal ID: aBc9
NMQ-nin qeydiyyat nömrəsi: 77
Geri qaytarılan məbləğ: 0.59
Geri qaytarılma tarixi: 01.02.2024 09:08
"""
EXPECTED = {
    "filename": "r.jpeg",
    "store_name": "ARAZ MARKET MMC",
    "store_address": "Bakı ş., Nizami 5",
    "store_code": "12-34",
    "taxpayer_name": "ARAZ MARKET MMC",
    "tax_id": "1234567891",
    "receipt_number": "0042",
    "cashier_name": "Aygün M.",
    "date": "31.01.2024",
    "time": "10:11:12",
    "item_name": "Su",
    "quantity": 2.0,
    "unit_price": 0.59,
    "line_total": 1.18,
    "subtotal": "1.18",
    "vat_18_percent": "0.18",
    "total_tax": "0.18",
    "cashless_payment": "1.00",
    "cash_payment": "0.00",
    "bonus_payment": "0.18",
    "advance_payment": "0.00",
    "credit_payment": "0.00",
    "queue_number": "7",
    "cash_register_model": "M 5",
    "cash_register_serial": "S/1",
    "fiscal_id": "aBc9",
    "fiscal_registration": "77",
    "refund_amount": "0.59",
    "refund_date": "01.02.2024",
    "refund_time": "09:08",
}


def test_whole_receipt(spark):
    df = spark.createDataFrame([("r.jpeg", RECEIPT)], "filename string, text string")
    out = parse_receipts(df)
    assert out.columns == [*COLUMNS, "line_no", "error"]
    (row,) = out.collect()
    assert {c: row[c] for c in COLUMNS} == EXPECTED
    (row,) = typed(out).collect()
    assert row["sold_at"] == datetime(2024, 1, 31, 10, 11, 12)
    assert row["refunded_at"] == datetime(2024, 2, 1, 9, 8)
    assert str(row["refund_amount"]) == "0.59"


def test_rules_read_what_python_re_reads(spark):
    """Shuffled and damaged receipts, every rule, Spark's against Python's dialect."""
    rng = random.Random(11)
    pieces = RECEIPT.splitlines() + ["", "Kassir:", "Kassir 12", "VÖEN", "fani Gəncə", "Fiskal İD", "Nağd 3.00", "Nisyə: 4.50", "Cəmi", "  "]
    pieces += ["ÖV", "ÖVÖV obyektin  kodu", "obyektin kodu: 5-6", "Obyektin kodu 77", "Obyektin kodu ÖV 8"]
    texts = []
    for _ in range(600):
        lines = [rng.choice(pieces) for _ in range(rng.randint(1, 14))]
        text = rng.choice(["\n", "\n", "\r\n", " "]).join(lines)
        texts.append(text if rng.random() < 0.5 else text[: rng.randrange(len(text) + 1)])
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    plain = {n: FieldRule(r.pattern, r.group, strip, finder=r.finder) for n, r in HEADER_RULES.items()}
    for row in extract_fields(df, "text", plain).collect():
        for name, rule in HEADER_RULES.items():
            m = re.search(rule.pattern, texts[row["i"]], re.MULTILINE | re.DOTALL)
            assert row[name] == ((m.group(rule.group).strip() or None) if m else None), (name, texts[row["i"]])


def test_fallback_rows(spark):
    rows = [("a", None, "broken file"), ("b", None, None), ("c", "nothing", None), ("d", "fiskal ıd: QQ.1", None)]
    df = spark.createDataFrame(rows, "filename string, text string, ocr_error string")
    out = {r["filename"]: r for r in parse_receipts(df).collect()}
    assert out["a"]["error"] == "broken file" and out["b"]["error"] == "Text missing"
    assert parse_receipts(df.drop("ocr_error")).filter("filename = 'a'").first()["error"] == "Text missing"
    assert [out["a"][p] for p in PAYMENTS] == [None] * 5
    assert out["c"]["error"] == "Item parsing failed"
    assert [out["c"][p] for p in PAYMENTS] == ["0.00"] * 5
    assert out["d"]["fiscal_id"] == "QQ"


def test_extract_fields_takes_any_rule_table(spark):
    df = spark.createDataFrame([("total:  A  B",)], "body string")
    rules = {"total": FieldRule(r"total:(.*)", clean=lambda c: strip(collapse(c))), "missing": FieldRule(r"x(\d)")}
    row = extract_fields(df, "body", rules).first()
    assert (row["total"], row["missing"]) == ("A B", None)


@pytest.mark.parametrize(
    "date, time, stamp",
    [
        ("29.02.2024", "23:59:59", datetime(2024, 2, 29, 23, 59, 59)),
        ("31.03.2024", "02:30:00", datetime(2024, 3, 31, 2, 30)),
        ("29.02.2023", "10:00:00", None),
        ("01.01.2024", "25:00:00", None),
        (None, "10:00:00", None),
    ],
)
def test_timestamps(column, date, time, stamp):
    assert column(local_timestamp(F.lit(date).cast("string"), F.lit(time))) == stamp


def test_conform_and_unite(spark):
    a = spark.createDataFrame([("x", 1)], "filename string, extra int")
    b = spark.createDataFrame([("y", "2.5")], "filename string, quantity string")
    out = conform(unite(a, b))
    assert out.columns == list(COLUMNS)
    assert sorted((r["filename"], r["quantity"]) for r in out.collect()) == [("x", None), ("y", 2.5)]


def test_extraction_needs_no_shuffle_and_one_walk(spark):
    df = spark.createDataFrame([("r", RECEIPT)], "filename string, text string")
    plan = parse_receipts(df).filter(F.col("quantity") > 1)._jdf.queryExecution().optimizedPlan().toString()
    physical = parse_receipts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Say\\s+Qiymət") == 1
    assert "Exchange" not in physical and "Python" not in physical


def test_unused_headers_are_not_computed(spark):
    df = spark.createDataFrame([("r", RECEIPT)], "filename string, text string")
    plan = parse_receipts(df).select("item_name")._jdf.queryExecution().optimizedPlan().toString()
    assert "VÖEN" not in plan and "Kassir" not in plan
    assert extract_header(df).select("tax_id").first()["tax_id"] == "1234567891"
