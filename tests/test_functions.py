"""Scalar functions against Python's own behaviour."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fiscalframe.functions.html import form_token, html_attr
from fiscalframe.functions.names import clean_company_name, clean_item_name
from fiscalframe.functions.numbers import one_decimal, read_double, two_decimal_text
from fiscalframe.functions.text import collapse, strip
from fiscalframe.operators.repair import money_text

SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def evaluate(spark, values, schema, column):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, f"i int, x {schema}").select("i", column.alias("y")).collect()
    return [r["y"] for r in sorted(out)]


def random_texts(seed, alphabet, n=400, longest=12):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_strip_is_python_strip(spark):
    texts = random_texts(1, [*SPACES, "a", "ə", "​"])
    assert evaluate(spark, texts, "string", strip(F.col("x"))) == [t.strip() for t in texts]


def test_collapse(spark):
    texts = random_texts(2, [*SPACES, "a", "İ"])
    assert evaluate(spark, texts, "string", collapse(F.col("x"))) == [re.sub(r"\s+", " ", t) for t in texts]


def test_rounding_is_exact_binary_half_even(spark):
    rng = random.Random(3)
    xs = [0.125, 0.375, 0.25, 0.35, 0.45, 2.675, 1.005, 0.005, 0.015, 1e-9, 0.0, 12345678.125, 99999999.995]
    xs += [rng.randrange(10**6) / 1000 for _ in range(2000)] + [rng.uniform(0, 1000) for _ in range(2000)]
    xs += [-x for x in xs[:200]]
    assert evaluate(spark, xs, "double", two_decimal_text(F.col("x"))) == [f"{x:.2f}" for x in xs]
    assert evaluate(spark, xs, "double", one_decimal(F.col("x"))) == [round(x, 1) for x in xs]


def test_read_double_is_python_float(spark):
    fixed = ["1", "1.5", ".5", "5.", ".", "", "1.2.3", "1.5d", "1f", "0x10", "1e3", "1E+2", "1_000", "1__0", "_1", "+2", "--1", "N/A", "null", "1 2", "1e", "1,5"]
    texts = fixed + [t.strip() for t in random_texts(4, list("0123456789._eE+-"), 600, 6)]

    def python_float(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert evaluate(spark, texts, "string", read_double(F.col("x"))) == [python_float(t) for t in texts]


@pytest.mark.parametrize(
    "raw, one, runs",
    [
        ("vƏDV: 189: Çörək", "Çörək", "Çörək"),
        ("ƏDV: 1894 Süd", "Süd", "Süd"),
        ('"ƏDV: 189: Süd"', "Süd", "Süd"),
        ("ƏDV: 189: ƏDV: 20 Un", "Un", "Un"),
        ("ƏDV-dən azad Un", "Un", "Un"),
        ("Ticarət əlavəsi: 18 Yağ", "Yağ", "Yağ"),
        ("Ticarət əlavəsiYağ", "Yağ", "Yağ"),
        ('""Su""', '"Su"', "Su"),
        ("'\"Su'\"", "\"Su'", "Su"),
        ('"', "", ""),
        ("ƏDV azad", "ƏDV azad", "ƏDV azad"),
        ("  a   b  ", "a b", "a b"),
        (None, "", ""),
    ],
)
def test_item_names(column, raw, one, runs):
    name = F.lit(raw).cast("string")
    assert column(clean_item_name(name)) == one
    assert column(clean_item_name(name, quote_runs=True)) == runs


def test_company_names(column):
    assert column(clean_company_name(F.lit("\"ARAZ\"  'MARKET' MMC"))) == "ARAZ MARKET MMC"


@pytest.mark.parametrize(
    "raw, text",
    [("N/A", "0.00"), ("null", "null"), ("", ""), ("7.5", "7.50"), (" 7.125 ", "7.12"), ("0", "0.00"), ("1.5d", "0.00"), (None, None)],
)
def test_money_text(column, raw, text):
    assert column(money_text(F.lit(raw).cast("string"))) == text


@pytest.mark.parametrize(
    "html, token",
    [
        ('<META Content="a b" name="csrf-token">', "a b"),
        ("<meta name=csrf-token content=abc>", "abc"),
        ('<meta name="CSRF-TOKEN" content="x">', ""),
        ('<meta name="x" content="no"><meta\n name="csrf-token"\n content="yes" >', "yes"),
        ('<meta name="csrf-token" data-content="z">', ""),
        ('<meta data-x="> name=csrf-token" name="csrf-token" content="q>r">', "q>r"),
        ('<meta name="csrf-token"><input name="_csrf" value="v">', "v"),
        ('<meta name="csrf-token" content=""><input name="_csrf" value="v">', ""),
        ("<metaphor name='csrf-token' content='x'>", ""),
        ("plain text", ""),
        ("<meta name='csrf-token' content='never closed'", ""),
        ("<meta name='csrf-token' content='a'>x content='b'>", "a"),
        ("<meta name='csrf-token' content='a' CONTENT = b />", "b"),
        ("<meta name='x'><p>name='csrf-token' content='no'>", ""),
    ],
)
def test_form_token(column, html, token):
    assert column(form_token(F.lit(html))) == token


def test_html_attr_without_key(column):
    html = F.lit('<a id="1">x</a><a href="/p?q=1&amp;r" id=2>')
    assert column(html_attr(html, "a", "href")) == "/p?q=1&r"
    assert column(html_attr(html, "a", "href", key="id", value="1")) is None


def test_html_with_very_many_attributes(column):
    html = F.concat(F.lit("<meta "), F.repeat(F.lit('a="b" '), 50000), F.lit('charset="utf-8">'))
    assert column(html_attr(html, "meta", "charset")) == "utf-8"


def test_very_long_texts_do_not_overflow(column):
    assert column(read_double(F.concat(F.lit("0"), F.repeat(F.lit("_0"), 100000)))) == 0.0
    name = F.concat(F.lit("ƏDV: "), F.repeat(F.lit("1 "), 100000), F.repeat(F.lit('"'), 100000))
    assert column(F.length(clean_item_name(name, quote_runs=True))) == 2 * 99999 - 1
