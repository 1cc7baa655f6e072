"""Queries over receipt text. Their SQL reads the tables, never the text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.fixtures.slips import line_slips, order_slips, spelled_slips
from fiscalframe.fixtures.tables import table
from fiscalframe.functions.names import clean_item_name, is_item_line
from fiscalframe.functions.text import strip
from fiscalframe.operators.fields import extract_header
from fiscalframe.operators.quality import (
    fill_rates,
    items_per_receipt,
    math_accuracy,
    payment_failures,
    receipt_names,
    reconcile_receipts,
    suspicious_rate,
)
from fiscalframe.plans.receipts import parse_items, parse_receipts
from fiscalframe.schema import COLUMNS, typed
from fiscalframe.sources.inputs import read_ocr_text
from fiscalframe.sources.outputs import finished_dates, read_csv, rewrite_changed_dates, scratch_path, write_by_sale_date, write_csv
from fiscalframe.streaming.incremental import parse_new_receipts, stream_ocr_table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_slips(table(spark, sf_dir, "orders"))


def _lines(style: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return parse_items(line_slips(table(spark, sf_dir, "lineitem"), style))

    return query


def store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: total sales and number of items per store, read from receipt text."""
    rows = parse_receipts(_orders(spark, sf_dir))
    return rows.groupBy("store_name").agg(
        F.count("item_name").alias("n_items"),
        F.sum(F.col("line_total").cast("decimal(18,2)")).cast("double").alias("sales"),
    )


_HEADER = [c for c in COLUMNS if c not in ("item_name", "quantity", "unit_price", "line_total")]
_OPTIONAL = ["tax_id", "total_tax", "cash_register_model", "cash_register_serial", "fiscal_registration"]


def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_header(_orders(spark, sf_dir)).select(*_HEADER)


def header_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = extract_header(_orders(spark, sf_dir))
    return header.select(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in (*_OPTIONAL, "refund_date", "store_name")]
    )


def payments_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = [c for c in COLUMNS if c.endswith("_payment")]
    return extract_header(_orders(spark, sf_dir)).select("filename", *payments)


def sale_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = typed(extract_header(_orders(spark, sf_dir)))
    return dated.select("filename", "sold_at", "refunded_at", F.col("refund_amount").cast("double").alias("refund_amount"))


def receipt_30col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_receipts(_orders(spark, sf_dir)).select(*COLUMNS)


def items_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts without items, and unreadable ones (every 17th text is missing here)."""
    slips = _orders(spark, sf_dir)
    unreadable = F.substring("filename", 1, 12).cast("bigint") % 17 == 0
    ocr = slips.select(
        "filename",
        F.when(~unreadable, F.col("text")).alias("text"),
        F.when(unreadable, F.lit("cannot identify image file")).alias("ocr_error"),
    )
    failed = parse_receipts(ocr).filter(F.col("error").isNotNull())
    return failed.select("filename", "error", "item_name", "tax_id", "cash_payment")


def header_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = extract_header(spelled_slips(table(spark, sf_dir, "orders")))
    return header.select("filename", "store_address", "store_code", "receipt_number", "fiscal_id")


def receipt_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts whose printed total differs from the sum of their items."""
    out = reconcile_receipts(parse_receipts(spelled_slips(table(spark, sf_dir, "orders"))))
    return out.filter("gap <> 0").select("filename", "n_items", F.col("gap").cast("double").alias("gap"))


def receipt_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reconcile_receipts(parse_receipts(_orders(spark, sf_dir)))
    return out.select("filename", "n_items", *[F.col(c).cast("double").alias(c) for c in ("items_total", "subtotal", "gap")])


def receipt_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_per_receipt(parse_receipts(_orders(spark, sf_dir)))


def distinct_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return receipt_names(parse_receipts(_orders(spark, sf_dir)))


def field_fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fill_rates(parse_receipts(_orders(spark, sf_dir)))
    return rates.select("metric", F.round("value", 9).alias("value"))


def payment_failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_failures(parse_receipts(_orders(spark, sf_dir)))


def math_accuracy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return math_accuracy(parse_items(line_slips(table(spark, sf_dir, "lineitem"))))


def suspicious_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate for a threshold of 30; slips hold quantities up to 50."""
    return suspicious_rate(parse_items(line_slips(table(spark, sf_dir, "lineitem"))), above=30)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "receipts-csv")
    write_csv(parse_receipts(_orders(spark, sf_dir)), path)
    return read_csv(spark, path)


def sale_date_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "receipts-by-date")
    write_by_sale_date(parse_receipts(_orders(spark, sf_dir)), path, by_month=True)
    by_date = spark.read.parquet(path).groupBy("sale_date").agg(
        F.count("*").alias("n_rows"), F.sum("line_total").cast("decimal(28,2)").cast("double").alias("sales")
    )
    return by_date


def sale_dates_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the receipts by day, then all, then all once more; the run that wrote each day last.

    Every run reads its rows twice, so the receipts are parsed once and stored,
    by as many tasks as there are, however few row groups the orders have.
    """
    path, parsed = (scratch_path(spark, name) for name in ("receipts-by-day", "receipts-parsed"))
    orders = table(spark, sf_dir, "orders")
    parse_receipts(order_slips(orders.repartition(*orders.columns))).write.parquet(parsed)
    rows = spark.read.parquet(parsed)
    third = rows.filter(F.substring("filename", 1, 12).cast("long") % 3 == 0)
    for part in (third, rows, rows):
        rewrite_changed_dates(part, path)
    by_day = spark.read.parquet(path).groupBy("sale_date").agg(
        F.count("*").alias("n_rows"), F.sum("line_total").cast("decimal(28,2)").cast("double").alias("sales")
    )
    return by_day.join(finished_dates(spark, path).select("sale_date", "run"), "sale_date")


def incremental_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts arriving as files, parsed by two incremental runs over one checkpoint."""
    arrivals, out, state = (scratch_path(spark, n) for n in ("arrivals", "parsed", "state"))
    slips = _orders(spark, sf_dir).withColumn("ocr_error", F.lit(None).cast("string"))
    for half in (0, 1):
        arrived = slips.filter(F.substring("filename", 12, 1).cast("int") % 2 == half)
        arrived.write.mode("append").parquet(arrivals)
        parse_new_receipts(stream_ocr_table(spark, arrivals), out, state).awaitTermination()
    return spark.read.parquet(out).select("filename", "line_no", "item_name", "quantity", "unit_price", "line_total", "error")


def ocr_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt text stored as JSON, read as a source, items found in it."""
    path = scratch_path(spark, "ocr-json")
    line_slips(table(spark, sf_dir, "lineitem"), "units").write.json(path)
    return parse_items(read_ocr_text(spark, path, "json"))


def document_line_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name clean-up on every line of every document, tax codes put before some."""
    docs = table(spark, sf_dir, "documents")
    prefix = (
        F.when(F.col("doc_id") % 4 == 0, F.lit("ƏDV: 1894 "))
        .when(F.col("doc_id") % 4 == 1, F.lit("vƏDV: 189: "))
        .when(F.col("doc_id") % 4 == 2, F.lit("  *ƏDV "))
        .otherwise(F.lit('"'))
    )
    lines = docs.select("doc_id", prefix.alias("prefix"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    raw = lines.select("doc_id", "line_no", strip(F.concat("prefix", "line")).alias("line"))
    kept = raw.filter(is_item_line(F.col("line")))
    return kept.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), clean_item_name(F.col("line")).alias("item_name"))


def document_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents read as receipts, a tax number put behind the last word."""
    docs = table(spark, sf_dir, "documents")
    ocr = docs.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".png")).alias("filename"),
        F.concat(F.col("text"), F.lit("\nVÖEN: "), F.col("doc_id").cast("string"), F.lit("\nNağd: 2.50")).alias("text"),
    )
    return parse_receipts(ocr).select("filename", "tax_id", "cash_payment", "item_name", "error")


QUERIES = {
    "store_sales": store_sales,
    "items_roundtrip": _lines("plain"),
    "items_roundtrip_units": _lines("units"),
    "items_wrapped_names": _lines("wrapped"),
    "items_vat_lines": _lines("tax"),
    "items_bad_number": _lines("bad"),
    "items_empty_names": _lines("bare"),
    "items_fallback": items_fallback,
    "header_fields": header_fields,
    "header_missing": header_missing,
    "payments_default": payments_default,
    "sale_timestamp": sale_timestamp,
    "receipt_30col": receipt_30col,
    "header_spellings": header_spellings,
    "receipt_gaps": receipt_gaps,
    "receipt_reconciliation": receipt_reconciliation,
    "receipt_sizes": receipt_sizes,
    "distinct_receipts": distinct_receipts,
    "field_fill_rate": field_fill_rate,
    "payment_failures": payment_failure_rate,
    "math_accuracy": math_accuracy_lines,
    "suspicious_rate": suspicious_quantities,
    "csv_roundtrip": csv_roundtrip,
    "sale_date_parquet": sale_date_parquet,
    "sale_dates_rerun": sale_dates_rerun,
    "incremental_items": incremental_items,
    "ocr_table": ocr_table,
    "document_line_clean": document_line_clean,
    "document_headers": document_headers,
}

# --- the same in SQL -------------------------------------------------------

_PAY = {"cashless": 0, "cash": 1, "bonus": 2, "advance": 3, "credit": 4}
_PAYMENT_SQL = ",\n".join(
    f"CASE WHEN o_custkey % 6 = {k} THEN printf('%.2f', o_totalprice) ELSE '0.00' END AS {n}_payment"
    for n, k in _PAY.items()
)
_CLOCK = "printf('%02d:%02d:%02d', o_orderkey % 24, o_orderkey % 60, o_orderkey * 7 % 60)"
_CENTS = "((o_custkey * 7 + i * 13) % 2000 + 5)"
_QUANTITY = "((o_orderkey + i) % 40 + 1)"
_FILENAME = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.jpeg'"
_MONEY_OF_CENTS = "printf('%d.%02d', {0} // 100, {0} % 100)"

_HEADER_SQL = f"""
  {_FILENAME} AS filename,
  'Mağaza ' || o_custkey || ' MMC' AS store_name,
  'Bakı, ' || o_orderpriority AS store_address,
  o_custkey || '-' || (o_orderkey % 9) AS store_code,
  'Mağaza ' || o_custkey || ' MMC' AS taxpayer_name,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey + 1000000000 AS VARCHAR) END AS tax_id,
  CAST(o_orderkey AS VARCHAR) AS receipt_number,
  CASE o_orderstatus WHEN 'F' THEN 'Aygün' WHEN 'O' THEN 'Rəşad' ELSE 'Leyla Məmmədova' END AS cashier_name,
  strftime(o_orderdate, '%d.%m.%Y') AS date,
  {_CLOCK} AS time,
  {_MONEY_OF_CENTS.format("total_cents")} AS subtotal,
  {_MONEY_OF_CENTS.format("(o_orderkey % 500)")} AS vat_18_percent,
  CASE WHEN o_orderkey % 11 <> 0 THEN {_MONEY_OF_CENTS.format("(o_orderkey % 700)")} END AS total_tax,
  {_PAYMENT_SQL},
  CAST(o_orderkey % 1000 AS VARCHAR) AS queue_number,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'Model ' || (o_custkey % 50) END AS cash_register_model,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'SN' || o_custkey END AS cash_register_serial,
  lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS fiscal_id,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'R' || o_orderkey END AS fiscal_registration,
  CASE WHEN o_orderstatus = 'P' THEN printf('%.2f', o_totalprice) END AS refund_amount,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d.%m.%Y') END AS refund_date,
  CASE WHEN o_orderstatus = 'P' THEN left({_CLOCK}, 5) END AS refund_time"""

# One row per printed item, then one row per receipt with its total.
_ITEMS = f"""
items AS (
  SELECT o_orderkey AS k, i, 'Mal ' || (o_custkey + i) || ' A' AS item_name,
         CAST({_QUANTITY} AS DOUBLE) AS quantity, {_CENTS} / 100.0 AS unit_price,
         {_QUANTITY} * {_CENTS} AS line_cents
  FROM (SELECT *, unnest(range(1, o_orderkey % 6 + 1)) AS i FROM orders)
),
receipt AS (
  SELECT o.*, coalesce(t.total_cents, 0) AS total_cents, coalesce(t.n, 0) AS n
  FROM orders o LEFT JOIN (SELECT k, CAST(sum(line_cents) AS BIGINT) AS total_cents, count(*) AS n FROM items GROUP BY k) t
    ON o.o_orderkey = t.k
)"""
_WIDE = f"""
{_ITEMS},
header AS (SELECT o_orderkey AS hk, {_HEADER_SQL} FROM receipt),
wide AS (
  SELECT * EXCLUDE (hk, k, i, line_cents), line_cents / 100.0 AS line_total
  FROM header LEFT JOIN items ON hk = k
)"""

_LINE_FILE = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS filename"
_PLAIN_NAME = "'Mal ' || l_partkey || ' ' || l_returnflag"


def _line_sql(goods: str = _PLAIN_NAME, rebate_if: str = "true") -> str:
    return f"""
SELECT {_LINE_FILE}, CAST(0 AS INTEGER) AS line_no, {goods} AS item_name,
       l_quantity AS quantity, l_extendedprice AS unit_price, l_extendedprice AS line_total
FROM lineitem
UNION ALL
SELECT {_LINE_FILE}, CAST(1 AS INTEGER), 'Endirim K', 1.0, l_discount, l_discount
FROM lineitem WHERE {rebate_if}"""


_RAW_LINES = """
SELECT doc_id, pos - 1 AS line_no,
  trim(CASE doc_id % 4 WHEN 0 THEN 'ƏDV: 1894 ' WHEN 1 THEN 'vƏDV: 189: ' WHEN 2 THEN '  *ƏDV ' ELSE '"' END || line) AS line
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents)"""

ORACLES = {
    "store_sales": f"""
WITH {_ITEMS}
SELECT 'Mağaza ' || o_custkey || ' MMC' AS store_name, CAST(sum(n) AS BIGINT) AS n_items,
       CASE WHEN sum(n) > 0 THEN CAST(sum(total_cents) AS DOUBLE) / 100 END AS sales
FROM receipt GROUP BY 1""",
    "items_roundtrip": _line_sql(),
    "items_roundtrip_units": _line_sql(),
    "items_wrapped_names": _line_sql(
        "CASE WHEN l_orderkey % 5 = 3 THEN 'qırıq Mal ' || l_partkey || ' ' || l_returnflag || ' (kq)' ELSE "
        + _PLAIN_NAME
        + " END"
    ),
    "items_vat_lines": _line_sql(),
    "items_bad_number": _line_sql(rebate_if="l_orderkey % 4 <> 0"),
    "items_empty_names": f"""
SELECT {_LINE_FILE}, CAST(0 AS INTEGER) AS line_no, {_PLAIN_NAME} AS item_name,
       l_quantity AS quantity, l_extendedprice AS unit_price, l_extendedprice AS line_total
FROM lineitem WHERE l_orderkey % 3 <> 0
UNION ALL
SELECT {_LINE_FILE}, CAST(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE 1 END AS INTEGER), 'Endirim K', 1.0, l_discount, l_discount
FROM lineitem""",
    "header_spellings": f"""
SELECT {_FILENAME} AS filename, o_orderpriority AS store_address, o_custkey || '-' || (o_orderkey % 9) AS store_code,
       CAST(o_orderkey AS VARCHAR) AS receipt_number, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS fiscal_id
FROM orders""",
    "receipt_gaps": f"""
SELECT {_FILENAME} AS filename, CAST(1 AS BIGINT) AS n_items, -1.0::DOUBLE AS gap FROM orders WHERE o_orderkey % 5 = 0""",
    "items_fallback": f"""
SELECT {_FILENAME} AS filename,
       CASE WHEN o_orderkey % 17 = 0 THEN 'cannot identify image file' ELSE 'Item parsing failed' END AS error,
       CAST(NULL AS VARCHAR) AS item_name,
       CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(o_custkey + 1000000000 AS VARCHAR) END AS tax_id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_custkey % 6 = 1 THEN printf('%.2f', o_totalprice) ELSE '0.00' END AS cash_payment
FROM orders WHERE o_orderkey % 17 = 0 OR o_orderkey % 6 = 0""",
    "header_fields": f"WITH {_ITEMS} SELECT {_HEADER_SQL} FROM receipt",
    "header_missing": f"""
SELECT {', '.join(f"count(*) FILTER (WHERE o_orderkey % 11 = 0) AS {c}_missing" for c in _OPTIONAL)},
       count(*) FILTER (WHERE o_orderstatus <> 'P') AS refund_date_missing, CAST(0 AS BIGINT) AS store_name_missing
FROM orders""",
    "payments_default": f"SELECT {_FILENAME} AS filename, {_PAYMENT_SQL} FROM orders",
    "sale_timestamp": f"""
SELECT {_FILENAME} AS filename,
       date_trunc('day', o_orderdate) + to_seconds(o_orderkey % 24 * 3600 + o_orderkey % 60 * 60 + o_orderkey * 7 % 60) AS sold_at,
       CASE WHEN o_orderstatus = 'P' THEN date_trunc('day', o_orderdate) + to_seconds(o_orderkey % 24 * 3600 + o_orderkey % 60 * 60) END AS refunded_at,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS refund_amount
FROM orders""",
    "receipt_30col": f"WITH {_WIDE} SELECT {', '.join(COLUMNS)} FROM wide",
    "receipt_reconciliation": f"""
WITH {_ITEMS}
SELECT {_FILENAME} AS filename, n AS n_items, CASE WHEN n > 0 THEN total_cents / 100.0 END AS items_total,
       total_cents / 100.0 AS subtotal, CASE WHEN n > 0 THEN 0.0::DOUBLE END AS gap
FROM receipt""",
    "receipt_sizes": "SELECT o_orderkey % 6 AS n_items, count(*) AS n_receipts FROM orders GROUP BY 1",
    "distinct_receipts": f"SELECT DISTINCT {_FILENAME} AS filename FROM orders",
    "field_fill_rate": f"""
WITH {_WIDE},
rates AS (SELECT {', '.join(f'count({c}) / count(*)::DOUBLE AS {c}' for c in COLUMNS)} FROM wide)
SELECT metric, round(value, 9) AS value FROM (UNPIVOT rates ON {', '.join(COLUMNS)} INTO NAME metric VALUE value)""",
    "payment_failures": """
SELECT count(*) FILTER (WHERE o_custkey % 6 = 5 OR o_totalprice <= 0) / count(*)::DOUBLE AS payment_failure_rate FROM orders""",
    "math_accuracy": """
SELECT (count(*) + count(*) FILTER (WHERE NOT abs(l_extendedprice - l_quantity * l_extendedprice) > 0.01)) / (2 * count(*))::DOUBLE AS math_accuracy
FROM lineitem""",
    "suspicious_rate": "SELECT count(*) FILTER (WHERE l_quantity > 30) / (2 * count(*))::DOUBLE AS suspicious_rate FROM lineitem",
    "csv_roundtrip": f"WITH {_WIDE} SELECT {', '.join(COLUMNS)} FROM wide",
    "sale_date_parquet": f"""
WITH {_WIDE}
SELECT CAST(date_trunc('month', strptime(date, '%d.%m.%Y')) AS DATE) AS sale_date, count(*) AS n_rows,
       CAST(sum(CAST(line_total AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM wide GROUP BY 1""",
    "sale_dates_rerun": f"""
WITH {_WIDE}
SELECT CAST(strptime(date, '%d.%m.%Y') AS DATE) AS sale_date, count(*) AS n_rows,
       CAST(sum(CAST(line_total AS DECIMAL(18,2))) AS DOUBLE) AS sales,
       CAST(max(CASE WHEN CAST(substr(filename, 1, 12) AS BIGINT) % 3 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS run
FROM wide GROUP BY 1""",
    "incremental_items": f"""
WITH {_ITEMS}
SELECT {_FILENAME} AS filename, CAST(i - 1 AS INTEGER) AS line_no, item_name, quantity, unit_price,
       line_cents / 100.0 AS line_total, CASE WHEN i IS NULL THEN 'Item parsing failed' END AS error
FROM receipt LEFT JOIN items ON o_orderkey = k""",
    "ocr_table": _line_sql(),
    "document_line_clean": f"""
WITH raw AS ({_RAW_LINES})
SELECT doc_id, line_no, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
         line, '^v?ƏDV[: \t]*[0-9]+[: \t]*', ''), '^"?ƏDV[: \t]*[0-9]+[: \t]*', ''),
         '^["'']|["'']$', '', 'g'), '[ \t]+', ' ', 'g')) AS item_name
FROM raw WHERE line <> '' AND NOT starts_with(line, '*ƏDV')""",
    "document_headers": """
SELECT doc_id || '.png' AS filename, CAST(doc_id AS VARCHAR) AS tax_id, '2.50' AS cash_payment,
       CAST(NULL AS VARCHAR) AS item_name, 'Item parsing failed' AS error
FROM documents""",
}
