"""Queries over model answers. Their SQL reads ``orders``, never the answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.fixtures.answers import FIELDS, UNUSABLE, emptied_answers, flawed_answers, order_answers, order_filename
from fiscalframe.fixtures.slips import line_slips, order_slips
from fiscalframe.fixtures.tables import table
from fiscalframe.operators.quality import compare_extractors, run_summary
from fiscalframe.operators.requests import SYSTEM_PROMPT, USER_PROMPT, build_requests, next_requests
from fiscalframe.operators.responses import (
    array_text,
    attempt_outcomes,
    attempt_states,
    first_good_attempt,
    item_value,
    items_from_response,
    merge_attempt_states,
    rejected_items,
    strip_fences,
)
from fiscalframe.operators.states import (
    SUMMARY,
    compare_states,
    estimated_receipts,
    merge_receipt_states,
    merge_totals,
    receipt_states,
    run_totals,
    sketch_error,
    summary_figures,
)
from fiscalframe.plans.receipts import parse_receipts
from fiscalframe.plans.responses import recover_receipts
from fiscalframe.schema import conform, unite
from fiscalframe.sources.inputs import read_responses
from fiscalframe.sources.outputs import scratch_path
from fiscalframe.streaming.answers import current_receipts, keep_answers, stream_responses

_SHOWN = ("item_name", "quantity", "unit_price", "line_total")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_answers(table(spark, sf_dir, "orders"))


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders in as many tasks as a shuffle has: one task reads a whole row group, and files may have few."""
    orders = table(spark, sf_dir, "orders")
    return orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *orders.columns)


def _receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(order_filename().alias("filename"))


def _attempt_items(first: DataFrame) -> DataFrame:
    shown = (*_SHOWN, "store_name", "date", "subtotal")
    items = first.select("filename", F.posexplode(items_from_response(F.col("response"), shown)).alias("line_no", "item"))
    return items.select("filename", "line_no", *[item_value(F.col("item"), c).alias(c) for c in shown])


def _strict(answers: DataFrame) -> DataFrame:
    """The one strict answer every order has among its later attempts."""
    later = F.col("attempt") == F.when(F.col("response").startswith("["), F.col("attempt"))
    return answers.filter((F.col("attempt") > 0) & later)


def _styled(shape):
    """Items of one answer per order, all written in the same style."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _attempt_items(_strict(_answers(spark, sf_dir)).withColumn("response", shape(F.col("response"))))

    return query


def response_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's array without its closing bracket and with a torn object behind."""
    torn = F.concat(F.substr("response", F.lit(1), F.length("response") - 1), F.lit(', {"item_name": "kəs'))
    return _attempt_items(_strict(_answers(spark, sf_dir)).withColumn("response", torn))


def response_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fence removal and array location on every conversation turn, every third one fenced."""
    turns = table(spark, sf_dir, "conversations")
    fenced = F.concat(F.lit("```json\n"), F.col("text"), F.lit("\n```"))
    bracketed = F.concat(F.lit("see [1"), F.col("text"), F.lit("] ok"))
    kind = F.col("conv_id") % 3
    response = F.when(kind == 0, fenced).when(kind == 1, bracketed).otherwise(F.col("text"))
    return turns.select(
        "conv_id",
        "turn",
        F.length(strip_fences(response)).cast("bigint").alias("unfenced_chars"),
        F.length(array_text(response)).cast("bigint").alias("array_chars"),
    )


def response_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = first_good_attempt(_answers(spark, sf_dir), columns=_SHOWN)
    items = chosen.select("filename", F.posexplode("items").alias("line_no", "item"))
    return items.select("filename", "line_no", *[f"item.{c}" for c in _SHOWN])


def response_two_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many items each receipt gets if only two attempts count."""
    chosen = first_good_attempt(_answers(spark, sf_dir), max_attempts=2, columns=_SHOWN)
    return chosen.select("filename", F.greatest(F.size("items"), F.lit(0)).alias("n_items"))


def response_missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of answers in which every field is unusable on some."""
    answers = flawed_answers(table(spark, sf_dir, "lineitem"))
    items = answers.select("filename", F.posexplode(items_from_response(F.col("response"), _SHOWN)).alias("line_no", "item"))
    return items.select("filename", "line_no", *[f"item.{c}" for c in _SHOWN])


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_items(flawed_answers(table(spark, sf_dir, "lineitem")))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attempt_outcomes(_answers(spark, sf_dir))


def response_emptied_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempt_items(emptied_answers(table(spark, sf_dir, "orders"))).select("filename", "line_no", *_SHOWN)


def response_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recover_receipts(_receipts(spark, sf_dir), _answers(spark, sf_dir))
    failed = rows.filter(F.col("error").isNotNull())
    return failed.select("source_filename", "filename", "item_name", "cash_payment", "bonus_payment", "date", "error")


def response_30col(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers stored as parquet, read as a source, recovered for every receipt."""
    path = scratch_path(spark, "responses")
    _answers(spark, sf_dir).write.parquet(path)
    rows = recover_receipts(_receipts(spark, sf_dir), read_responses(spark, path))
    return rows.select("source_filename", "filename", "store_name", "date", *_SHOWN, "subtotal", "cash_payment", "error")


def answers_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers in three batches, later attempts first, each taken in as it arrives."""
    path, out, checkpoint = (scratch_path(spark, name) for name in ("arriving", "kept", "progress"))
    answers = _answers(spark, sf_dir)
    for attempt in (2, 1, 0):
        answers.filter(F.col("attempt") == attempt).write.mode("append").parquet(path)
        keep_answers(stream_responses(spark, path), out, checkpoint).awaitTermination()
    rows = current_receipts(_receipts(spark, sf_dir), out)
    return rows.select("source_filename", "filename", "store_name", "date", *_SHOWN, "subtotal", "cash_payment", "error")


def requests_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is asked next: all receipts have had a first attempt, those with an even key a second one too."""
    answers = _answers(spark, sf_dir)
    second = answers.filter((F.col("attempt") == 1) & (F.substring("filename", 12, 1).cast("int") % 2 == 0))
    states = merge_attempt_states(attempt_states(answers.filter("attempt = 0")), attempt_states(second))
    requests = next_requests(order_slips(table(spark, sf_dir, "orders")), states, most=3)
    asked = F.contains(F.col("messages")[1]["content"], F.col("filename")) & (F.size("messages") == 2)
    return requests.select("filename", "attempt", asked.alias("names_receipt"))


def response_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict answers in which objects repeat keys and hold ``NaN``, in strings too."""
    doubled = F.replace("response", F.lit('"quantity":'), F.lit('"quantity":"N/A", "quantity" : '))
    doubled = F.replace(doubled, F.lit('"store_name":'), F.lit('"note":"NaN, \\"x\\": -Infinity", "store_name":NaN, "other":[NaN, {"a":-Infinity}],\n"store_name":'))
    return _attempt_items(_strict(order_answers(_dealt(spark, sf_dir))).withColumn("response", doubled))


def response_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = recover_receipts(_receipts(spark, sf_dir), _answers(spark, sf_dir))
    return rows.groupBy(
        F.coalesce(F.array_join("repair", ","), F.lit("none")).alias("repairs"), "suspicious_quantity", "high_price", "error"
    ).agg(F.count("*").alias("n_rows"))


def run_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipts = _receipts(spark, sf_dir)
    return run_summary(recover_receipts(receipts, _answers(spark, sf_dir)), receipts)


_RUNS = 3


def _runs(items: DataFrame, label: str) -> list[DataFrame]:
    """The rows dealt over three runs, so that most receipts are in several; each stored."""
    spark = items.sparkSession
    path = scratch_path(spark, label)
    dealt = F.pmod(F.xxhash64("filename", "item_name"), F.lit(_RUNS))
    items.withColumn("run", dealt).write.partitionBy("run").parquet(path)
    return [spark.read.parquet(path).filter(F.col("run") == i).drop("run") for i in range(_RUNS)]


def _stored_states(items: DataFrame, label: str, columns) -> DataFrame:
    """The states of three runs, stored and merged."""
    spark = items.sparkSession
    path = scratch_path(spark, f"{label}-states")
    for i, run in enumerate(_runs(items, label)):
        receipt_states(run, columns).write.parquet(f"{path}/run={i}")
    return merge_receipt_states(*[spark.read.parquet(f"{path}/run={i}") for i in range(_RUNS)])


def merged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary out of the states of three runs, and whether the sketches' estimates keep their bound."""
    receipts = _receipts(spark, sf_dir)
    rows = recover_receipts(receipts, _answers(spark, sf_dir))
    runs = _runs(rows, "runs")
    path = scratch_path(spark, "states")
    for i, run in enumerate(runs):
        receipt_states(run, tuple(SUMMARY)).write.parquet(f"{path}/receipts/run={i}")
        run_totals(run, tuple(SUMMARY)).write.parquet(f"{path}/totals/run={i}")
    states = merge_receipt_states(*[spark.read.parquet(f"{path}/receipts/run={i}") for i in range(_RUNS)])
    totals = estimated_receipts(merge_totals(spark.read.parquet(f"{path}/totals").drop("run")))
    off = F.abs(totals.select("receipts").scalar() - F.col("unique_receipts"))
    within = off <= F.lit(sketch_error()) * F.col("unique_receipts")
    return summary_figures(states, receipts).withColumn("estimate_within_bound", within)


def merged_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison of both extractors out of stored states."""
    by_pattern = parse_receipts(order_slips(table(spark, sf_dir, "orders")))
    by_model = recover_receipts(_receipts(spark, sf_dir), _answers(spark, sf_dir))
    states = {name: _stored_states(rows, name, _COMPARED) for name, rows in (("pattern", by_pattern), ("model", by_model))}
    return compare_states(states).select("metric", *[F.round(c, 9).alias(c) for c in ("pattern", "model", "difference")])


def request_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = build_requests(line_slips(table(spark, sf_dir, "lineitem")))
    return requests.select(
        "filename",
        F.col("messages")[0]["role"].alias("first_role"),
        F.col("messages")[0]["content"].alias("system_prompt"),
        F.col("messages")[1]["role"].alias("second_role"),
        F.col("messages")[1]["content"].alias("user_prompt"),
    )


_COMPARED = ("store_name", "store_address", "date", "item_name", "subtotal")


def extractor_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_pattern = parse_receipts(order_slips(table(spark, sf_dir, "orders")))
    by_model = recover_receipts(_receipts(spark, sf_dir), _answers(spark, sf_dir))
    compared = compare_extractors({"pattern": by_pattern, "model": by_model}, _COMPARED)
    return compared.select("metric", *[F.round(c, 9).alias(c) for c in ("pattern", "model", "difference")])


def united_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both extractors' rows appended and brought to the 30 columns."""
    by_pattern = parse_receipts(order_slips(table(spark, sf_dir, "orders"))).select("filename", "tax_id", *_SHOWN)
    by_model = recover_receipts(_receipts(spark, sf_dir), _answers(spark, sf_dir)).select("filename", "store_name", *_SHOWN)
    both = conform(unite(by_pattern, by_model))
    return both.groupBy("filename").agg(
        F.count("*").alias("n_rows"),
        F.count("tax_id").alias("with_tax_id"),
        F.count("store_name").alias("with_store"),
        F.count("item_name").alias("with_item"),
    )


QUERIES = {
    "response_strict": _styled(lambda r: r),
    "response_fenced": _styled(lambda r: F.concat(F.lit(" ```json\n"), r, F.lit("\n``` "))),
    "response_prose": _styled(lambda r: F.concat(F.lit("Items: "), r, F.lit(" - done"))),
    "response_salvage": response_salvage,
    "response_shapes": response_shapes,
    "response_attempts": response_attempts,
    "response_two_attempts": response_two_attempts,
    "response_missing_values": response_missing_values,
    "response_emptied_names": response_emptied_names,
    "attempt_outcomes": outcomes,
    "rejected_items": rejected,
    "response_fallback": response_fallback,
    "response_30col": response_30col,
    "response_repeated_keys": response_repeated_keys,
    "answers_stream": answers_stream,
    "next_requests": requests_again,
    "response_audit": response_audit,
    "run_summary": run_figures,
    "merged_summary": merged_summary,
    "merged_comparison": merged_comparison,
    "request_prompts": request_prompts,
    "extractor_comparison": extractor_comparison,
    "united_results": united_results,
}

# --- the same in SQL -------------------------------------------------------

_FILENAME = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.jpeg'"
_LINE_FILE = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
_CENTS = "((o_custkey * 7 + i * 13) % 2000 + 5)"
_QUANTITY = "((o_orderkey + i) % 40 + 1)"

# Every item of every order, as one validation leaves it, and as two do.
_ALL = f"""
every AS (
  SELECT {_FILENAME} AS filename, o_orderkey AS k, o_custkey % 7 AS style, o_orderkey % 5 AS n, i,
         o_orderkey % 13 = 0 AND i = 1 AS odd, (o_orderkey + i) % 9 = 0 AS lost,
         'Mal ' || (o_custkey + i) || ' A' AS base_name, 'Mağaza ' || o_custkey AS store_name,
         strftime(o_orderdate, '%d.%m.%Y') AS date,
         CASE WHEN o_orderkey % 4 = 0 THEN '0.00' ELSE printf('%.2f', o_totalprice) END AS subtotal,
         CASE WHEN o_orderkey % 13 = 0 AND i = 1 THEN 1500.0 ELSE CAST({_QUANTITY} AS DOUBLE) END AS quantity,
         CASE WHEN o_orderkey % 13 = 0 AND i = 1 THEN 1.0 ELSE {_CENTS} / 100.0 END AS unit_price,
         CASE WHEN o_orderkey % 13 = 0 AND i = 1 THEN 1500.0 ELSE {_QUANTITY} * {_CENTS} / 100.0 END AS line_total
  FROM (SELECT *, unnest(range(1, o_orderkey % 5 + 1)) AS i FROM orders))"""
_CHOSEN = f"""
{_ALL},
chosen AS (
  SELECT filename, k, CAST(i - 1 AS INTEGER) AS line_no, odd, lost, store_name, date, subtotal, unit_price,
         style = 4 AND n > 1 AS salvaged,
         base_name || CASE WHEN style >= 5 OR (style = 4 AND n = 1) THEN ' II' ELSE '' END AS item_name,
         CASE WHEN odd AND style = 4 AND n > 1 THEN 1.5 ELSE quantity END AS quantity,
         CASE WHEN odd AND style = 4 AND n > 1 THEN 1.5 ELSE line_total END AS line_total
  FROM every WHERE NOT (style = 4 AND n > 1 AND i = n)),
wide AS (
  SELECT {_FILENAME} AS source_filename, {_FILENAME} AS filename, store_name, date, item_name, quantity, unit_price,
         line_total, subtotal, CASE WHEN line_no IS NULL THEN '0.00' END AS cash_payment, odd, lost, salvaged,
         CASE WHEN line_no IS NULL THEN 'AI extraction failed' END AS error
  FROM orders LEFT JOIN chosen ON o_orderkey = k)"""
_ONCE = f"""
WITH {_ALL}
SELECT filename, CAST(i - 1 AS INTEGER) AS line_no, base_name || ' II' AS item_name, quantity, unit_price, line_total,
       store_name, date, subtotal FROM every"""
_WIDE = f"""
WITH {_CHOSEN}
SELECT source_filename, filename, store_name, date, item_name, quantity, unit_price, line_total, subtotal, cash_payment, error FROM wide"""
_TWICE = f"""
WITH {_ALL}
SELECT filename, CAST(i - 1 AS INTEGER) AS line_no, base_name || ' II' AS item_name,
       CASE WHEN odd THEN 1.5 ELSE quantity END AS quantity, unit_price,
       CASE WHEN odd THEN 1.5 ELSE line_total END AS line_total, store_name, date, subtotal FROM every"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_HEAD, _MIDDLE, _BEFORE_TEXT, _END = (_quoted(part) for part in USER_PROMPT)

ORACLES = {
    "response_strict": _ONCE,
    "response_fenced": _ONCE,
    "response_prose": _ONCE,
    "response_salvage": _TWICE,
    "response_shapes": r"""
WITH turns AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 3 = 1 THEN 'see [1' || text || '] ok' ELSE text END AS t FROM conversations),
stripped AS (SELECT conv_id, turn, regexp_replace(t, '^\s+|\s+$', '', 'g') AS t FROM turns)
SELECT conv_id, turn, length(t) AS unfenced_chars,
       CASE WHEN starts_with(t, '[') THEN length(t) ELSE nullif(length(regexp_extract(t, '(?s)\[.*\]', 0)), 0) END AS array_chars
FROM stripped""",
    "response_attempts": f"WITH {_CHOSEN} SELECT filename, line_no, item_name, quantity, unit_price, line_total FROM chosen",
    "response_fallback": f"""
WITH {_CHOSEN}
SELECT source_filename, filename, item_name, '0.00' AS cash_payment, '0.00' AS bonus_payment, date, error
FROM wide WHERE error IS NOT NULL""",
    "response_30col": _WIDE,
    "answers_stream": _WIDE,
    "response_repeated_keys": _ONCE,
    "next_requests": f"""
SELECT {_FILENAME} AS filename, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS attempt, true AS names_receipt
FROM orders WHERE o_orderkey % 5 = 0 OR o_custkey % 7 = 6 OR o_orderkey % 2 = 1 AND (o_custkey % 7 = 5 OR o_custkey % 7 = 4 AND o_orderkey % 5 = 1)""",
    "response_audit": f"""
WITH {_CHOSEN}
SELECT CASE WHEN error IS NOT NULL THEN 'none' WHEN odd AND salvaged THEN 'ocr_quantity,ocr_quantity,line_total'
            WHEN odd OR lost THEN 'ocr_quantity' ELSE '' END AS repairs,
       quantity > 50 AS suspicious_quantity, unit_price > 500 AS high_price, error, count(*) AS n_rows
FROM wide GROUP BY ALL""",
    "run_summary": f"""
WITH {_CHOSEN}
SELECT count(DISTINCT filename) AS unique_receipts, count(*) AS item_rows, count(store_name) AS rows_with_store_name,
       CAST(0 AS BIGINT) AS rows_with_address, count(item_name) AS rows_with_item, count(date) AS rows_with_date,
       printf('%.1f', count(*) / count(DISTINCT filename))::DOUBLE AS rows_per_receipt,
       count(DISTINCT CASE WHEN error IS NULL THEN filename END) / count(DISTINCT filename)::DOUBLE AS success_rate,
       (SELECT count(*) FROM orders) * 0.03::DOUBLE AS cost
FROM wide""",
    "response_two_attempts": f"""
SELECT {_FILENAME} AS filename,
       CAST(CASE WHEN o_custkey % 7 = 6 THEN 0 WHEN o_custkey % 7 = 4 AND o_orderkey % 5 > 1 THEN o_orderkey % 5 - 1 ELSE o_orderkey % 5 END AS INTEGER) AS n_items
FROM orders""",
    "response_missing_values": f"""
WITH judged AS (SELECT *, {_LINE_FILE} AS filename FROM lineitem)
SELECT filename, CAST(0 AS INTEGER) AS line_no, 'Mal ' || l_partkey AS item_name,
       3.0::DOUBLE AS quantity, 0.5::DOUBLE AS unit_price, 1.5::DOUBLE AS line_total FROM judged""",
    "rejected_items": f"""
WITH judged AS (SELECT *, {_LINE_FILE} AS filename FROM lineitem)
SELECT filename, CAST(0 AS INTEGER) AS attempt, CAST(0 AS INTEGER) AS position,
       CASE l_partkey % 4 {' '.join(f"WHEN {i} THEN '{f} '" for i, f in enumerate(FIELDS))} END
       || CASE l_suppkey % 5 {' '.join(f"WHEN {i} THEN '{why}'" for i, (_, why) in enumerate(UNUSABLE))} END AS reason
FROM judged
UNION ALL
SELECT filename, 0, 2, 'not an object' FROM judged WHERE l_orderkey % 7 = 0""",
    "attempt_outcomes": f"""
WITH tried AS (
  SELECT {_FILENAME} AS filename, o_custkey % 7 AS style, o_orderkey % 5 AS n, unnest([0, 1, 2]) AS attempt FROM orders),
judged AS (
  SELECT filename, attempt, CASE
    WHEN attempt = 0 AND style IN (5, 6) OR attempt = 1 AND style = 6 THEN 'no_array'
    WHEN attempt = 0 AND style = 4 THEN CASE WHEN n > 1 THEN 'salvaged' ELSE 'broken' END
    WHEN n = 0 THEN 'no_valid_item' ELSE 'ok' END AS outcome, n
  FROM tried WHERE attempt < 2 OR style = 6)
SELECT filename, CAST(attempt AS INTEGER) AS attempt, outcome,
       CAST(CASE outcome WHEN 'ok' THEN n WHEN 'salvaged' THEN n - 1 ELSE 0 END AS INTEGER) AS n_items FROM judged""",
    "response_emptied_names": f"""
SELECT {_FILENAME} AS filename, CAST(i AS INTEGER) AS line_no, CASE WHEN i = 0 THEN '' ELSE 'ok' END AS item_name,
       1.0::DOUBLE AS quantity, 2.0::DOUBLE AS unit_price, 2.0::DOUBLE AS line_total
FROM (SELECT *, unnest([0, 1]) AS i FROM orders)""",
    "request_prompts": f"""
WITH slips AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS filename,
         concat_ws(chr(10), 'Məhsulun adı Say Qiymət Cəmi',
           printf('Mal %d %s %d.000 %.2f %.2f', l_partkey, l_returnflag, l_quantity::BIGINT, l_extendedprice, l_extendedprice),
           printf('Endirim K 1.000 %.2f %.2f', l_discount, l_discount),
           printf('Cəmi %.2f', l_extendedprice)) AS text
  FROM lineitem)
SELECT filename, 'system' AS first_role, {_quoted(SYSTEM_PROMPT)} AS system_prompt, 'user' AS second_role,
       {_HEAD} || filename || {_MIDDLE} || filename || {_BEFORE_TEXT} || text || {_END} AS user_prompt
FROM slips""",
    "extractor_comparison": f"""
WITH {_CHOSEN},
pattern AS (
  SELECT count(*) AS n, sum(o_orderkey % 6) AS items, sum(greatest(o_orderkey % 6, 1)) AS n_rows,
         count(*) FILTER (WHERE o_custkey % 6 = 5 OR o_totalprice <= 0) AS unpaid FROM orders),
model AS (
  SELECT count(*) AS n_rows, count(item_name) AS items, count(subtotal) AS totals, count(*) FILTER (WHERE quantity > 50) AS large,
         count(DISTINCT filename) AS n FROM wide),
long AS (
  SELECT 'store_name' AS metric, 1.0::DOUBLE AS pattern, items / n_rows::DOUBLE AS model FROM model
  UNION ALL SELECT 'store_address', 1.0, 0.0
  UNION ALL SELECT 'date', 1.0, items / n_rows::DOUBLE FROM model
  UNION ALL SELECT 'subtotal', 1.0, totals / n_rows::DOUBLE FROM model
  UNION ALL SELECT 'item_name', (SELECT items / n_rows::DOUBLE FROM pattern), items / n_rows::DOUBLE FROM model
  UNION ALL SELECT 'math_accuracy', 1.0, 1.0
  UNION ALL SELECT 'suspicious_rate', 0.0, large / items::DOUBLE FROM model
  UNION ALL SELECT 'payment_failure_rate', (SELECT unpaid / n::DOUBLE FROM pattern), 1.0
  UNION ALL SELECT 'items_per_receipt', (SELECT items / n::DOUBLE FROM pattern), items / n::DOUBLE FROM model)
SELECT metric, round(pattern, 9) AS pattern, round(model, 9) AS model, round(model - pattern, 9) AS difference FROM long""",
    "united_results": f"""
WITH {_CHOSEN},
per_receipt AS (SELECT filename, count(*) AS n, count(item_name) AS items FROM wide GROUP BY 1)
SELECT o.f AS filename, greatest(o_orderkey % 6, 1) + n AS n_rows,
       CASE WHEN o_orderkey % 11 <> 0 THEN greatest(o_orderkey % 6, 1) ELSE 0 END AS with_tax_id,
       items AS with_store, o_orderkey % 6 + items AS with_item
FROM (SELECT *, {_FILENAME} AS f FROM orders) o JOIN per_receipt ON o.f = per_receipt.filename""",
}
ORACLES["merged_summary"] = f"SELECT *, true AS estimate_within_bound FROM ({ORACLES['run_summary']})"
ORACLES["merged_comparison"] = ORACLES["extractor_comparison"]
