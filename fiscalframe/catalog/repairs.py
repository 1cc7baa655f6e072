"""Queries over the repair rules, straight on line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.fixtures.tables import table
from fiscalframe.operators.repair import money_text, repair_items


def raw_items(lineitem: DataFrame) -> DataFrame:
    """Items with lost decimal points (% 7), exact, halved and foreign totals (% 3), free ones (% 31)."""
    part = F.col("l_partkey")
    lost = F.col("l_orderkey") % 7 == 0
    priced = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("Mal "), part.cast("string")).alias("item_name"),
        F.when(lost, F.col("l_quantity") * 1000).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(part % 31 == 0, F.lit(0.0)).otherwise(F.floor("l_extendedprice") / F.lit(100.0)).alias("unit_price"),
        "l_quantity",
        "l_extendedprice",
        (part % 3).alias("_kind"),
    )
    total = (
        F.when(F.col("_kind") == 0, F.col("l_extendedprice"))
        .when(F.col("_kind") == 1, F.col("l_quantity") * F.col("unit_price"))
        .otherwise(F.floor(F.col("l_quantity") * F.col("unit_price") * 50) / F.lit(100.0))
    )
    return priced.select(
        "l_orderkey", "l_linenumber", "item_name", "quantity", "unit_price", total.alias("line_total")
    )


def repaired_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = repair_items(raw_items(table(spark, sf_dir, "lineitem")))
    return fixed.select("l_orderkey", "l_linenumber", "item_name", "quantity", "unit_price", "line_total")


def repair_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each combination of repairs and warnings occurs."""
    fixed = repair_items(raw_items(table(spark, sf_dir, "lineitem")))
    return fixed.groupBy(
        F.array_join("repair", ",").alias("repairs"), "suspicious_quantity", "high_price"
    ).agg(F.count("*").alias("n_items"))


def money_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as money text in every accepted and refused spelling."""
    value = F.col("value")
    spelled = (
        F.when(F.col("event_id") % 6 == 0, F.concat(F.lit(" "), value.cast("string")))
        .when(F.col("event_id") % 6 == 1, F.lit("N/A"))
        .when(F.col("event_id") % 6 == 2, F.lit("null"))
        .when(F.col("event_id") % 6 == 3, F.lit(""))
        .when(F.col("event_id") % 6 == 4, F.concat(value.cast("string"), F.lit("d")))
        .otherwise((value / 8).cast("string"))
    )
    return table(spark, sf_dir, "events").select("event_id", money_text(spelled).alias("money"))


QUERIES = {
    "repair_items": repaired_lines,
    "repair_audit": repair_audit,
    "money_format": money_format,
}

_FIXED = """
raw AS (
  SELECT l_orderkey, l_linenumber, 'Mal ' || l_partkey AS item_name, l_quantity, l_extendedprice, l_partkey % 3 AS kind,
         CASE WHEN l_orderkey % 7 = 0 THEN l_quantity * 1000 ELSE l_quantity END AS q0,
         CASE WHEN l_partkey % 31 = 0 THEN 0.0::DOUBLE ELSE floor(l_extendedprice) / 100.0::DOUBLE END AS p
  FROM lineitem),
priced AS (
  SELECT *, CASE kind WHEN 0 THEN l_extendedprice WHEN 1 THEN l_quantity * p
                 ELSE floor(l_quantity * p * 50) / 100.0::DOUBLE END AS t,
         CASE WHEN q0 >= 1000 THEN printf('%.1f', q0 / 1000)::DOUBLE ELSE q0 END AS q1
  FROM raw),
checked AS (
  SELECT *, abs(t - q1 * p) > 0.01::DOUBLE AS is_off, CASE WHEN p > 0 THEN printf('%.1f', t / p)::DOUBLE END AS implied
  FROM priced),
decided AS (
  SELECT *, is_off AND coalesce(implied > 0 AND implied <= 100, false) AS new_q FROM checked),
fixed AS (
  SELECT l_orderkey, l_linenumber, item_name, CASE WHEN new_q THEN implied ELSE q1 END AS quantity,
         printf('%.2f', p)::DOUBLE AS unit_price,
         printf('%.2f', CASE WHEN is_off AND NOT new_q THEN q1 * p ELSE t END)::DOUBLE AS line_total,
         concat_ws(',', CASE WHEN q0 >= 1000 THEN 'ocr_quantity' END, CASE WHEN new_q THEN 'quantity' END,
                   CASE WHEN is_off AND NOT new_q THEN 'line_total' END) AS repairs, p
  FROM decided)"""

ORACLES = {
    "repair_items": f"WITH {_FIXED} SELECT l_orderkey, l_linenumber, item_name, quantity, unit_price, line_total FROM fixed",
    "repair_audit": f"""
WITH {_FIXED}
SELECT repairs, quantity > 50 AS suspicious_quantity, p > 500 AS high_price, count(*) AS n_items FROM fixed GROUP BY ALL""",
    "money_format": """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN printf('%.2f', value) WHEN 1 THEN '0.00' WHEN 2 THEN 'null'
         WHEN 3 THEN '' WHEN 4 THEN '0.00' ELSE printf('%.2f', value / 8) END AS money
FROM events""",
}
