"""Queries over IDs, image names, fetch logs and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalframe.fixtures.slips import order_key
from fiscalframe.fixtures.tables import table
from fiscalframe.functions.html import form_token, html_attr
from fiscalframe.operators.worklist import DOCUMENT_URL, fetch_outcomes, fetch_summary, fetch_worklist, image_name, is_image
from fiscalframe.sources.inputs import folders, list_folders, read_fetch_log, read_fiscal_ids
from fiscalframe.sources.outputs import scratch_path
from fiscalframe.sources.present import add_present, present_table, worklist_from_table


def fiscal_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys written one per line with white space around them, read back."""
    path = scratch_path(spark, "ids")
    padded = F.concat(F.lit(" \t"), order_key(), F.lit("  "))
    line = F.when(F.col("o_orderkey") % 10 == 0, F.lit("  ")).otherwise(padded)
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return read_fiscal_ids(spark, path)


def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are wanted; line items stand for the images already there."""
    ids = table(spark, sf_dir, "orders").select(order_key().alias("fiscal_id"))
    files = table(spark, sf_dir, "lineitem").select(image_name(order_key("l_orderkey")).alias("filename"))
    return fetch_worklist(ids, files)


def _fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    # A purchase of high value stands for an ID that was not fetched.
    status = F.when(kind == "click", 200).when(kind == "view", 404).when(kind == "signup", 503)
    error = F.when(kind == "error", F.when(F.col("value") < 20, "timeout").otherwise("connection")).when(
        (kind == "purchase") & (F.col("value") < 60), "other"
    )
    return table(spark, sf_dir, "events").select(
        order_key("user_id").alias("fiscal_id"), status.alias("status_code"), error.alias("error")
    )


def _customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of customers in one market segment."""
    there = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return there.select(image_name(order_key("c_custkey")).alias("filename"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fetch-log")
    _fetch_log(spark, sf_dir).write.parquet(path)
    rows = fetch_outcomes(read_fetch_log(spark, path), _customer_files(spark, sf_dir))
    return rows.groupBy("outcome", "success").agg(F.count("*").alias("n_fetches"))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_summary(fetch_outcomes(_fetch_log(spark, sf_dir), _customer_files(spark, sf_dir)))


def image_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    ending = F.element_at(F.array(*map(F.lit, (".jpeg", ".JPG", ".png", ".Tiff", ".gif", ".jpeg.txt", "jpg"))), (key % 7 + 1).cast("int"))
    names = table(spark, sf_dir, "orders").select(F.concat(order_key(), ending).alias("filename"))
    return names.filter(is_image(F.col("filename")))


#: Customers that share a listed file, and files that a task writes in a row.
_PER_FILE, _RUN = 20, 10


def listed_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a bounded number of customers with three endings, a folder per nation, and what a listing of them finds."""
    path = scratch_path(spark, "images")
    number = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_name")) - 1
    runs = table(spark, sf_dir, "customer").select("c_nationkey", "c_name", F.floor(number / (_PER_FILE * _RUN)).alias("run"))
    # All runs but a nation's last fill their files, so it has as many files however they are dealt out.
    # The number keeps adaptive execution from giving them to few tasks: the rows are small, the files many.
    tasks = max(8, 4 * spark.sparkContext.defaultParallelism)
    names = runs.repartition(tasks, "c_nationkey", "run").drop("run")
    for ending in ("jpg", "png", "gif"):
        small = names.write.mode("append").partitionBy("c_nationkey").option("maxRecordsPerFile", _PER_FILE)
        # Tasks put their files in place themselves, not the driver one by one.
        small = small.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
        small.option("extension", ending).csv(path)
    found = list_folders(spark, folders(spark, path))
    key = F.regexp_extract("path", r"c_nationkey=(\d+)/", 1).cast("int").alias("nation")
    return found.groupBy(key, F.substring_index("filename", ".", -1).alias("ending")).agg(F.count("*").alias("n_files"))


def worklist_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worklist against a bucketed table that has taken in the present files in two parts, some of them twice."""
    path = scratch_path(spark, "present")
    name = path.rpartition("/")[2].replace("-", "_")
    present_table(spark, name, path, buckets=8)
    files = table(spark, sf_dir, "lineitem").select("l_linenumber", image_name(order_key("l_orderkey")).alias("filename"))
    add_present(files.filter("l_linenumber <= 4"), name)
    add_present(files.filter("l_linenumber >= 3"), name)
    return worklist_from_table(table(spark, sf_dir, "orders").select(order_key().alias("fiscal_id")), name)


def page_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        html_attr(html, "META", "charset").alias("charset"),
        html_attr(html, "html", "lang").alias("lang"),
        html_attr(html, "a", "href").alias("first_link"),
        html_attr(html, "div", "class", key="class", value="ad").alias("ad_class"),
        html_attr(html, "input", "value").alias("input_value"),
    )


def page_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens put into the pages: as meta tag, turned round, as form field, both, not at all."""
    page = F.col("page_id")
    token = F.concat(F.lit("t-"), page.cast("string"))
    meta = F.concat(F.lit('<head><meta name="csrf-token" content="'), token, F.lit('">'))
    turned = F.concat(F.lit("<head><META content='"), token, F.lit("' NAME='csrf-token'/>"))
    field = F.concat(F.lit('<head><input type=hidden name=_csrf value="f'), token, F.lit('">'))
    empty = F.concat(F.lit('<head><meta name="csrf-token">'), F.substring(field, 7, 1000))
    injected = F.when(page % 5 == 0, meta).when(page % 5 == 1, turned).when(page % 5 == 2, field).when(page % 5 == 3, empty).otherwise("<head>")
    html = F.replace(F.col("html"), F.lit("<head>"), injected)
    return table(spark, sf_dir, "pages").select("page_id", form_token(html).alias("token"))


def page_token_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens that do not count, in comments, scripts, styles and values, beside ones that do, with entities in them."""
    page = F.col("page_id")
    key = page.cast("string")
    in_comment = F.concat(F.lit('<head><!-- <meta name="csrf-token" content="old"> > --><meta name="csrf-token" content="a&amp;b-'), key, F.lit('">'))
    script = "<head><script>if (a < b) x = '<meta name=\"csrf-token\" content=\"js\">';</script>"
    in_script = F.concat(F.lit(script + '<input name="_csrf" value="&#233;&lt;&#x20AC;&unknown;-'), key, F.lit('">'))
    in_value = F.lit("<head><a title='<meta name=\"csrf-token\" content=\"value\">'>x</a><style>/* <input name=\"_csrf\" value=\"css\"> */</style>")
    never_closed = F.lit('<head><!-- <meta name="csrf-token" content="open">')
    head = F.when(page % 4 == 0, in_comment).when(page % 4 == 1, in_script).when(page % 4 == 2, in_value).otherwise(never_closed)
    html = F.replace(F.col("html"), F.lit("<head>"), head)
    return table(spark, sf_dir, "pages").select("page_id", form_token(html).alias("token"))


QUERIES = {
    "fiscal_ids": fiscal_ids,
    "fetch_worklist": worklist,
    "fetch_outcomes": outcomes,
    "fetch_summary": summary,
    "image_listing": image_listing,
    "listed_images": listed_images,
    "fetch_worklist_bucketed": worklist_bucketed,
    "page_attribute": page_attribute,
    "page_token": page_token,
    "page_token_hidden": page_token_hidden,
}

_ID = "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')"
_LOG = """
log AS (
  SELECT user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS there, event_type, value FROM events),
judged AS (
  SELECT CASE WHEN event_type = 'click' THEN 'downloaded'
              WHEN event_type IN ('view', 'signup') THEN 'bad_status'
              WHEN event_type = 'purchase' THEN CASE WHEN there AND NOT value < 60 THEN 'present' ELSE 'other_error' END
              WHEN value < 20 THEN 'timeout' ELSE 'connection' END AS outcome FROM log)"""

ORACLES = {
    "fiscal_ids": f"SELECT CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE {_ID} END AS fiscal_id FROM orders",
    "fetch_worklist": f"""
SELECT DISTINCT {_ID} AS fiscal_id, '{DOCUMENT_URL}' || {_ID} AS url, {_ID} || '.jpeg' AS filename
FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "fetch_outcomes": f"""
WITH {_LOG}
SELECT outcome, outcome IN ('present', 'downloaded') AS success, count(*) AS n_fetches FROM judged GROUP BY ALL""",
    "fetch_summary": f"""
WITH {_LOG}
SELECT count(*) AS total, count(*) FILTER (WHERE outcome IN ('present', 'downloaded')) AS successful,
       count(*) FILTER (WHERE outcome NOT IN ('present', 'downloaded')) AS failed FROM judged""",
    "image_listing": f"""
SELECT {_ID} || CASE o_orderkey % 7 WHEN 0 THEN '.jpeg' WHEN 1 THEN '.JPG' WHEN 2 THEN '.png' ELSE '.Tiff' END AS filename
FROM orders WHERE o_orderkey % 7 < 4""",
    "listed_images": f"""
SELECT c_nationkey AS nation, ending, CAST(ceil(count(*) / {_PER_FILE}.0) AS BIGINT) AS n_files
FROM customer, (VALUES ('jpg'), ('png')) AS e(ending) GROUP BY ALL""",
    "page_attribute": """
SELECT page_id, nullif(regexp_extract(html, '<meta charset="([^"]*)"', 1), '') AS charset,
       nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
       nullif(regexp_extract(html, '<a href="([^"]*)"', 1), '') AS first_link,
       nullif(regexp_extract(html, '<div class="(ad)"', 1), '') AS ad_class,
       CAST(NULL AS VARCHAR) AS input_value
FROM pages""",
    "page_token": """
SELECT page_id, CASE page_id % 5 WHEN 0 THEN 't-' || page_id WHEN 1 THEN 't-' || page_id WHEN 2 THEN 'ft-' || page_id
         WHEN 3 THEN 'ft-' || page_id ELSE '' END AS token FROM pages""",
    "page_token_hidden": """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'a&b-' || page_id WHEN 1 THEN 'é<€&unknown;-' || page_id ELSE '' END AS token FROM pages""",
}
ORACLES["fetch_worklist_bucketed"] = ORACLES["fetch_worklist"]
