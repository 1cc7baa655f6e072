"""The fiscal IDs whose file is there, as a table that is bucketed by ID.

A worklist against a plain file list shuffles both sides every time. The known
side only ever grows, so it is stored the way the join needs it: later
worklists shuffle the wanted IDs and read the known ones in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.operators.worklist import DOCUMENT_URL, document_url, image_name, present_ids


def present_table(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """Name the table at ``path``, which may hold IDs already; its number of buckets never changes."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` (fiscal_id STRING) USING parquet "
        f"CLUSTERED BY (fiscal_id) SORTED BY (fiscal_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def buckets_of(spark: SparkSession, name: str) -> int:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED `{name}`").collect()}
    return int(told["Num Buckets"])


def _known(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(f"`{name}`").hint("merge")


def _new(ids: DataFrame, name: str) -> DataFrame:
    """The distinct IDs that the table lacks.

    They are dealt out by the table's own buckets, so only they are shuffled;
    the first ``distinct`` leaves one row per task of an ID that is repeated
    very often.
    """
    spark = ids.sparkSession
    wanted = ids.select("fiscal_id").distinct().repartition(buckets_of(spark, name), "fiscal_id")
    return wanted.join(_known(spark, name), "fiscal_id", "left_anti")


def add_present(files: DataFrame, name: str) -> None:
    """Take in the IDs of a file list; those that are known already are not written again."""
    # One task per bucket, which writes one sorted file into it.
    _new(present_ids(files), name).write.insertInto(f"`{name}`")


def worklist_from_table(ids: DataFrame, name: str, base: str = DOCUMENT_URL) -> DataFrame:
    """What ``fetch_worklist`` gives, against the bucketed table of present IDs."""
    key = F.col("fiscal_id")
    return _new(ids, name).select("fiscal_id", document_url(key, base).alias("url"), image_name(key).alias("filename"))
