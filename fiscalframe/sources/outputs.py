"""Writers: the CSV layout and date-partitioned parquet."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalframe.functions.numbers import two_decimal_text
from fiscalframe.schema import TEXT_LAYER, conform, typed


def is_one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    A session on one machine that names none gets a temporary folder; on a
    cluster that would be a different folder on every host, so it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not is_one_machine(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="fiscalframe-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str, two_decimals: bool = False, mode: str = "errorifexists") -> None:
    """The 30 columns as UTF-8 CSV with header; nulls and empty strings are empty.

    ``two_decimals`` writes price and total as ``2.10``, the form validated
    model answers have; otherwise as plain numbers (``2.1``).
    """
    out = conform(df)
    if two_decimals:
        out = out.withColumns({c: two_decimal_text(F.col(c)) for c in ("unit_price", "line_total")})
    (
        out.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read back what ``write_csv`` wrote; names may hold line breaks."""
    return (
        spark.read.schema(TEXT_LAYER)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_by_sale_date(df: DataFrame, path: str, by_month: bool = False, mode: str = "errorifexists") -> None:
    """Typed layer as parquet, one folder per sale date, or per month for small tables.

    ``rebalance`` brings the rows of a folder together and lets adaptive
    execution split a folder that is too large for one task.
    """
    _dated(df, by_month).hint("rebalance", "sale_date").write.mode(mode).partitionBy("sale_date").parquet(path)


def _dated(df: DataFrame, by_month: bool) -> DataFrame:
    day = F.col("sold_at").cast("date")
    return typed(conform(df)).withColumn("sale_date", F.trunc(day, "month") if by_month else day)


_MANIFEST = "sale_date date, n_rows long, content long, run long"


def finished_dates(spark: SparkSession, path: str) -> DataFrame:
    """``(sale_date, n_rows, content, run)``: what ``rewrite_changed_dates`` has finished, the last state of each date."""
    notes = spark.read.schema(_MANIFEST).option("ignoreMissingFiles", True)
    try:
        every = notes.parquet(f"{path.rstrip('/')}/_finished")
    except AnalysisException:
        every = spark.createDataFrame([], _MANIFEST)
    last = every.groupBy("sale_date").agg(F.max(F.struct("run", "n_rows", "content")).alias("last"))
    return last.select("sale_date", "last.n_rows", "last.content", "last.run")


def rewrite_changed_dates(df: DataFrame, path: str, by_month: bool = False) -> None:
    """Typed layer by sale date, safe to run again: only dates that are new or differ are written.

    A date is replaced as a whole, and noted as finished, with the number and
    a hash of its rows, after all are written. A run that is killed leaves
    dates without a note, which the next run writes again; a run over the same
    rows writes nothing. Dates that a run does not hold stay as they are. The
    rows are worked out twice, so store what is expensive first.
    """
    spark, rows = df.sparkSession, _dated(df, by_month)
    # A sum of hashes does not depend on the order of rows, and counts repeated ones.
    content = F.sum(F.xxhash64(*[c for c in rows.columns if c != "sale_date"]).cast("decimal(20,0)"))
    low = F.pmod(content, F.lit(1 << 62).cast("decimal(20,0)")).cast("long")
    now = rows.groupBy("sale_date").agg(F.count("*").alias("n_rows"), low.alias("content"))
    done = finished_dates(spark, path)
    same = [now[c].eqNullSafe(done[c]) for c in ("sale_date", "n_rows", "content")]
    run = done.agg(F.coalesce(F.max("run"), F.lit(-1)) + 1).first()[0]
    changed = now.join(done, same[0] & same[1] & same[2], "left_anti").withColumn("run", F.lit(run))
    # Fixed before anything is replaced: afterwards the notes would say something else.
    notes = scratch_path(spark, "changed-dates")
    changed.write.parquet(notes)
    changed = spark.read.schema(_MANIFEST).parquet(notes)
    if not changed.limit(1).count():
        return
    dates = changed.select(F.col("sale_date").alias("_date"))
    stale = rows.join(dates, rows["sale_date"].eqNullSafe(dates["_date"]), "left_semi")
    written = stale.hint("rebalance", "sale_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy("sale_date").parquet(path)
    changed.write.mode("append").parquet(f"{path.rstrip('/')}/_finished")
