"""Which receipts are still to be fetched, and how fetching went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Document address, image name ending, accepted image endings.
DOCUMENT_URL = "https://monitoring.e-kassa.gov.az/pks-monitoring/2.0.0/documents/"
IMAGE_ENDING = ".jpeg"
IMAGE_ENDINGS = (".jpeg", ".jpg", ".png", ".tiff")


def image_name(fiscal_id: Column) -> Column:
    return F.concat(fiscal_id, F.lit(IMAGE_ENDING))


def document_url(fiscal_id: Column, base: str = DOCUMENT_URL) -> Column:
    return F.concat(F.lit(base), fiscal_id)


def is_image(filename: Column) -> Column:
    """Ends like an image, in any letter case."""
    endings = "|".join(e.lstrip(".") for e in IMAGE_ENDINGS)
    return filename.rlike(rf"(?i)\.({endings})\z")


def present_ids(files: DataFrame) -> DataFrame:
    """IDs that have a file, each once; copies are reduced before the shuffle."""
    named = files.filter(F.col("filename").endswith(IMAGE_ENDING))
    fiscal_id = F.substr("filename", F.lit(1), F.length("filename") - len(IMAGE_ENDING))
    return named.select(fiscal_id.alias("fiscal_id")).distinct()


def fetch_worklist(ids: DataFrame, files: DataFrame, base: str = DOCUMENT_URL) -> DataFrame:
    """Each ID without a file once, with the address to fetch and the name to store.

    Both sides hold a key at most once when they meet, so no key can be hot.
    A left join with a null test, because the optimizer would move an anti join
    below the first ``distinct``; the merge hint, because it can only guess the
    size of the file list and must not broadcast it on that guess.
    """
    there = present_ids(files).withColumn("_there", F.lit(True))
    wanted = ids.select("fiscal_id").distinct()
    missing = wanted.join(there.hint("merge"), "fiscal_id", "left").filter(F.col("_there").isNull())
    key = F.col("fiscal_id")
    return missing.select("fiscal_id", document_url(key, base).alias("url"), image_name(key).alias("filename"))


def outcome(present: Column, status_code: Column, error: Column) -> Column:
    """What the log says wins; an ID that was never asked for is there or not."""
    return (
        F.when(status_code == 200, "downloaded")
        .when(status_code.isNotNull(), "bad_status")
        .when(error.isin("timeout", "connection"), error)
        .when(error.isNull() & present, "present")
        .otherwise("other_error")
    )


def fetch_outcomes(fetch_log: DataFrame, files: DataFrame) -> DataFrame:
    """The log with ``filename``, ``outcome`` and ``success``.

    A row with neither status nor error was not fetched, because its file was
    there already; that is a success. A file that came later does not change
    how an attempt went.

    Joined on the file name, not on the ID the present ones are distinct by:
    adaptive execution splits a hot ID of the log only if both sides come
    straight from a shuffle, and the second shuffle moves nothing but names.
    """
    there = present_ids(files).select(image_name(F.col("fiscal_id")).alias("filename"), F.lit(True).alias("_there"))
    log = fetch_log.withColumn("filename", image_name(F.col("fiscal_id")))
    result = outcome(F.coalesce("_there", F.lit(False)), F.col("status_code"), F.col("error"))
    judged = log.join(there.hint("merge"), "filename", "left").withColumn("outcome", result)
    return judged.select(
        *fetch_log.columns, "filename", "outcome", F.col("outcome").isin("present", "downloaded").alias("success")
    )


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.agg(
        F.count("*").alias("total"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
    )
