"""The pattern path over new files only; the checkpoint remembers what was done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fiscalframe.plans.receipts import parse_receipts
from fiscalframe.sources.inputs import OCR_SCHEMA, text_files


def stream_ocr_table(spark: SparkSession, path: str) -> DataFrame:
    """New parquet files of an OCR table."""
    return spark.readStream.schema(OCR_SCHEMA).parquet(path)


def stream_ocr_files(spark: SparkSession, path: str) -> DataFrame:
    """New text files, one receipt each."""
    return text_files(spark.readStream.text(path, wholetext=True))


def parse_new_receipts(ocr_stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Parse everything that has arrived since the last run, then stop."""
    return (
        parse_receipts(ocr_stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
