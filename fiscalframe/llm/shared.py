"""Helpers of the corpus operators: intermediate tables, ranks, row packing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalframe.sources.outputs import scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Removes the shuffle files of a write when it has ended; else they stay until the driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a few numbers each that make one file, about.
ROWS_A_FILE = 1 << 17


def stored(df: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, on storage that outlives executors.

    ``most``: a known bound on the rows of a narrow table, which is then written
    by no more tasks than so many rows need. Each file costs its task a few
    calls of the store, on a local one even processes.
    """
    path = scratch_path(df.sparkSession, label)
    if most is not None:
        df = df.coalesce(max(1, -(-most // ROWS_A_FILE)))
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that working columns cannot clash with its names."""
    return F.struct(*[col(c) for c in df.columns])


def unpacked(df: DataFrame, row: str = "_row") -> DataFrame:
    fields = df.schema[row].dataType.names
    return df.select(*[F.col(row)[c].alias(c) for c in fields])


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32: first all lower halves, then all upper ones, which are mostly zero and pack well."""
    return (numbers & 0xFFFF).astype("<u2").tobytes() + (numbers >> 16).astype("<u2").tobytes()


def unpacked_numbers(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int64)
    return low | high << 16


#: Bits of a key filter.
FILTER_BITS = 1 << 22


def key_filter(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test for 64-bit hashes: true for all of ``keys`` and for few others.

    One bit per key in a table of fixed size, made in Spark, so that rows
    that cannot match stay out of a shuffle. Where very many keys fill the
    table it lets more pass, and only saves less: a join still has to decide.
    """

    def cell(h: Column) -> Column:
        return F.shiftright(h, 6).bitwiseAND(F.lit(FILTER_BITS // 64 - 1))

    def mark(h: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))

    every = keys.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("bits"))
    set_ = keys.groupBy(cell(F.col(key)).alias("cell")).agg(F.bit_or(mark(F.col(key))).alias("bits"))
    cells = set_.union(every).groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    table = cells.agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "bits"))), lambda s: s["bits"]))
    bits = table.scalar()
    return lambda h: F.get(bits, cell(h).cast("int")).bitwiseAND(mark(h)) != 0


def with_position(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows from 0 by a total order, without bringing them into one task.

    Rows are dealt out by range and written; each part then only needs to know
    how many rows stand before it, which is one number a part.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # A row's number within its part is in the low 33 bits.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = stored(dealt.select("*", F.spark_partition_id().alias("_part"), within.alias("_at")), "position")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return parts.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
