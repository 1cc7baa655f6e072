"""Mixing sources to target weights.

Tokens are summed per source, every source gets a target, and each document is
taken floor(rate) times plus once more with probability rate - floor(rate),
where rate = target / tokens of the source. The draw is a hash of seed,
document id and text, so reruns agree, and documents without id or with a
repeated one draw apart as long as their texts differ.

Targets share all tokens by weight and stop at ``most`` times a source's own
tokens; the excess goes to the others by weight until none is above. That is
target = min(most * size, weight * level) with one level for all sources,
found by a few sums over the table of sources.

Defined results: a null text has no tokens, documents without source form a
source of their own, a source without tokens gets nothing. Rows that repeat
both id and text share their draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalframe.llm.shared import WORD, packed, stored, unpacked, with_position

SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(documents: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    sized = documents.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``; weights repeat by code point, null last."""
    placed = with_position(sizes, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(placed.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    limit, share = most * F.col("source_size"), F.col("weight").cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        full = share * F.lit(level) > limit
        now, held, open_ = sources.agg(F.count_if(full), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        if now == stopped or not open_:
            break
        level, stopped = float(total - (held or 0)) / float(open_), now
    target = F.when(share * F.lit(level) > limit, limit.cast("double")).otherwise(share * F.lit(level))
    return sources.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of a hash of seed, id and text; null counts as empty."""
    own = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text.cast("string"), F.lit(""))))
    return F.conv(F.substring(F.md5(own), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(target: Column, source_size: Column, drawn: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("int")).cast("long")


def mixture(documents: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies, taken``."""
    drawn = draw(F.col("doc_id"), F.col("text"), seed).alias("_drawn")
    sized = documents.select("doc_id", F.col("source"), word_count(F.col("text")).alias("size"), drawn)
    # The texts are read once; sizes, ids and draws are all that is needed from here.
    sized = stored(sized, "sized")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    out = joined.withColumn("copies", copies(F.col("target"), F.col("source_size"), F.col("_drawn")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(documents: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: str = SEED) -> DataFrame:
    """The documents themselves, each as often as it is taken, with all their columns."""
    targets = source_targets(source_sizes(documents), weights, most).withColumnRenamed("source", "_source")
    rows = documents.select(packed(documents).alias("_row"))
    joined = rows.join(targets, F.col("_row")["source"].eqNullSafe(F.col("_source")))
    n = copies(F.col("target"), F.col("source_size"), draw(F.col("_row")["doc_id"], F.col("_row")["text"], seed))
    times = joined.select("_row", n.cast("int").alias("_n")).filter("_n > 0")
    return unpacked(times.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")))
