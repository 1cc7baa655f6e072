"""Shards of near equal bytes for groups that must stay whole, by Karmarkar-Karp differencing.

Copies of one text must not be torn apart. Differencing starts with one
partial partition a unit and repeatedly combines the two with the largest
spread, the heaviest part of one with the lightest of the other.

Groups whose bytes are at least a 16384th of all are units of their own, so
there are at most 16384 of them; all others are put together into 8192 bundles
by a hash of their text. So whatever the size of the corpus, differencing runs
over at most 24576 units, and the map of units to shards has a proven bound.

Defined results: a null text has size 1, no checksum, and is equal to other
null texts only. Empty texts have size 1. Repeated rows get slots of their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalframe.llm.shared import stored

BUNDLES = 8192
LARGEST = 16384
SLOT_ROWS = 4096


def difference(sizes: Sequence[int], parts: int) -> list[int]:
    """The part of each size, by largest differencing."""
    if not sizes:
        return []
    # A node: its sums in descending order less the smallest, and what stands behind
    # each position: a unit, or positions of the two nodes it was combined from.
    nodes: list = [(i, None, None) for i in range(len(sizes))]
    heap = [(-size, i, (size, *[0] * (parts - 1))) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, high = heapq.heappop(heap)
        _, b, low = heapq.heappop(heap)
        sums = [high[i] + low[parts - 1 - i] for i in range(parts)]
        order = sorted(range(parts), key=lambda i: (-sums[i], i))
        least = sums[order[-1]]
        nodes.append((None, (a, order), (b, [parts - 1 - i for i in order])))
        heapq.heappush(heap, (least - sums[order[0]], len(nodes) - 1, tuple(sums[i] - least for i in order)))
    out = [0] * len(sizes)
    # Walk down from the last node: the part that each of a node's positions ended in.
    open_ = [(heap[0][1], list(range(parts)))]
    while open_:
        node, part_of = open_.pop()
        unit, *children = nodes[node]
        if unit is not None:
            out[unit] = part_of[0]
            continue
        for child, positions in children:
            below = [0] * parts
            for place, position in enumerate(positions):
                below[position] = part_of[place]
            open_.append((child, below))
    return out


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def sized_rows(documents: DataFrame) -> DataFrame:
    text = F.col("text")
    group = F.xxhash64(text.isNull(), text)
    return documents.select("doc_id", text_bytes(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), group.alias("_group"))


def assign_shards(sized: DataFrame, shards: int) -> DataFrame:
    """``(doc_id, size, text_crc32, _group)`` with ``shard``."""
    spark = sized.sparkSession
    groups = sized.groupBy("_group").agg(F.sum("size").alias("bytes"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    large = F.col("bytes") * LARGEST >= F.lit(total)
    bundle = F.pmod(F.col("_group"), F.lit(BUNDLES))
    units = groups.select(large.alias("large"), F.when(large, F.col("_group")).otherwise(bundle).alias("unit"), "bytes")
    listed = units.groupBy("large", "unit").agg(F.sum("bytes").alias("bytes")).collect()
    listed.sort(key=lambda u: (-u["bytes"], u["large"], u["unit"]))
    where = difference([u["bytes"] for u in listed], shards)
    placed = [(u["unit"], s) for u, s in zip(listed, where, strict=True) if u["large"]], [(u["unit"], s) for u, s in zip(listed, where, strict=True) if not u["large"]]
    large_map = spark.createDataFrame(placed[0], "_group long, _own int")
    bundle_map = spark.createDataFrame(placed[1], "_bundle long, _shared int")
    joined = sized.withColumn("_bundle", bundle).join(F.broadcast(large_map), "_group", "left").join(F.broadcast(bundle_map), "_bundle", "left")
    return joined.withColumn("shard", F.coalesce("_own", "_shared")).drop("_own", "_shared", "_bundle")


def with_slots(placed: DataFrame, rows: int) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in pieces of bounded size.

    A shard's rows are dealt to pieces by hash; a row's slot is the number of
    rows in the pieces before its own plus its place within it.
    """
    pieces = max(1, rows // SLOT_ROWS)
    dealt = placed.withColumn("_piece", F.pmod(F.xxhash64("doc_id", "_group"), F.lit(pieces)))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "_piece").agg(F.count("*").alias("_n"))
    starts = counts.select("shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("shard", "_piece").orderBy("doc_id", "_group"))
    numbered = dealt.withColumn("_place", place)
    out = numbered.join(starts, ["shard", "_piece"])
    return out.withColumn("slot", (F.col("_start") + F.col("_place") - 1).cast("long"))


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    # The texts are read once; all that follows works on ids, sizes and hashes.
    sized = stored(sized_rows(documents), "sized")
    placed = with_slots(assign_shards(sized, shards), sized.count())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )
