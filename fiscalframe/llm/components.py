"""Connected components of a table of links, without gathering any of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalframe.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every id in ``(a, b)``: root is the smallest id reachable.

    Each round gives every id the smallest root among its neighbours' and then
    the root of that root, so long chains halve. A round's table is written,
    in as many files as its rows ask for: rounds are many, and small ones would
    mostly make files. A hot id costs no more than a partial minimum per task
    and a split join. ``links`` is read more than once, so it should be stored.
    """
    most = 2 * links.count()
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links", most)
    roots = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")), "roots", most)
    while True:
        seen = both.join(roots.select(F.col("id").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lower = roots.join(seen.withColumnRenamed("a", "id"), "id").select("id", "root", F.least("root", "near").alias("low"))
        target = roots.select(F.col("id").alias("low"), F.col("root").alias("further"))
        # Every root is an id of the table itself, so the inner join loses nobody.
        step = lower.join(target, "low").select("id", F.least("low", "further").alias("root"), (F.least("low", "further") != F.col("root")).alias("moved"))
        step = stored(step, "roots", most)
        roots = step.select("id", "root")
        if not step.filter("moved").limit(1).count():
            return roots
