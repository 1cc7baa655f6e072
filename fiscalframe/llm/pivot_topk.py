"""Exact top-k search by inner product, with a table of distances to pivots.

Every vector gets its Euclidean distances to a few pivots once. By the
triangle inequality the largest difference of two vectors' pivot distances is
a lower bound of the distance between them, and with the norms that is an
upper bound of their inner product. A query looks at the candidates of a block
in the order of that bound and stops when its k-th best score is above the
bound of all that are left. Nothing is approximate.

Queries and candidates meet in blocks of fixed size: the candidates of a block
are spread by a hash of their id, so neither a common vector nor a dense
region makes a block large, and every query is sent to every block.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without id. Shorter vectors count as padded with
zeros, so an empty vector scores 0. Repeated rows are candidates each; all
rows with the query's id are its own. A repeated query row asks once; rows
with one id but different vectors ask separately. Ties go to the smaller id.
Sums are exact as long as a score fits 64 bits: where the largest components
could take a sum beyond 2**53, scores are whole numbers of 64 bits and the
bounds leave room for the rounding of distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pivots come from a sample of bounded size; the bounds hold for any pivots.
PIVOTS = 32
SAMPLE = 1024
BLOCK_ROWS = 4096
QUERY_ROWS = 512

_TABLE = "id long, vector binary, distances binary, block int, part int"
_FOUND = "query_id long, _asked long, vec_id long, score long"


def digest(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, NULL for a vector that takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(values: pd.Series, dtype: type, width: int, into: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype).reshape(len(values), width).astype(into)


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first choice from the sample; pivots far apart give tight bounds."""
    chosen = [0]
    nearest = np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    # Below 2**53 only the root rounds; beyond, the slack of the bounds covers the sums.
    vectors, pivots = vectors.astype(np.float64), pivots.astype(np.float64)
    squared = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * vectors @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def _best_in_block(k: int, width: int, pivots: int, kept: type, exact: type):
    """``kept`` is the type that vectors are shuffled in, ``exact`` one whose sums are."""

    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "_asked": [], "vec_id": [], "score": []}).astype("int64")
        asked, x = _matrix(queries["vector"], kept, width, exact), _matrix(rows["vector"], kept, width, exact)
        near = _matrix(queries["distances"], np.float64, pivots)
        table = _matrix(rows["distances"], np.float64, pivots)
        ids = rows["id"].to_numpy()
        bound = np.zeros((len(asked), len(x)))
        for p in range(pivots):
            np.maximum(bound, np.abs(near[:, p, None] - table[None, :, p]), out=bound)
        norms = (asked.astype(np.float64) ** 2).sum(1)[:, None] + (x.astype(np.float64) ** 2).sum(1)
        # The slack covers the rounding of roots and squares; a distance of inexact sums is off by 1e-7 of the norms.
        bound = (norms - bound**2) / 2 + 1 + (1e-9 if exact is np.float64 else 1e-6) * norms
        found = []
        for q, at_least in enumerate(queries["at_least"].to_numpy()):
            open_ = np.nonzero(bound[q] >= at_least)[0]
            order = open_[np.argsort(-bound[q, open_], kind="stable")]
            best_id, best = np.empty(0, np.int64), np.empty(0, exact)
            at, step = 0, 64
            while at < len(order) and not (len(best) == k and best[-1] > bound[q, order[at]]):
                part = order[at : at + step]
                part = part[ids[part] != queries["id"].iat[q]]
                best_id = np.concatenate([best_id, ids[part]])
                best = np.concatenate([best, x[part] @ asked[q]])
                keep = np.lexsort((best_id, -best))[:k]
                best_id, best = best_id[keep], best[keep]
                at, step = at + step, 2 * step
            found.append(pd.DataFrame({"query_id": queries["id"].iat[q], "_asked": queries["asked"].iat[q], "vec_id": best_id, "score": best.astype(np.int64)}))
        return pd.concat(found, ignore_index=True)

    return search


def pivot_topk(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for each query row, its own id left out."""
    spark = rows.sparkSession
    # Names first, so that extra columns cannot clash.
    known = rows.select(F.col(id_col).cast("long").alias("id"), digest(F.col(vector), scale).alias("v"), is_query.alias("q"))
    known = known.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    largest = F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))
    n, width, largest = known.agg(F.count("*"), F.max(F.size("v")), F.coalesce(largest, F.lit(0.0))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, width)
    kept = np.int32 if largest < 2**31 else np.int64
    exact = np.float64 if 4 * width * largest**2 < 2**53 else np.int64
    thin = max(1, n // (4 * SAMPLE))
    drawn = known.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(thin)) == 0)
    sample = drawn.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).select("id", "v").toPandas()
    sample_ids, sample_x = sample["id"].to_numpy(), _padded(sample["v"], width)
    # A thin table may draw nobody; the zero vector is as good a pivot as any.
    pivots = spread_pivots(sample_x, PIVOTS) if len(sample) else np.zeros((1, width), np.int64)
    blocks = -(-n // BLOCK_ROWS)
    parts = max(1, -(-known.filter("q").count() // QUERY_ROWS))

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _padded(b["v"], width)
            yield pd.DataFrame(
                {
                    "id": b["id"],
                    "vector": [v.tobytes() for v in x.astype(kept)],
                    "distances": [d.tobytes() for d in _distances(x, pivots)],
                    "block": b["block"],
                    "part": b["part"],
                }
            )

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = sample_x.astype(np.float64)
        for b in batches:
            asked = _matrix(b["vector"], kept, width)
            scores = np.where(b["id"].to_numpy()[:, None] == sample_ids, -np.inf, asked @ sample.T)
            # The k-th best of the sample: no row below it can be among the k best of all.
            least = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if scores.shape[1] >= k else np.full(len(b), -np.inf)
            # Less what the sums may be off.
            off = 1e-12 * np.sqrt((asked**2).sum(1) * (sample**2).sum(1).max(initial=0))
            yield b.assign(at_least=least - off)

    spread = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    candidates = known.select("id", "v", spread.alias("block")).mapInPandas(prepare_rows(prepare), _TABLE)
    candidates = candidates.select("id", "vector", "distances", "block", each_part)
    queries = known.filter("q").select("id", "v").distinct()
    queries = queries.select("id", "v", F.lit(0).alias("block"), F.pmod(F.xxhash64("id", F.lit("part")), F.lit(parts)).cast("int").alias("part"))
    queries = queries.mapInPandas(prepare, _TABLE).mapInPandas(ask, _TABLE + ", at_least double")
    queries = queries.select("id", F.xxhash64("vector").alias("asked"), "vector", "distances", "at_least", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    found = queries.groupBy("block", "part").cogroup(candidates.groupBy("block", "part")).applyInPandas(_best_in_block(k, width, len(pivots), kept, exact), _FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id", "_asked").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def prepare_rows(prepare):
    """Candidates have no part of their own: each goes to every part of the queries."""

    def with_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return prepare(b.assign(part=0) for b in batches)

    return with_part
