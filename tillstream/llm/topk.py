"""Exact top-k by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

Vectors are dealt into shards of a bounded size. A shard sorts its vectors along each dimension. A
query goes down all lists together, from the end that its sign in that dimension favours, scores
what it meets for the first time, and stops when no vector below the present depth could come
into its k best. The shards' answers, k rows each, then meet per query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, EVERY, SCALE = 5, 50, 256
# Vectors of a shard and queries of a block, about; a task holds one of each.
SHARD_ROWS, BLOCK_ROWS = 8_192, 512
FIRST_STEP = 16
FOUND = "query_id long, query_key long, vec_id long, score long"


class Lists:
    """The vectors of a shard sorted along each dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, ties to the smaller id, without the query's own id."""
        count = len(self.ids)
        up, down = np.nonzero(query < 0)[0], np.nonzero(query > 0)[0]
        seen = np.zeros(count, bool)
        ids, scores = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        depth, step = 0, FIRST_STEP
        while depth < count:
            end = min(count, depth + step)
            met = np.zeros(count, bool)
            met[self.order[depth:end, up].ravel()] = True
            met[self.order[count - end:count - depth, down].ravel()] = True
            if not len(up) and not len(down):  # all scores are 0
                met[:] = True
                end = count
            new = np.nonzero(met & ~seen)[0]
            seen[new] = True
            new = new[self.ids[new] != own]
            got = self.vectors[new] @ query
            ids, scores = np.concatenate([ids, self.ids[new]]), np.concatenate([scores, got])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            depth, step = end, step * 2
            if depth < count and len(ids) == k:
                bound = self.values[depth, up] @ query[up] + self.values[count - 1 - depth, down] @ query[down]
                if scores[-1] > bound:  # at a tie, a smaller id might still be below
                    break
        return ids, scores


def _stacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows as (ids, whole-number vectors); floats where these hold all sums exactly."""
    vectors = np.stack(rows["vector"].to_list()).astype(np.int64)
    ids = rows["vec_id"].to_numpy(np.int64)
    both = np.unique(np.column_stack([ids, vectors]), axis=0)
    return both[:, 0], both[:, 1:]


def _search(k: int):
    def search(key, shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(block):
            return pd.DataFrame(columns=["query_id", "query_key", "vec_id", "score"]).astype("int64")
        ids, vectors = _stacked(shard)
        query_ids, queries = _stacked(block)
        keys = dict(zip(map(tuple, np.column_stack([query_ids, queries])), range(len(queries))))
        largest = [float(np.abs(x).max(initial=0)) for x in (vectors, queries)]
        if largest[0] * largest[1] * vectors.shape[1] < 2 ** 53:
            vectors, queries = vectors.astype(np.float64), queries.astype(np.float64)
        lists, out = Lists(ids, vectors), []
        names = {i: name for name, i in zip(block["query_key"], [keys[(a, *map(int, v))] for a, v in zip(
            block["vec_id"], block["vector"])])}
        for i, (own, query) in enumerate(zip(query_ids, queries)):
            found, scores = lists.best(query, own, k)
            out.append(pd.DataFrame({"query_id": own, "query_key": names[i], "vec_id": found,
                                     "score": scores.astype(np.int64)}))
        return pd.concat(out)
    return search


def search(table: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest integer inner products.

    Reads vec_id and embedding, whatever else the table has. Components become floor(scale * x).
    Queries are the rows whose vec_id is divisible by `every`; candidates are all rows but those of
    the query's own vec_id. Vectors that are null, empty or hold a null or non-finite component, and
    rows without a vec_id, take no part. Vectors meet those of the same length. Rows equal in both
    columns count once; a vec_id with several vectors is several candidates, and as a query gets an
    answer for each. An empty table gives no rows. Sums are exact within 64-bit whole numbers.
    """
    given = F.col("embedding").cast("array<double>")
    sound = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    vectors = (table.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)) & (F.size(given) > 0))
               .select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform(given, lambda x: F.floor(x * scale)).alias("vector")))
    queries = vectors.where(F.col("vec_id") % every == 0)
    rows = vectors.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards, blocks = max(1, -(-rows[0] // SHARD_ROWS)), max(1, -(-rows[1] // BLOCK_ROWS))
    width = F.size("vector").alias("width")
    dealt = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("*", width, dealt(shards, 0).cast("int").alias("shard"), each(blocks).alias("block"))
    right = queries.select("*", F.xxhash64("vector").alias("query_key"), width,
                           dealt(blocks, 1).cast("int").alias("block"), each(shards).alias("shard"))
    found = (left.groupBy("width", "shard", "block").cogroup(right.groupBy("width", "shard", "block"))
             .applyInPandas(_search(k), FOUND))
    ranking = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
