"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt into blocks. Each block keeps one sorted list per dimension; a query walks the lists of its
non-zero dimensions in step (from the large end for positive components, else from the small end), scores
every vector it meets in full, and stops once the score of an imaginary vector made of the values just
reached cannot beat the kth result, or no vector is left unseen. A query searches the block of its own vector first; its kth
score there is a floor for all other blocks, which end where the imaginary vector falls below it. The best k of all blocks are
merged per query.

Defined results: vectors that are null, empty, of another length than most, or that hold null or non-finite
components take no part, neither as query nor as candidate; ties go to the smaller id; of rows with equal
ids each takes part; a query is never its own candidate (rows that share its id are left out); an empty
table or a table without queries gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import stored

#: Vectors in a block, and queries that meet a block together.
BLOCK = 16384
QUERIES = 8192
FIRST_DEPTH = 16


class SortedLists:
    """The lists of one block: ``order[d]`` has the rows by falling component d."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, whole = ids[by_id], x[by_id]
        self.order = np.ascontiguousarray(np.argsort(-whole, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.take_along_axis(whole.T, self.order, axis=1)
        self.largest = int(np.abs(whole).max(initial=0))
        # products of whole numbers are exact in doubles below 2**53; larger ones keep to integers
        self.x = np.ascontiguousarray(whole, np.float64) if self.largest < 2**52 else whole

    def _scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.largest * int(np.abs(q).sum()) < 2**53:
            return (self.x[rows] @ q.astype(np.float64)).astype(np.int64)
        return self.x[rows].astype(np.int64) @ q

    def top(self, query_id: int, q: np.ndarray, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, by falling score, then rising id; those below ``floor`` may be missing."""
        n, used = len(self.ids), np.flatnonzero(q)
        if len(used) == 0:
            used = np.arange(len(q))
        up = q[used] > 0
        seen = np.zeros(n, bool)
        seen[self.ids == query_id] = True
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high = 0, min(FIRST_DEPTH, n)
        while True:
            lists = np.where(up[:, None], self.order[used, low:high], self.order[used, n - high : n - low][:, ::-1])
            met = np.zeros(n, bool)
            met[lists.ravel()] = True
            rows = np.flatnonzero(met & ~seen)
            seen |= met
            rows_all, scores_all = np.concatenate([best_rows, rows]), np.concatenate([best, self._scores(rows, q)])
            kept = np.lexsort((rows_all, -scores_all))[:k]  # rows are in order of id
            best_rows, best = rows_all[kept], scores_all[kept]
            reached = np.where(up, self.values[used, high - 1], self.values[used, n - high])
            bound = reached @ q[used]
            if high == n or seen.all() or (len(best) == k and best[-1] > bound) or (floor is not None and bound < floor):
                return self.ids[best_rows], best
            low, high = high, min(4 * high, n)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, x): floor(scale * component) of the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & (F.size(x) > 0) & fit).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("x")
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best other vectors.

    ``is_query`` is a condition on the column ``id``. Every pair of a block of vectors and a block of queries is
    a group of at most about BLOCK + QUERIES rows, whatever the table's size.
    """
    x = stored(quantised(vectors, id_col, vector_col, scale), "vectors")
    width = x.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return x.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    x = x.where(F.size("x") == width.w)
    chosen = x.where(is_query)
    n_blocks, n_groups = -(-width["count"] // BLOCK), -(-max(chosen.count(), 1) // QUERIES)
    deal = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    left = x.withColumn("block", deal("block", n_blocks)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    asked = stored(chosen.withColumn("part", deal("part", n_groups)).withColumn("own", deal("block", n_blocks)), "queries")

    def search(block: pa.Table, queries: pa.Table) -> pa.Table:
        def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            return t.column("id").to_numpy(), t.column("x").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)

        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        if block.num_rows and queries.num_rows:
            lists = SortedLists(*matrix(block))
            floors = queries.column("floor").to_pylist()
            out = [(int(i), *lists.top(i, q, k, floor)) for i, q, floor in zip(*matrix(queries), floors)]
        sizes = [len(s) for _, _, s in out]
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({"query_id": np.repeat(np.array([i for i, _, _ in out], np.int64), sizes), "vec_id": join([v for _, v, _ in out]), "score": join([s for _, _, s in out])})

    def searched(queries: DataFrame) -> DataFrame:
        rows = queries.select("id", "x", "part", "block", "floor")
        return left.groupBy("block", "part").cogroup(rows.groupBy("block", "part")).applyInArrow(search, "query_id long, vec_id long, score long")

    near = stored(searched(asked.withColumn("block", F.col("own")).withColumn("floor", F.lit(None).cast("long"))), "own-blocks")
    if n_blocks > 1:
        kth = F.sort_array(F.collect_list("score"), asc=False)  # at most k for a query, but for equal ids
        floors = near.groupBy(F.col("query_id").alias("of")).agg(F.get(kth, F.lit(k - 1)).alias("floor"))
        others = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).where("block <> own")
        near = near.unionByName(searched(others.join(floors, F.col("id") == F.col("of"), "left")))
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
