"""Exact top-k inner products by no-random-access aggregation (NRA).

Vectors become integers floor(scale * x).  Queries and vectors are dealt into blocks by a hash of
their id, and every block of queries meets every block of vectors in one task.  There the vectors
are sorted once per component: those are the lists.  They are read from both ends, since a query
reads a component's list downwards where its own component is positive and upwards where it is
negative, all lists to the same depth.  After each step every (query, vector) has

* a lower bound: what has been read of it, and for unread components the list's far end;
* an upper bound: what has been read, and for unread components the value read last.

A query stops when no vector outside its k best lower bounds, read or not, has an upper bound above
the k-th lower bound.  Vectors whose upper bound still reaches it are then read to the end, which
gives their final scores.  Bounds of a block's queries and vectors are matrix products, so one step
costs a few of them; queries that have stopped leave the next step.

Each block gives at most k vectors a query, so the last merge sorts k rows for each block of
vectors.  The queries and vectors are a fixed query set against all rows, in blocks; no pair of
rows leaves a task but the k best.

All sums are exact: they are made in single or double precision where the bound of their size,
which is checked, allows it, and in Python integers otherwise.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, as
query or as candidate; vectors of another length than the query's meet only their like.  Ties go to
the smaller id; a null id takes no part.  Rows with an equal id are separate candidates; a query's
own row, and every row with its id, is no candidate; queries with equal ids and vectors are one, and
queries with equal ids and other vectors are ranked apart.  Scores beyond 64 bits are cut to them.
Empty tables give an empty result, and extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, table
from .vector_blocks import block_of, groups, matrix, usable

SCALE = 256
K = 5
QUERY_BLOCK, VECTOR_BLOCK = 1024, 4096
DEPTHS = (0.25, 0.5, 0.75)  # of the lists read, before the end


class _Lists:
    """The sorted lists of a block of integer vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n, width = vectors.shape
        order = np.argsort(vectors, axis=0, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(n)[:, None].repeat(width, 1), axis=0)
        self.sorted = np.take_along_axis(vectors, order, axis=0)

    def read(self, queries: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of each query and vector."""
        n = len(self.vectors)
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        top, low = self.place >= n - depth, self.place < depth
        last_top, last_low = self.sorted[n - depth], self.sorted[depth - 1]
        # A component unread from the top is at most the value read last, and at least the least.
        least, most = self.sorted[0], self.sorted[-1]
        lower = up @ np.where(top, self.vectors, least).T + down @ np.where(low, self.vectors, most).T
        upper = up @ np.where(top, self.vectors, last_top).T + down @ np.where(low, self.vectors, last_low).T
        return lower, upper


def best_of_block(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of each query's k best vectors, ties to the smaller id.

    ``own`` are the queries' ids; vectors with a query's id are no candidates for it."""
    n = len(vectors)
    rows = np.argsort(ids, kind="stable")
    vectors, ids = vectors[rows], ids[rows]
    lists = _Lists(vectors)
    out = []
    open_ = np.arange(len(queries))
    for depth in [*sorted({max(1, int(n * d)) for d in DEPTHS} - {n}), n]:
        lower, upper = lists.read(queries[open_], depth)
        barred = own[open_][:, None] == ids[None, :]
        lower = np.where(barred, -np.inf, lower)
        upper = np.where(barred, -np.inf, upper)
        count = min(k, n)
        kth = np.partition(lower, n - count, axis=1)[:, n - count]
        # Outsiders: upper bound at or above the k-th lower bound (ties go by id, so they count).
        rivals = (upper >= kth[:, None]).sum(axis=1)
        closed = (kth > -np.inf) & (rivals <= max(4 * k, n // 16)) if depth < n else np.ones(len(open_), bool)
        for i in np.flatnonzero(closed):
            candidates = np.flatnonzero((upper[i] >= kth[i]) & ~barred[i])
            scores = vectors[candidates] @ queries[open_[i]]
            for j in np.lexsort((ids[candidates], -scores))[:k]:
                out.append((int(open_[i]), int(rows[candidates[j]]), int(scores[j])))
        open_ = open_[~closed]
        if not len(open_):
            break
    return out


def _kind(numbers: np.ndarray):
    """The fastest kind of number in which all inner products are exact."""
    largest = float(np.abs(numbers).max(initial=0)) ** 2 * numbers.shape[1]
    return np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else object


def _search(k: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ["qb", "vb", "width"]):
            rows = rows.combine_chunks()
            is_query = rows.column("query").to_numpy(zero_copy_only=False)
            ids = rows.column("vec_id").to_numpy()
            whole = np.floor(matrix(rows.column("numbers").combine_chunks()) * scale)
            kind = _kind(whole)
            whole = np.vectorize(int, otypes=[object])(whole) if kind is object else whole.astype(kind)
            queries, vectors = whole[is_query], whole[~is_query]
            if not len(queries) or not len(vectors):
                continue
            found = best_of_block(queries, ids[is_query], vectors, ids[~is_query], k)
            q, v, s = (list(x) for x in (zip(*found) if found else ((), (), ())))
            s = [min(max(x, -(2**63)), 2**63 - 1) for x in s]
            mark = rows.column("mark").to_numpy()[is_query]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()) for a in (ids[is_query][q], mark[q], ids[~is_query][v], s)],
                names=["query_id", "mark", "vec_id", "score"],
            )

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best vectors of each query; both tables
    hold vec_id and embedding."""

    def numbers(df: DataFrame) -> DataFrame:
        vector = F.col("embedding").cast("array<double>")
        return df.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            vector.alias("numbers"),
        ).withColumns({"width": F.size("numbers"), "mark": F.xxhash64("numbers")})

    asked = stored(numbers(queries).dropDuplicates())
    held = stored(numbers(vectors))
    qbs = max(1, -(-asked.count() // QUERY_BLOCK))
    vbs = max(1, -(-held.count() // VECTOR_BLOCK))
    # Each row is dealt to every block of the other side: the search set against all rows.
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qb", block_of(F.col("vec_id"), qbs)).withColumn("vb", each(vbs)).withColumn("query", F.lit(True))
    right = held.withColumn("vb", F.pmod(F.xxhash64("vec_id", "numbers"), F.lit(vbs)).cast("int")).withColumn("qb", each(qbs)).withColumn("query", F.lit(False))
    cells = left.unionByName(right).repartition(max(1, qbs * vbs), "qb", "vb").sortWithinPartitions("qb", "vb", "width")
    best = cells.select("qb", "vb", "width", "query", "vec_id", "mark", "numbers").mapInArrow(
        _search(k, scale), "query_id long, mark long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_nra_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.n, c.n) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.n) = len(c.n) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
