"""Exact top-k search by inner product, with ball trees.

The rows are dealt into shards once. A task reads a shard, builds a ball tree over it (nodes with a centre
and a radius) and answers the queries that stream through it (see `shards`): it holds one shard and one
batch of queries. Nodes are visited in the order of their upper bound <q, centre> + |q| * radius, and a
query is done when the bound of the next node is below its k-th score. The k-th scores are shared:
each query first visits one home shard, and carries what it found there to all others as the score to
beat. So each row is sent twice, and each query once to every shard, however many queries there are.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .shards import stream_through

LEAF = 64
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
#: Sums of products below this are whole numbers in double precision.
EXACT = 1 << 53


class BallTree:
    """A binary tree of balls over the rows of a matrix; leaves are slices of `order`."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(rows))
        self.nodes: list[tuple] = []  # (begin, end, left, right)
        centres, radii = [], []
        todo = [(0, len(rows), None)]
        while todo:
            begin, end, link = todo.pop()
            own = rows[self.order[begin:end]]
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.nodes)
            self.nodes.append([begin, end, -1, -1])
            centres.append(centre)
            radii.append(away.max())
            if link:
                self.nodes[link[0]][link[1]] = node
            if end - begin > leaf and away.max() > 0:
                # Split at the median along the line through two far points.
                one = own[away.argmax()]
                other = own[((own - one) ** 2).sum(axis=1).argmax()]
                half = (end - begin) // 2
                place = np.argpartition(own @ (other - one), half)
                self.order[begin:end] = self.order[begin:end][place]
                todo += [(begin, begin + half, (node, 2)), (begin + half, end, (node, 3))]
        self.centres = np.array(centres)
        self.radii = np.array(radii)


class Index:
    """The rows of a shard and their ball tree."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.tree, self.rows, self.ids = BallTree(rows.astype(np.float64)), rows, ids
        self.most = max(1, int(np.abs(rows).max(initial=0)))
        self.leaves: dict = {}

    def leaf(self, node: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        if (node, kind) not in self.leaves:
            begin, end, _, _ = self.tree.nodes[node]
            own = self.tree.order[begin:end]
            self.leaves[node, kind] = (self.ids[own], self.rows[own].astype(kind))
        return self.leaves[node, kind]


def search(index: Index, queries: np.ndarray, query_ids: list[int], bounds: list[int], k: int) -> Iterator[tuple[int, int, int]]:
    """Hits (query_id, vec_id, score) of at most k rows per query that may be among its k best.

    `bounds`: the score that a row must reach to matter. Products are whole numbers.
    """
    tree = index.tree
    most = index.most * max(1, int(np.abs(queries).max(initial=0))) * queries.shape[1]
    kind = np.float64 if most < EXACT else object  # beyond doubles: Python's whole numbers
    queries_k = queries.astype(kind)
    upper = queries.astype(np.float64) @ tree.centres.T
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    # A little more than the bound, for what rounding may take from it.
    upper += norms[:, None] * tree.radii[None, :] * (1 + 1e-9)
    upper += np.abs(upper) * 1e-9 + norms[:, None] * np.sqrt((tree.centres ** 2).sum(axis=1))[None, :] * 1e-9 + 1e-6
    for i, query_id in enumerate(query_ids):
        need, best, heap = bounds[i], [], [(-upper[i, 0], 0)]  # best: min-heap of (score, -vec_id)
        while heap and -heap[0][0] >= need:
            node = heapq.heappop(heap)[1]
            _, _, left, right = tree.nodes[node]
            if left >= 0:
                heapq.heappush(heap, (-upper[i, left], left))
                heapq.heappush(heap, (-upper[i, right], right))
                continue
            ids, vectors = index.leaf(node, kind)
            scores = vectors @ queries_k[i]
            for j in np.nonzero(scores >= need)[0]:
                if ids[j] == query_id:
                    continue
                hit = (int(scores[j]), -int(ids[j]))
                if len(best) < k:
                    heapq.heappush(best, hit)
                else:
                    heapq.heappushpop(best, hit)
            if len(best) == k:
                need = max(need, best[0][0])
        for score, minus in best:
            yield query_id, -minus, score


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.ListArray) else pa.chunked_array([flat]).combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integer_vectors(rows: DataFrame, id_column: str, vector: str, scale: int, *more: str) -> DataFrame:
    """(vec_id, v, more columns): floor(scale * x) of every component; rows with a null vector or id, or a
    component that is null or not finite, are left out."""
    whole = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"), *more)
    fit = whole.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall(
        "x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    return fit.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"), *more)


def top_k(rows: DataFrame, k: int = 10, every: int = 100, id_column: str = "vec_id", vector: str = "embedding",
          scale: int = 1024, shard_rows: int = 65536, block: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows with the highest inner product with each query.

    Queries are the rows whose id is divisible by `every`; candidates are all other rows of the
    same number of components. Ties go to the smaller id. Repeated rows are repeated candidates,
    but a row with a query's id is never its candidate; a repeated query is answered once.
    Vectors without components and empty tables give no rows. Scores must fit 64 bits. A task compares
    `block` queries at a time with the nodes of a shard.
    """
    numbered = integer_vectors(rows, id_column, vector, scale).where("size(v) > 0").withColumn("number", F.monotonically_increasing_id())
    fit = materialise(numbered, "vectors")
    total = fit.count()
    slots = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-total // shard_rows), min(slots, total // 2048))
    width = F.size("v").alias("width")
    # Dealt by number: shards are equal, also where one id or vector is on very many rows.
    candidates = fit.select("vec_id", "v", width, F.pmod("number", F.lit(shards)).cast("int").alias("shard"))
    queries = fit.where(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id"])
    queries = queries.select("vec_id", "v", width, F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(shards)).cast("int").alias("home"))
    lowest = -(1 << 63)

    def build(table: pa.Table) -> Index:
        return Index(_matrix(table["v"]), table["vec_id"].to_numpy())

    def answer(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = []
        for at in range(0, len(batch), block):
            own = batch.slice(at, block)
            hits += search(index, _matrix(pa.chunked_array([own.column("v")])), own.column("vec_id").to_pylist(), own.column("bound").to_pylist(), k)
        return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*hits) if hits else [[]] * 3)], schema=HITS)

    def ask(asked: DataFrame) -> DataFrame:
        return stream_through(candidates, asked, shards, build, answer, "query_id long, vec_id long, score long")

    at_home = materialise(ask(queries.withColumn("bound", F.lit(lowest)).withColumnRenamed("home", "shard")), "home-hits")
    bound = at_home.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bound"))
    others = (queries.join(bound, F.col("vec_id") == F.col("query_id"), "left")
              .withColumn("bound", F.coalesce("bound", F.lit(lowest))).select(*queries.columns, "bound")
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard != home").drop("home"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (at_home.unionByName(ask(others)).withColumn("rank", F.row_number().over(best).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
