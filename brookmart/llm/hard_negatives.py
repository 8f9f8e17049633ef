"""Hard-negative mining with an inverted multi-index.

A shard's vectors are cut into two halves. Each half has a codebook, and a pair of codes is a cell. The
score of a row with an anchor is the sum of the scores of the halves, and with the radius of a code
in its half, |q| r, a cell has an upper and a lower bound of all its scores. The multi-sequence
heap visits cells by falling upper bound: it starts with the best codes of both halves and goes on from
each cell to its neighbours in the two orders.

Positives are the best rows of an anchor's own label. A positive opens a window of scores; the best
rows of other labels in it are its negatives. A window is certified once its last negative is above
the bound of the next cell, or once that bound is below the window; the search of an anchor ends when
all its windows are. Cells whose lower bound is above every open window are passed over.

Codebooks are fitted on at most `sample` rows of a shard (a bound of theirs alone: every row lies in a
cell, radii are those of all rows, and results are exact). A shard stays in one task and anchors
are streamed through it; see `shards`.
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
from .topk import EXACT, _matrix, integer_vectors

#: Rows of a cell on average.
CELL = 256
CODES = 64
POSITIVES = pa.schema([("anchor_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
NEGATIVES = pa.schema([("anchor_id", pa.int64()), ("window", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def codebook(rows: np.ndarray, codes: int, rounds: int = 5) -> np.ndarray:
    """Centres of so many clusters of `rows`, by Lloyd's rounds from evenly spaced rows."""
    centres = rows[np.linspace(0, len(rows) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        code = nearest(rows, centres)
        counts = np.bincount(code, minlength=codes)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, some rows at a time."""
    squares = (centres ** 2).sum(axis=1)
    parts = [np.argmin(squares - 2 * (rows[at:at + 8192] @ centres.T), axis=1) for at in range(0, len(rows), 8192)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


class MultiIndex:
    """Rows of a shard in the cells of two half-space codebooks."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, sample: int):
        half = vectors.shape[1] // 2
        self.halves = [slice(0, half), slice(half, vectors.shape[1])]
        self.most = max(1, int(np.abs(vectors).max(initial=0)))
        codes = int(np.clip(round((len(vectors) / CELL) ** 0.5), 1, CODES))
        about = vectors.astype(np.float64)
        self.centres, owned, away = [], [], []
        for part in self.halves:
            own = about[:, part]
            centres = codebook(own[np.linspace(0, len(own) - 1, min(sample, len(own))).astype(int)], codes)
            code = nearest(own, centres)
            self.centres.append(centres)
            owned.append(code)
            away.append(np.sqrt(((own - centres[code]) ** 2).sum(axis=1)))
        self.radii = []
        for code, distance in zip(owned, away):
            radius = np.zeros(codes)
            np.maximum.at(radius, code, distance)
            self.radii.append(radius * (1 + 1e-9))
        cell = owned[0] * codes + owned[1]
        order = np.argsort(cell, kind="stable")
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        self.begins = np.searchsorted(cell[order], np.arange(codes * codes + 1)).tolist()
        self.codes = codes

    def products(self, query: np.ndarray) -> np.ndarray:
        """Rows in a form whose products with the query are exact."""
        if self.most * max(1, int(np.abs(query).max(initial=0))) * len(query) < EXACT:
            if self.vectors.dtype != np.float64:
                self.vectors = self.vectors.astype(np.float64)
            return self.vectors
        return self.vectors.astype(np.int64).astype(object)

    def cells(self, query: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(upper bound, lower bound, begin, end) of the cells with rows, by falling upper bound."""
        about = query.astype(np.float64)
        upper, lower, order = [], [], []
        for part, centres, radii in zip(self.halves, self.centres, self.radii):
            own = about[part]
            middle, spread = centres @ own, np.sqrt(own @ own) * radii
            spare = 1e-9 * (np.abs(centres) @ np.abs(own) + spread) + 1e-6
            best = np.argsort(-(middle + spread + spare), kind="stable")
            upper.append((middle + spread + spare)[best].tolist())
            lower.append((middle - spread - spare)[best].tolist())
            order.append(best.tolist())
        (up, other_up), (low, other_low), (codes, other_codes) = upper, lower, order
        heap = [(-(up[0] + other_up[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < self.codes:
                heapq.heappush(heap, (-(up[i] + other_up[j + 1]), i, j + 1))
            if j == 0 and i + 1 < self.codes:
                heapq.heappush(heap, (-(up[i + 1] + other_up[0]), i + 1, 0))
            cell = codes[i] * self.codes + other_codes[j]
            if self.begins[cell] < self.begins[cell + 1]:
                yield -bound, low[i] + other_low[j], self.begins[cell], self.begins[cell + 1]


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k first (-score, id): high scores first, ties by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[scores >= least], ids[scores >= least]
    order = np.lexsort((ids, -scores))[:k]
    return [(-int(scores[i]), int(ids[i])) for i in order]


def positives(index: MultiIndex, anchor: int, label: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(-score, id) of the first k other rows of the label."""
    rows, found = index.products(query), []
    exact = query.astype(rows.dtype)
    for upper, _, begin, end in index.cells(query):
        if len(found) == k and upper < -found[-1][0]:
            break
        own = np.flatnonzero((index.labels[begin:end] == label) & (index.ids[begin:end] != anchor)) + begin
        if len(own):
            found = sorted(found + best_of(rows[own] @ exact, index.ids[own], k))[:k]
    return found


def negatives(index: MultiIndex, anchor: int, label: int, query: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """(-score, id) of the first k rows of other labels in each window (low, high) of scores."""
    rows, found, open_ = index.products(query), [[] for _ in windows], [n for n, (low, high) in enumerate(windows) if low <= high]
    exact = query.astype(rows.dtype)
    for upper, lower, begin, end in index.cells(query):
        open_ = [n for n in open_ if upper >= windows[n][0] and (len(found[n]) < k or upper >= -found[n][-1][0])]
        if not open_:
            break
        if lower > max(windows[n][1] for n in open_):
            continue
        own = np.flatnonzero((index.labels[begin:end] != label) & (index.ids[begin:end] != anchor)) + begin
        scores = rows[own] @ exact
        for n in open_:
            low, high = windows[n]
            within = (scores >= (low if len(found[n]) < k else max(low, -found[n][-1][0]))) & (scores <= high)
            if within.any():
                found[n] = sorted(found[n] + best_of(scores[within], index.ids[own[within]], k))[:k]
    return found


def hard_negatives(rows: DataFrame, every: int = 50, k_positives: int = 5, k_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   id_column: str = "vec_id", vector: str = "embedding", label: str = "label", shard_rows: int = 65536, sample: int = 4096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id is divisible by `every`. The first `k_positives` rows of an anchor's
    label are its positives; for each, the first `k_negatives` rows of other labels are returned whose
    score is `low` to `high` hundredths of the positive's, so none for a negative score. First are
    higher inner products of floor(`scale` * x), ties by smaller id. Rows with a null id, label, vector
    or component, a component that is not finite or no components take no part. A row with the anchor's
    id is neither positive nor negative of it; other repeated rows are rows like any others. Of rows with
    one anchor's id the one with the smallest label and vector asks. Rows are compared with those of
    the same number of components. Scores must fit 64 bits. An empty table gives an empty result.
    """
    labelled = rows.where(F.col(label).isNotNull()).select(F.col(id_column).alias("vec_id"), F.col(vector).alias("x"), F.col(label).cast("long").alias("label"))
    numbered = integer_vectors(labelled, "vec_id", "x", scale, "label").where("size(v) > 0").withColumn("number", F.monotonically_increasing_id())
    fit = materialise(numbered, "vectors")
    total = fit.count()
    slots = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-total // shard_rows), min(slots, total // 2048))
    # Dealt by number: shards are equal, also where one id or vector is on very many rows.
    dealt = fit.select("vec_id", "label", "v", F.size("v").alias("width"), F.pmod("number", F.lit(shards)).cast("int").alias("shard"))
    anchors = fit.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own")).select(
        "vec_id", "own.label", "own.v", F.size("own.v").alias("width"))

    def build(table: pa.Table) -> MultiIndex:
        return MultiIndex(_matrix(table["v"]), table["vec_id"].to_numpy(), table["label"].to_numpy(), sample)

    def asked(batch: pa.RecordBatch):
        return zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), _matrix(pa.chunked_array([batch.column("v")])))

    def find_positives(index: MultiIndex, batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [(a, i, -s) for a, own, q in asked(batch) for s, i in positives(index, a, own, q, k_positives)]
        return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*hits) if hits else [[]] * 3)], schema=POSITIVES)

    def find_negatives(index: MultiIndex, batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = []
        for (a, own, q), scores in zip(asked(batch), batch.column("windows").to_pylist()):
            windows = [(-(-low * p // 100), high * p // 100) for p in scores]
            for p, found in zip(scores, negatives(index, a, own, q, windows, k_negatives)):
                hits += [(a, p, i, -s) for s, i in found]
        return pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*hits) if hits else [[]] * 4)], schema=NEGATIVES)

    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    near = stream_through(dealt, anchors, shards, build, find_positives, "anchor_id long, vec_id long, score long")
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k_positives)
    near = materialise(near.select("anchor_id", F.col("vec_id").alias("positive_id"), "place", F.col("score").alias("positive_score")), "positives")
    windows = near.where("positive_score >= 0").groupBy("anchor_id").agg(F.collect_set("positive_score").alias("windows"))
    open_ = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found = stream_through(dealt, open_, shards, build, find_negatives, "anchor_id long, window long, negative_id long, negative_score long")
    first = Window.partitionBy("anchor_id", "window").orderBy(F.col("negative_score").desc(), "negative_id")
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k_negatives)
    kept = near.withColumnRenamed("anchor_id", "of").join(found, (F.col("of") == F.col("anchor_id")) & (F.col("positive_score") == F.col("window")))
    return kept.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
