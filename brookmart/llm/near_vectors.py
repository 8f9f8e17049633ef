"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

A unit vector u is coded as s * q with whole numbers q from -127 to 127; its error e = |u - s q| is
computed, not estimated. For two of them

    |u.v - s_u s_v q_u.q_v| <= e_u |s_v q_v| + e_v,

so a pair whose coded product plus this bound is below the threshold has no link. Only the others
are computed in double precision.

Equal vectors are one node with a weight. Nodes are dealt into blocks of bounded bytes and a task
holds one pair of blocks, as tiles of `TILE` rows. A tile's products are whole numbers below 2**24 and
exact in the single-precision products that it uses. A task sends, for each node that it found links
for, their number and the node that it is joined to: at most two rows a node and pair of blocks,
however many pairs are linked. Every pair of blocks is computed, so the products grow with the square
of the number of different vectors; what is sent grows with it over the rows of a block.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .graph import components

TILE = 1024
#: Pairs that are computed in double precision at once.
SLICE = 1 << 15
#: More than rounding adds to a coded product below 1.02 in single precision.
SLACK = np.float32(4e-6)
LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that sums of squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(rows).max(axis=1, initial=0))
    return np.ldexp(rows, -exponent[:, None])


class Coded:
    """Vectors in double precision with their int8 codes and errors."""

    def __init__(self, rows: np.ndarray):
        self.rows = scaled(rows)
        self.norms = np.sqrt((self.rows ** 2).sum(axis=1))
        unit = self.rows / self.norms[:, None]
        scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / scale[:, None])
        back = codes * scale[:, None]
        self.codes = codes.astype(np.int8)
        self.scale = scale.astype(np.float32)
        # A little more than the error and the coded length, for the rounding of the lines above.
        self.error = np.sqrt(((unit - back) ** 2).sum(axis=1)) + 1e-12
        self.length = np.sqrt((back ** 2).sum(axis=1)) + 1e-12
        self.exact = np.float32 if 127 * 127 * rows.shape[1] < 1 << 24 else np.float64

    def candidates(self, i: slice, j: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the two tiles whose cosine may reach the threshold."""
        product = self.codes[i].astype(self.exact) @ self.codes[j].astype(self.exact).T
        product *= self.scale[i, None]
        product *= self.scale[None, j]
        spare = self.error[i].max() * self.length[j].max() + self.error[j].max() + SLACK
        a, b = np.nonzero(product >= threshold - spare)
        near = product[a, b] + self.error[i][a] * self.length[j][b] + self.error[j][b] + SLACK >= threshold
        return a[near] + i.start, b[near] + j.start

    def linked(self, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
        """Which of the pairs have a cosine of the threshold or more, in double precision."""
        found = np.zeros(len(a), dtype=bool)
        for at in range(0, len(a), SLICE):
            x, y = a[at:at + SLICE], b[at:at + SLICE]
            found[at:at + SLICE] = np.einsum("ij,ij->i", self.rows[x], self.rows[y]) / (self.norms[x] * self.norms[y]) >= threshold
        return found


def join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked rows the smallest label of their component, in place; labels are row numbers."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = label[label]
            if (above == label).all():
                break
            label[:] = above


def _vectors(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """row, vec_id, width, digest and bytes of every row; no digest where a row can have no link."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(2):
                values = np.array(x.as_py() or [], dtype=np.float64) + 0.0 if x.is_valid else np.zeros(0)  # no negative zeros
                fit = len(values) > 0 and np.isfinite(values).all() and values.any()
                data = values.tobytes() if fit else None
                out.append((len(values), xxhash.xxh3_128_digest(data) if fit else None, data))
            widths, digests, data = zip(*out) if out else ([], [], [])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(widths, pa.int32()), pa.array(digests, pa.binary()), pa.array(data, pa.binary())],
                                  names=["row", "vec_id", "width", "digest", "data"])

    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("vec_id"),
                       F.col(vector).cast("array<double>").alias("x")).mapInArrow(
        code, "row long, vec_id long, width int, digest binary, data binary")


def near_vectors(rows: DataFrame, threshold: float = 0.9, id_column: str = "vec_id", vector: str = "embedding", block_bytes: int = 16 << 20) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `rows`.

    Rows link where the cosine of their vectors is `threshold` (above 0) or more. n_links: the other
    rows that a row links with; component_id: the smallest vec_id reachable over links; kept: whether
    that is the row's own. Null, empty and zero vectors and those with null or non-finite
    components link with nothing, nor do vectors of different numbers of components. Equal rows link
    like any others. A null vec_id is larger than any other; a component of such rows only has none,
    and of repeated vec_ids each row is kept or not by its own id. Other columns are ignored; an
    empty table gives an empty result.
    """
    held = materialise(_vectors(rows, id_column, vector), "vectors")
    fit = held.where("digest is not null")
    # Sums only, so that copies meet before the shuffle; the vector comes from the first row.
    classes = fit.groupBy("digest", "width").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id"))
    classes = materialise(classes, "classes")
    nodes = materialise(classes.join(held.select(F.col("row").alias("node"), "data"), "node").select("node", "width", "weight", "data"), "nodes")

    total, size = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("data")), F.lit(0))).first()
    slots = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-size // block_bytes))
    while blocks * (blocks + 1) < 4 * slots and total > 2 * TILE * blocks:
        blocks += 1

    def compare(table: pa.Table) -> pa.Table:
        node, weight, block = (table[c].to_numpy() for c in ("node", "weight", "block"))
        order = np.argsort(block, kind="stable")
        node, weight, block = node[order], weight[order], block[order]
        data = table["data"].combine_chunks().take(pa.array(order))
        coded = Coded(np.frombuffer(b"".join(data.to_pylist()), dtype=np.float64).reshape(len(node), -1))
        one, two = table["one"][0].as_py(), table["two"][0].as_py()
        middle = int(np.searchsorted(block, one, side="right"))
        first = 0 if one == two else middle
        label, links = np.arange(len(node)), np.zeros(len(node), dtype=np.int64)
        for x in range(0, middle, TILE):
            i = slice(x, min(x + TILE, middle))
            for y in range(x if one == two else first, len(node), TILE):
                a, b = coded.candidates(i, slice(y, min(y + TILE, len(node))), threshold)
                if one == two and y == x:
                    a, b = a[a < b], b[a < b]
                if len(a):
                    good = coded.linked(a, b, threshold)
                    a, b = a[good], b[good]
                    links += np.bincount(a, weight[b], len(node)).astype(np.int64) + np.bincount(b, weight[a], len(node)).astype(np.int64)
                    join(label, a, b)
        some = links > 0
        return pa.table([node[some], links[some], node[label[some]]], schema=LINKS)

    own = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    sent = nodes.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = sent.select("width", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "weight", "data")
    found = materialise(sent.groupBy("width", "one", "two").applyInArrow(compare, "node long, links long, root long"), "links")

    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = classes.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select(
        "digest", "node", "weight", "first_id", F.coalesce("root", "node").alias("root"))
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    links = found.groupBy(F.col("node").alias("of")).agg(F.sum("links").alias("links"))
    told = rooted.join(links, F.col("node") == F.col("of"), "left").join(first, "root").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    joined = fit.select("vec_id", "digest").join(told, "digest").select("vec_id", "n_links", "component_id")
    alone = held.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.expr("vec_id <=> component_id"))
