"""Near copies of the corpus pipeline: SimHash candidates, then true Jaccard similarity.

Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of 0.8 or
more. Such pairs lie up to 14 bits apart (measured on sf0.1, see README), so fingerprints are
compared at 14 bits by the generalised pigeonhole of `simhash.plan`: in one partition of the bits at
least, two of them differ in at most its threshold.

1. Texts with equal sets of shingles are one node.
2. Probing: a partition's first bits are its shard, and a shard with many nodes is cut into blocks.
   Nodes are sent to the pairs of blocks whose shards the threshold allows, and values within the
   threshold are compared there, all with all. Pairs that a sketch rejects are done with. Of those
   that are left a task, which has several small pairs of blocks or a large one, returns a forest: fewer
   pairs than nodes. Its components are clusters; all similar pairs lie within them.
3. The nodes of clusters are sent once more, with their shingles, to the task of their cluster (a
   large one is cut into blocks, and its pairs of blocks are tasks), where close pairs are verified.
   Nodes that are joined already need no more comparing. A task returns a forest again.
4. Components of all links; of each the row with the smallest doc_id stays.

So what is shuffled and returned grows with the nodes; only the work inside a task grows with the pairs
of nodes that are close in bits.

The sketch has 128 places. A shingle hash falls on one, which is then filled and takes a bit of its
smallest hash. A place that is filled for one set only, or shows different bits, stands for a shingle of
its own that one of the sets lacks; sets of s shingles together that are similar have at most s / 9
of those (at 0.8), so no similar pair is rejected by it. For short texts, of which each shingle has a
place to itself, this count is nearly exact. For long ones the bits are a sample: at similarity 0.8, 12.8
of 128 differ on average, and more than `BITS_APART` about 2 times in 100,000 pairs (calculated); of
unlike texts 64 do.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom, simhash
from .common import keyed, materialise
from .graph import components
from .near_vectors import join

#: Places of the sketch, and how many of its bits may differ.
PLACES = 128
BITS_APART = 28
#: Bits of a partition that name its shard, at least; they grow with the number of nodes.
SHARD_BITS = 4
#: Nodes of a block, and nodes that are compared at once with as many others.
BLOCK, TILE = 8192, 1024
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted hashes of the different shingles; a shorter text is one, a text without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[b:e], simhash.SEED) for b, e in zip(begins, ends[min(width, len(words)) - 1:].tolist())], dtype=np.uint64))


def sketch(hashes: np.ndarray) -> bytes:
    """Which places are filled, and a bit of the smallest hash of each."""
    begins = np.searchsorted(hashes, np.arange(PLACES, dtype=np.uint64) << np.uint64(64 - PLACES.bit_length() + 1))
    filled = begins < np.append(begins[1:], len(hashes))
    bits = np.zeros(PLACES, dtype=np.uint8)
    bits[filled] = hashes[begins[filled]] & np.uint64(1)
    return np.packbits(filled, bitorder="little").tobytes() + np.packbits(bits, bitorder="little").tobytes()


def marks(docs: DataFrame, width: int) -> DataFrame:
    """row, doc_id, fp, sketch, size and shingle_set (a 128-bit digest) of every row (row, doc_id, text)."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for t in batch.column(2):
                text = t.as_py() or ""
                own = shingles(text, width)
                out.append((simhash._fingerprint(text, width), sketch(own), len(own), xxhash.xxh128_digest(own.tobytes())))
            columns = [list(c) for c in zip(*out)] if out else [[]] * 4
            types = [pa.int64(), pa.binary(), pa.int64(), pa.binary()]
            yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types))],
                                  names=["row", "doc_id", "fp", "sketch", "size", "shingle_set"])

    return docs.select("row", F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "row long, doc_id long, fp long, sketch binary, size long, shingle_set binary")


def _value(bits: list[int]):
    """The bits of a fingerprint, put next to each other."""
    value = F.lit(0).cast("int")
    for place, bit in enumerate(bits):
        value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", bit).bitwiseAND(F.lit(1)).cast("int"), place))
    return value


class Nodes:
    """The nodes that a task holds, as arrays."""

    def __init__(self, table: pa.Table, parts: list[tuple[list[int], int]], part: int, distance: int, similarity: float):
        self.rep, self.size, self.here = (table[c].to_numpy() for c in ("rep", "size", "here"))
        self.fp = table["fp"].to_numpy().view(np.uint64)
        words = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype="<u8").reshape(len(self.rep), -1)
        self.filled, self.bits = words[:, :PLACES // 64], words[:, PLACES // 64:]
        self.distance, self.similarity = distance, similarity
        # Pairs that an earlier partition brings together are compared there.
        self.earlier = [(np.uint64(sum(1 << b for b in bits)), threshold) for bits, threshold in parts[:part]]

    def close(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a, b): the nodes of `i` and `j` that may be similar, but for those compared elsewhere."""
        at = np.nonzero(np.bitwise_count(self.fp[i][:, None] ^ self.fp[j][None, :]) <= self.distance)
        a, b = i[at[0]], j[at[1]]
        total = self.size[a] + self.size[b]
        good = np.minimum(self.size[a], self.size[b]) >= self.similarity * np.maximum(self.size[a], self.size[b])
        for mask, threshold in self.earlier:
            good &= np.bitwise_count((self.fp[a] ^ self.fp[b]) & mask) > threshold
        a, b, total = a[good], b[good], total[good]
        lone = np.bitwise_count(self.filled[a] ^ self.filled[b]).sum(axis=1, dtype=np.int64)
        apart = np.bitwise_count((self.bits[a] ^ self.bits[b]) & self.filled[a] & self.filled[b]).sum(axis=1, dtype=np.int64)
        good = (lone + apart <= total * (1 - self.similarity) / (1 + self.similarity) + 1e-6) & (apart <= BITS_APART)
        return a[good], b[good]

    def pairs(self, one: int, two: int, bits: list[int], threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Close pairs of the two blocks, a tile at a time."""
        flips = [f for f in range(1 << len(bits)) if f.bit_count() <= threshold]
        value = np.zeros(len(self.fp), dtype=np.int64)
        for place, bit in enumerate(bits):
            value |= ((self.fp >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place

        def by_value(block):
            own = np.flatnonzero(self.here == block)
            own = own[np.argsort(value[own], kind="stable")]
            values, begins = np.unique(value[own], return_index=True)
            return dict(zip(values.tolist(), np.split(own, begins[1:]))) if len(own) else {}

        left = by_value(one)
        right = left if one == two else by_value(two)
        for v, some in left.items():
            for w in {v ^ f for f in flips} & right.keys() if len(flips) < len(right) else [w for w in right if (v ^ w).bit_count() <= threshold]:
                if one == two and w < v:
                    continue
                more = right[w]
                for x in range(0, len(some), TILE):
                    for y in range(x if one == two and v == w else 0, len(more), TILE):
                        a, b = self.close(some[x:x + TILE], more[y:y + TILE])
                        if one == two and v == w and x == y:
                            a, b = a[a < b], b[a < b]
                        if len(a):
                            yield a, b


def dealt(nodes: DataFrame, parts: list[tuple[list[int], int]], shard_bits: int, block: int) -> DataFrame:
    """`nodes` with part, here (its block), the pairs of blocks (one, two) it is sent to and their task, of about `block` rows or one pair."""
    sent = None
    for i, (bits, threshold) in enumerate(parts):
        own = bits[:shard_bits]
        flips = [f for f in range(1 << len(own)) if f.bit_count() <= threshold]
        rows = nodes.select(F.lit(i).alias("part"), *nodes.columns, _value(own).alias("shard"),
                            F.array(*[F.lit(f) for f in flips]).alias("flips"))
        sent = rows if sent is None else sent.unionByName(rows)
    # At most 2 ** shard_bits rows a partition.
    sizes = materialise(sent.groupBy("part", "shard", "flips").agg(F.count(F.lit(1)).alias("rows")).withColumn("blocks", F.ceil(F.col("rows") / block).cast("long")), "shards")
    blocks = sizes.select("part", "shard", "blocks")
    reached = sizes.select("part", "rows", F.explode(F.transform("flips", lambda f: F.col("shard").bitwiseXOR(f))).alias("shard")).join(F.broadcast(blocks), ["part", "shard"])
    tasks = max(1, (reached.agg(F.sum(F.col("rows") * F.col("blocks"))).first()[0] or 0) // block)
    here = F.shiftleft(F.col("shard").cast("long"), 32) + F.pmod(F.xxhash64("rep"), F.col("blocks"))
    placed = sent.join(F.broadcast(blocks), ["part", "shard"]).withColumn("here", here)
    other = placed.drop("blocks").withColumn("flip", F.explode("flips")).withColumn("other", F.col("shard").bitwiseXOR(F.col("flip")))
    other = other.join(F.broadcast(blocks.toDF("part", "other", "blocks")), ["part", "other"])
    both = other.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn(
        "there", F.shiftleft(F.col("other").cast("long"), 32) + F.col("number"))
    pairs = both.select("part", F.least("here", "there").alias("one"), F.greatest("here", "there").alias("two"), "here", *nodes.columns)
    return pairs.withColumn("task", F.pmod(F.xxhash64("part", "one", "two"), F.lit(tasks)))


def candidates(nodes: DataFrame, parts: list[tuple[list[int], int]], distance: int, similarity: float, shard_bits: int, block: int) -> DataFrame:
    """(a, b): in each task a forest of the pairs that the sketch does not reject."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("part", "one", "two")])
        keys = np.stack([table[c].to_numpy() for c in ("part", "one", "two")], axis=1)
        begins = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        reps, place = np.unique(table["rep"].to_numpy(), return_inverse=True)
        label = np.arange(len(reps))
        for begin, end in zip(begins.tolist(), np.append(begins[1:], len(keys)).tolist()):
            part, one, two = keys[begin].tolist()
            x = Nodes(table.slice(begin, end - begin), parts, part, distance, similarity)
            own = np.arange(end - begin)
            for a, b in x.pairs(one, two, *parts[part]):
                join(own, a, b)
            linked = np.flatnonzero(own != np.arange(end - begin))
            join(label, place[begin + linked], place[begin + own[linked]])
        linked = label != np.arange(len(reps))
        return pa.table([reps[linked], reps[label[linked]]], schema=PAIRS)

    return dealt(nodes, parts, shard_bits, block).groupBy("task").applyInArrow(compare, "a long, b long").distinct()


def verified(nodes: DataFrame, distance: int, similarity: float, block: int) -> DataFrame:
    """(a, b): a forest of the similar pairs of each cluster. `nodes` (written) has root, its cluster,
    and hashes, its shingles. Small clusters share tasks."""

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by("root")
        x = Nodes(table, [], 0, distance, similarity)
        held = [np.frombuffer(h, dtype=np.uint64) for h in table["hashes"].to_pylist()]
        one, two = table["one"][0].as_py(), table["two"][0].as_py()
        label, out = np.arange(len(table)), []

        def link(a, b):
            while len(a):
                apart = label[a] != label[b]
                a, b = a[apart], b[apart]
                for i, j in zip(a[:64].tolist(), b[:64].tolist()):
                    if label[i] != label[j]:
                        shared = len(np.intersect1d(held[i], held[j], assume_unique=True))
                        if shared >= similarity * (len(held[i]) + len(held[j]) - shared):
                            label[label == label[j]] = label[i]
                            out.append((x.rep[i], x.rep[j]))
                a, b = a[64:], b[64:]

        roots = table["root"].to_numpy()
        for own in np.split(np.arange(len(table)), np.flatnonzero(np.diff(roots)) + 1):
            left, right = own[x.here[own] == one], own[x.here[own] == two]
            for i in range(0, len(left), TILE):
                for j in range(i if one == two else 0, len(right), TILE):
                    a, b = x.close(left[i:i + TILE], right[j:j + TILE])
                    if one == two and i == j:
                        a, b = a[a < b], b[a < b]
                    link(a, b)
        return pa.table([np.array(c, dtype=np.int64) for c in (zip(*out) if out else ([], []))], schema=PAIRS)

    shared = max(1, nodes.count() // 1024)
    sizes = nodes.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    placed = nodes.join(sizes, "root").withColumn("here", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        *nodes.columns, "here", F.least("here", "other").alias("one"), F.greatest("here", "other").alias("two"),
        F.when(F.col("blocks") > 1, F.col("root")).otherwise(-1 - F.pmod(F.xxhash64("root"), F.lit(shared))).alias("task"))
    return sent.groupBy("task", "one", "two").applyInArrow(verify, "a long, b long")


def with_shingles(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """(rep, hashes) of the rows `reps`; only their texts are shuffled."""

    def sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            hashes = [shingles(t.as_py() or "", width).tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(hashes, pa.binary())], names=["rep", "hashes"])

    some = bloom.may_hold(docs.select(F.col("row").alias("rep"), F.col("text").cast("string").alias("text")), "rep", reps).where("maybe").drop("maybe")
    return some.join(reps, "rep", "left_semi").mapInArrow(sets, "rep long, hashes binary")


def groups(docs: DataFrame, width: int = 5, distance: int = 14, similarity: float = 0.8, partitions: int = 5, block: int = BLOCK) -> DataFrame:
    """row, doc_id and keep_row of every row of `docs` (row, doc_id, text; `row` is a key and never null).

    keep_row is, of all rows reachable over similar pairs, the one with the smallest doc_id; a null
    doc_id is larger than any other, and of repeated ones the smallest row counts. Rows with equal
    sets of shingles, also empty ones, are similar.
    """
    marked = materialise(marks(docs, width), "marks")
    nodes = marked.groupBy("shingle_set", "size").agg(F.min(F.struct("row", "fp", "sketch")).alias("m"))
    nodes = materialise(nodes.select("shingle_set", "size", F.col("m.row").alias("rep"), F.col("m.fp").alias("fp"), F.col("m.sketch").alias("sketch")), "nodes")
    worded = nodes.where("size > 0").select("rep", "fp", "sketch", F.col("size").cast("int").alias("size"))
    parts = simhash.plan(worded, distance, (partitions,))
    shard_bits = max(SHARD_BITS, (worded.count() // block).bit_length())
    clusters = components(materialise(candidates(worded, parts, distance, similarity, shard_bits, block), "candidates"))
    clusters = materialise(clusters.select(F.col("node").alias("rep"), "root"), "clusters")
    shingled = worded.join(clusters, "rep").join(with_shingles(docs, clusters.select("rep"), width), "rep")
    joined = components(materialise(verified(materialise(shingled, "shingled"), distance, similarity, block), "links"))
    rooted = nodes.join(joined, F.col("rep") == F.col("node"), "left").select("shingle_set", F.coalesce("root", "rep").alias("root"))
    placed = materialise(marked.select("row", "doc_id", "shingle_set").join(rooted, "shingle_set").select("row", "doc_id", "root"), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    # As in exact_dedup: the join gets exchanges of its own, which can split a large group.
    kept = placed.groupBy("root", F.pmod("root", F.lit(2)).alias("half")).agg(first).drop("half")
    return placed.join(kept, "root").select("row", "doc_id", F.col("first.row").alias("keep_row"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns: of each group of near copies only the one with the smallest doc_id.

    Exactly one row with a doc_id of a group stays, also where doc_ids are repeated (see `groups`); rows
    without one stay. Null and empty texts are copies of each other. An empty table gives an empty one.
    """
    held = keyed(docs)
    found = groups(held.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text")), **options)
    dropped = found.where("row != keep_row and doc_id is not null").select("row")
    return bloom.without(held, "row", materialise(dropped, "near-copies")).select("doc.*")
