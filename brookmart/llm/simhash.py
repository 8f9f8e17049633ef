"""SimHash near-duplicates by generalised pigeonhole.

Two fingerprints that differ in at most `d` bits are found by cutting the bits into m
partitions with thresholds t_i that sum up to d - m + 1: in at least one partition the two differ
in at most t_i bits (a threshold of -1 skips the partition). Correlated bits are put into one
partition, since they make its values unselective; the thresholds come from dynamic
programming on estimated candidate counts. Probing lists each fingerprint under its own value
in a partition and under every value within the threshold.

Candidates are verified without listing all pairs of a large bucket: a bucket of few members
is compared pair by pair; the members of a larger one are listed under the 65 values within one
bit of themselves. Two fingerprints share such a value if and only if they differ in at most two
bits, and a value has 65 members at most. Components of the verified links are the groups.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import materialise
from .graph import components

BITS = 64
SEED = 42
#: Buckets with more members are verified through shared neighbours.
PAIRWISE = 32


def _fingerprint(text: str, width: int) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(width, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[b:e], SEED) for b, e in zip(begins, stops)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        some = hashes[at:at + 8192]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp (64 bits as a signed long) of every row; a null text is an empty one."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fps = [_fingerprint(t.as_py() or "", width) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bit_pairs(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set (64 x 64)."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, total = np.zeros((BITS, BITS)), 0
        for batch in rows:
            fps = batch.column(0).to_numpy().astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            both, total = both + bits.T @ bits, total + len(fps)
        yield pa.record_batch([pa.array([*range(BITS * BITS), -1]), pa.array([*both.ravel().astype(np.int64), total])], names=["cell", "n"])

    sums = dict(distinct.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect())
    both = np.array([sums.get(c, 0) for c in range(BITS * BITS)], dtype=np.float64).reshape(BITS, BITS)
    return sums.get(-1, 0), both


def correlated_groups(total: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Cut the bits into m groups: each in turn takes the bit most correlated with what it holds."""
    share = both / max(total, 1)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free = set(range(BITS))
    groups = []
    for i in range(m):
        size = BITS * (i + 1) // m - BITS * i // m
        rest = sorted(free)
        seed = rest[int(related[np.ix_(rest, rest)].sum(axis=1).argmax())]
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            rest = sorted(free)
            pick = rest[int(related[np.ix_(rest, group)].sum(axis=1).argmax())]
            group.append(pick)
            free.remove(pick)
        groups.append(sorted(group))
    return groups


def value_pairs(distinct: DataFrame, groups: list[list[int]]) -> list[float]:
    """Per group of bits, the ordered pairs of fingerprints that agree in it."""
    masks = [_signed(sum(1 << b for b in g)) for g in groups]
    parts = F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    counts = distinct.select(F.inline(parts)).groupBy("part", "key").count()
    sums = dict(counts.groupBy("part").agg(F.sum(F.col("count").cast("double") * F.col("count"))).collect())
    return [sums.get(i, 0.0) for i in range(len(groups))]


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost that sum up to `budget`; costs[i][t + 1] is partition i's at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, c in enumerate(own, start=-1):
                if spent + t not in step or cost + c < step[spent + t][0]:
                    step[spent + t] = (cost + c, [*chosen, t])
        best = step
    return best[budget]


def plan(distinct: DataFrame, distance: int, choices=(2, 3)) -> list[tuple[list[int], int]]:
    """Partitions (bits, threshold) to probe: the cheapest of the cuts into `choices` partitions.

    A partition's cost at threshold t is the keys that it lists and the candidate pairs it is
    estimated to give: those that agree in all its bits (counted), times the odds that up to t of
    its bits differ (from the share of ones of each bit).
    """
    total, both = bit_pairs(distinct)
    ones = np.diag(both) / max(total, 1)
    agree = np.clip(ones ** 2 + (1 - ones) ** 2, 1e-6, 1 - 1e-6)
    cuts = [correlated_groups(total, both, m) for m in choices]
    flat = [g for cut in cuts for g in cut]
    equal = dict(zip(map(tuple, flat), value_pairs(distinct, flat)))
    found = []
    for cut in cuts:
        costs = []
        for group in cut:
            odds = ((1 - agree) / agree)[group]
            near, keys, own = 1.0, 1, [0.0]
            own.append(total + equal[tuple(group)])
            for t in range(1, distance + 1):
                near += sum(float(np.prod(odds[list(c)])) for c in combinations(range(len(group)), t))
                keys += _choose(len(group), t)
                own.append(keys * total + equal[tuple(group)] * near)
            costs.append(own)
        cost, thresholds = allocate(costs, distance - len(cut) + 1)
        found.append((cost, [(g, t) for g, t in zip(cut, thresholds) if t >= 0]))
    return min(found, key=lambda f: f[0])[1]


def _choose(n, k):
    return 1 if k == 0 else _choose(n - 1, k - 1) * n // k


def _within(value, bits: list[int], distance: int):
    """Array of the values that differ from `value` in at most `distance` of the bits."""
    flips = [0]
    for t in range(1, distance + 1):
        flips += [_signed(sum(1 << b for b in c)) for c in combinations(bits, t)]
    return F.transform(F.array(*[F.lit(f).cast("long") for f in flips]), lambda f: value.bitwiseXOR(f))


def probe(distinct: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, key, rep, fp, own): each fingerprint under its own keys and those it probes."""
    listed = None
    for i, (bits, threshold) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))
        keys = distinct.select(F.lit(i).alias("part"), F.explode(_within(own, bits, threshold)).alias("key"), "rep", "fp", own.alias("value"))
        keys = keys.select("part", "key", "rep", "fp", (F.col("key") == F.col("value")).alias("own"))
        listed = keys if listed is None else listed.unionByName(keys)
    return listed


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """Edges (a, b) between reps that connect exactly the fingerprints within `distance` bits."""
    listed = probe(distinct, plan(distinct, distance))
    # Grouped by one column more than is joined on, so that the join exchanges both sides
    # itself and adaptive execution can split a bucket with very many members.
    buckets = listed.groupBy("part", "key", F.shiftrightunsigned("key", 32).alias("high")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("own").alias("owners")).where("n > 1 and owners > 0").drop("high")
    shared = materialise(listed.join(buckets, ["part", "key"]), "candidates")

    few = shared.where(F.col("n") <= PAIRWISE).groupBy("part", "key").agg(
        F.collect_list(F.struct("rep", "fp", "own")).alias("members"))  # PAIRWISE members at most
    pairs = (few.select("members", F.explode(F.filter("members", lambda m: m["own"])).alias("x"))
             .select("x", F.explode("members").alias("y"))
             .where((F.col("x.rep") != F.col("y.rep")) & (F.bit_count(F.expr("x.fp ^ y.fp")) <= distance))
             .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")))

    if distance != 2:
        raise ValueError("large buckets are verified through neighbours at one bit: distance must be 2")
    many = shared.where(F.col("n") > PAIRWISE).select("rep", "fp").distinct()
    hubs = (many.select("rep", F.explode(_within(F.col("fp"), list(range(BITS)), 1)).alias("hub"))
            .groupBy("hub").agg(F.collect_list("rep").alias("reps"))  # 65 at most
            .where("size(reps) > 1").select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")))
    return pairs.unionByName(hubs)


def simhash_groups(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fp and component_id of every row of `docs` (doc_id, text).

    Shingles are `width` words, repeats included; a shorter text is one shingle and a text
    without words has fingerprint 0, which is linked like any other. component_id is the smallest
    doc_id of all rows reachable over links of at most `distance` (2) bits. Equal fingerprints are
    one node. Rows without a doc_id get a component by their fingerprint, which is null if all
    rows of the component lack one. Other columns are ignored; an empty table gives no rows.
    """
    marked = materialise(fingerprints(docs, width), "fingerprints")
    distinct = materialise(marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    roots = components(links(distinct, distance))
    grouped = materialise(distinct.join(roots, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")), "components")
    return marked.join(grouped, "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns: of each group only the one with the smallest doc_id.

    Rows without a doc_id stay.
    """
    dropped = simhash_groups(docs, **options).where("doc_id != component_id").select("doc_id")
    return bloom.without(docs, "doc_id", materialise(dropped, "near-copies"))
