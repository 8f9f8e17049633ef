"""Hard negatives against a search of all rows."""
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm import hard_negatives as H
from brookmart.llm.queries import op13_hard_negatives

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, every=50, scale=256):
    fit = [(i, [math.floor(x * scale) for x in v], label) for i, v, label in rows
           if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, label in fit:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, q) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, own) for i, v, own in fit if i != a and len(v) == len(q))
        same, other = [s for s in scored if s[2] == label], [s for s in scored if s[2] != label]
        for p, i, _ in same[:5]:
            window = [s for s in other if 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(window)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def small():
    r = random.Random(8)
    point = lambda: [round(r.gauss(0, 1), 2) for _ in range(5)]
    rows = [(i, point(), r.choice([0, 1, 1, 1, 2])) for i in range(400)]
    same = point()
    rows += [(1000 + i, same, i % 2) for i in range(60)]  # ties
    rows += [(50, point(), 0), (50, rows[100][1], 1), (100, rows[100][1], rows[100][2]), (3, point(), 0)]
    rows += [(None, point(), 1), (2000, None, 1), (2050, point(), None), (2100, [], 1), (2150, [1.0, None, 1.0, 1.0, 1.0], 1), (2200, [float("nan")] * 5, 1),
             (2250, [0.0] * 5, 1), (2300, [3.0], 1), (2301, [2.0], 1), (2302, [1.5], 0), (2303, [-1.0], 0), (-50, point(), 1), (2350, [1e13, 1e13, 0.0, 0.0, 0.0], 1)]
    return rows


@pytest.mark.parametrize("shard_rows", [65536, 90])
def test_all_rows(spark, shard_rows):
    rows = small()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("x", "v", "shard", "width", "kind", "windows")})
    assert got(H.hard_negatives(df, shard_rows=shard_rows, sample=50)) == expected(rows)


def test_query_over_the_given_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert got(op13_hard_negatives(spark, FOLDER)) == expected(rows)


def test_empty_table(spark):
    assert got(H.hard_negatives(spark.createDataFrame([], SCHEMA))) == []


def test_cells_bound_their_scores():
    r = np.random.default_rng(2)
    rows = r.integers(-300, 300, size=(3000, 7))
    index = H.MultiIndex(rows, np.arange(3000), np.zeros(3000, dtype=int), 200)
    query, seen, last = r.integers(-300, 300, size=7), 0, float("inf")
    for upper, lower, begin, end in index.cells(query):
        scores = index.vectors[begin:end] @ query
        assert lower <= scores.min() and scores.max() <= upper <= last
        seen, last = seen + end - begin, upper
    assert seen == 3000 and index.codes > 2


def test_tight_windows_end_the_search_early():
    """Clustered rows: a search leaves out about half of them."""
    r = np.random.default_rng(3)
    centres = r.normal(size=(64, 16)) * 3000
    rows = (centres[r.integers(0, 64, 20000)] + r.normal(size=(20000, 16)) * 30).astype(np.int64)
    index = H.MultiIndex(rows, np.arange(20000), r.integers(0, 2, 20000), 4096)
    read = []
    cells = index.cells

    def counted(query):
        for cell in cells(query):
            read.append(cell[3] - cell[2])
            yield cell

    index.cells = counted
    assert len(H.positives(index, 5, 1, index.vectors[5].astype(np.int64), 5)) == 5
    assert sum(read) < 12000
