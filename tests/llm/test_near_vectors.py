"""Near-duplicate embeddings against all pairs in double precision."""
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from brookmart.llm import near_vectors
from brookmart.llm.common import table
from brookmart.llm.near_vectors import Coded, join

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, threshold=0.9):
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fit = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    links = [0] * n
    for i in range(n):
        for j in range(i):
            if fit[i] and fit[j] and len(rows[i][1]) == len(rows[j][1]):
                x, y = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (i, j))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    root[find(i)] = find(j)
    first = {}
    for i in range(n):
        if rows[i][0] is not None:
            first[find(i)] = min(first.get(find(i), rows[i][0]), rows[i][0])
    return sorted(((v, links[i], first.get(find(i)), v == first.get(find(i))) for i, (v, _) in enumerate(rows)), key=repr)


def small():
    r = np.random.default_rng(4)
    base = r.normal(size=(20, 6))
    rows = [(100 - i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, (base[i % 4] + r.normal(size=6) * 0.35).tolist()) for i in range(60)]  # around the threshold
    rows += [(300 + i, base[0].tolist()) for i in range(40)] + [(400 + i, (base[0] * 3.5 ** i).tolist()) for i in range(5)]
    rows += [(500, None), (501, []), (502, [0.0] * 6), (503, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (504, [float("nan")] * 6), (505, [float("inf")] + [0.0] * 5),
             (506, [-0.0, 1.0]), (507, [0.0, 1.0]), (508, [1e200, 1e200]), (509, [1e-200, 1e-200]), (None, [1.0, 0.01]), (None, None), (510, [1.0]), (510, [-1.0])]
    return rows + [rows[0], (None, [5.0, 5.0, 1.0])]


def got(df, **options):
    return sorted((tuple(r) for r in near_vectors.near_vectors(df, **options).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_all_pairs(spark, block_bytes):
    rows = small()
    df = spark.createDataFrame([(v, x, 0) for v, x in rows], SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("row", "node", "block", "digest")})
    assert got(df, block_bytes=block_bytes) == expected(rows)


def test_given_table(spark):
    df = table(spark, FOLDER, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    near = df.where("vec_id % 3 = 0").select((F.col("vec_id") + 10_000).alias("vec_id"), F.transform("embedding", lambda x: x + 0.02 * F.sin(x * 1000)).alias("embedding"))
    df = df.unionByName(near)
    assert got(df) == expected([tuple(r) for r in df.collect()])


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_bounds_hold():
    r = np.random.default_rng(1)
    for width in (1, 3, 64, 1500):
        x = r.normal(size=(200, width)) * 10.0 ** r.integers(-100, 100, size=(200, 1))
        coded = Coded(x)
        unit = coded.rows / coded.norms[:, None]
        true = unit @ unit.T
        about = (coded.codes.astype(np.int64) @ coded.codes.T.astype(np.int64)) * np.outer(coded.scale.astype(float), coded.scale.astype(float))
        assert (np.abs(true - about) <= coded.error[:, None] * coded.length[None, :] + coded.error[None, :] + 1e-6).all()
        a, b = coded.candidates(slice(0, 100), slice(100, 200), 0.2)
        want = set(zip(*(x.tolist() for x in np.nonzero(true[:100, 100:] >= 0.2))))
        assert want <= set(zip(a.tolist(), (b - 100).tolist()))


def test_join_of_labels():
    label = np.arange(9)
    join(label, np.array([8, 1, 5, 5]), np.array([7, 2, 2, 6]))
    join(label, np.array([7]), np.array([6]))
    assert label.tolist() == [0, 1, 1, 3, 4, 1, 1, 1, 1]
