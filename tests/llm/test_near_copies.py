"""The pipeline's near copies against plain Python."""
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brookmart.llm import exact_dedup, near_copies, quality, simhash


def near_texts():
    """Texts with copies that differ by a few words, others that share only a half, a large group."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]
    texts = []
    for n in range(60):
        base = [r.choice(words) for _ in range(r.randint(60, 400))]
        texts.append(base)
        for edits in (1, 2, 3, 8):
            other = list(base)
            for _ in range(edits):
                other[r.randrange(len(other))] = r.choice(words)
            texts.append(other)
        texts.append(base[:len(base) // 2] + [r.choice(words) for _ in range(len(base) // 2)])
    base = [r.choice(words) for _ in range(300)]
    for _ in range(150):
        other = list(base)
        other[r.randrange(300)] = r.choice(words)
        texts.append(other)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(9000, ""), (9001, None), (9002, "a b"), (9003, "A  b"), (None, "a b")]


def want(rows):
    def own(text):
        w = (text or "").lower().split()
        return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {d: own(t) for d, t in rows if d is not None}
    ids = sorted(sets)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_near_copies_of_the_pipeline(spark):
    rows = near_texts()
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, n_chars long").repartition(3)
    known = want(rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    got = {r.doc_id for r in kept.collect()}
    true = set(known.values()) | {None}
    # No text goes that has no near copy; what is missed lies over 14 bits apart.
    assert true <= got
    assert len(got - true) <= 0.02 * (len(known) - len(true) + 1)
    assert near_copies.drop_near_copies(docs.limit(0)).count() == 0


def test_blocks_of_a_shard_give_the_same_groups(spark):
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.monotonically_increasing_id())
    whole, cut = ({tuple(r) for r in near_copies.groups(near_copies.materialise(docs, "d"), block=b).collect()} for b in (8192, 100))
    assert whole == cut


def test_sketches_reject_no_similar_sets():
    """The count of places that differ is never above that of the shingles, and nearly it for short texts."""
    r = random.Random(4)
    words = [str(r.random()) for _ in range(5000)]
    for size in (8, 40, 150, 2000):
        base = [r.choice(words) for _ in range(size)]
        other = list(base)
        for _ in range(max(1, size // 60)):
            other[r.randrange(size)] = r.choice(words)
        one, two = (near_copies.shingles(" ".join(t), 5) for t in (base, other))
        x, y = (np.frombuffer(near_copies.sketch(h), dtype=np.uint8) for h in (one, two))
        half = near_copies.PLACES // 8
        lone = int(np.bitwise_count(x[:half] ^ y[:half]).sum())
        apart = int(np.bitwise_count((x[half:] ^ y[half:]) & x[:half] & y[:half]).sum())
        true = len(np.setxor1d(one, two))
        assert lone + apart <= true
        assert size > 40 or lone + apart >= 0.5 * true
        assert apart <= near_copies.BITS_APART


def short_group(n):
    """Short texts two words apart from each other: some pairs are similar, most are nearly so."""
    r = random.Random(n)
    base = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(n):
        other = list(base)
        other[r.randrange(40)] = f"x{r.randrange(9)}"
        texts.append(" ".join(other))
    return list(enumerate(texts))


def test_a_group_of_short_texts_gives_few_links(spark):
    """What a task returns grows with the nodes, not with their pairs; nothing is lost by it."""
    returned = []
    for n in (150, 300):
        rows = short_group(n)
        docs = near_copies.materialise(spark.createDataFrame(rows, "row long, text string").selectExpr("row", "row as doc_id", "text"), "d")
        got = {r.row: r.keep_row for r in near_copies.groups(docs).collect()}
        true = want(rows)
        assert all(true[d] == true[k] for d, k in got.items())
        assert sum(d == k for d, k in got.items()) <= 1.02 * sum(d == k for d, k in true.items()) + 1
        nodes = near_copies.marks(docs, 5).select(F.col("row").alias("rep"), "fp", "sketch", "size")
        parts = simhash.plan(near_copies.materialise(nodes, "n"), 14, (5,))
        returned.append(near_copies.candidates(nodes, parts, 14, 0.8, 4, 8192).count())
    assert returned[0] < 150 * 20 and returned[1] < 2.5 * returned[0] + 50


@pytest.mark.parametrize("block", [8192, 400])
def test_a_task_of_several_pairs_of_blocks_returns_one_forest(spark, block):
    """Links that the pairs of blocks of a task find again are not returned again; the clusters stay the same."""
    docs = near_copies.materialise(spark.createDataFrame(short_group(150), "row long, text string").selectExpr("row", "row as doc_id", "text"), "d")
    nodes = near_copies.materialise(near_copies.marks(docs, 5).select(F.col("row").alias("rep"), "fp", "sketch", "size"), "n")
    parts = simhash.plan(nodes, 14, (5,))
    tasks = near_copies.dealt(nodes, parts, 4, block).select("task").distinct().count()
    found = near_copies.candidates(nodes, parts, 14, 0.8, 4, block).toPandas()
    assert tasks == 1 if block == 8192 else 4 < tasks < 30
    assert len(found) < 150 * tasks
    rows = nodes.toArrow().append_column("here", pa.array([0] * 150, pa.int32()))
    every = near_copies.Nodes(rows, [], 0, 14, 0.8)
    label, true = np.arange(150), np.arange(150)
    near_copies.join(true, *(every.rep[i] for i in every.close(*2 * [np.arange(150)])))
    near_copies.join(label, *(found[c].to_numpy() for c in "ab"))
    assert label.tolist() == true.tolist()


CLASHING = ("words", "block", "slots", "maybe", "row", "held", "key", "doc", "size", "fp", "keep_row", "h")


@pytest.mark.parametrize("stage", ["quality", "exact_dedup", "near_dedup"])
def test_stages_drop_rows_not_ids(spark, stage):
    """Repeated and null doc_ids, columns with the operators' own names: a text goes only for its own copy."""
    say = " ".join(f"word{i}" for i in range(50))
    rows = [(1, "a"), (5, "a"), (5, "b"), (None, "b"), (None, "c"), (None, "c"), (2, say), (2, say + " more"), (2, "other text"), (2, "other text"), (9, None), (9, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(7) for c in CLASHING})
    kept = {"quality": lambda: quality.keep_clean(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")),
            "exact_dedup": lambda: exact_dedup.drop_copies(docs), "near_dedup": lambda: near_copies.drop_near_copies(docs)}[stage]()
    assert kept.columns == docs.columns and all(r.maybe == 7 and r.block == 7 for r in kept.collect())
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    if stage == "quality":
        assert got == sorted(rows, key=repr)
        return
    named = [t or "" for d, t in got if d is not None or stage == "exact_dedup"]
    texts = {t or "" for d, t in rows if (d is not None or stage == "exact_dedup") and not (stage == "near_dedup" and t == say + " more")}
    assert sorted(texts) == sorted(named)  # one row of each
    assert (1, "a") in got and (5, "b") in got and (5, "a") not in got
    assert got.count((None, "b")) == (stage == "near_dedup")
