"""Mixing of rows whose doc_id is null or repeated."""
from collections import Counter

from brookmart.llm import mixing


def test_rows_without_a_doc_id_of_their_own(spark):
    rows = [(None if i % 5 == 0 else i % 11, f"t{i} " * (3 + i % 17), ["a", "b", None][i % 3], i, "x") for i in range(300)]
    rows += [(7, "same words here", "a", -1, "x")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, row string").repartition(4)
    taken = mixing.mix(docs)
    want, out = Counter(), Counter()
    for r in taken.collect():
        want[r.source] += r.taken
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    per_text = Counter()
    held = {t.split()[0]: len(t.split()) for _, t, *_ in rows[:300]}
    for r in mixed.collect():
        out[r.source] += len(r.text.split())
        per_text[r.text.split()[0]] += len(r.text.split())
        assert r.row == "x"
    assert out == want
    assert all(per_text[t] <= 2 * n for t, n in held.items())
    assert {t for t in held if int(t[1:]) % 5 == 0} & set(per_text)


def test_a_tiny_source_makes_only_its_own_blocks_small(spark):
    """One source of a few words beside large ones: their documents are not cut into single words."""
    rows = [(i, " ".join(["w"] * 400), "abc"[i % 3]) for i in range(600)] + [(1000 + i, "one two", "d") for i in range(3)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for source in "abcd":
        own = [r for r in out if r.source == source]
        took, target = sum(r.taken for r in own), own[0].target
        assert abs(took - target) <= max(8, 0.01 * target)
        if source != "d":
            assert max(len(r.spans) for r in own) <= 4
    assert all(r.taken <= 2 * r.size for r in out)
