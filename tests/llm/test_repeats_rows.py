"""The substring operators on rows whose doc_id is null or repeated."""
import hashlib
import random

import pytest

from brookmart.llm import phrase_dedup, suffix_dedup
import brute


def rows():
    r = random.Random(8)
    words = ["".join(r.choice("abcdefghé") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, line = say(130), say(70)
    texts = [say(90) + " " + passage, passage + " " + say(40), say(10), line + " " + say(20), say(30) + " " + line + " " + say(9),
             passage, line, None, say(200) + " " + line]
    texts += [f"{say(20)} {line} {say(20)}" for _ in range(12)]
    return [([None, 4, 4, 7, None, 4, 2, None][i % 8], t) for i, t in enumerate(texts)]


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.mark.parametrize("options", [{}, {"group_rows": 2, "k": 64}])
def test_suffix_dedup_of_any_doc_ids(spark, options):
    given = rows()
    want = {(n, *w[1:]) for n, w in enumerate(sorted(brute.substrings([(i, t) for i, (_, t) in enumerate(given)])))}
    want = sorted(((given[w[0]][0], *w[1:]) for w in want), key=repr)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    assert sorted((tuple(x) for x in suffix_dedup.suffix_dedup(docs, **options).collect()), key=repr) == want


@pytest.mark.parametrize("options", [{}, {"k": 40, "shard_rows": 3}, {"shard_words": 200, "task_words": 300}])
def test_phrase_dedup_of_any_doc_ids(spark, options):
    given, window, first, want = rows(), 50, {}, []
    words = [brute.WORD.findall(t or "") for _, t in given]
    place = [2 ** 63 - 1 if d is None else d for d, _ in given]
    for p, w in zip(place, words):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, p), p)
    for (d, _), p, w in zip(given, place, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < p:
                gone[i:i + window] = [True] * window
        want.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    assert sorted((tuple(x) for x in phrase_dedup.phrase_dedup(docs, **options).collect()), key=repr) == sorted(want, key=repr)
