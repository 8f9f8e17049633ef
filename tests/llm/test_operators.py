"""The operators against plain Python, on awkward documents."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brookmart.llm import chat, exact_dedup, mixing, packing, phrase_dedup, quality, sharding, simhash, suffix_dedup, topk
import brute


def got(df, *columns):
    listed = [tuple(r) for r in df.select(*columns).collect()]
    assert len(listed) == len(set(listed))
    return set(listed)


def test_exact_dedup(documents, no_documents):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = brute.exact(brute.rows())
    assert got(exact_dedup.exact_dedup(documents), *columns) == want
    # A filter that is full sends every row through the shuffle; the result is the same.
    assert got(exact_dedup.exact_dedup(documents, max_bits=1), *columns) == want
    assert exact_dedup.exact_dedup(no_documents).count() == 0
    kept = exact_dedup.drop_copies(documents)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {w[0] for w in want if w[3]}


def test_exact_dedup_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (None, None), (5, "")], "doc_id long, text string")
    out = sorted((tuple(r)[:4] for r in exact_dedup.exact_dedup(rows).collect()), key=repr)
    assert out == sorted([(1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False), (None, None, 2, True), (None, None, 2, True),
                          (None, 5, 2, False), (5, 5, 2, True)], key=repr)


def test_simhash(documents, no_documents):
    out = simhash.simhash_groups(documents)
    assert got(out, "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id") == brute.simhash(brute.rows())
    assert simhash.simhash_groups(no_documents).count() == 0
    kept = simhash.drop_near_copies(documents)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in brute.simhash(brute.rows())}


@pytest.mark.parametrize("pairwise", [2, 32, 10 ** 6])
def test_simhash_links_of_dense_clusters(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    r = random.Random(3)
    fps = set()
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(25):
            fps.add(centre ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64) if r.random() < .4 else 0))
    fps = sorted(fps)
    rows = spark.createDataFrame([(i, simhash._signed(f)) for i, f in enumerate(fps)], "rep long, fp long")
    roots = {a.node: a.root for a in simhash.components(simhash.links(rows, 2)).collect()}
    root = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= 2:
                    root[i] = min(root[i], root[j])
        if all(root[i] == root[root[i]] for i in range(len(fps))) and all(
                root[i] == root[j] for i, a in enumerate(fps) for j, b in enumerate(fps[:i]) if (a ^ b).bit_count() <= 2):
            break
    assert [roots.get(i, i) for i in range(len(fps))] == root


def test_thresholds_are_allocated_by_cost():
    # Two partitions, thresholds sum up to 1: the costly one is probed exactly.
    assert simhash.allocate([[0, 1, 100, 1000], [0, 5, 6, 1000]], 1)[1] == [0, 1]
    assert simhash.allocate([[0, 1, 2, 3], [0, 500, 600, 1000]], 1)[1] == [2, -1]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 400), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 500: 400, 400: 400}


def test_packing(documents, no_documents):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = packing.pack(documents, windows=4, merge=2).collect()
    texts = {d: t or "" for d, t, *_ in brute.rows()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert by_doc.keys() == texts.keys()
    for d, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        ids = b"".join(p.ids for p in own)
        want = tokenizer.encode(texts[d], add_special_tokens=False).ids + [1]
        assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == want
        assert {p.doc_tokens for p in own} == {len(want)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
        assert sum(p.length for p in own) <= 2048
    total = sum(p.length for p in pieces)
    assert len(by_sequence) * 2048 < total + 4 * 2048 + total * 0.05
    assert packing.pack(no_documents).count() == 0
    plain = packing.pack(documents, windows=4, merge=2, keep_ids=False)
    assert plain.where("ids is not null").count() == 0
    assert got(plain, *packing.COLUMNS) == {tuple(p)[:7] for p in pieces}


def test_sharding(documents, no_documents):
    rows = documents.withColumn("size", F.octet_length(F.coalesce("text", F.lit("")))).select("doc_id", "size", "source", "lang")
    out = sharding.shard(rows, ["doc_id"], ["source", "lang"], ["size"], 24).collect()
    counts = Counter(r.shard for r in out)
    assert len(out) == len(brute.rows()) and max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 24
    for s in range(24):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    order = [r.curve for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert sharding.shard(no_documents.select("doc_id", "source", "lang", F.col("n_chars").alias("size")),
                          ["doc_id"], ["source", "lang"], ["size"], 24).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 3), (4, 2), (3, 1)])
def test_hilbert_neighbours(dims, bits):
    import itertools
    import numpy as np
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_chat(spark):
    controls = ["<|", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\\\\", "\\<|", "<", "|>", "<|part|>", "é\n𝄞", "", None]
    r = random.Random(1)
    rows = []
    for c in range(40):
        for t in range(r.randint(1, 7)):
            rows.append((c, t, r.choice(["user", "assistant", "assistant", "sys|>tem", "<|x", None]), r.choice(["", " ", "a"]).join(str(r.choice(controls)) for _ in range(3))))
    rows += [(50, 1, "user", None), (50, 1, "user", None), (50, None, "assistant", "first"), (None, 0, "assistant", "x")]
    frame = spark.createDataFrame([(*x, 7) for x in rows], "conv_id long, turn long, role string, text string, formatted int")
    chats = chat.format_chats(frame)
    want = defaultdict(list)
    for c, t, role, text in rows:
        want[c].append((-1 if t is None else t, role or "", text or ""))
    out = chats.select("conv_id", "formatted", "loss_spans", chat.read_back().alias("turns"), chat.loss_text().alias("loss")).collect()
    assert len(out) == len(want)
    for row in out:
        turns = [x[1:] for x in sorted(want[row.conv_id])]
        assert [tuple(t) for t in row.turns] == turns
        assert row.loss == "".join(t for role, t in turns if role == "assistant")
        blocks = sum(1 for i, t in enumerate(turns) if not i or turns[i - 1][0] != t[0])
        assert row.formatted.count("<|end|>") == blocks and row.formatted.count("<|part|>") == len(turns) - blocks
        assert row.formatted.count("</s>") == 1 and "[INST]" not in row.formatted and "<<SYS>>" not in row.formatted
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_mixing(documents, no_documents):
    options = {"shard_rows": 20, "blocks_per_source": 50}
    out = mixing.mix(documents, **options).collect()
    sums, target = brute.targets(brute.rows())
    assert sorted(r.doc_id for r in out) == list(range(len(out))) and len(out) == len(brute.rows())
    taken = Counter()
    for r in out:
        assert r.source_size == sums[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        spans = sum(s["to"] - s["from"] for s in r.spans)
        assert r.size == 0 or r.taken % r.size == spans % r.size
        taken[r.source] += r.taken
    for s in sums:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 1
    again = mixing.mix(documents.repartition(3), **options).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    assert mixing.mix(no_documents).count() == 0 and mixing.mixed_documents(no_documents).count() == 0
    assert mixing.mix(documents.where("text is null")).first().taken == 0
    mixed = mixing.mixed_documents(documents, **options)
    assert mixed.columns == documents.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(brute.WORD.findall(r.text))
    assert words == Counter({r.doc_id: r.taken for r in out if r.taken})


def test_apportion_is_sainte_lague(spark):
    r = random.Random(9)
    parties = [(g, p, float(r.randint(0, 1000) ** 2), seats) for g, seats in ((0, 50), (1, 7), (2, 1000)) for p in range(r.randint(1, 60))]
    frame = spark.createDataFrame(parties, "g int, p int, votes double, seats long")
    out = {(x.g, x.p): x.quota for x in mixing.apportion(frame, "votes", "seats", ["p"], ["g"]).collect()}
    for g in range(3):
        own = [x for x in parties if x[0] == g]
        quotas = Counter({x[1]: 0 for x in own})
        for _ in range(own[0][3]):
            best = max(own, key=lambda x: (x[2] / (2 * quotas[x[1]] + 1), -x[1]))
            quotas[best[1]] += 1
        assert {p: out[g, p] for _, p, *_ in own} == quotas


def test_top_k(spark):
    r = random.Random(2)
    vectors = [(i, [r.choice([0.0, 0.5, -0.25, r.gauss(0, 1)]) for _ in range(8)]) for i in range(3000)]
    vectors += [(3000 + i, vectors[i % 5][1]) for i in range(300)]
    vectors += [(-100, [1.0, 2.0]), (-99, [3.0, 4.0]), (4000, None), (4100, [None] * 8), (4200, [float("nan")] * 8), (4300, [float("inf")] * 8), (4400, [])]
    frame = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<double>, score int")
    for options in ({"shard_rows": 500, "block": 8}, {}):
        assert got(topk.top_k(frame, **options), "query_id", "rank", "vec_id", "score") == brute.top(vectors)
    assert topk.top_k(frame.limit(0)).count() == 0
    large = spark.createDataFrame([(0, [1e6, 2e6]), (1, [9e5, 1e6]), (2, [-1e6, 5.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in topk.top_k(large).orderBy("rank").collect()] == [1, 2]


def test_quality(spark, no_documents):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(900):
        toxic, low = r.random() < .15, r.random() < .15
        text = [r.choice(words) for _ in range(r.randint(20, 120))]
        if toxic:
            text[r.randrange(len(text))] = r.choice(["vile", "nasty", "awful"])
        if low:
            text = [w + "%%%" for w in text]
        docs.append((i, " ".join(text), "en", f"s{i % 7}", None))
        labels.append((i, int(not low), int(toxic)))
    docs += [(1000, None, None, None, None), (1001, "", "en", None, None), (1002, "vile " * 5000, "xx", "s1", 3)]
    frame = spark.createDataFrame(docs, no_documents.schema)
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id long, quality int, toxic int")
    out = {x.doc_id: x for x in quality.classify(frame, known).collect()}
    assert len(out) == len(docs)
    held_out = [x for x in labels if x[0] % 2 == 0]
    right = sum(out[d].kept == bool(q and not t) for d, q, t in held_out)
    assert right / len(held_out) > 0.97
    assert not out[1002].kept
    kept = quality.keep_clean(frame, known)
    assert kept.columns == frame.columns and kept.count() == sum(x.kept for x in out.values())
    assert quality.classify(frame, known.limit(0)).where("kept").count() == len(docs)
    assert quality.classify(no_documents, known).count() == 0


@pytest.mark.parametrize("labels", [[(0, 1, 0), (1, 0, 1)], [(1, 0, 1)], [(0, 1, 0), (1, 0, 1), (2, 0, 0), (3, 1, 1), (4, 1, 0)]])
def test_a_few_labels_drop_no_other_documents(spark, no_documents, labels):
    """What tells two labelled texts apart by chance says nothing about others."""
    r = random.Random(8)
    docs = [(i, " ".join("".join(r.choice("abcdef") for _ in range(r.randint(2, 8))) for _ in range(r.randint(1, 300))), "en", f"s{i % 3}", None)
            for i in range(60)]
    frame = spark.createDataFrame(docs, no_documents.schema)
    out = quality.classify(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("kept").collect()
    assert {x.doc_id for x in out} >= set(range(5, 60))


def test_sparse_places_shrink(spark):
    rows = [("big", "a", 3.0)] * 500 + [("big", "b", -4.0)] * 500 + [("one", "a", 3.0)] + [("rest", "a", -4.0)] * 1000
    scored = spark.createDataFrame(rows, "source string, lang string, toxic_odds double").withColumn("low_odds", F.lit(-5.0))
    shift = {(r.source, r.lang): r.toxic_shift for r in quality.place_posteriors(scored).collect()}
    assert shift["big", "a"] > shift["one", "a"] > 0 > shift["rest", "a"]




@pytest.mark.parametrize("options", [{}, {"group_rows": 2, "k": 64}, {"shard_bytes": 4000, "k": 350}])
def test_suffix_dedup(documents, no_documents, options):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got(suffix_dedup.suffix_dedup(documents, **options), *columns) == brute.substrings(brute.rows())
    assert suffix_dedup.suffix_dedup(no_documents).count() == 0


@pytest.mark.parametrize("letters,depth", [(1, 400), (2, 9), (2, 400), (5, 30), (200, 400)])
def test_suffix_order(letters, depth):
    import numpy as np
    r = np.random.default_rng(letters)
    for n in (0, 1, 2, 3, 4, 5, 50, 51, 52, 700):
        s = r.integers(1, letters + 1, n)
        order = suffix_dedup.suffix_order(s, depth).tolist()
        assert sorted(order) == list(range(n))
        prefixes = [s[i:i + depth].tolist() for i in order]
        assert prefixes == sorted(prefixes)


def test_repeated_windows():
    r = random.Random(6)
    for _ in range(30):
        texts = [bytes(r.choice(b"ab") for _ in range(r.randint(6, 60))) for _ in range(5)]
        texts += [texts[0][:8], b"abababababab"]
        windows = [t[i:i + 6] for t in texts for i in range(len(t) - 5)]
        want = [[windows.count(t[i:i + 6]) > 1 for i in range(len(t) - 5)] for t in texts]
        assert [f.tolist() for f in suffix_dedup.repeated_windows(texts, 6)] == want


@pytest.mark.parametrize("options", [{}, {"k": 40, "shard_rows": 3}, {"shard_words": 200, "task_words": 300}])
def test_phrase_dedup(documents, no_documents, options):
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert got(phrase_dedup.phrase_dedup(documents, **options), *columns) == brute.phrases(brute.rows())
    assert phrase_dedup.phrase_dedup(no_documents).count() == 0
