"""Token alignment against plain Python."""
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

import brute
from brookmart.llm import alignment
from brookmart.llm.alignment import Aligner, ByteLevel, Pieces

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_of():
    """The byte behind each character of a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}


def expected(given):
    a_model = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    table, docs = byte_of(), []
    for doc_id, text in given:
        links, groups, a, b = [], [], [], []
        if text:
            ids = a_model.encode(" " + text, add_special_tokens=False).ids
            a = [(i, bytes(table[c] for c in a_model.id_to_token(i))) for i in ids]
            for i in b_model.encode(text):
                p = b_model.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode()))
            if {b"".join(x[1] for x in a), b"".join(x[1] for x in b)} != {(" " + text).encode()}:
                a, b = [], []
        i = j = at_a = at_b = 0
        own = ([], [])
        while i < len(a):
            links.append((a[i][0], b[j][0]))
            end_a, end_b = at_a + len(a[i][1]), at_b + len(b[j][1])
            if end_a <= end_b:
                own[0].append(a[i][0])
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                own[1].append(b[j][0])
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(own)
                own = ([], [])
        docs.append((doc_id, len(a), len(b), groups, links))
    counts = Counter(p for *_, links in docs for p in set(links))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        printed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(printed.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def got(docs, **options):
    return sorted((tuple(r) for r in alignment.align(docs, **options).select(*COLUMNS).collect()), key=repr)


def odd():
    """Texts at which one tokenizer or both do something of their own."""
    r = random.Random(3)
    return ["<s>x</s> <0x41> <|endoftext|>", "a▁b", "a\tb\n c", "é ﬁ 漢字 😀😀", " ", "  a  b  ", "x\x00y", "　a  b", "a" + " " * 500 + "b",
            " ".join("".join(r.choice("abé漢 .,'") for _ in range(r.randint(1, 12))) for _ in range(800)), "ab" * 3000, "don't 12 345's"]


def test_whole_table(spark, documents):
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd())] + [(None, "a null key"), (1, "a repeated key"), (1, "a repeated key")],
                                  "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(extra)
    want = expected([tuple(r) for r in docs.collect()])
    assert got(docs) == want
    # Documents of many chunks, composed as a tree of several levels.
    assert got(docs, chunk=40) == want


def test_extra_columns_and_empty_table(spark, documents, no_documents):
    clash = documents.limit(5).selectExpr("*", "1 as row", "2 as part", "3 as block", "4 as key", "5 as n", "6 as best")
    assert len(got(clash)) == 5
    assert got(no_documents) == []


def test_fragments_compose_in_any_order():
    aligner, text = Aligner(ByteLevel, Pieces), " " + odd()[9]
    whole = aligner.encode(text)
    want = aligner.close(aligner.fragment(whole))
    r = random.Random(1)
    for _ in range(20):
        cuts = sorted(r.sample(range(1, len(text.encode())), 30))
        begins = [np.concatenate([[0], e[:-1]]) for e in (whole.a_ends, whole.b_ends)]
        parts = []
        for low, high in zip([0, *cuts], [*cuts, len(text.encode())]):
            (i, k), (j, m) = (np.searchsorted(x, [low, high]).tolist() for x in begins)
            parts.append(aligner.fragment(alignment.Run(whole.a[i:k], whole.a_ends[i:k], whole.b[j:m], whole.b_ends[j:m])))
        while len(parts) > 1:  # any two neighbours
            i = r.randrange(len(parts) - 1)
            parts[i:i + 2] = [aligner.compose(parts[i], parts[i + 1])]
        made = aligner.close(parts[0])
        assert (made.groups, made.links, made.printed) == (want.groups, want.links, want.printed)
        assert made.keys.tolist() == want.keys.tolist() and made.times.tolist() == want.times.tolist()


@pytest.mark.parametrize("size", [1, 7, 50])
def test_chunks_cover_the_text(size):
    for text in odd():
        data = (" " + text).encode()
        parts = alignment.cut_text(" " + text, size)
        assert b"".join(c.encode()[low:high] for c, low, high in parts) == data
        assert all(c.startswith(" ") for c, _, _ in parts)


def test_encoder_is_that_of_the_file():
    own, model = ByteLevel(), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    for text in [*odd(), *(t for _, t, *_ in brute.rows() if t), "a" + " " * 300_000 + "b"]:
        assert own.encode(" " + text) == model.encode(" " + text, add_special_tokens=False).ids
