"""Plain Python versions of the operators, and a small table of documents."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, rank int, shard int"


def rows():
    """Documents with copies, near copies, shared passages, nulls and odd characters."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghié") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, line = say(140), say(60)
    texts = [say(r.randint(1, 300)) for _ in range(60)]
    texts += [texts[3], texts[3].replace(" ", "\n\t", 4), texts[3] + " ", texts[4], texts[4]]  # copies but for white space
    texts += [passage, say(30) + " " + passage + " " + say(80), passage[40:] + " " + say(10), say(5) + "\n" + passage]
    texts += [f"{say(40)} {line} {say(20)} {line} {say(3)}", line, line + " " + line]
    texts += [None, "", " ", "\x0b\x0c", "a", "a b", "  x\u0085y", "<|endoftext|> \\ </s>", "x" * 3000, say(6000), "ab " * 900]
    base = say(120).split()
    for i in range(40):  # near copies: a chain of texts that differ by a word
        base[i % 120] = r.choice(words)
        texts.append(" ".join(base))
    texts += [texts[0]] * 50
    out = [(i, t, r.choice(["en", "de", None]), r.choice(["s0", "s0", "s0", "s1", "é", "", None]), None) for i, t in enumerate(texts)]
    r.shuffle(out)
    return out


def documents(spark):
    # Extra columns with names that operators use themselves.
    return spark.createDataFrame([(*row, "x", 1, 2) for row in rows()], SCHEMA).repartition(5)


def exact(given):
    sha = {d: hashlib.sha256(SPACE.sub(" ", t or "").encode()).hexdigest() for d, t, *_ in given}
    groups = defaultdict(list)
    for d, s in sha.items():
        groups[s].append(d)
    return {(d, min(groups[s]), len(groups[s]), d == min(groups[s]), s) for d, s in sha.items()}


def simhash(given):
    fps = {}
    for d, t, *_ in given:
        w = [x.encode() for x in WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))]
        s = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        fps[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(fps)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(d, f"{fps[d]:016x}", find(d)) for d in ids}


def substrings(given, length=400):
    texts = {d: (t or "").encode() for d, t, *_ in given}
    seen = defaultdict(int)
    for t in texts.values():
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] += 1
    out = set()
    for d, t in texts.items():
        drop = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                drop[i:i + length] = b"\1" * length
        out.add((d, len(t), sum(drop), len(re.findall(rb"\x01+", drop)),
                 hashlib.sha256(bytes(c for c, x in zip(t, drop) if not x)).hexdigest()))
    return out


def phrases(given, window=50):
    words = {d: WORD.findall(t or "") for d, t, *_ in given}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), d)
    out = set()
    for d, w in words.items():
        drop = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                drop[i:i + window] = [True] * window
        kept = " ".join(x for x, gone in zip(w, drop) if not gone)
        out.add((d, len(w), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def targets(given):
    sums = defaultdict(int)
    for _, t, _, source, *_ in given:
        sums[source] += len(WORD.findall(t or ""))
    order = sorted(sums, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sums.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sums[s]}
        for s in over or free:
            target[s] = 2.0 * sums[s] if over else weight[s] * level
        left -= sum(2 * sums[s] for s in over)
        free -= over or free
    return sums, target


def top(vectors, k=10, every=100):
    import math
    whole = {i: [math.floor(x * 1024) for x in v] for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in whole:
        if q % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(hits[:k])}
    return out


def crc(b):
    return zlib.crc32(b)
