"""Removing repeated byte strings with difference-cover suffix sorting.

The text that can repeat is found first, without deciding anything: every 400-byte window has
an anchor (see `anchors`), windows whose anchor occurs once cannot repeat, and runs of windows
with equal context are one text with a number of copies. Equal windows have equal anchors, so
the remaining texts are dealt by anchor into shards of bounded size, and each shard is suffix-sorted
by the difference-cover method: triples of symbols at two of three positions are sorted and
named, the sequence of names is sorted by recursion, the suffixes left out are sorted by one
symbol and the rank behind it and merged in. Adjacent suffixes are then compared over 400 bytes.

An anchor with more texts than fit a shard (a line that very many documents share) is not given
to one task: its windows are compared by digest, in a distributed aggregate.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors, repeats
from .common import materialise, whole_text

_BYTES = anchors.mix(np.arange(1, 257, dtype=np.uint64))
SPANS = "row long, lo int, copies long, data binary"


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of `symbols` (positive integers) in the order of their first `depth` symbols.

    Suffixes that agree in those come next to each other, in any order.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    s = np.zeros(n + 3, dtype=np.int64)
    s[:n] = symbols
    # Positions 1 and 2 of three; one more where the first kind would end without a zero.
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    width = int(s.max()) + 1
    if width < 1 << 21:
        triples = (s[sample] * width + s[sample + 1]) * width + s[sample + 2]
    else:
        pairs = np.unique(s[sample] * width + s[sample + 1], return_inverse=True)[1]
        triples = pairs * width + s[sample + 2]
    names = np.unique(triples, return_inverse=True)[1].ravel() + 1
    if depth > 3 and names.max() < len(sample):
        order = suffix_order(names, -(-depth // 3))
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < n]
    # The others: by a symbol and the rank behind it.
    zeros, base = np.arange(0, n, 3), len(sample) + 1
    key = s[zeros] * base + rank[zeros + 1]
    by_key = np.argsort(key, kind="stable")
    zeros, key = zeros[by_key], key[by_key]
    # Merge: how many of either kind of the sample come before each.
    ones = ones[ones < n]
    before = np.searchsorted(np.sort(s[ones] * base + rank[ones + 1]), key)
    pair = np.unique(np.concatenate([s[zeros] * width + s[zeros + 1], s[twos] * width + s[twos + 1]]), return_inverse=True)[1].ravel()
    before += np.searchsorted(np.sort(pair[len(zeros):] * base + rank[twos + 2]), pair[:len(zeros)] * base + rank[zeros + 2])
    place = np.arange(len(zeros)) + np.maximum.accumulate(before)
    out = np.empty(n, dtype=np.int64)
    rest = np.ones(n, dtype=bool)
    rest[place] = False
    out[place] = zeros
    out[rest] = sorted_sample
    return out


def repeated_windows(texts: list[bytes], window: int) -> list[np.ndarray]:
    """For each text, which of its windows occur again, in it or in another."""
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    begins = np.cumsum(np.append(0, size[:-1] + 1))
    # A text end is a symbol below all bytes; windows do not reach it.
    symbols = data.astype(np.int64) + 2
    symbols[begins + size] = 1
    order = suffix_order(symbols, window)
    starts = np.zeros(len(data), dtype=bool)
    for b, m in zip(begins, size):
        starts[b:b + m - window + 1] = True
    order = order[starts[order]]
    rows = np.lib.stride_tricks.sliding_window_view(data, window)
    same = np.zeros(len(order) + 1, dtype=bool)
    for at in range(0, len(order) - 1, 4096):
        upper, lower = order[at:at + 4096], order[at + 1:at + 4097]
        same[at + 1:at + 1 + len(lower)] = (rows[upper[:len(lower)]] == rows[lower]).all(axis=1)
    again = np.zeros(len(data), dtype=bool)
    again[order] = same[:-1] | same[1:]
    return [again[b:b + m - window + 1] for b, m in zip(begins, size)]


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """(begin, length) of the maximal runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b - a)) for a, b in edges.reshape(-1, 2)]


def removed_windows(docs: DataFrame, window: int = 400, k: int = 128, shard_bytes: int = 2 << 20, group_rows: int = 2000) -> DataFrame:
    """row, lo, n: the windows (n from byte lo on) that occur more than once in `docs`."""

    def codes(texts):
        return _BYTES[np.frombuffer(b"".join(texts), dtype=np.uint8)], np.cumsum([len(t) for t in texts])

    again = repeats.recurring(repeats.scan(docs, codes, window, k))
    copies = again.where("copies > 1").select("row", "lo", "n")

    # One text for each context of the anchors that have several.
    texts = again.where("contexts > 1 and row = first_row and lo = first_lo")
    texts = materialise(texts.select("row", "lo", "n", "h", "copies"), "texts")
    sizes = texts.groupBy("h").agg(F.count(F.lit(1)).alias("members"))
    total = texts.agg(F.sum(F.col("n") + window)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    listed = repeats.by_document(texts, "lo", "n", "h", "copies", name="texts")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, runs in zip(*(batch.column(i) for i in range(3))):
                data = text.as_py().encode()
                out += [(r["h"], key.as_py(), r["lo"], r["copies"], data[r["lo"]:r["lo"] + r["n"] + window - 1]) for r in runs.as_py()]
            yield pa.record_batch([list(c) for c in zip(*out)] if out else [[]] * 5, schema=pa.schema(
                [("h", pa.int64()), ("row", pa.int64()), ("lo", pa.int32()), ("copies", pa.int64()), ("data", pa.binary())]))

    spans = repeats.with_text(docs, listed).select("row", "text", "texts").mapInArrow(extract, "h long, " + SPANS)
    spans = spans.join(sizes.where(F.col("members") > group_rows), "h", "left")
    spans = materialise(spans.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))), "spans")

    def sort_shard(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = []
        for r, flags in zip(rows, repeated_windows([r["data"] for r in rows], window)):
            if r["copies"] == 1:
                out += [(r["row"], r["lo"] + a, n) for a, n in _stretches(flags)]
        return pa.table([list(c) for c in zip(*out)] if out else [[]] * 3, schema=pa.schema(
            [("row", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())]))

    sorted_out = spans.where("members is null").groupBy("shard").applyInArrow(sort_shard, "row long, lo int, n int")
    return copies.unionByName(sorted_out).unionByName(_by_digest(spans.where("members is not null"), window))


def _by_digest(spans: DataFrame, window: int) -> DataFrame:
    """The same for spans of any number, window by window."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, lo, copies, data in zip(*(c.to_pylist() for c in batch.columns)):
                digest = [hashlib.blake2b(data[i:i + window], digest_size=16).digest() for i in range(len(data) - window + 1)]
                yield pa.record_batch([pa.array(digest, pa.binary()), pa.array([key] * len(digest), pa.int64()),
                                       pa.array(range(lo, lo + len(digest)), pa.int32()), pa.array([copies] * len(digest), pa.int64())],
                                      names=["key", "row", "lo", "copies"])

    windows = materialise(spans.select("row", "lo", "copies", "data").mapInArrow(digests, "key binary, row long, lo int, copies long"), "digests")
    # Grouped by more than the join's key: the join's own exchanges can be split where they are skewed.
    again = windows.groupBy("key", F.substring("key", 1, 8).alias("head")).agg(F.sum("copies").alias("times")).where("times > 1").select("key")
    return windows.where("copies = 1").join(again, "key").select("row", "lo", F.lit(1).alias("n"))


def suffix_dedup(docs: DataFrame, window: int = 400, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of `docs` (doc_id, text).

    Texts are bytes of UTF-8; a null text is empty. A byte is removed if a string of `window` bytes
    that covers it also starts anywhere else, in any text of the table. Rows with a null doc_id or
    one doc_id are texts of their own. Other columns are ignored; an empty table gives no rows.
    """
    docs = repeats.with_row(whole_text(docs).select(F.col("doc_id").cast("long"), "text"))
    removed = materialise(removed_windows(docs.select("row", "text"), window, **options), "removed")

    def row(doc_id, data, spans):
        if not spans:
            return doc_id, len(data), 0, 0, hashlib.sha256(data).hexdigest()
        gone = repeats.covered(len(data), spans, window)
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        return doc_id, len(data), int(gone.sum()), len(_stretches(gone)), hashlib.sha256(kept).hexdigest()

    return repeats.cut(docs, removed, row, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
