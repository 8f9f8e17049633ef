"""Removing passages that an earlier document has, with Aho-Corasick automata.

1. Recurring passages: every window of 50 words has an anchor phrase of 16 words (see
   `anchors`). Phrases that occur in one document only cannot be in a repeated window. The context
   of a phrase (all words of its windows) that several documents have is a passage; its words are
   taken from the first document that has it.
2. Passages are compiled into automata over word numbers, sharded by the place that they come
   from, so that the passages of a copied text share a shard. The stretches of every document
   that may hold passages of a shard are streamed through its automaton, which locates each
   occurrence word by word. Busy shards are dealt to several tasks.
3. A phrase with several contexts may have windows in common that no whole context shows. Those
   contexts are dealt out by phrase, streamed through automata of the phrases, and the windows
   around each located phrase are compared by digest.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import materialise, whole_text


#: Uses of a run's words.
PASSAGE, STRETCH, CONTEXT = 1, 2, 3
WINDOWS = pa.schema([("row", pa.int64()), ("lo", pa.int32()), ("n", pa.int32())])


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = [t.split() for t in texts]  # bytes: the white space of the contract
    hashes = list(map(xxhash.xxh64_intdigest, [w for ws in words for w in ws]))
    return np.array(hashes, dtype=np.uint64), np.cumsum([len(ws) for ws in words])


def automaton(phrases: set[str]) -> ahocorasick.Automaton:
    """Finds the phrases; a space on either side lets only whole words match."""
    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", f" {phrase} ")
    found.make_automaton()
    return found


def removed_windows(docs: DataFrame, window: int = 50, k: int = 16, shard_rows: int = 2000, shard_words: int = 250_000,
                    task_words: int = 1_000_000) -> DataFrame:
    """row, lo, n: the windows (n from word lo on) that a document with a smaller place has too.

    `docs` has row, place and text.

    An automaton holds about `shard_words` words of passages, and a task streams about
    `task_words` words through it.
    """
    again = repeats.recurring(repeats.scan(docs, _codes, window, k)).where("low < high")
    size = F.col("n") + window - 1
    passage = (F.col("last_place") > F.col("first_place")) & (F.col("row") == F.col("first_row")) & (F.col("lo") == F.col("first_lo"))
    total = again.where(passage).agg(F.sum(size)).first()[0] or 0
    again = again.withColumn("shard", F.pmod(F.xxhash64("first_row", F.shiftright("first_lo", 12)), F.lit(max(1, -(-total // shard_words)))).cast("int"))

    # What a run's words are for: a passage to compile, a stretch to stream, a context to compare.
    uses = F.filter(F.array(F.when(passage, F.lit(PASSAGE)), F.when(F.col("place") > F.col("first_place"), F.lit(STRETCH)),
                            F.when((F.col("contexts") > 1) & (F.col("place") == F.col("first_place")), F.lit(CONTEXT))), lambda u: u.isNotNull())
    listed = repeats.by_document(again.select("row", "lo", "n", "at", "h", "shard", F.explode(uses).alias("use")),
                                 "use", "shard", "lo", "n", "at", "h", name="runs")
    columns = pa.schema([("use", pa.int32()), ("shard", pa.int32()), ("h", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("lo", pa.int32()),
                         ("n", pa.int32()), ("at", pa.int32()), ("words", pa.string())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, place, text, runs in zip(*batch.columns):
                words, out = text.as_py().encode().split(), []
                for r in _joined(runs.as_py(), window):
                    said = b" ".join(words[r["lo"]:r["lo"] + r["n"] + window - 1]).decode()
                    out.append((r["use"], r["shard"], r["h"], key.as_py(), place.as_py(), r["lo"], r["n"], r["at"], said))
                yield pa.record_batch([list(c) for c in zip(*out)] if out else [[]] * len(columns), schema=columns)

    spans = materialise(repeats.with_text(docs, listed).select("row", "place", "text", "runs").mapInArrow(
        extract, "use int, shard int, h long, row long, place long, lo int, n int, at int, words string"), "spans")

    # Each part of a shard's stretches meets all passages of the shard.
    stretches, passages = spans.where(F.col("use") == STRETCH), spans.where(F.col("use") == PASSAGE)
    parts = materialise(stretches.groupBy("shard").agg(F.ceil(F.sum(size) / task_words).alias("parts")), "parts")
    part = F.pmod(F.xxhash64("row", "lo"), F.col("parts"))
    stretches = stretches.join(parts, "shard").select("shard", part.alias("part"), "row", "place", "lo", "words")
    passages = passages.join(parts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "place", "lo", "words")
    passages = passages.toDF(*passages.columns)  # columns of its own: both sides come from one table

    def locate(known: pa.Table, asked: pa.Table) -> pa.Table:
        found = list(_occurrences(known, asked, window))
        return pa.table([list(c) for c in zip(*found)] if found else [[]] * 3, schema=WINDOWS)

    located = passages.groupBy("shard", "part").cogroup(stretches.groupBy("shard", "part")).applyInArrow(
        locate, "row long, lo int, n int")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, shard_rows):
                yield _digests(batch.slice(at, shard_rows), window, k)

    # Dealt by phrase and document: a phrase's contexts mostly share automata, and a very common
    # phrase is still many tasks' work.
    dealt = spans.where(F.col("use") == CONTEXT).select("h", "row", "place", "lo", "n", "at", "words").repartition("h", F.pmod("row", F.lit(16)))
    windows = materialise(dealt.mapInArrow(stream, "key binary, row long, place long, lo int"), "windows")
    # Grouped by more than the join's key: the join's own exchanges can be split where they are skewed.
    first = windows.groupBy("key", F.substring("key", 1, 8).alias("head")).agg(
        F.min("place").alias("low"), F.max("place").alias("high")).where("low < high").select("key", "low")
    later = windows.join(first, "key").where("place > low").select("row", "lo", F.lit(1).alias("n"))
    return located.unionByName(later)


def _joined(runs: list, window: int) -> Iterator[dict]:
    """The runs of a document; stretches for one shard that overlap or touch become one."""
    last = None
    for r in sorted(runs, key=lambda r: (r["use"], r["shard"], r["lo"])):
        if r["use"] != STRETCH:
            yield r
        elif last and last["shard"] == r["shard"] and r["lo"] <= last["lo"] + last["n"] + window - 1:
            last["n"] = max(last["n"], r["lo"] + r["n"] - last["lo"])
        else:
            if last:
                yield last
            last = dict(r)
    if last:
        yield last


def _occurrences(passages: pa.Table, stretches: pa.Table, window: int) -> Iterator[tuple]:
    """(row, lo, n) of every passage in the stretches that comes from a smaller place."""
    if not len(passages) or not len(stretches):
        return
    numbers: dict[str, int] = {}
    found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for place, said in zip(passages["place"].to_pylist(), passages["words"]):
        words = said.as_py().split(" ")
        found.add_word(tuple(numbers.setdefault(w, len(numbers) + 1) for w in words), (place, len(words)))
    found.make_automaton()
    for row, place, lo, said in zip(stretches["row"].to_pylist(), stretches["place"].to_pylist(), stretches["lo"].to_pylist(), stretches["words"]):
        for last, (owner, length) in found.iter(tuple(numbers.get(w, 0) for w in said.as_py().split(" "))):
            if owner < place:
                yield row, lo + last - length + 1, length - window + 1


def _digests(batch: pa.RecordBatch, window: int, k: int) -> pa.RecordBatch:
    """Digests of the windows around the located phrases of a shard of contexts."""
    rows = batch.to_pylist()
    lines = [f" {r['words']} ".encode() for r in rows]
    spaces = [[i for i, c in enumerate(line) if c == 32] for line in lines]
    own = [line[s[r["at"]]:s[r["at"] + k] + 1].decode() for r, line, s in zip(rows, lines, spaces)]
    shard = automaton({phrase.strip(" ") for phrase in own})
    keys, ids, places, los = [], [], [], []
    for r, line, s, phrase in zip(rows, lines, spaces, own):
        text = f" {r['words']} "
        wide = len(text) != len(line)  # places in characters are not places in bytes
        ends = [last for last, found in shard.iter(text) if found == phrase]
        starts = {(len(text[:last + 1].encode()) if wide else last + 1) - len(phrase.encode()) for last in ends}
        at = [w for w, place in enumerate(s) if place in starts]
        for w in range(r["n"]):
            if any(w <= a <= w + window - k for a in at):
                keys.append(hashlib.blake2b(line[s[w]:s[w + window]], digest_size=16).digest())
                ids.append(r["row"])
                places.append(r["place"])
                los.append(r["lo"] + w)
    return pa.record_batch([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(places, pa.int64()), pa.array(los, pa.int32())], names=["key", "row", "place", "lo"])


def phrase_dedup(docs: DataFrame, window: int = 50, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of `docs` (doc_id, text).

    Words are runs of anything but ASCII white space; a null text has none. A word is removed if
    a window of `window` words that covers it also starts in a document with a smaller doc_id. The
    digest is that of the kept words with a space between them. Rows with one doc_id are documents
    of their own, none smaller than the other; a null doc_id counts as the largest long. Other
    columns are ignored; an empty table gives no rows.
    """
    docs = repeats.with_row(whole_text(docs).select(F.col("doc_id").cast("long"), "text"))
    placed = docs.select("row", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("place"), "text")
    removed = materialise(removed_windows(placed, window, **options), "removed")

    def row(doc_id, data, spans):
        words = data.split()
        gone = repeats.covered(len(words), spans, window)
        kept = [w for w, x in zip(words, gone.tolist()) if not x] if spans else words
        return doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    return repeats.cut(docs, removed, row, "doc_id long, n_words long, n_removed long, kept_sha256 string")
