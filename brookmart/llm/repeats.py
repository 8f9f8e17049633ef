"""Finding and cutting repeated windows of texts: what the two substring operators share."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors, bloom
from .common import materialise

#: Bytes of text that are looked at together.
CHUNK = 4 << 20


def with_row(docs: DataFrame) -> DataFrame:
    """`docs` with a column row, a key of its own for every row; written, so that all reads see the same keys."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), *docs.columns), "keyed")


def chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[list, list[bytes]]]:
    """Keys (all columns but the last) and texts (UTF-8) of the batches, about `size` bytes at a time."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for *own, text in zip(*batch.columns):
            data = (text.as_py() or "").encode()
            ids.append([x.as_py() for x in own])
            texts.append(data)
            held += len(data)
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def scan(docs: DataFrame, codes: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], window: int, k: int) -> DataFrame:
    """The runs of all documents: row, place, lo (first window), n (windows), at (place of the anchor
    behind lo), h (anchor), ctx.

    `docs` has row, text and, where the order of documents matters, place; neither key is null.
    `codes(texts)` gives the codes of the texts, one after the other, and where each ends.
    """
    keys = [c for c in docs.columns if c != "text"]

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks(batches):
            values, ends = codes(texts)
            text, begin, count, at, h, ctx = anchors.runs(values, ends, window, k)
            lo = begin - np.append(0, ends)[text]
            small = [pa.array(x.astype(np.int32)) for x in (lo, count, at)]
            own = [pa.array(column[text]) for column in np.array(ids, dtype=np.int64).T]
            yield pa.record_batch([*own, *small, pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64))],
                                  names=[*keys, "lo", "n", "at", "h", "ctx"])

    return docs.select(*keys, "text").mapInArrow(partition, ", ".join(f"{c} long" for c in keys) + ", lo int, n int, at int, h long, ctx long")


def recurring(found: DataFrame) -> DataFrame:
    """The runs whose anchor occurs at least twice, with what is known of anchor and context.

    copies: runs with this context; first_row and first_lo: the first of them by place, row and lo;
    contexts: how many different ones the anchor has. With places: first_place; last_place, the
    largest of the context; low and high, the smallest and largest place of the anchor.
    Counts come from aggregates and are joined back, so that adaptive execution can split an
    anchor or context that very many documents share.
    """
    found = materialise(found, "runs")
    placed = "place" in found.columns
    keys = ["place", "row"] if placed else ["row"]
    last = [F.max("place").alias("last_place")] if placed else []
    per_context = found.groupBy("h", "ctx").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*keys, "lo")).alias("first"), *last).select(
        "h", "ctx", "copies", *[F.col(f"first.{c}").alias(f"first_{c}") for c in (*keys, "lo")], *(["last_place"] if placed else []))
    # Grouped by more than is joined on: both sides of the joins then have exchanges of their own.
    ends = [F.min("first_place").alias("low"), F.max("last_place").alias("high")] if placed else []
    per_anchor = per_context.groupBy("h", F.shiftright("h", 32).alias("half")).agg(
        F.sum("copies").alias("times"), F.count(F.lit(1)).alias("contexts"), *ends).where("times > 1").drop("half", "times")
    known = materialise(per_context.join(per_anchor, "h"), "contexts")
    return materialise(found.join(known, ["h", "ctx"]), "recurring")


def by_document(rows: DataFrame, *columns: str, name: str) -> DataFrame:
    """The rows of a document as one list; a document has at most as many as it has windows."""
    return rows.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias(name))


def with_text(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """`lists` (one for a row) with the documents' keys and texts; only their texts are shuffled."""
    some = bloom.may_hold(docs, "row", lists.select("row")).where("maybe").drop("maybe")
    return some.join(lists, "row")


def cut(docs: DataFrame, removed: DataFrame, row: Callable[[int, bytes, list], tuple], schema: str) -> DataFrame:
    """`row(doc_id, text, spans)` of every document; spans: its (lo, n) of `removed` (materialised).

    `docs` has row, doc_id and text, `removed` names rows. Documents that `removed` does not name are
    done where they are read.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    types = {"long": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(2) if batch.num_columns > 2 else [None] * batch.num_rows
            rows = [row(d.as_py(), (t.as_py() or "").encode(), (s.as_py() or []) if s is not None else [])
                    for d, t, s in zip(batch.column(0), batch.column(1), spans)]
            yield pa.record_batch([list(c) for c in zip(*rows)] if rows else [[] for _ in names], schema=arrow)

    lists = by_document(removed, "lo", "n", name="spans")
    flagged = bloom.may_hold(docs.select("row", "doc_id", "text"), "row", removed.select("row").distinct())
    whole = flagged.where("not maybe").select("doc_id", "text").mapInArrow(partition, schema)
    some = flagged.where("maybe").select("row", "doc_id", "text").join(lists, "row", "left").select("doc_id", "text", "spans")
    return whole.unionByName(some.mapInArrow(partition, schema))


def covered(length: int, spans: list, window: int) -> np.ndarray:
    """Which of `length` places lie in a window of the spans (lo, n)."""
    edges = np.zeros(length + 1, dtype=np.int64)
    for s in spans:
        edges[s["lo"]] += 1
        edges[s["lo"] + s["n"] - 1 + window] -= 1
    return np.cumsum(edges[:-1]) > 0
