"""Packing of tokenised documents into sequences by bounded-space best fit.

Each input partition is packed by itself while it is read: a fixed number of windows is open;
a document goes to the window that it leaves with the least room; when none has room, the
fullest window is emitted and a new one is opened. Documents of a sequence's length or more are
cut into whole sequences first. When a partition ends, its open windows are leftovers. They are
few, and are merged in groups of partitions: their pieces are laid end to end and cut at the
sequence's length, so that one sequence per group is not full.
"""
from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "`offset` long, ids binary, is_open boolean")
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                   ("ids", pa.binary()), ("is_open", pa.bool_())])

#: Sequence ids hold the partition above these bits; merged leftovers lie above all partitions.
LOCAL_BITS = 32
MERGED = 1 << 62


#: White space of this many characters and more is left to `tokenizers`: tiktoken's pattern
#: overflows its stack on very long runs.
LONG_SPACE = 100_000


def byte_bpe(path: str | None = None) -> Callable[[str], list[int]]:
    """Encoder of the 50k byte-level vocabulary that takes added tokens for plain text.

    The rank file of the same vocabulary is read, since this encoder is some four times faster
    than that of the JSON file; `tests/llm` compare the ids of both.
    """
    import tiktoken
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary


def contract_bpe(path: str | None = None) -> Callable[[str], list[int]]:
    """Encoder with the ids that `tokenizers` gives for byte_bpe_50k.json, added tokens included.

    A text is cut at the added tokens of the file, which are one id each; what is between is
    encoded by `byte_bpe`, and by `tokenizers` itself where white space is very long. A file whose
    added tokens take in their surroundings is left to `tokenizers` as a whole.
    """
    from tokenizers import Tokenizer
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as lines:
        added = json.load(lines)["added_tokens"]

    def whole(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        return whole
    plain = byte_bpe()
    ids = {t["content"]: t["id"] for t in added}
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(ids, key=len, reverse=True)) + ")") if ids else None
    long_space = re.compile(rf"(?<!\s)\s{{{LONG_SPACE},}}")

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_SPACE and long_space.search(text):
            return whole(text)
        if cut is None or not cut.search(text):
            return plain(text)
        out: list[int] = []
        for piece in cut.split(text):
            if piece in ids:
                out.append(ids[piece])
            elif piece:
                out += plain(piece)
        return out

    return encode


class Packer:
    """The open windows of one partition."""

    def __init__(self, length: int, windows: int, first_id: int):
        self.length, self.windows, self.next_id = length, windows, first_id
        self.free: list[tuple[int, int]] = []  # (room, sequence_id), sorted
        self.pieces: dict[int, list] = {}

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        """Place a document; yields the pieces of the sequences that are complete."""
        whole = len(ids) - len(ids) % self.length
        for start in range(0, whole, self.length):
            yield self._piece(doc_id, ids, start, self.length, self._new_id(), 0), False
        rest = len(ids) - whole
        if not rest:
            return
        at = bisect.bisect_left(self.free, (rest, -1))
        if at < len(self.free):
            room, sequence = self.free.pop(at)
        else:
            if len(self.free) == self.windows:
                _, fullest = self.free.pop(0)
                for piece in self.pieces.pop(fullest):
                    yield piece, False
            room, sequence = self.length, self._new_id()
            self.pieces[sequence] = []
        self.pieces[sequence].append(self._piece(doc_id, ids, whole, rest, sequence, self.length - room))
        if room > rest:
            bisect.insort(self.free, (room - rest, sequence))
        else:
            for piece in self.pieces.pop(sequence):
                yield piece, False

    def leftovers(self) -> Iterator[tuple]:
        for _, sequence in self.free:
            for piece in self.pieces[sequence]:
                yield piece, True

    def _new_id(self):
        self.next_id += 1
        return self.next_id - 1

    @staticmethod
    def _piece(doc_id, ids, start, length, sequence, offset):
        part = ids[start:start + length].tobytes()
        return doc_id, start, length, zlib.crc32(part), len(ids), sequence, offset, part


def _batches(rows: Iterator[tuple], keep_ids: bool, size: int = 4096) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in ARROW]
    for piece, is_open in rows:
        for column, value in zip(columns, (*piece[:7], piece[7] if keep_ids or is_open else None, is_open), strict=True):
            column.append(value)
        if len(columns[0]) >= size:
            yield pa.record_batch(columns, schema=ARROW)
            columns = [[] for _ in ARROW]
    if columns[0]:
        yield pa.record_batch(columns, schema=ARROW)


def pack(docs: DataFrame, encoder: Callable = byte_bpe, end: int = 1, length: int = 2048, windows: int = 64,
         merge: int = 8, keep_ids: bool = True) -> DataFrame:
    """The pieces of all sequences: COLUMNS and ids (little-endian unsigned 32-bit, binary).

    `docs` has doc_id and text; other columns are ignored. A document's ids are `encoder()` of its
    text (null: empty) and `end`, so an empty document has one id. A piece is a run of a
    document's ids in one sequence; every id lies in one piece. Rows with one doc_id are packed
    as documents of their own; a null doc_id stays null. An empty table gives no pieces. Without
    `keep_ids` the ids are left null, and only the leftovers' are kept for the time between.
    """

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        packer = Packer(length, windows, TaskContext.get().partitionId() << LOCAL_BITS)

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0), batch.column(1)):
                    ids = encode(text.as_py() or "")
                    ids.append(end)
                    yield from packer.add(doc_id.as_py(), np.array(ids, dtype="<u4"))
            yield from packer.leftovers()

        yield from _batches(rows(), keep_ids)

    def merged(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        out, at, pieces = [], 0, pieces.sort_values(["sequence_id", "offset"])
        for p in pieces.itertuples(index=False):
            done, doc_id = 0, None if pd.isna(p.doc_id) else int(p.doc_id)
            while done < p.length:
                n = min(int(p.length) - done, length - at % length)
                part = p.ids[4 * done:4 * (done + n)]
                out.append((doc_id, p.start + done, n, zlib.crc32(part), p.doc_tokens,
                            MERGED + (int(key[0]) << LOCAL_BITS) + at // length, at % length, part if keep_ids else None, False))
                done, at = done + n, at + n
        frame = pd.DataFrame(out, columns=ARROW.names)
        return frame.astype({"doc_id": "Int64"})

    packed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partition, PIECES)
    # Written once: which windows are left over depends on a partition's order of rows.
    packed = materialise(packed, "packed")
    group = F.shiftright(F.col("sequence_id"), LOCAL_BITS) / merge
    leftovers = packed.where("is_open").groupBy(F.floor(group).alias("group")).applyInPandas(merged, PIECES)
    return packed.where("not is_open").unionByName(leftovers).select(*COLUMNS, "ids")
