"""Alignment of the tokens of two tokenizers, and how often their ids meet.

A text is one space and the given text. Both tokenizers tile its bytes; where a token of both ends,
a group is closed. Texts are cut into chunks of bytes, and a chunk becomes a fragment:

    head   the tokens up to the first common end: an open group, as it may have begun before
    body   the closed groups behind it: their number, links, pairs of ids and printed form
    tail   the tokens behind the last common end: an open group again

Fragments form a monoid: `compose` lays tail and head side by side, closes the groups that end
there, and adds up the bodies. It is associative, so the fragments of a very long document are
computed by different tasks and composed as a tree (`reduce_tree`, `FAN` at a time). A document of
one chunk needs no tree.

A chunk owns the tokens that begin in it. It is encoded with what lies around it, up to the next
place on either side where neither tokenizer can join two characters: a single space between two
characters that are no white space. A border in a longer stretch without such a place is left out.

Counts. Tasks gather the documents they read into blocks of some megabytes of text, one row each,
with a dictionary of the pairs of ids that occur in it. Only dictionaries are shuffled to count, for
each pair, the documents that hold it; each block gets the counts of its own pairs back.
"""
from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .packing import LONG_SPACE, byte_bpe

#: Characters of a chunk; longer documents are cut.
CHUNK = 1 << 16
#: Fragments that are composed at once.
FAN = 16
#: Bytes of text that are aligned together, and those of a block.
BATCH, BLOCK = 1 << 18, 1 << 22

COUNTED = "n_a long, n_b long, n_groups long, n_links long"
RESULT = f"doc_id long, {COUNTED}, n_best long, count_sum long, groups_sha256 string"
BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, ends array<int>, refs binary, times binary, keys array<long>, docs array<int>")
FRAGMENTS = ("row long, doc_id long, part long, parts long, fits boolean, n_a long, n_b long, cut boolean, "
             "head array<binary>, tail array<binary>, n_groups long, n_links long, keys binary, times binary, printed binary")


class ByteLevel:
    """Token ids and bytes of a byte-level BPE file; special tokens in a text are plain text."""

    def __init__(self, path: str | None = None):
        import json

        from tokenizers import Tokenizer
        path = path or public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The faster encoder reads the rank file of the same vocabulary; tests compare both.
        self.fast = byte_bpe() if path == public_tokenizers.path("byte_bpe_50k.json") else None
        shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        with open(path, encoding="utf-8") as lines:
            vocabulary = json.load(lines)["model"]["vocab"]
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def encode(self, text: str) -> list[int]:
        """Ids of `text`, which begins with the space."""
        if self.fast and (len(text) < LONG_SPACE or not _spaced(text)):
            return self.fast(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Token ids and bytes of a sentencepiece model that puts a space before a text."""

    def __init__(self, path: str | None = None):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        n = self.model.vocab_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(pieces)]

    def encode(self, text: str) -> list[int]:
        """Ids of `text`, which begins with the space."""
        return self.model.encode(text[1:])


def _spaced(text: str) -> bool:
    import re
    return re.search(rf"\s{{{LONG_SPACE},}}", text) is not None


def _no_ids():
    return np.zeros(0, dtype=np.int64)


@dataclass
class Run:
    """Tokens of both tokenizers in order, with the byte at which each ends."""
    a: np.ndarray = field(default_factory=_no_ids)
    a_ends: np.ndarray = field(default_factory=_no_ids)
    b: np.ndarray = field(default_factory=_no_ids)
    b_ends: np.ndarray = field(default_factory=_no_ids)

    def parts(self):
        return [self.a, self.a_ends, self.b, self.b_ends]

    def __add__(self, other: Run) -> Run:
        return Run(*(np.concatenate(x) for x in zip(self.parts(), other.parts())))

    def cut(self, i: int, j: int) -> tuple[Run, Run]:
        """The first i and j tokens, and the others."""
        return (Run(self.a[:i], self.a_ends[:i], self.b[:j], self.b_ends[:j]),
                Run(self.a[i:], self.a_ends[i:], self.b[j:], self.b_ends[j:]))

    def common(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the tokens of each kind that end where one of the other kind ends."""
        at = np.searchsorted(self.b_ends, self.a_ends)
        same = at < len(self.b_ends)
        same[same] = self.b_ends[at[same]] == self.a_ends[same]
        return np.flatnonzero(same), at[same]


class Printer:
    """The printed form of groups: `a1,a2|b1;a3|b2,b3;` with decimal ids."""

    def __init__(self, sizes: tuple[int, int]):
        forms = [f"{i}{mark}".encode() for n, marks in zip(sizes, (",|", ",;")) for mark in marks for i in range(n)]
        self.offset = [0, sizes[0], 2 * sizes[0], 2 * sizes[0] + sizes[1]]
        self.lengths = np.array([len(f) for f in forms], dtype=np.int64)
        width = int(self.lengths.max())
        self.forms = np.frombuffer(b"".join(f.ljust(width) for f in forms), dtype=np.uint8).reshape(-1, width)
        self.used = np.arange(width) < self.lengths[:, None]

    def write(self, run: Run, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Text of the groups that end at tokens `last_a`, `last_b`, and the length of each group's."""
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        form_a, form_b = run.a + self.offset[0], run.b + self.offset[2]
        form_a[last_a] += self.offset[1] - self.offset[0]
        form_b[last_b] += self.offset[3] - self.offset[2]
        order = np.empty(len(run.a) + len(run.b), dtype=np.int64)
        order[np.arange(len(run.a)) + np.repeat(last_b + 1 - size_b, size_a)] = form_a
        order[np.arange(len(run.b)) + np.repeat(last_a + 1, size_b)] = form_b
        ends = np.cumsum(self.lengths[order])
        return self.forms[order][self.used[order]].tobytes(), np.diff(ends[last_a + last_b + 1], prepend=0)


def links(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of both kinds whose bytes overlap. The run begins and ends in common.

    The ends of both kinds cut the bytes into stretches; each lies in one token of each kind, and
    no other stretch lies in the same two.
    """
    ends = np.union1d(run.a_ends, run.b_ends)
    return np.searchsorted(run.a_ends, ends), np.searchsorted(run.b_ends, ends)


@dataclass
class Body:
    """Closed groups, added up."""
    groups: int = 0
    links: int = 0
    keys: np.ndarray = field(default_factory=_no_ids)
    times: np.ndarray = field(default_factory=_no_ids)
    printed: bytes = b""

    @staticmethod
    def total(bodies: list[Body]) -> Body:
        keys, inverse = np.unique(np.concatenate([_no_ids(), *(b.keys for b in bodies)]), return_inverse=True)
        times = np.zeros(len(keys), dtype=np.int64)
        np.add.at(times, inverse, np.concatenate([_no_ids(), *(b.times for b in bodies)]))
        return Body(sum(b.groups for b in bodies), sum(b.links for b in bodies), keys, times, b"".join(b.printed for b in bodies))


@dataclass
class Fragment:
    """An element of the monoid. Without a common end (`cut`), all its tokens are in `head`."""
    head: Run
    body: list[Body]
    tail: Run
    cut: bool


class Aligner:
    """Alignment by two tokenizers, in a task."""

    def __init__(self, left: Callable, right: Callable):
        self.left, self.right = left(), right()
        self.printer = Printer((len(self.left.tokens), len(self.right.tokens)))
        self.base = len(self.right.tokens)
        self.sizes = [np.array([len(t) for t in x.tokens], dtype=np.int64) for x in (self.left, self.right)]

    def encode(self, text: str) -> Run | None:
        """The tokens of `text`, which begins with the space; None if their bytes are not its own."""
        data, found = text.encode(), []
        for own, sizes in zip((self.left, self.right), self.sizes):
            ids = own.encode(text)
            if b"".join(map(own.tokens.__getitem__, ids)) != data:
                return None
            ids = np.array(ids, dtype=np.int64)
            found += [ids, np.cumsum(sizes[ids])]
        return Run(*found)

    def body(self, run: Run) -> Body:
        """A run that begins and ends in common, closed."""
        last_a, last_b = run.common()
        if not len(last_a):
            return Body()
        i, j = links(run)
        keys, times = np.unique(run.a[i] * self.base + run.b[j], return_counts=True)
        return Body(len(last_a), len(i), keys, times, self.printer.write(run, last_a, last_b)[0])

    def fragment(self, run: Run) -> Fragment:
        last_a, last_b = run.common()
        if not len(last_a):
            return Fragment(run, [], Run(), False)
        head, rest = run.cut(last_a[0] + 1, last_b[0] + 1)
        closed, tail = rest.cut(last_a[-1] - last_a[0], last_b[-1] - last_b[0])
        return Fragment(head, [self.body(closed)], tail, True)

    def compose(self, one: Fragment, two: Fragment) -> Fragment:
        middle = self.fragment((one.tail if one.cut else one.head) + two.head)
        if not middle.cut:
            return Fragment(one.head, one.body, middle.head, True) if one.cut else middle
        head, body = (one.head, [*one.body, self.body(middle.head), *middle.body]) if one.cut else (middle.head, middle.body)
        return Fragment(head, [*body, *two.body], two.tail if two.cut else middle.tail, True)

    def close(self, whole: Fragment) -> Body:
        """The fragment of a whole text, which begins and ends in common."""
        return Body.total([self.body(whole.head), *whole.body, self.body(whole.tail)])


@functools.lru_cache(maxsize=2)
def _aligner(left: Callable, right: Callable) -> Aligner:
    """One for all groups and batches of a Python worker: loading the vocabularies takes a second."""
    return Aligner(left, right)


class Block:
    """Documents of one task on their way into one row."""

    def __init__(self):
        self.rows, self.keys, self.times, self.size = [], [], [], 0

    def add(self, doc_id, counted: tuple, digest: str, keys: np.ndarray, times: np.ndarray, size: int):
        self.rows.append((doc_id, *counted, digest))
        self.keys.append(keys)
        self.times.append(times)
        self.size += size

    def batch(self, number: int) -> pa.RecordBatch:
        keys, refs, docs = np.unique(np.concatenate([_no_ids(), *self.keys]), return_inverse=True, return_counts=True)
        columns = list(zip(*self.rows))
        types = [pa.int64()] * 5 + [pa.string()]
        lists = [pa.array([c], pa.list_(t)) for c, t in zip(columns, types)]
        ends = np.cumsum([len(k) for k in self.keys]).astype(np.int32)
        times = np.concatenate([_no_ids(), *self.times]).astype(np.int32)
        return pa.record_batch(
            [pa.array([number]), *lists, pa.array([ends], pa.list_(pa.int32())), pa.array([refs.astype(np.int32).tobytes()]),
             pa.array([times.tobytes()]), pa.array([keys], pa.list_(pa.int64())), pa.array([docs.astype(np.int32)], pa.list_(pa.int32()))],
            names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ends", "refs", "times", "keys", "docs"])


NOTHING = ((0, 0, 0, 0), "", _no_ids(), _no_ids())


def _aligned(aligner: Aligner, texts: list[str]) -> list[tuple]:
    """(counts, digest, keys, times) of whole texts, aligned as one run after the other."""
    out, runs, owners = [NOTHING] * len(texts), [], []
    for n, text in enumerate(texts):
        run = aligner.encode(" " + text) if text else None
        if run is not None:
            runs.append(run)
            owners.append(n)
    if not runs:
        return out
    a_ends, b_ends, ends = (np.cumsum([f(r) for r in runs]) for f in (lambda r: len(r.a), lambda r: len(r.b), lambda r: r.a_ends[-1]))
    begins = ends - [r.a_ends[-1] for r in runs]
    whole = Run(np.concatenate([r.a for r in runs]), np.concatenate([r.a_ends + at for r, at in zip(runs, begins)]),
                np.concatenate([r.b for r in runs]), np.concatenate([r.b_ends + at for r, at in zip(runs, begins)]))
    last_a, last_b = whole.common()
    printed, lengths = aligner.printer.write(whole, last_a, last_b)
    group_ends = np.searchsorted(last_a, a_ends - 1) + 1
    printed_ends = np.cumsum(lengths)[group_ends - 1]
    i, j = links(whole)
    doc = np.searchsorted(a_ends, i, side="right")
    span = len(aligner.left.tokens) * aligner.base
    found, times = np.unique(doc * span + whole.a[i] * aligner.base + whole.b[j], return_counts=True)
    cuts = np.searchsorted(found, np.arange(1, len(runs)) * span)
    counts = zip(*(np.diff(x, prepend=0).tolist() for x in (a_ends, b_ends, group_ends, np.cumsum(np.bincount(doc, minlength=len(runs))))))
    at = 0
    for n, counted, end, keys, own in zip(owners, counts, printed_ends.tolist(), np.split(found % span, cuts), np.split(times, cuts)):
        out[n] = (counted, hashlib.sha256(printed[at:end - 1]).hexdigest(), keys, own)
        at = end
    return out


def _blocks(docs: DataFrame, left: Callable, right: Callable) -> DataFrame:
    """The blocks of documents (doc_id, text) that are aligned as a whole."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, number = _aligner(left, right), Block(), TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held >= BATCH or len(ids) >= 4096:
                    for i, found in zip(ids, _aligned(aligner, texts)):
                        block.add(i, *found, 0)
                    block.size += held
                    ids, texts, held = [], [], 0
                if block.size >= BLOCK or len(block.rows) >= 65536:
                    yield block.batch(number)
                    block, number = Block(), number + 1
        for i, found in zip(ids, _aligned(aligner, texts)):
            block.add(i, *found, 0)
        if block.rows:
            yield block.batch(number)

    return docs.mapInArrow(partition, BLOCKS)


def cut_text(text: str, size: int) -> list[tuple[str, int, int]]:
    """(context, low, high) of the chunks of `text`: a chunk owns the tokens that begin at the bytes
    low to high - 1 of its context."""
    import re
    safe = np.array([0, *(m.start() for m in re.finditer(r"(?<=\S) (?=\S)", text)), len(text)])
    wanted = np.arange(size, len(text), size)
    after = np.searchsorted(safe, wanted, side="left")
    close = safe[after] - safe[np.maximum(after - 1, 0)] <= size
    borders = [0, *wanted[close].tolist(), len(text)]
    out = []
    for low, high in zip(borders, borders[1:]):
        begin = int(safe[np.searchsorted(safe, low, side="right") - 1])
        end = int(safe[np.searchsorted(safe, high, side="left")])
        skip = len(text[begin:low].encode())
        out.append((text[begin:end], skip, skip + len(text[low:high].encode())))
    return out


def _chunks(docs: DataFrame, size: int) -> DataFrame:
    """The chunks of documents (row, doc_id, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*batch.columns):
                parts = cut_text(" " + text.as_py(), size)
                own = [[row.as_py(), doc_id.as_py(), n, len(parts), *part] for n, part in enumerate(parts)]
                columns = [pa.array(c, t) for c, t in zip(zip(*own), [*[pa.int64()] * 4, pa.string(), pa.int64(), pa.int64()])]
                yield pa.record_batch(columns, names=["row", "doc_id", "part", "parts", "context", "low", "high"])

    return docs.mapInArrow(cut, "row long, doc_id long, part long, parts long, context string, low long, high long")


def _pack(run: Run) -> list[bytes]:
    return [x.tobytes() for x in run.parts()]


def _row(key: dict, fits: bool, n_a: int, n_b: int, f: Fragment | None) -> dict:
    """A fragment as a row; one of a text whose bytes the tokens do not give holds nothing."""
    f = f if fits else Fragment(Run(), [], Run(), False)
    body = Body.total(f.body)
    return key | {"fits": fits, "n_a": n_a, "n_b": n_b, "cut": f.cut, "head": _pack(f.head), "tail": _pack(f.tail), "n_groups": body.groups,
                  "n_links": body.links, "keys": body.keys.tobytes(), "times": body.times.tobytes(), "printed": body.printed}


def _read(row: dict) -> Fragment:
    head, tail = (Run(*(np.frombuffer(x, dtype=np.int64) for x in row[c])) for c in ("head", "tail"))
    keys, times = (np.frombuffer(row[c], dtype=np.int64) for c in ("keys", "times"))
    return Fragment(head, [Body(row["n_groups"], row["n_links"], keys, times, row["printed"])], tail, row["cut"])


ROWS = pa.schema([*((c, pa.int64()) for c in ("row", "doc_id", "part", "parts")), ("fits", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                  ("cut", pa.bool_()), ("head", pa.list_(pa.binary())), ("tail", pa.list_(pa.binary())), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                  ("keys", pa.binary()), ("times", pa.binary()), ("printed", pa.binary())])


def _fragments(chunks: DataFrame, left: Callable, right: Callable) -> DataFrame:
    """The fragment of every chunk. Bytes are counted from the beginning of the context plus `part` << 40."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(left, right)
        for batch in batches:
            for n in range(len(batch)):
                row = batch.slice(n, 1).to_pylist()[0]
                key = {c: row[c] for c in ("row", "doc_id", "part", "parts")}
                run = aligner.encode(row["context"])
                if run is not None:
                    begins = [np.concatenate([[0], e[:-1]]) for e in (run.a_ends, run.b_ends)]
                    (i, k), (j, m) = (np.searchsorted(x, [row["low"], row["high"]]).tolist() for x in begins)
                    own = Run(run.a[i:k], run.a_ends[i:k] - row["low"], run.b[j:m], run.b_ends[j:m] - row["low"])
                yield pa.RecordBatch.from_pylist([
                    _row(key, True, len(own.a), len(own.b), aligner.fragment(own)) | {"length": row["high"] - row["low"]} if run is not None
                    else _row(key, False, 0, 0, None) | {"length": row["high"] - row["low"]}], schema=ROWS.append(pa.field("length", pa.int64())))

    return chunks.mapInArrow(partition, FRAGMENTS + ", length long")


def reduce_tree(fragments: DataFrame, left: Callable, right: Callable) -> DataFrame:
    """One fragment for each document, composed in rounds of `FAN` neighbours."""

    def merge(table: pa.Table) -> pa.Table:
        aligner = _aligner(left, right)
        rows = table.sort_by("part").to_pylist()
        fits, made, length = all(r["fits"] for r in rows), None, 0
        for r in rows:
            f = _read(r)
            for run in (f.head, f.tail):  # bytes from the beginning of the first
                run.a_ends, run.b_ends = run.a_ends + length, run.b_ends + length
            length += r["length"]
            made = f if made is None else aligner.compose(made, f) if fits else made
        first = rows[0]
        key = {"row": first["row"], "doc_id": first["doc_id"], "part": first["part"] // FAN, "parts": -(-first["parts"] // FAN)}
        done = _row(key, fits, sum(r["n_a"] for r in rows), sum(r["n_b"] for r in rows), made)
        return pa.Table.from_pylist([done | {"length": length}], schema=ROWS.append(pa.field("length", pa.int64())))

    while not fragments.where("parts > 1").isEmpty():
        grouped = fragments.groupBy("row", F.expr(f"part div {FAN}").alias("place"))
        fragments = materialise(grouped.applyInArrow(merge, FRAGMENTS + ", length long"), "fragments")
    return fragments


def _long_blocks(fragments: DataFrame, left: Callable, right: Callable) -> DataFrame:
    """A block for every document that was composed from its fragments."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(left, right), -1 - (TaskContext.get().partitionId() << 32)
        for batch in batches:
            for row in batch.to_pylist():
                block = Block()
                if row["fits"]:
                    body = aligner.close(_read(row))
                    block.add(row["doc_id"], (row["n_a"], row["n_b"], body.groups, body.links),
                              hashlib.sha256(body.printed[:-1]).hexdigest(), body.keys, body.times, 0)
                else:
                    block.add(row["doc_id"], *NOTHING, 0)
                yield block.batch(number)
                number -= 1

    return fragments.mapInArrow(partition, BLOCKS)


def aligned_blocks(docs: DataFrame, left: Callable = ByteLevel, right: Callable = Pieces, chunk: int = CHUNK) -> DataFrame:
    """Blocks (see `BLOCKS`) of all documents, written."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long = given.where(F.char_length("text") > chunk)
    keyed = long.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = materialise(_chunks(keyed, chunk), "chunks")
    blocks = materialise(_blocks(given.where(F.char_length("text") <= chunk), left, right), "blocks")
    if chunks.isEmpty():
        return blocks
    spread = chunks.repartition("row", "part")  # the chunks of a document go to different tasks
    fragments = reduce_tree(materialise(_fragments(spread, left, right), "fragments"), left, right)
    return blocks.unionByName(materialise(_long_blocks(fragments, left, right), "long-blocks"))


def align(docs: DataFrame, left: Callable = ByteLevel, right: Callable = Pieces, chunk: int = CHUNK) -> DataFrame:
    """n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of `docs` (doc_id, text).

    A pair of ids counts once for each row that holds it linked. n_best: links whose pair counts as
    much as any pair of its left id; count_sum: the counts of all links, added up. Null and empty
    texts, and those whose tokens do not give their own bytes, have zeros and an empty digest. Doc_ids
    may be null or repeated: every row is a document. Other columns are ignored; an empty table gives
    an empty result. The tokens of a text, like the text itself, must fit in one row.
    """
    blocks = aligned_blocks(docs, left, right, chunk)
    pairs = blocks.select("block", F.inline(F.arrays_zip("keys", "docs")))
    base = len(right().tokens)
    counts = materialise(pairs.groupBy(F.col("keys").alias("key")).agg(F.sum("docs").alias("n")), "pair-counts")
    # One row for each id of the left vocabulary at most.
    highest = counts.groupBy(F.expr(f"key div {base}").alias("a")).agg(F.max("n").alias("highest"))
    ranked = counts.join(highest, F.expr(f"key div {base}") == F.col("a")).select("key", "n", (F.col("n") == F.col("highest")).alias("best"))
    told = pairs.select("block", F.col("keys").alias("key")).join(ranked, "key")

    def finish(own: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("key")
        n, best = told["n"].to_numpy(), told["best"].to_numpy().astype(np.int64)
        out = []
        for row in own.to_pylist():
            refs, times = (np.frombuffer(row[c], dtype=np.int32) for c in ("refs", "times"))
            begin = 0
            for i, end in enumerate(row["ends"]):
                at, by = refs[begin:end], times[begin:end].astype(np.int64)
                out.append((row["doc_id"][i], row["n_a"][i], row["n_b"][i], row["n_groups"][i], row["n_links"][i],
                            int(by @ best[at]), int(by @ n[at]), row["groups_sha256"][i]))
                begin = end
        columns = list(zip(*out)) if out else [[]] * 8
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        return pa.table([pa.array(c, pa.string() if m == "groups_sha256" else pa.int64()) for c, m in zip(columns, names)], names=names)

    held = blocks.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ends", "refs", "times")
    held, told = held.toDF(*held.columns), told.toDF(*told.columns)  # columns of their own: both come from `blocks`
    return held.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(finish, RESULT)
