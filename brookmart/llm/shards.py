"""Streaming questions through shards that stay where they are.

Rows are dealt into shards once, and sorted so that a shard's rows come before the questions to it. A
task reads a shard, builds its index once, and answers the questions batch by batch as they come:
it holds one shard and one batch, however many questions there are. Every question is sent to every
shard; no row is sent twice.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_through(rows: DataFrame, asked: DataFrame, shards: int, build: Callable[[pa.Table], object],
                   answer: Callable[[object, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """What `answer` gives for the questions `asked`, by an index of each shard that `build` makes.

    `rows` has shard (0 to `shards` - 1) and width; `asked` has width. Rows and questions meet where
    their widths are equal. Other columns are theirs; what one side lacks is null there. Where `asked`
    names a `shard`, a question goes to that one only.
    """
    dealt = rows.withColumn("kind", F.lit(0))
    questions = asked.withColumn("kind", F.lit(1))
    if "shard" not in asked.columns:
        questions = questions.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = dealt.unionByName(questions, allowMissingColumns=True)
    names = ["shard", "width", "kind"]

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, index = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in names])
            cuts = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if begin == end:
                    continue
                own, (shard, width, kind) = batch.slice(begin, end - begin), keys[:, begin].tolist()
                if (shard, width) != at:
                    at, parts, index = (shard, width), [], None
                if kind == 0:
                    parts.append(own)
                elif parts or index is not None:
                    if index is None:
                        index, parts = build(pa.Table.from_batches(parts)), []
                    yield answer(index, own)

    return both.repartition(shards, "shard").sortWithinPartitions(*names).mapInArrow(partition, schema)
