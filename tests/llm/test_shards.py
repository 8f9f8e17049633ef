"""Shards on disk, their cells against plain Python, and questions streamed through shards."""
import math
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from brookmart.llm import sharding
from brookmart.llm.queries import op7_sharding
from brookmart.llm.shards import stream_through

FOLDER = "/root/testdata/sf0.001"


def test_written_shards_hold_every_row_once(spark, documents, tmp_path):
    docs = documents.withColumn("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("doc_id") % 50)).withColumns({c: F.lit(3) for c in ("slot", "row", "to")})
    assert "shard" in docs.columns
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    back = sharding.write_shards(sized, str(tmp_path / "out"), ["source", "lang"], ["n_bytes"], 5)
    assert sorted(map(repr, back.select(*sized.columns).collect())) == sorted(map(repr, sized.collect()))
    counts = [r["count"] for r in back.groupBy("shard_").count().collect()]
    assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_cells_are_those_of_plain_python(spark, documents):
    """Cells by rank hold about as many rows each; cells by size are two for each power of two."""
    rows = documents.select("source")
    got = {r[0]: r[1] for r in sharding.by_rank(rows, "source", 4).collect()}
    values = sorted((r.source for r in rows.collect()), key=lambda x: (x is None, x or ""))
    assert got == {v: values.index(v) * 16 // len(values) for v in set(values)}
    sizes = [0, 1, 2, 3, 5, 8, 100, 1 << 20, 1 << 40]
    cells = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", sharding.by_size(F.col("n"), 5).alias("c")).collect()
    steps = sorted({math.ceil(2 ** (i / 2)) for i in range(1, 32)})
    assert {r.n: r.c for r in cells} == {n: min(31, sum(n >= s for s in steps)) for n in sizes}


def test_query_columns(spark):
    want = {}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        data = (r.text or "").encode()
        want[r.doc_id] = (len(data) + 8, zlib.crc32(data), "rows", None)
    rows = op7_sharding(spark, FOLDER).collect()
    assert {r.doc_id: (r["size"], r.text_crc32, r.law, r.grown_shard) for r in rows} == want
    counts = [sum(r.shard == s for r in rows) for s in range(24)]
    assert max(counts) - min(counts) <= 1 and all(sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s])) for s in range(24))


def test_every_question_meets_every_shard_once(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as int) as shard", "cast(id % 2 as int) as width")
    asked = spark.range(30).selectExpr("id as q", "cast(id % 2 as int) as width")
    built = lambda table: table["id"].to_pylist()

    def answer(index, batch):
        pairs = [(q, len(index), sum(index)) for q in batch.column("q").to_pylist()]
        return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pairs)], names=["q", "n", "total"])

    got = stream_through(rows, asked, 7, built, answer, "q long, n long, total long").groupBy("q").agg(F.sum("n").alias("n"), F.sum("total").alias("t")).collect()
    assert {(r.q, r.n, r.t) for r in got} == {(q, 500, sum(range(q % 2, 1000, 2))) for q in range(30)}
    home = stream_through(rows, asked.selectExpr("q", "width", "cast(3 as int) as shard"), 7, built, answer, "q long, n long, total long")
    assert sum(r.n for r in home.collect()) == sum(sum(1 for i in range(1000) if i % 7 == 3 and i % 2 == q % 2) for q in range(30))
