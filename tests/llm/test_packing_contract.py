"""Ids of the encoder that op5_packing and the pipeline use, against the tokenizer that the contract names."""
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brookmart.llm import packing, queries
import corpus_pipeline

END = "<|endoftext|>"


@pytest.mark.parametrize("text", ["", END, f"a{END}b", f"{END}{END} x\n{END} ", f"<|endoftext|{END}>|>", " a  b\n\n c ", "é 　x" + END,
                                  "a" + " " * 1_000_000 + "b", END + "\n" * 1_000_000 + END])
def test_ids_are_those_of_the_named_tokenizer(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.contract_bpe()(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_op5_and_pipeline_encode_added_tokens(spark, tmp_path):
    frame = spark.createDataFrame([(1, f"one {END} two")], "doc_id long, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(f"one {END} two", add_special_tokens=False).ids + [1]
    assert 50256 in ids
    crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    for out in (queries.op5_packing(spark, str(tmp_path)), corpus_pipeline.pack(spark, frame, "")):
        assert [tuple(r) for r in out.select("doc_id", "ids_crc32", F.col("doc_tokens")).collect()] == [(1, crc, len(ids))]
