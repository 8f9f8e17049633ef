"""What the operators of this subpackage share."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

#: White space of the text contracts: space and 0x09 to 0x0D. `bytes.split()` uses the same set.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared work folder and read it back.

    Cuts the lineage in a way that outlives executors, fixes what depends on
    partition order, and gives the optimizer the true size of the data.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """row, a key of its own for every row, and doc, the row as a struct: no column name of `docs` can
    clash with what an operator adds.

    Rows are numbered by scan task and place. A table that is read from files as it is (a relation
    and nothing above it) is split and numbered in the same way by each read, so it is not copied;
    any other DataFrame is written, so that all reads see the same keys.
    """
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc"))
    plain = docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and bool(docs.inputFiles())
    return numbered if plain else materialise(numbered, "keyed")


def whole_text(df: DataFrame, column: str = "text") -> DataFrame:
    """The rows with a text that is never null."""
    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit("")))
