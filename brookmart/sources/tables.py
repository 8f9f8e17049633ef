"""Tables: JDBC, dimensions, literal rows."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jdbc(spark, table, conn):
    """Scan a JDBC table. `conn` holds reader options; give `partitionColumn`,
    `lowerBound`, `upperBound` and `numPartitions` to read large tables in parallel."""
    return spark.read.format("jdbc").options(dbtable=table, **conn).load()


def read_dim(spark, path, columns=None):
    """A dimension as stored now. A stream that looks up in it must read it in every batch (see `looked_up`)."""
    dim = spark.read.parquet(path)
    return dim.select(*columns) if columns else dim


def dictionary(codes, names):
    """Shape of the code dictionary: `dic_code` and a struct `info` of its name."""
    return [codes.cast("string").alias("dic_code"),
            F.struct(names.cast("string").alias("dic_name")).alias("info")]


def literal_rows(spark, rows, schema):
    """A small table of literal rows; a local relation, so its size is known."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = schema.fieldNames()
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, row)) for row in rows]), schema)
