"""Column naming styles and JSON rows."""
from __future__ import annotations

import re

from pyspark.sql import functions as F


def snake(name):
    return re.sub(r"(?<!^)([A-Z])", r"_\1", name).lower()


def camel(name):
    head, *tail = name.split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in tail)


def to_snake(df):
    """Rename camelCase columns to snake_case."""
    return df.withColumnsRenamed({c: snake(c) for c in df.columns})


def to_camel(df):
    """Rename snake_case columns to camelCase."""
    return df.withColumnsRenamed({c: camel(c) for c in df.columns})


def to_snake_json(df, columns=None):
    """One JSON text per row, in column `value`, keys in snake_case.

    `columns` limits the row to its output fields (working columns such as `ts`
    or `sid` stay out).
    """
    named = to_snake(df.select(*columns) if columns else df)
    return named.select(F.to_json(F.struct(*named.columns)).alias("value"))
