"""Additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_columns(df: DataFrame, columns: T.StructType) -> DataFrame:
    """Add the columns that df lacks, as NULLs of the given type; keep the others."""
    present = {name.lower() for name in df.columns}
    absent = {
        f.name: F.lit(None).cast(f.dataType) for f in columns if f.name.lower() not in present
    }
    return df.withColumns(absent) if absent else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of schema, in order, cast; absent ones are NULL."""
    wide = ensure_columns(df, schema)
    return wide.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
