"""Tables of given rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def frame(spark, data, ddl):
    """A DataFrame of given rows that is planned as a local relation."""
    schema = T.StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl
    named = [dict(zip(schema.names, row, strict=True)) for row in data]
    return spark.createDataFrame(pa.Table.from_pylist(named, to_arrow_schema(schema)), schema)
