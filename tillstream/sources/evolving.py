"""Tables whose schema grows while they are written.

A table has versions of its schema.  Rows lie under the version they were written with and
are never rewritten: a reader casts each version's rows to the newest schema.  Fields
are added and types widened by the rules of a union of the old and the new.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.operators.evolve import conform
from tillstream.schemas import LONG, STRING, columns

VERSIONS = columns(version=LONG, schema=STRING)


def unified(spark: SparkSession, old: T.StructType, new: T.StructType) -> T.StructType:
    """The fields of both, old ones first, each in a type that holds either's values.

    Spark's own rules for a union say which type that is; a field whose types have no
    common one becomes a string.
    """
    fields = []
    names = [*old.names, *(n for n in new.names if n not in old.names)]
    for name in names:
        kinds = [s[name].dataType for s in (old, new) if name in s.names]
        kind = kinds[0]
        if len(kinds) == 2 and kinds[0] != kinds[1]:
            one, two = (spark.createDataFrame([], T.StructType([T.StructField(name, k)])) for k in kinds)
            numeric = all(isinstance(k, (T.NumericType, T.BooleanType)) == isinstance(kinds[0], (T.NumericType, T.BooleanType)) for k in kinds)
            try:
                kind = one.union(two).schema[name].dataType if numeric or T.NullType() in kinds else T.StringType()
            except AnalysisException:
                kind = T.StringType()
        fields.append(T.StructField(name, T.StringType() if isinstance(kind, T.NullType) else kind))
    return T.StructType(fields)


@dataclass(frozen=True)
class EvolvingTable:
    """A table under root.  One writer at a time; a batch written again replaces its rows."""

    spark: SparkSession
    root: str

    def versions(self) -> list[T.StructType]:
        """The schemas so far, oldest first: as many as there were changes."""
        try:
            rows = self.spark.read.schema(VERSIONS).parquet(f"{self.root}/versions").orderBy("version").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [T.StructType.fromJson(json.loads(r["schema"])) for r in rows]

    def write_batch(self, df: DataFrame, batch_id: str) -> int:
        """Write a batch, with a new version if it needs one; returns the version."""
        known = self.versions()
        wanted = unified(self.spark, known[-1] if known else T.StructType([]), df.schema)
        if not known or wanted != known[-1]:
            known.append(wanted)
            row = self.spark.createDataFrame([(len(known), wanted.json())], VERSIONS)
            row.coalesce(1).write.mode("append").parquet(f"{self.root}/versions")
        path = f"{self.root}/rows/version={len(known)}/batch_id={batch_id}"
        conform(df, wanted).write.mode("overwrite").parquet(path)
        return len(known)

    def read(self) -> DataFrame:
        """All rows in the newest schema; what a version lacks is NULL."""
        known = self.versions()
        if not known:
            raise ValueError(f"nothing was written to {self.root}")
        newest, parts = known[-1], []
        for number, schema in enumerate(known, 1):
            try:
                rows = self.spark.read.schema(schema).parquet(f"{self.root}/rows/version={number}").select(*schema.names)
            except AnalysisException as error:  # its first write died
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            parts.append(conform(rows, newest))
        return reduce(DataFrame.unionByName, parts, conform(self.spark.range(0), newest))


def fields_of(messages: DataFrame, column: str = "value") -> T.StructType:
    """The fields that the JSON objects of a micro-batch have, with types that hold them all.

    One aggregate over parsed values.  Text that is no JSON object counts for nothing; a
    field whose values have no common type, or that holds objects, is read as its JSON text.
    """
    value = F.try_parse_json(F.col(column))
    objects = messages.select(value.alias("v")).where(F.schema_of_variant("v").startswith("OBJECT<"))
    told = objects.agg(F.schema_of_variant_agg("v").alias("t")).first()["t"]
    if not told.startswith("OBJECT<"):
        return T.StructType([])
    found = T.StructType.fromDDL("r " + told.replace("OBJECT<", "STRUCT<"))["r"].dataType
    plain = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampNTZType)
    return T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, plain) else T.StringType()) for f in found])


def store_as_they_come(table: EvolvingTable) -> Callable[[DataFrame, str], None]:
    """For a stream of messages: store each micro-batch with the fields its JSON has."""

    def each_batch(messages: DataFrame, batch: str) -> None:
        fields = fields_of(messages)
        if not fields.names:
            return
        parsed = messages.select(F.inline(F.array(F.from_json("value", fields))))
        table.write_batch(parsed.where(F.coalesce(*[F.col(f"`{n}`").cast("string") for n in fields.names]).isNotNull()), batch)

    return each_batch
