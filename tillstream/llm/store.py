"""Shared storage: written tables, files written by tasks, and code for the workers."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import work_area

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once per session."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    files = sorted(root.rglob("*.py"))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in files:
            archive.write(file, str(file.relative_to(root.parent)))
    path = f"{work_area(spark, 'code')}/{root.name}.zip"
    write_file(path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store a path or URI lies in, and the path inside it."""
    if "://" not in path:
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, data: bytes) -> None:
    store, inside = filesystem(path)
    store.create_dir(inside.rpartition("/")[0], recursive=True)
    with store.open_output_stream(inside, compression=None) as out:
        out.write(data)


def written(df: DataFrame, name: str, schema=None) -> DataFrame:
    """df as a table in the shared folder: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = work_area(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def gapless(df: DataFrame, group: list[str], order: list[str], name: str, salts: int) -> DataFrame:
    """Number the rows of each group from 0 without a gap; no group is held by one task.

    A group is cut into salts parts by the hash of the order columns.  Rows are ranked
    inside a part, and a part begins where the parts before it end; the table of parts
    has groups x salts rows.  Rows that are equal in all order columns are interchangeable.
    """
    from pyspark.sql import Window

    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = salted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(*group, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    rank = F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*order)) - 1
    ranked = salted.withColumn("_rank", rank)
    return ranked.join(begins, [*group, "_salt"]).withColumn(
        name, (F.col("_begin") + F.col("_rank")).cast("long")
    ).drop("_salt", "_rank", "_begin")
