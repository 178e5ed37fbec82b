"""Random sample of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_ids(df: DataFrame, id_column: str, n: int, seed: str | None = None) -> DataFrame:
    """n ids in random order.

    With a seed the order is a hash of id and seed, so the same rows come back on any
    partitioning.  Either way Spark keeps the n smallest per task (top-k), no full sort.
    """
    if seed is None:
        return df.select(id_column).orderBy(F.rand()).limit(n)
    shuffled = F.md5(F.concat(F.col(id_column), F.lit(seed)))
    return df.select(id_column).orderBy(shuffled, id_column).limit(n)
