"""Batches that become visible in all their tables at once.

Tables keep the rows of a batch in its own partitions.  A log says which batches are
complete; readers take only those.  A batch that died between two of its writes is in no
table for them, and is written anew when it is run again; a batch that is complete is not
written again, so what readers see never changes under them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.schemas import LONG, STRING, TIME, columns
from tillstream.sources.tables import BATCH, Lake, side_by_side

COMMITS = columns(batch_id=STRING, number=LONG, committed_at=TIME)


@dataclass(frozen=True)
class CommittedLake(Lake):
    """A lake whose reads see complete batches only.

    One writer at a time: commits are numbered one after another.
    """

    def commits(self) -> DataFrame:
        """batch_id, number, committed_at of the complete batches."""
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMITS)

    def is_committed(self, batch_id: str) -> bool:
        return bool(self.commits().where(F.col(BATCH) == batch_id).head(1))

    def commit(self, batch_id: str) -> None:
        """Make a batch visible.  One file with one row, which appears when it is whole."""
        last = self.commits().agg(F.max("number")).first()[0]
        line = self.spark.range(1).select(
            F.lit(batch_id).alias("batch_id"),
            F.lit((last or 0) + 1).cast("long").alias("number"),
            F.localtimestamp().alias("committed_at"),
        )
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def all_or_nothing(self, batch_id: str, writes: Sequence[Callable[[], None]]) -> bool:
        """Run the writes of a batch and commit it; False if it was committed before."""
        if self.is_committed(batch_id):
            return False
        side_by_side(self.spark, list(writes))
        self.commit(batch_id)
        return True

    def batches(
        self, name: str, schema: T.StructType | None = None, layer: str = "raw", upto: int | None = None
    ) -> DataFrame:
        """The rows of complete batches; with upto, of the first so many commits.

        The log prunes the partitions of the scan: batches that are not in it are not read.
        """
        done = self.commits() if upto is None else self.commits().where(F.col("number") <= upto)
        return super().batches(name, schema, layer).join(done.select(BATCH).distinct(), BATCH, "left_semi")

    def read_at(self, name: str, upto: int) -> DataFrame:
        """A raw table as it was after so many commits."""
        return self.batches(name, upto=upto).drop(BATCH)
