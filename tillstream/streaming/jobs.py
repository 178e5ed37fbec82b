"""Starting a micro-batch job."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# What a job does with a micro-batch, given a name for it that no other stream uses.
EachBatch = Callable[[DataFrame, str], None]


def batch_name(stream: str, number: int) -> str:
    return f"{stream}-{number:012d}"


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that this checkpoint belongs to.

    It is kept with the checkpoint: drawn when the stream first starts and read when it
    starts again.  So a micro-batch that is run again has the name it had, and a stream
    with another checkpoint, which counts its micro-batches from 0 too, has other names.
    """
    path = f"{checkpoint.rstrip('/')}/identity"
    try:
        known = spark.read.schema("stream string").parquet(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is None:
        name = uuid.uuid4().hex
        spark.range(1).select(F.lit(name).alias("stream")).write.mode("overwrite").parquet(path)
        return name
    return known["stream"]


def start(
    stream: DataFrame,
    each_batch: EachBatch,
    checkpoint: str,
    every: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run each_batch over the stream: all that is there now, or `every` interval."""
    name = stream_identity(stream.sparkSession, checkpoint)
    writer = (
        stream.writeStream.foreachBatch(lambda df, number: each_batch(df, batch_name(name, number)))
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_to_end(
    stream: DataFrame,
    each_batch: EachBatch,
    checkpoint: str,
    output_mode: str = "append",
) -> None:
    start(stream, each_batch, checkpoint, output_mode=output_mode).awaitTermination()
