"""A message log in a folder: partitions, offsets, and a stream that starts early or late.

    {path}/partition=3/00000000000000000120-00000000000000000180.parquet

holds the messages 120 to 179 of partition 3, one row each in order.  A reader asks the
file names for the ends of the partitions, so finding out what is new opens no file, and
a micro-batch reads the rows between two sets of offsets.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The classes go to Python workers by value, so these need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEGMENT_ROWS = 200_000  # a segment ends with the batch that reaches so many
SCHEMA = "key string, value string, partition int, offset long"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """The store a path or URI lies in, and the path inside it."""
    return pafs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


def segments(path: str) -> list[tuple[int, int, int, str]]:
    """(partition, first offset, offset behind the last, file) of a log, in order."""
    store, inside = _store(path)
    listed = store.get_file_info(pafs.FileSelector(inside, recursive=True, allow_not_found=True))
    found = []
    for info in listed:
        folder, _, name = info.path.rpartition("/")
        stem, dot, kind = name.partition(".")
        if info.type == pafs.FileType.File and kind == "parquet" and "/partition=" in folder:
            first, _, behind = stem.partition("-")
            found.append((int(folder.rpartition("=")[2]), int(first), int(behind), info.path))
    return sorted(found)


def ends(path: str) -> dict[str, int]:
    """The offset behind the last message of each partition."""
    out: dict[str, int] = {}
    for partition, _, behind, _ in segments(path):
        out[str(partition)] = max(behind, out.get(str(partition), 0))
    return out


def append(messages: DataFrame, path: str, partitions: int = 8, order: str | None = None) -> None:
    """Add messages (key, value) to a log; a key always goes to the same partition.

    Messages are sorted by partition and rank over many tasks.  A task writes its runs as
    they come, cut into segments, beside the log; when all are whole, their row counts in
    order give the offsets, and each moves to the name these make.  So no task holds a
    partition, and a writer that dies leaves a log without gaps.  One writer at a time.
    """
    behind = ends(path)
    store, inside = _store(path)
    beside = f"{inside}/writing-{uuid.uuid4().hex}"
    place = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    rank = [F.col(order)] if order else []
    by = ["partition", *rank, "key", "value"]
    dealt = messages.withColumn("partition", place).repartitionByRange(*by).sortWithinPartitions(*by).select("partition", "key", "value")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _store(path)
        store.create_dir(beside, recursive=True)
        told, open_one = [], None

        def close() -> None:
            nonlocal open_one
            if open_one:
                open_one.close()
            open_one = None

        for batch in batches:
            for number in pc.unique(batch["partition"]).to_pylist():
                run = batch.filter(pc.equal(batch["partition"], number)).select(["key", "value"])
                if not open_one or told[-1]["partition"] != number or told[-1]["rows"] >= SEGMENT_ROWS:
                    close()
                    told.append({"partition": number, "task": TaskContext.get().partitionId(), "nth": len(told), "rows": 0, "file": f"{beside}/{uuid.uuid4().hex}.parquet"})
                    open_one = pq.ParquetWriter(told[-1]["file"], run.schema, filesystem=store)
                open_one.write_batch(run)
                told[-1]["rows"] += run.num_rows
        close()
        if told:
            yield pa.RecordBatch.from_pylist(told, pa.schema([("partition", pa.int32()), ("task", pa.int32()), ("nth", pa.int32()), ("rows", pa.int64()), ("file", pa.string())]))

    # One row a segment.
    for run in sorted(dealt.mapInArrow(write, "partition int, task int, nth int, rows long, file string").collect()):
        first = behind.get(str(run.partition), 0)
        behind[str(run.partition)] = first + run.rows
        folder = f"{inside}/partition={run.partition}"
        store.create_dir(folder, recursive=True)
        store.move(run.file, f"{folder}/{first:020d}-{first + run.rows:020d}.parquet")
    if store.get_file_info(beside).type == pafs.FileType.Directory:
        store.delete_dir(beside)


class Segment(InputPartition):
    def __init__(self, file: str, partition: int, first: int, begin: int, end: int):
        self.file, self.partition, self.first, self.begin, self.end = file, partition, first, begin, end


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.starting = options.get("startingoffsets", options.get("startingOffsets", "earliest"))
        self.memory = options.get("rememberstart", options.get("rememberStart"))
        if self.starting not in ("earliest", "latest"):
            raise ValueError("startingOffsets is 'earliest' or 'latest'")

    def initialOffset(self) -> dict:
        """Where a stream without progress begins.  For 'latest' the place is remembered: the
        next start of a stream that has read nothing yet begins there, too."""
        if self.starting == "earliest":
            return {}
        if not self.memory:
            return ends(self.path)
        store, inside = _store(self.memory)
        name = f"{inside}/start.json"
        if store.get_file_info(name).type == pafs.FileType.NotFound:
            store.create_dir(inside, recursive=True)
            with store.open_output_stream(name) as out:
                out.write(json.dumps(ends(self.path)).encode())
        with store.open_input_stream(name) as found:
            return json.loads(found.read())

    def latestOffset(self) -> dict:
        return ends(self.path)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for number, first, behind, file in segments(self.path):
            begin, stop = max(first, start.get(str(number), 0)), min(behind, end.get(str(number), 0))
            if begin < stop:
                out.append(Segment(file, number, first, begin, stop))
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        at = partition.first
        for batch in pq.ParquetFile(partition.file, filesystem=store).iter_batches(10_000):
            a, b = max(partition.begin - at, 0), min(partition.end - at, batch.num_rows)
            if a < b:
                n = b - a
                columns = [batch["key"].slice(a, n), batch["value"].slice(a, n)]
                numbers = [pa.array([partition.partition] * n, pa.int32()), pa.array(range(at + a, at + b), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + numbers, names=["key", "value", "partition", "offset"])
            at += batch.num_rows

    def commit(self, end: dict) -> None:
        """Segments stay; the stream's checkpoint holds its progress."""


class FolderLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogReader(dict(self.options))


def log_stream(spark: SparkSession, path: str, starting_offsets: str = "earliest", remember: str | None = None) -> DataFrame:
    """Messages of a log as a stream: key, value, partition, offset.

    Progress lives in the query's checkpoint; the starting offsets matter for its first
    run only.  With 'latest', remember names a folder (in the checkpoint's, say) for
    the place where the stream began, should it stop before it has read anything.
    """
    spark.dataSource.register(FolderLog)
    reader = spark.readStream.format("folder_log").option("path", path).option("startingOffsets", starting_offsets)
    if remember:
        reader = reader.option("rememberStart", remember)
    return reader.load()
