"""The change feed of the chunk table as a Spark data source, for batches and streams.

Each run of the feed is a folder of Parquet files and counts once its mark is written. A run's number is its offset: a stream
takes up after the last run it has seen, and a batch reads from one run to another. Every file is read by a task of its
own, a record batch at a time, through Arrow's file systems, which have to reach the folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from paperbrook.sources.tables import write_snapshot

FORMAT = "change_feed"
RUN = "run"
BATCH_ROWS = 8192


def append_feed(feed: DataFrame, folder: str, run: int) -> None:
    """Write the feed of one run, and then the mark that makes it count. An attempt that failed is written over."""
    write_snapshot(feed, f"{folder}/feed/run={run}")
    write_snapshot(feed.sparkSession.range(1), f"{folder}/done/run={run}")


def feed_schema(feed: T.StructType) -> T.StructType:
    """The feed's columns and the run they come from."""
    return T.StructType([*feed.fields, T.StructField(RUN, T.LongType())])


@dataclass
class FeedFile(InputPartition):
    path: str
    run: int

    def __init__(self, path: str, run: int):
        super().__init__((path, run))
        self.path, self.run = path, run


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def finished_runs(folder: str) -> list[int]:
    files, root = _folder(folder)
    found = files.get_file_info(fs.FileSelector(f"{root}/done", allow_not_found=True))
    marked = [i.path for i in found if i.type == fs.FileType.Directory and "/run=" in i.path]
    return sorted(int(p.rsplit("=", 1)[1]) for p in marked if files.get_file_info(f"{p}/_SUCCESS").type == fs.FileType.File)


def files_of(folder: str, runs: list[int]) -> list[FeedFile]:
    files, root = _folder(folder)
    found = []
    for run in runs:
        for info in files.get_file_info(fs.FileSelector(f"{root}/feed/run={run}")):
            name = info.path.rsplit("/", 1)[1]
            if info.type == fs.FileType.File and not name.startswith(("_", ".")):
                found.append(FeedFile(info.path, run))
    return found


def read_file(folder: str, part: FeedFile, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    files, _ = _folder(folder)
    wanted = to_arrow_schema(schema)
    names = [n for n in wanted.names if n != RUN]
    with files.open_input_file(part.path) as source:
        for batch in pq.ParquetFile(source).iter_batches(BATCH_ROWS, columns=names):
            columns = {n: batch.column(n).cast(wanted.field(n).type) for n in names}
            columns[RUN] = pa.array([part.run] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([columns[n] for n in wanted.names], schema=wanted)


class FeedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.folder = schema, options["path"]
        self.low, self.high = int(options.get("after", -1)), int(options.get("upto", 2**62))

    def partitions(self) -> list[FeedFile]:
        return files_of(self.folder, [r for r in finished_runs(self.folder) if self.low < r <= self.high])

    def read(self, partition: FeedFile) -> Iterator[pa.RecordBatch]:
        return read_file(self.folder, partition, self.schema) if partition else iter(())


class FeedStreamReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.folder, self.after = schema, options["path"], int(options.get("after", -1))

    def initialOffset(self) -> dict:
        return {RUN: self.after}

    def latestOffset(self) -> dict:
        return {RUN: max([self.after, *finished_runs(self.folder)])}

    def partitions(self, start: dict, end: dict) -> list[FeedFile]:
        return files_of(self.folder, [r for r in finished_runs(self.folder) if start[RUN] < r <= end[RUN]])

    def read(self, partition: FeedFile) -> Iterator[pa.RecordBatch]:
        return read_file(self.folder, partition, self.schema)

    def commit(self, end: dict) -> None:
        """Runs stay where they are; other readers may be behind."""


class FeedSource(DataSource):
    """``spark.read`` or ``readStream`` of format ``change_feed``, with the schema given and the folder as ``path``.

    Options: ``after``, the run that is known already; for batches ``upto``, the last run wanted.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("give the schema of the feed with .schema(feed_schema(...))")

    def reader(self, schema: T.StructType) -> FeedReader:
        return FeedReader(schema, dict(self.options))

    def streamReader(self, schema: T.StructType) -> FeedStreamReader:
        return FeedStreamReader(schema, dict(self.options))


def read_feed(spark: SparkSession, folder: str, schema: T.StructType, **options: int) -> DataFrame:
    """Finished runs as a table; ``schema`` is that of the feed, to which the run is added."""
    spark.dataSource.register(FeedSource)
    return spark.read.format(FORMAT).schema(feed_schema(schema)).options(**options).load(folder)


def stream_feed(spark: SparkSession, folder: str, schema: T.StructType, **options: int) -> DataFrame:
    """Runs as they are finished."""
    spark.dataSource.register(FeedSource)
    return spark.readStream.format(FORMAT).schema(feed_schema(schema)).options(**options).load(folder)


def net_changes(feed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The feed of several runs as one: of each key what it was before the first and what it is after the last.

    Rows that go are kept from all runs, for a key that was not there is no loss; rows that come only from the last
    run of their key.
    """
    last = feed.groupBy(F.col(key).alias("_key")).agg(F.max(RUN).alias("_last"))
    gone = F.col("_change_type").isin("delete", "update_preimage")
    both = feed.join(last, F.col(key) == F.col("_key"))
    return both.where(gone | (F.col(RUN) == F.col("_last"))).drop("_key", "_last", RUN)
