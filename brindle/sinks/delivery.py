"""A sink with commit: what a failed, repeated or speculative task wrote never shows.

Each task writes its Arrow batches to a file of its own attempt and reports it.  When all
tasks are done, one manifest names the files of the reported attempts; readers take files
from manifests only.  A job that fails publishes nothing, and removes what its tasks
reported.  Files of attempts that died unreported stay unread until ``sweep``.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Executors need Spark and the installed libraries, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "brindle_delivery"
STAGED, PUBLISHED = "attempts", "manifests"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


@dataclass
class Attempt(WriterCommitMessage):
    """What a task reports: its file, if it had rows, and their number."""

    file: str | None
    rows: int


class DeliveryWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str) -> None:
        self.path, self.run = path, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        context = TaskContext.get()
        name = f"{STAGED}/{self.run}/{context.partitionId()}-{context.taskAttemptId()}.parquet"
        system, folder = opened(self.path)
        writer, rows = None, 0
        try:
            for batch in iterator:
                if writer is None:
                    system.create_dir(f"{folder}/{STAGED}/{self.run}", recursive=True)
                    writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=system)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Attempt(name if writer is not None else None, rows)

    def commit(self, messages: list[Attempt | None]) -> None:
        files = [{"file": one.file, "rows": one.rows} for one in messages if one is not None and one.file]
        system, folder = opened(self.path)
        system.create_dir(f"{folder}/{PUBLISHED}", recursive=True)
        # The manifest takes its place by a rename, so that a reader sees all of it or nothing.
        draft = f"{folder}/{PUBLISHED}/.{self.run}"
        with system.open_output_stream(draft) as out:
            for one in files:
                out.write((json.dumps(one) + "\n").encode())
        system.move(draft, f"{folder}/{PUBLISHED}/{self.run}.json")

    def abort(self, messages: list[Attempt | None]) -> None:
        system, folder = opened(self.path)
        for one in messages:
            if one is not None and one.file:
                system.delete_file(f"{folder}/{one.file}")


class Delivery(DataSource):
    """``df.write.format("brindle_delivery").option("path", ...)``; appends only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DeliveryWriter:
        if overwrite:
            raise ValueError("a delivery only adds to what was published")
        return DeliveryWriter(self.options["path"], uuid.uuid4().hex)


def deliver(df: DataFrame, path: str) -> None:
    """Write the rows of ``df`` below ``path``, all or none, each once."""
    df.sparkSession.dataSource.register(Delivery)
    df.write.format(FORMAT).mode("append").option("path", path).save()


def delivered_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, rows`` of all published files."""
    listed = spark.read.schema("file string, rows bigint").json(f"{path}/{PUBLISHED}")
    return listed.select(F.concat(F.lit(f"{path}/"), "file").alias("file"), "rows")


def read_delivered(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The published rows; the list of files, one for each task that wrote, comes to the driver as any listing does."""
    files = [row["file"] for row in delivered_files(spark, path).collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files)


def sweep(spark: SparkSession, path: str) -> int:
    """Remove the files no manifest names, when no delivery is under way; how many there were."""
    known = {row["file"][len(path) + 1 :] for row in delivered_files(spark, path).collect()}
    system, folder = opened(path)
    found = system.get_file_info(fs.FileSelector(f"{folder}/{STAGED}", recursive=True, allow_not_found=True))
    stale = [info.path for info in found if info.is_file and info.path[len(folder) + 1 :] not in known]
    for file in stale:
        system.delete_file(file)
    return len(stale)
