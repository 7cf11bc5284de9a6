"""Where jobs put the files they write on the way.

A cluster names a folder all executors can reach in ``spark.checkpoint.dir``.
A machine-local folder is used only in local mode, where every task sees it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"

# What the open scopes own: folders and tables, innermost scope last.
_SCOPES: list[tuple[list[str], list[str]]] = []


def _root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None)
    if not root and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="brindle-"))
    root = root or context.getCheckpointDir()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str = "work") -> str:
    """A fresh path (not yet created) below the shared folder."""
    path = f"{_root(spark)}/brindle/{purpose}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1][0].append(path)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut at a checkpoint in the shared folder."""
    _root(df.sparkSession)
    return df.checkpoint()


def table_name(purpose: str) -> str:
    """A catalog name no other call uses."""
    name = f"brindle_{purpose}_{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1][1].append(name)
    return name


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the shared folders and tables named inside, and removes them at the end.

    Frames that read them must have been used, or written elsewhere, by then.
    """
    owned: tuple[list[str], list[str]] = ([], [])
    _SCOPES.append(owned)
    try:
        yield
    finally:
        _SCOPES.remove(owned)
        for name in owned[1]:
            for table in (name, f"{name}_hot"):
                spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in owned[0]:
            remove_folder(spark, path)
            remove_folder(spark, f"{path}-hot")


def materialize(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage in a columnar form that survives the loss of any executor.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
