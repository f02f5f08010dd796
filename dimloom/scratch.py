"""Shared folder for tables that cut a plan in two."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

# Tables that a run stores and reads again; a quarter to a third less than Spark's default.
STORED_CODEC = "zstd"

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[SparkSession, tuple[int, str | None]] = {}  # writes that run, the setting before


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    That folder has to be one all executors share. Only a local-mode session may do without
    the setting; it then gets a temporary folder, set once as its checkpoint directory.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.getCheckpointDir():
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="dimloom-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/dimloom/{uuid.uuid4().hex}/{label}"


def make_folder(spark: SparkSession, path: str) -> None:
    """The folder, wherever Spark keeps it, if it is not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a write shuffles goes when it ends, and not when the driver happens to collect its garbage.

    Frames keep their plans, so one that is used again shuffles again.
    """
    with _lock:
        writes, before = _writing.get(spark) or (0, spark.conf.get(_FREED, None))
        _writing[spark] = writes + 1, before
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            writes, before = _writing.pop(spark)
            if writes > 1:
                _writing[spark] = writes - 1, before
            else:
                spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def store(path: str, df: DataFrame, mode: str = "errorifexists", by: Sequence[str] = ()) -> None:
    """Write the frame as Parquet, a folder for each value of ``by``."""
    with shuffles_freed(df.sparkSession):
        df.write.mode(mode).partitionBy(*by).parquet(path, compression=STORED_CODEC)
