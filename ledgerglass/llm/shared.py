"""Session matters: the folder that the driver and all executors share, and the size of Arrow batches."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import SparkSession

from ledgerglass.sources.stage import stage_dir


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder's URI under the shared folder; removed when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{stage_dir(spark)}/{name}-{uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    uri = fs.makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def open_fs(uri: str):
    """(pyarrow file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def size_of(text: str) -> int:
    """Bytes of a size as Spark writes it: 4194304, 64b, 64k, 64m, 64mb, 1g and so on."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def bounded_batches(spark: SparkSession) -> None:
    """Let texts go to Python at most 4 MB at a time, unless the session has a smaller size already.

    Spark's own limit of 64 MB is held several times over by each task, in the JVM and in Python.
    """
    if size_of(spark.conf.get(BATCH)) > BATCH_BYTES:
        spark.conf.set(BATCH, BATCH_BYTES)
