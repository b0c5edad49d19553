"""Writing an intermediate table once, so that its lineage is cut and later reads are cheap."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_own: list[tempfile.TemporaryDirectory] = []


def stage_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; in local mode a temporary one if unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.TemporaryDirectory(prefix="ledgerglass-"))
    return _own[0].name


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    """Let the driver remove the table when it ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)


def stage(df: DataFrame) -> DataFrame:
    """The same rows read back from parquet.

    Several branches of a plan can then read them without computing them again, a lost
    executor loses nothing, and the planner knows the size of the table.
    """
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/staged-{uuid4().hex}"
    df.write.parquet(path)
    _delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


METHOD_LIMIT, METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def small_methods(spark: SparkSession) -> None:
    """Let plans with wide rows run as one step per operator where one generated method would pass 8,000 bytes, unless the session has a smaller limit.

    The JVM never compiles a longer method, so it would be interpreted row by row.
    """
    if int(spark.conf.get(METHOD_LIMIT)) > METHOD_BYTES:
        spark.conf.set(METHOD_LIMIT, METHOD_BYTES)
