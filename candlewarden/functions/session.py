"""Where a job may put intermediate tables, and how they are written."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DIR_SETTING = "spark.checkpoint.dir"

_JOB: contextvars.ContextVar[str | None] = contextvars.ContextVar("job", default=None)
_LOCAL_DIRS: dict[str, str] = {}


def working_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode, where none is set."""
    app = spark.sparkContext.applicationId
    root = spark.conf.get(DIR_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{DIR_SETTING} must name a folder that every executor can reach")
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="candlewarden-")
        root = _LOCAL_DIRS[app]
    own = f"{root.rstrip('/')}/candlewarden-{app}"
    return f"{own}/{_JOB.get()}" if _JOB.get() else own


@contextlib.contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for the intermediate tables of one job, deleted when the job ends or fails.

    Tables of other jobs of the application are not touched. Nothing lazy may leave the block.
    """
    token = _JOB.set(f"job-{uuid.uuid4().hex}")
    path = working_dir(spark)
    try:
        yield path
    finally:
        _JOB.reset(token)
        delete(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and fixes row ids that depend on how a
    scan was split. Readers of the table get column pruning and filters pushed to Parquet.
    """
    spark = df.sparkSession
    path = f"{working_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete all of this application's intermediate tables; call when their results have been written."""
    delete(spark, working_dir(spark))
