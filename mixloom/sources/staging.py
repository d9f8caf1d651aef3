"""Materialise an intermediate result that several jobs will read.

Operators that need more than one pass (exact quantiles, running totals,
likelihood fits) write their input once as Parquet below the checkpoint folder
of the session and read it back. That cuts the lineage, survives the loss of
executors because the folder is shared, and lets each pass read only the columns
it needs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Folders of staged tables of this process, until ``drop_staged``.
_STAGED: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only for local masters."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a shared folder before running multi-pass operators")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="mixloom-"))
    return context.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/mixloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete all tables staged so far; to be called when no result that reads them is needed any more."""
    n = len(_STAGED)
    while _STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
