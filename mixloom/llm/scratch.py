"""Intermediate tables of the text operators.

A scratch space is one folder below ``spark.checkpoint.dir``. Tables written there cut the
lineage and survive lost executors, because the folder is shared. Superseded tables are dropped
while an operator runs; the ones that a returned DataFrame still reads stay until ``close``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mixloom.sources.staging import staging_root


class Scratch:
    """Written and reread tables of one operator call."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{staging_root(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}
        self._held: list[DataFrame] = []

    def keep(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        """Write ``df`` and return a scan of the written table."""
        path = f"{self.folder}/{len(self._held)}"
        df.write.option("compression", compression).parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        self._held.append(table)
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            self._delete(self.paths.pop(id(table)))

    def close(self) -> None:
        """Delete everything."""
        self._delete(self.folder)
        self.paths.clear()

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
