"""Writers for predictions and result tables. Nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def save_predictions(df: DataFrame, path: str, columns, file_format: str = "csv") -> None:
    """Write ``columns`` with the predicted class and probability."""
    out = df.select(*columns, "predicted_class", "predicted_probability")
    writer = out.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(file_format).save(path)


def save_table(df: DataFrame, path: str) -> None:
    """Write a result table as header CSV."""
    df.write.mode("overwrite").option("header", True).csv(path)


def load_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a result table back under its schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
