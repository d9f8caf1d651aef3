"""Readers: inferred and contract-bound CSV, frozen schema contracts, table ingestion."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.functions.dates import parse_date
from mixloom.operators.keys import dedupe_on_key
from mixloom.sources.schemas import TABLES, TableSpec

CORRUPT = "_corrupt_record"


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with inferred types; costs one extra scan, so freeze the schema for repeated use."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Header CSV under a contract.

    Cells that do not fit become NULL. With ``keep_corrupt`` the raw text of such a
    row stays in ``_corrupt_record``, so that it can be counted. Header names are
    checked against the contract.
    """
    read_schema = T.StructType(list(schema))
    if keep_corrupt:
        read_schema = read_schema.add(CORRUPT, T.StringType(), True)
    return (
        spark.read.schema(read_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def corrupt_count(df: DataFrame) -> DataFrame:
    """Rows read, rows with a malformed cell, and readable values per column; one row of result.

    Only cells of columns a query uses are converted, so every column is counted here.
    """
    columns = [c for c in df.columns if c != CORRUPT]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(CORRUPT).alias("n_corrupt"),
        *[F.count(c).alias(f"n_{c}") for c in columns],
    )


def freeze_schema(df: DataFrame, path: str) -> str:
    """Write the schema of ``df`` as a one-line JSON contract; returns the JSON text."""
    text = df.schema.json()
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """JSON contract (a file or a folder, one or many lines) to a schema."""
    lines = [r[0] for r in spark.read.text(path, wholetext=True).collect() if r[0].strip()]
    return T.StructType.fromJson(json.loads("".join(lines)))


def sql_source(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """A query text as a source; tables are named ``{name}`` in the text."""
    return spark.sql(text, **tables)


def ingest_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Read one retail CSV: header check, date coercion, first row per key.

    Dates arrive in two layouts, so they are read as text and parsed. Of rows with
    the same key one is kept, chosen by the order of the other columns.
    """
    raw = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in spec.date_columns else f.dataType) for f in spec.schema]
    )
    df = read_csv(spark, path, raw)
    df = df.withColumns({c: parse_date(c) for c in spec.date_columns}) if spec.date_columns else df
    rest = [f.name for f in spec.schema if f.name not in spec.key]
    return dedupe_on_key(df, list(spec.key), rest or list(spec.key)).select(*spec.schema.names)


def ingest(spark: SparkSession, folder: str, target: str, names=None) -> dict[str, DataFrame]:
    """Ingest the named retail tables from ``folder/<NAME>.csv`` into Parquet below ``target``."""
    tables = {}
    for name in names or list(TABLES):
        spec = TABLES[name]
        path = f"{target.rstrip('/')}/{name}"
        ingest_table(spark, f"{folder.rstrip('/')}/{name.upper()}.csv", spec).write.mode("overwrite").parquet(path)
        tables[name] = spark.read.schema(spec.schema).parquet(path)
    return tables
