"""Registry of queries; each has a builder and, where SQL can say it, the SQL beside it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The Parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # Looked up once per query; reading a footer again for every use would cost a job each.
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round sums and ratios, whose last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as ISO text."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def query(name: str, sql: str | None = None):
    """Register a builder under ``name``."""

    def wrap(build):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return wrap


def load_all() -> dict[str, Query]:
    """All registered queries."""
    from mixloom.plans import churn, decisions, fitted, lifetime, panel, quality, sales, scoring, sources

    del churn, decisions, fitted, lifetime, panel, quality, sales, scoring, sources
    return REGISTRY
