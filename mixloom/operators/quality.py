"""Data-quality reports. Each scans its input once, whatever the number of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.functions.scalars import safe_ratio
from mixloom.operators.ordering import exact_quantiles


def check_columns(df: DataFrame, expected) -> list[str]:
    """Expected columns that ``df`` lacks; metadata only."""
    return [c for c in expected if c not in df.columns]


def require_columns(df: DataFrame, expected) -> None:
    missing = check_columns(df, expected)
    if missing:
        raise ValueError(f"missing columns: {missing}")


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def missing_report(df: DataFrame, columns=None) -> DataFrame:
    """NULL count and share of each column that has any NULL."""
    columns = columns or df.columns
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    long = counted.unpivot(["_rows"], columns, "column_name", "n_missing")
    return long.filter("n_missing > 0").select(
        "column_name", "n_missing", F.round(F.col("n_missing") * 100.0 / F.col("_rows"), 2).alias("pct_missing")
    )


def missing_share_by_group(df: DataFrame, group: str, columns) -> DataFrame:
    """Share of NULLs per group and column, long."""
    wide = df.groupBy(group).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return wide.unpivot([group], list(columns), "column_name", "missing_share")


def missing_matrix(df: DataFrame, keys, columns) -> DataFrame:
    """0/1 indicator of NULL per row and column."""
    return df.select(*keys, *[F.col(c).isNull().cast("int").alias(c) for c in columns])


def describe(df: DataFrame, columns) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column.

    ``df`` is read twice (moments, then quartiles).
    """
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    values = [F.col(c).cast("double") for c in columns]
    stats = {
        "n": lambda v: F.count(v),
        "mean": lambda v: F.avg(v),
        "std": lambda v: F.stddev_samp(v),
        "min": lambda v: F.min(v),
        "max": lambda v: F.max(v),
    }
    row = df.agg(
        *[
            F.struct(*[fn(v).alias(name) for name, fn in stats.items()]).alias(f"c{i}")
            for i, v in enumerate(values)
        ]
    )
    parts = []
    for i, c in enumerate(columns):
        q = quartiles[c]
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"c{i}.n").alias("n"),
                F.col(f"c{i}.mean").alias("mean"),
                F.col(f"c{i}.std").alias("std"),
                F.col(f"c{i}.min").alias("min"),
                F.lit(q[0]).cast("double").alias("q25"),
                F.lit(q[1]).cast("double").alias("q50"),
                F.lit(q[2]).cast("double").alias("q75"),
                F.col(f"c{i}.max").alias("max"),
            )
        )
    return row.select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def profile_keys(df: DataFrame, organisation: str, territory: str, day: str) -> DataFrame:
    """Distinct organisations and territories, and the date range."""
    # Two distinct aggregates in one pass would expand every row; the pairs are few.
    pairs = df.groupBy(organisation, territory).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return pairs.agg(
        F.count_distinct(organisation).alias("n_organisations"),
        F.count_distinct(territory).alias("n_territories"),
        F.min("lo").alias("first_day"),
        F.max("hi").alias("last_day"),
    )


def temporal_range(df: DataFrame, columns) -> DataFrame:
    """Minimum and maximum of each column in one row."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def train_readiness(df: DataFrame, day: str, spend_columns, target: str, time_controls, min_weeks=104, min_channels=3):
    """Checks before a marketing-mix fit: span, active channels, target and controls present."""
    totals = df.agg(
        F.datediff(F.max(day), F.min(day)).alias("days"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in spend_columns],
    )
    active = sum([(F.col(c) > 0).cast("int") for c in spend_columns], F.lit(0))
    has_target = float(target in df.columns)
    n_missing = float(len(check_columns(df, time_controls)))

    def check(name, value, passed):
        return F.struct(F.lit(name).alias("check_name"), value.alias("value"), passed.alias("passed"))

    weeks = F.col("days") / F.lit(7.0)
    checks = F.array(
        check("train_weeks", weeks.cast("double"), weeks >= min_weeks),
        check("active_channels", active.cast("double"), active >= min_channels),
        check("target_present", F.lit(has_target), F.lit(has_target == 1.0)),
        check("missing_time_controls", F.lit(n_missing), F.lit(n_missing == 0.0)),
    )
    return totals.select(F.explode(checks).alias("c")).select("c.*")


def column_types(df: DataFrame, exclude=()) -> dict[str, list[str]]:
    """Columns by role: categorical, numeric, date."""
    roles: dict[str, list[str]] = {"categorical": [], "numeric": [], "date": []}
    for f in df.schema:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, (T.StringType, T.BooleanType)):
            roles["categorical"].append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            roles["numeric"].append(f.name)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            roles["date"].append(f.name)
    return roles


def not_null_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows with both values present."""
    return df.dropna(subset=[a, b])


def excluded_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """How many rows ``not_null_pairs`` keeps and drops."""
    complete = F.col(a).isNotNull() & F.col(b).isNotNull()
    return df.agg(F.count_if(complete).alias("n_kept"), F.count_if(~complete).alias("n_excluded"))


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features without the target, and the target alone."""
    return df.drop(target), df.select(target)


def value_share(counted: DataFrame, count: str, out: str) -> DataFrame:
    """Share of each row of a small counted table in its total, in percent."""
    total = counted.agg(F.sum(count).alias("_total"))
    joined = counted.crossJoin(F.broadcast(total))
    return joined.withColumn(out, safe_ratio(F.col(count) * 100.0, F.col("_total"))).drop("_total")
