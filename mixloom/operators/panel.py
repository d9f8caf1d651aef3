"""Marketing panel: channel roles, firm selection, preparation, alignment, splits.

A panel has one row per territory and day and, per channel, columns named
``<CHANNEL>_SPEND``, ``<CHANNEL>_CLICKS`` and ``<CHANNEL>_IMPRESSIONS``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.functions.dates import day_of_week
from mixloom.functions.scalars import coalesced_sum, row_total, safe_ratio
from mixloom.operators.ordering import running_totals
from mixloom.sources.staging import stage

# Column suffixes and names of the panel files.
SPEND, CLICKS, IMPRESSIONS = "_SPEND", "_CLICKS", "_IMPRESSIONS"
ALL_TERRITORIES = "All Territories"
TIME_CONTROLS = ("TREND", "DAY_OF_WEEK", "MONTH")
UNUSED_COLUMNS = (
    "MMM_TIMESERIES_ID",
    "ORGANISATION_ID",
    "ORGANISATION_VERTICAL",
    "ORGANISATION_SUBVERTICAL",
    "ORGANISATION_MARKETING_SOURCES",
    "ORGANISATION_PRIMARY_TERRITORY_NAME",
    "CURRENCY_CODE",
    "FIRST_PURCHASES",
    "FIRST_PURCHASES_UNITS",
    "ALL_PURCHASES",
    "ALL_PURCHASES_UNITS",
    "FIRST_PURCHASES_ORIGINAL_PRICE",
    "FIRST_PURCHASES_GROSS_DISCOUNT",
)
RANKING_MISSING_SHARE = 0.80
DROP_MISSING_SHARE = 0.70
TRAIN_RATIO = 0.75
PRIOR_SIGMA = 0.5


def spend_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.endswith(SPEND)]


def media_channels(df: DataFrame) -> dict[str, list[str]]:
    """Columns by role, and the channels that have a spend column."""
    spend = spend_columns(df)
    return {
        "channels": [c.removesuffix(SPEND) for c in spend],
        "spend_cols": spend,
        "clicks_cols": [c for c in df.columns if c.endswith(CLICKS)],
        "impressions_cols": [c for c in df.columns if c.endswith(IMPRESSIONS)],
    }


def paired_channels(df: DataFrame) -> list[str]:
    """Channels with both a spend and a clicks column."""
    return [c for c in media_channels(df)["channels"] if c + CLICKS in df.columns]


def select_firm(df: DataFrame, organisation, territory="TERRITORY_NAME", org="ORGANISATION_ID") -> DataFrame:
    """Rows of one organisation without the total over territories."""
    return df.filter((F.col(org) == organisation) & (F.col(territory) != ALL_TERRITORIES))


def org_ranking(df: DataFrame, max_missing: float = RANKING_MISSING_SHARE) -> DataFrame:
    """Per organisation the date span, active channels and rows, in one aggregate."""
    spend = spend_columns(df)
    active = sum(
        [(F.avg(F.col(c).isNull().cast("double")) < max_missing).cast("long") for c in spend], F.lit(0).cast("long")
    )
    return (
        df.filter(F.col("TERRITORY_NAME") != ALL_TERRITORIES)
        .groupBy("ORGANISATION_ID")
        .agg(
            F.datediff(F.max("DATE_DAY"), F.min("DATE_DAY")).alias("date_range_days"),
            active.alias("active_channels"),
            F.count(F.lit(1)).alias("n_rows"),
        )
    )


def best_organisation(df: DataFrame, max_missing: float = RANKING_MISSING_SHARE) -> DataFrame:
    """The organisation with most active channels, then the longest span; ties by id."""
    order = [F.desc("active_channels"), F.desc("date_range_days"), F.col("ORGANISATION_ID")]
    return org_ranking(df, max_missing).orderBy(*order).limit(1)


def drop_sparse_channels(df: DataFrame, group: str = "TERRITORY_NAME", max_missing: float = DROP_MISSING_SHARE):
    """Drop the columns of channels missing too often in any group; fill the other spends with 0.

    Only one row of shares reaches the driver, to decide on column names.
    """
    spend = spend_columns(df)
    shares = df.groupBy(group).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in spend])
    worst = shares.agg(*[F.max(c).alias(c) for c in spend]).first()
    dropped = [c.removesuffix(SPEND) for c in spend if worst[c] is not None and worst[c] > max_missing]
    gone = [c for c in df.columns if any(c.startswith(channel + "_") for channel in dropped)]
    kept = df.drop(*gone)
    return kept.fillna(0.0, subset=spend_columns(kept)) if spend_columns(kept) else kept


def trend_index(df: DataFrame, day: str = "DATE_DAY", out: str = "TREND") -> DataFrame:
    """0-based index of the day among the distinct days.

    Ranks the distinct days, a calendar-sized table, and joins them back instead of
    sorting the panel.
    """
    return df.join(F.broadcast(_ranked_days(df, day, out)), day)


def _ranked_days(df: DataFrame, day: str, out: str) -> DataFrame:
    ranked = df.select(day).distinct()
    return ranked.withColumn(out, (F.row_number().over(Window.orderBy(day)) - F.lit(1)).cast("long"))


def trend_row_index(df: DataFrame, geo: str = "GEO", day: str = "DATE_DAY", out: str = "TREND") -> DataFrame:
    """0-based index of the row in (day, geo) order. ``df`` is read several times and should be staged."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), [day, geo], {out: "_one"})
    return counted.withColumn(out, F.col(out) - F.lit(1)).drop("_one")


def prepare_panel(df: DataFrame, day: str = "DATE_DAY") -> DataFrame:
    """Net revenue, discount rate, zero-filled media, trend and calendar controls."""
    kept = df.drop(*UNUSED_COLUMNS)
    price, discount = F.col("ALL_PURCHASES_ORIGINAL_PRICE"), F.col("ALL_PURCHASES_GROSS_DISCOUNT")
    media = [c for c in kept.columns if c.endswith((SPEND, CLICKS))]
    prepared = kept.withColumns(
        {
            "GEO": F.col("TERRITORY_NAME"),
            "NET_REVENUE": price - discount,
            "DISCOUNT_RATE": safe_ratio(discount, price, 0.0),
            "DAY_OF_WEEK": day_of_week(F.col(day)),
            "MONTH": F.month(day),
        }
    )
    return trend_index(prepared.fillna(0, subset=media), day)


def temporal_split(df: DataFrame, day: str = "DATE_DAY", ratio: float = TRAIN_RATIO, out: str = "split") -> DataFrame:
    """Mark the first ``ratio`` of the distinct days as train, the others as test."""
    days = _ranked_days(df, day, "_rank").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
    cut = F.floor(F.col("_n") * F.lit(ratio))
    marked = days.select(day, F.when(F.col("_rank") < cut, "train").otherwise("test").alias(out))
    return df.join(F.broadcast(marked), day)


def temporal_split_rows(df: DataFrame, geo="GEO", day="DATE_DAY", ratio=TRAIN_RATIO, out="split") -> DataFrame:
    """Variant that cuts by row position in (day, geo) order; a day may fall on both sides."""
    numbered = trend_row_index(df, geo, day, "_row")
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    cut = F.floor(F.col("_n") * F.lit(ratio))
    return (
        numbered.crossJoin(F.broadcast(total))
        .withColumn(out, F.when(F.col("_row") < cut, "train").otherwise("test"))
        .drop("_row", "_n")
    )


def geo_day_grid(df: DataFrame, geo: str = "GEO", day: str = "DATE_DAY") -> DataFrame:
    """Every geo with every day; the days are a calendar-sized table."""
    return df.select(geo).distinct().crossJoin(F.broadcast(df.select(day).distinct()))


def holdout_mask(df: DataFrame, geo: str = "GEO", day: str = "DATE_DAY", ratio: float = TRAIN_RATIO) -> DataFrame:
    """Boolean per geo and day, true for the last days."""
    split = temporal_split(geo_day_grid(df, geo, day), day, ratio)
    return split.select(geo, day, (F.col("split") == "test").alias("is_holdout"))


def densify(df: DataFrame, geo="GEO", day="DATE_DAY") -> DataFrame:
    """A row for every geo and day; time controls by day, other numbers 0 where there was no row.

    ``df`` is read several times; it should come from a staged table.
    """
    controls = [c for c in TIME_CONTROLS if c in df.columns]
    full = geo_day_grid(df, geo, day).join(df.drop(*controls), [geo, day], "left")
    if controls:
        per_day = df.groupBy(day).agg(*[F.min(c).alias(c) for c in controls])
        full = full.join(F.broadcast(per_day), day)
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in controls]
    return full.fillna(0, subset=numeric).select(*df.columns)


def align_geo_dates(df: DataFrame, geo="GEO", day="DATE_DAY", target="NET_REVENUE") -> DataFrame:
    """Densify, then drop the days on which any geo has no revenue."""
    filled = stage(densify(stage(df), geo, day))
    zero_days = filled.filter(F.col(target) == 0).select(day).distinct()
    return filled.join(F.broadcast(zero_days), day, "left_anti").select(*df.columns)


def complete_days(df: DataFrame, geo="GEO", day="DATE_DAY", target="NET_REVENUE") -> DataFrame:
    """The same rows as ``align_geo_dates`` by a HAVING: days on which every geo has revenue."""
    base = stage(df)
    n_geos = base.agg(F.count_distinct(geo).alias("_geos"))
    with_revenue = F.count_if(F.coalesce(F.col(target), F.lit(0)) != 0).alias("_n")
    days = base.groupBy(day).agg(with_revenue).crossJoin(F.broadcast(n_geos)).filter("_n = _geos").select(day)
    kept = base.join(F.broadcast(days), day, "left_semi")
    numeric = [f.name for f in base.schema if isinstance(f.dataType, T.NumericType)]
    return kept.fillna(0, subset=numeric).select(*df.columns)


def rows_per_geo(df: DataFrame, geo: str = "GEO") -> DataFrame:
    return df.groupBy(geo).agg(F.count(F.lit(1)).alias("n_rows"))


def empirical_roi(df: DataFrame, geo: str = "GEO", target: str = "NET_REVENUE") -> DataFrame:
    """Revenue over spend per geo and for all geos, from one rollup."""
    spent = df.select(geo, F.col(target).alias("_r"), row_total(spend_columns(df)).alias("_s"))
    rolled = spent.groupBy(geo).agg(F.sum("_r").alias("_r"), F.sum("_s").alias("_s")).rollup(geo)
    return rolled.agg(F.sum("_r").alias("revenue"), F.sum("_s").alias("spend"), F.grouping(geo).alias("_g")).select(
        F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col(geo)).alias("geo"),
        "revenue",
        "spend",
        safe_ratio("revenue", "spend").alias("roi"),
    )


def roi_prior(roi: DataFrame, sigma: float = PRIOR_SIGMA) -> DataFrame:
    """Location and scale of the log-normal prior centred on the empirical ROI."""
    return roi.filter(F.col("geo") == "ALL").select(
        F.log("roi").alias("mu"), F.lit(sigma).alias("sigma"), F.col("roi").alias("prior_median")
    )


def media_input(df: DataFrame, geo="GEO", day="DATE_DAY") -> DataFrame:
    """Long media table (geo, day, channel, media, spend) of the paired channels."""
    cells = [
        F.struct(
            F.lit(c).alias("channel"),
            F.coalesce(F.col(c + CLICKS).cast("double"), F.lit(0.0)).alias("media"),
            F.coalesce(F.col(c + SPEND).cast("double"), F.lit(0.0)).alias("spend"),
        )
        for c in paired_channels(df)
    ]
    long = df.select(F.col(geo).alias("geo"), F.col(day).alias("day"), F.explode(F.array(*cells)).alias("m"))
    return long.select("geo", "day", "m.channel", "m.media", "m.spend")


def avg_price(df: DataFrame) -> DataFrame:
    """Net revenue per purchase."""
    net = F.col("ALL_PURCHASES_ORIGINAL_PRICE") - F.col("ALL_PURCHASES_GROSS_DISCOUNT")
    return df.agg(safe_ratio(coalesced_sum(net), F.sum("ALL_PURCHASES")).alias("avg_price"))

