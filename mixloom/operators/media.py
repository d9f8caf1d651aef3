"""Media response: adstock, saturation, contributions, returns, response curves, what-if.

``media`` tables are long: geo, day, channel, media, spend. ``draws`` tables hold one
row per draw, geo and channel with beta, alpha, ec and slope. Draws share few settings
(alpha, ec, slope), so the earlier days of a row are looked up once, carried over and
saturated once per setting, summed over days where the days are not wanted, and only
then joined to the draws.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.functions.scalars import hill, safe_ratio
from mixloom.operators.keys import missing_keys
from mixloom.operators.ordering import exact_quantiles

# Fixed values of the published analysis.
MAX_LAG = 8
INTERVAL = (0.025, 0.5, 0.975)
SETTING = ("alpha", "ec", "slope")
STRETCH = 1024  # days of a series that one task looks at


def scale_media(media: DataFrame, channels) -> DataFrame:
    """Media over the channel's median of non-zero values, as ``scaled``."""
    wide = media.select(
        *[F.when((F.col("channel") == c) & (F.col("media") > 0), F.col("media")).alias(f"c{i}") for i, c in enumerate(channels)]
    )
    medians = exact_quantiles(wide, wide.columns, [0.5])
    rows = [(c, medians[f"c{i}"][0]) for i, c in enumerate(channels)]
    table = media.sparkSession.createDataFrame(rows, "channel string, media_unit double")
    joined = media.join(F.broadcast(table), "channel")
    return joined.withColumn("scaled", safe_ratio("media", "media_unit", 0.0))


def with_lags(
    media: DataFrame, value: str = "scaled", max_lag: int = MAX_LAG, keys=("geo", "channel"), step: int = 1, stretch: int = STRETCH
) -> DataFrame:
    """Media with ``_lags``: the value of the row and of each of the ``max_lag`` steps before, 0 where there is none.

    A step is ``step`` days; ``day`` is a date, a timestamp or a number. The calendar is cut into stretches of
    ``stretch`` steps, and the last ``max_lag`` steps of a stretch go along with the next one, so a series runs
    in as many tasks as it has stretches and ``stretch`` does not change the result. Rows without a day have no
    earlier steps; rows of one day keep their own value and carry over their sum.
    """
    kind = media.schema["day"].dataType.typeName()
    days = {"date": F.unix_date("day"), "timestamp": F.floor(F.unix_seconds(F.col("day").cast("timestamp")) / 86400)}
    number = F.floor(days.get("timestamp" if kind.startswith("timestamp") else kind, F.col("day")) / step)
    own = F.floor(F.col("_step") / stretch)
    halo = F.sequence(own, F.floor((F.col("_step") + max_lag) / stretch))
    cut = media.withColumn("_step", number).withColumn("_stretch", F.explode_outer(halo))
    order = Window.partitionBy(*keys, "_stretch").orderBy("_step")
    before = [F.when(F.col("_step").isNotNull(), F.sum(value).over(order.rangeBetween(-k, -k))) for k in range(1, max_lag + 1)]
    lags = F.array(*[F.coalesce(x, F.lit(0.0)) for x in (F.col(value), *before)])
    return cut.withColumn("_lags", lags).filter(F.col("_stretch").eqNullSafe(own)).drop("_step", "_stretch")


def adstock(alpha: Column, max_lag: int = MAX_LAG) -> Column:
    """Normalised geometric carry-over of the ``_lags`` of a row."""
    weights = [F.lit(1.0), *[F.pow(alpha, F.lit(float(k))) for k in range(1, max_lag + 1)]]
    weighted = reduce(lambda a, b: a + b, [w * F.col("_lags")[k] for k, w in enumerate(weights)])
    return weighted / reduce(lambda a, b: a + b, weights)


def settings_of(draws: DataFrame) -> DataFrame:
    """The distinct response settings of the draws."""
    return draws.select("geo", "channel", *SETTING).distinct()


def carry_over(media: DataFrame, settings: DataFrame, value: str = "scaled", max_lag: int = MAX_LAG) -> DataFrame:
    """Adstocked media per geo, channel and distinct setting."""
    keys = [c for c in ("geo", "channel") if c in settings.columns]
    joined = with_lags(media, value, max_lag).join(settings, keys)
    return joined.withColumn("adstocked", adstock(F.col("alpha"), max_lag)).drop("_lags")


def saturate(carried: DataFrame, multiplier=None) -> DataFrame:
    """Hill saturation of the adstocked media; a multiplier scales the media, which is linear in adstock."""
    level = F.col("adstocked") if multiplier is None else F.col("adstocked") * multiplier
    return carried.withColumn("response", hill(level, "ec", "slope"))


def contributions(draws: DataFrame, media: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """Contribution per draw, geo, day and channel."""
    response = saturate(carry_over(media, settings_of(draws), max_lag=max_lag))
    joined = response.join(draws, ["geo", "channel", *SETTING])
    return joined.select("draw", "geo", "day", "channel", (F.col("beta") * F.col("response")).alias("contribution"))


def interval(column: str, prefix: str = "") -> list[Column]:
    """Aggregates: median and 95 % bounds over the draws of a group.

    A group holds one value per draw; the number of draws is a setting of the fit.
    """
    q = F.percentile(F.col(column), F.array(*[F.lit(p) for p in INTERVAL]))
    names = (f"{prefix}low", f"{prefix}median", f"{prefix}high")
    return [F.element_at(q, i + 1).alias(n) for i, n in enumerate(names)]


def posterior_interval(draws: DataFrame, keys, value: str) -> DataFrame:
    """Median and 95 % interval of ``value`` per key over all draws."""
    return draws.groupBy(*keys).agg(*interval(value))


def contribution_intervals(parts: DataFrame) -> DataFrame:
    return posterior_interval(parts, ["geo", "day", "channel"], "contribution")


def expected_outcome(parts: DataFrame, intercepts: DataFrame) -> DataFrame:
    """Expected outcome per draw, geo and day: intercept plus all contributions."""
    summed = parts.groupBy("draw", "geo", "day").agg(F.sum("contribution").alias("media_total"))
    joined = summed.join(intercepts, ["draw", "geo"])
    return joined.select(
        "draw",
        "geo",
        "day",
        "media_total",
        (F.col("intercept") + F.col("media_total")).alias("expected"),
        F.col("intercept").alias("baseline"),
    )


def outcome_medians(expected: DataFrame) -> DataFrame:
    """Median expected outcome, media total and true baseline per geo and day."""
    def mid(c):
        return F.percentile(F.col(c), F.lit(0.5)).alias(f"{c}_median")

    return expected.groupBy("geo", "day").agg(
        mid("expected"), mid("media_total"), F.percentile(F.col("expected") - F.col("media_total"), F.lit(0.5)).alias("baseline_median")
    )


def geo_slice(df: DataFrame, geo: str) -> DataFrame:
    return df.filter(F.col("geo") == geo)


def mean_abs_contribution(medians: DataFrame) -> DataFrame:
    """Importance: mean absolute median contribution per geo and channel."""
    return medians.groupBy("geo", "channel").agg(F.avg(F.abs("median")).alias("importance"))


def credible_interval_table(medians: DataFrame) -> DataFrame:
    """Time means of median and bounds, and the width between the bounds."""
    return medians.groupBy("geo", "channel").agg(
        F.avg("median").alias("median"),
        F.avg("low").alias("ci_low"),
        F.avg("high").alias("ci_high"),
        (F.avg("high") - F.avg("low")).alias("ci_width"),
    )


def dependence(medians: DataFrame, media: DataFrame) -> DataFrame:
    """Media against contribution per day, with the contribution scaled to 0..1 within the series."""
    bounds = medians.groupBy("geo", "channel").agg(F.min("median").alias("_lo"), F.max("median").alias("_hi"))
    joined = medians.join(media.select("geo", "day", "channel", "media"), ["geo", "day", "channel"])
    scaled = (F.col("median") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1e-9))
    return joined.join(bounds, ["geo", "channel"]).select(
        "geo", "day", "channel", "media", F.col("median").alias("contribution"), scaled.alias("scaled_contribution")
    )


def _draw_totals(draws: DataFrame, media: DataFrame, levels: dict, keys) -> DataFrame:
    """Outcome per draw and key for several media levels, from one pass over the media.

    ``levels`` maps an output name to the factor on the media of a row.
    """
    carried = carry_over(media, settings_of(draws))
    per_setting = carried.groupBy("geo", "channel", *SETTING).agg(
        *[F.sum(hill(F.col("adstocked") * m, "ec", "slope")).alias(f"_{n}") for n, m in levels.items()]
    )
    joined = per_setting.join(draws, ["geo", "channel", *SETTING])
    return joined.groupBy("draw", *keys).agg(*[F.sum(F.col("beta") * F.col(f"_{n}")).alias(n) for n in levels])


def channel_spend(media: DataFrame) -> DataFrame:
    return media.groupBy("channel").agg(F.sum("spend").alias("spend_total"))


def return_table(draws: DataFrame, media: DataFrame, kind: str = "roi", bump: float = 0.01) -> DataFrame:
    """Median and interval per channel of ROI, or of the marginal ROI at a small bump."""
    if kind not in ("roi", "mroi"):
        raise ValueError("kind must be 'roi' or 'mroi'")
    levels = {"base": F.lit(1.0)}
    if kind == "mroi":
        levels["bumped"] = F.lit(1.0 + bump)
    totals = _draw_totals(draws, media, levels, ["channel"]).join(channel_spend(media), "channel")
    gained = F.col("base") if kind == "roi" else F.col("bumped") - F.col("base")
    spent = F.col("spend_total") if kind == "roi" else F.col("spend_total") * F.lit(bump)
    ratios = totals.select("draw", "channel", safe_ratio(gained, spent).alias("ratio"))
    return ratios.groupBy("channel").agg(*interval("ratio", f"{kind}_"))


def response_curve(draws: DataFrame, media: DataFrame, multipliers) -> DataFrame:
    """Outcome per channel over a grid of spend multipliers: mean, median and interval."""
    multipliers = [float(m) for m in multipliers]
    # One sum per grid point beside each other: rows are read once and never multiplied by the grid.
    sums = [F.sum(hill(F.col("adstocked") * F.lit(m), "ec", "slope")).alias(f"_r{i}") for i, m in enumerate(multipliers)]
    per_setting = carry_over(media, settings_of(draws)).groupBy("geo", "channel", *SETTING).agg(*sums)
    outcomes = [F.sum(F.col("beta") * F.col(f"_r{i}")).alias(f"_r{i}") for i in range(len(multipliers))]
    points = [F.struct(F.lit(m).alias("multiplier"), F.col(f"_r{i}").alias("outcome")) for i, m in enumerate(multipliers)]
    per_draw = (
        per_setting.join(draws, ["geo", "channel", *SETTING])
        .groupBy("draw", "channel")
        .agg(*outcomes)
        .select("draw", "channel", F.explode(F.array(*points)).alias("_point"))
        .select("draw", "channel", "_point.*")
    )
    curve = per_draw.groupBy("channel", "multiplier").agg(F.avg("outcome").alias("mean"), *interval("outcome"))
    spent = curve.join(channel_spend(media), "channel")
    return spent.withColumn("spend", F.col("spend_total") * F.col("multiplier")).drop("spend_total")


def multiplier_table(media: DataFrame, multipliers) -> DataFrame:
    """Factor per channel, 1 where none is given; unknown channels are an error."""
    channels = media.select("channel").distinct()
    if isinstance(multipliers, dict):
        multipliers = media.sparkSession.createDataFrame(
            [(c, float(m)) for c, m in multipliers.items()], "channel string, multiplier double"
        )
        unknown = [r[0] for r in missing_keys(multipliers, channels, "channel").collect()]
        if unknown:
            raise ValueError(f"channels not in the media table: {unknown}")
    joined = channels.join(multipliers.select("channel", "multiplier"), "channel", "left")
    return joined.select("channel", F.coalesce("multiplier", F.lit(1.0)).alias("multiplier"))


def apply_multipliers(media: DataFrame, multipliers) -> DataFrame:
    """Media and spend scaled per channel."""
    table = multiplier_table(media, multipliers)
    scaled = [c for c in ("media", "spend", "scaled") if c in media.columns]
    joined = media.join(F.broadcast(table), "channel")
    return joined.withColumns({c: F.col(c) * F.col("multiplier") for c in scaled}).drop("multiplier").select(*media.columns)


def what_if(draws: DataFrame, media: DataFrame, multipliers, name: str, channels) -> DataFrame:
    """Baseline and scenario outcome with 95 % intervals, their difference, and the factors used."""
    table = multiplier_table(media, multipliers)
    with_factor = media.join(F.broadcast(table), "channel")
    levels = {"base": F.lit(1.0), "scenario": F.col("multiplier")}
    carried = carry_over(with_factor, settings_of(draws))
    per_setting = carried.groupBy("geo", "channel", *SETTING).agg(
        *[F.sum(hill(F.col("adstocked") * m, "ec", "slope")).alias(f"_{n}") for n, m in levels.items()]
    )
    totals = (
        per_setting.join(draws, ["geo", "channel", *SETTING])
        .groupBy("draw")
        .agg(*[F.sum(F.col("beta") * F.col(f"_{n}")).alias(n) for n in levels])
    )
    result = totals.agg(*interval("base", "baseline_"), *interval("scenario", "scenario_"))
    factors = table.agg(*[F.max(F.when(F.col("channel") == c, F.col("multiplier"))).alias(f"mult_{c}") for c in channels])
    delta = F.col("scenario_median") - F.col("baseline_median")
    return (
        result.withColumns(
            {
                "scenario_name": F.lit(name),
                "delta_abs": delta,
                "delta_pct": safe_ratio(delta, "baseline_median") * F.lit(100.0),
            }
        )
        .crossJoin(F.broadcast(factors))
    )
