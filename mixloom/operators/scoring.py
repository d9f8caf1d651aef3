"""Customer scoring: bins, recency-frequency-monetary segments, descriptive value, tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.functions.scalars import equal_width_score, quantile_score, safe_ratio
from mixloom.operators.ordering import exact_quantiles
from mixloom.sources.staging import stage

# Fixed values of the published analysis.
CHURN_DAYS = 90
DAYS_PER_MONTH = 30
TIER_PROBS = (0.0, 0.20, 0.50, 0.80, 1.0)
TIERS = ("Bronze", "Silver", "Gold", "Platinum")


def snapshot(orders: DataFrame) -> DataFrame:
    """The day after the last order, one row."""
    return orders.agg(F.date_add(F.max("order_date"), 1).alias("snapshot_date"))


def rfm_raw(orders: DataFrame) -> DataFrame:
    """Recency in days, number of orders and net revenue per customer.

    Customers are aggregated first; the snapshot date then comes from the small
    result, so the orders are read once.
    """
    per_customer = stage(
        orders.groupBy("customer_id").agg(
            F.max("order_date").alias("last_order"),
            F.count("order_id").alias("frequency"),
            F.sum("net_revenue_usd").alias("monetary"),
            F.min("signup_date").alias("signup_date"),
        )
    )
    snap = per_customer.agg(F.date_add(F.max("last_order"), 1).alias("snapshot_date"))
    return per_customer.crossJoin(F.broadcast(snap)).select(
        "customer_id",
        F.datediff("snapshot_date", "last_order").alias("recency"),
        "frequency",
        "monetary",
        "signup_date",
        "snapshot_date",
    )


def bin_edges(df: DataFrame, columns, probs) -> dict[str, list[float]]:
    """Quantile edges per column. ``df`` is read more than once and should be staged."""
    return exact_quantiles(df, columns, probs)


def quantile_bins(df: DataFrame, column: str, bins: int, out: str) -> DataFrame:
    """Value bins on exact quantiles."""
    probs = [i / bins for i in range(bins + 1)]
    return df.withColumn(out, quantile_score(column, bin_edges(df, [column], probs)[column]))


def equal_width_bins(df: DataFrame, column: str, bins: int, out: str) -> DataFrame:
    """Bins of equal width over the observed range."""
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return df.withColumn(out, equal_width_score(column, row["lo"] or 0.0, row["hi"] or 0.0, bins))


def score_columns(df: DataFrame, specs: dict, bins: int) -> dict[str, tuple[Column, str]]:
    """Score of each column and the path taken: quantile edges, or equal width if an edge repeats.

    ``specs`` maps a column to True where small values score high.
    """
    probs = [i / bins for i in range(bins + 1)]
    edges = bin_edges(df, list(specs), probs)
    scores = {}
    for column, descending in specs.items():
        e = edges[column]
        if len(set(e)) == len(e):
            scores[column] = (quantile_score(column, e, descending), "quantile")
        else:
            scores[column] = (equal_width_score(column, e[0], e[-1], bins, descending), "equal_width")
    return scores


def assign_score(df: DataFrame, column: str, bins: int, out: str, ascending: bool = True) -> DataFrame:
    """One score column with the path it took."""
    score, path = score_columns(df, {column: not ascending}, bins)[column]
    return df.withColumns({out: score, f"{out}_path": F.lit(path)})


def rfm(raw: DataFrame, bins: int = 5) -> DataFrame:
    """R, F and M digits, the segment text and their mean score.

    ``raw`` is read twice, for the edges and for the scores; ``rfm_raw`` returns a staged table.
    """
    scores = score_columns(raw, {"recency": True, "frequency": False, "monetary": False}, bins)
    r, f, m = (scores[c][0] for c in ("recency", "frequency", "monetary"))
    digits = raw.withColumns({"r_score": r, "f_score": f, "m_score": m})
    return digits.withColumns(
        {
            "rfm_segment": F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
            "rfm_score": F.round((F.col("r_score") + F.col("f_score") + F.col("m_score")) / F.lit(3.0), 2),
            "rfm_number": F.col("r_score") * 100 + F.col("f_score") * 10 + F.col("m_score"),
        }
    )


def segment_mapping(scored: DataFrame, min_size: int) -> DataFrame:
    """Each small segment with the large segment that replaces it.

    Works on segment counts only, at most bins^3 rows: nearest by Euclidean distance
    of the digits, large segments of the same R digit first, ties to the larger.
    """
    counts = scored.groupBy("rfm_segment", "r_score", "f_score", "m_score").agg(F.count(F.lit(1)).alias("n"))
    small = counts.filter(F.col("n") < min_size).alias("s")
    large = counts.filter(F.col("n") >= min_size).alias("l")
    distance = F.sqrt(
        sum((F.pow(F.col(f"s.{c}") - F.col(f"l.{c}"), 2) for c in ("r_score", "f_score", "m_score")), F.lit(0.0))
    )
    pairs = small.crossJoin(F.broadcast(large)).select(
        F.col("s.rfm_segment").alias("rfm_segment"),
        F.col("s.n").alias("n_customers"),
        F.col("l.rfm_segment").alias("target_segment"),
        (F.col("s.r_score") == F.col("l.r_score")).cast("int").alias("same_r"),
        distance.alias("distance"),
        F.col("l.n").alias("target_n"),
    )
    order = F.struct(-F.col("same_r"), F.col("distance"), -F.col("target_n"), F.col("target_segment"))
    return pairs.groupBy("rfm_segment", "n_customers").agg(
        F.min_by("target_segment", order).alias("target_segment"), F.min_by("distance", order).alias("distance")
    )


def prune_segments(scored: DataFrame, min_size: int = 100) -> DataFrame:
    """Move customers of small segments; without any large segment all keep theirs."""
    mapping = segment_mapping(scored, min_size).select("rfm_segment", "target_segment")
    joined = scored.join(F.broadcast(mapping), "rfm_segment", "left")
    return joined.withColumn("pruned_segment", F.coalesce("target_segment", "rfm_segment")).drop("target_segment")


def pruning_summary(pruned: DataFrame) -> DataFrame:
    """Segments before and after pruning and customers moved."""
    groups = pruned.groupBy("rfm_segment", "pruned_segment").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.count_distinct("rfm_segment").alias("segments_before"),
        F.count_distinct("pruned_segment").alias("segments_after"),
        F.sum(F.when(F.col("rfm_segment") != F.col("pruned_segment"), F.col("n")).otherwise(0)).alias(
            "customers_moved"
        ),
        F.sum("n").alias("n_customers"),
    )


def churn_rate(raw: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    """Share of customers whose last order is more than ``days`` ago."""
    churned = F.count_if(F.col("recency") > days)
    return raw.agg(
        F.count(F.lit(1)).alias("n_customers"),
        churned.alias("n_churned"),
        safe_ratio(churned, F.count(F.lit(1))).alias("churn_rate"),
    )


def clv_descriptive(raw: DataFrame, days: int = CHURN_DAYS, frequency_basis: str = "months") -> DataFrame:
    """Average purchase value, purchase frequency and value per month of each customer.

    ``frequency_basis`` "months" divides the orders by months since sign-up;
    "customers" divides them by the number of customers, as the written definition has it.
    """
    rate = churn_rate(raw, days).select("churn_rate", "n_customers")
    joined = raw.crossJoin(F.broadcast(rate))
    months = F.datediff("snapshot_date", "signup_date") / F.lit(float(DAYS_PER_MONTH))
    if frequency_basis not in ("months", "customers"):
        raise ValueError("frequency_basis must be 'months' or 'customers'")
    basis = F.col("active_months") if frequency_basis == "months" else F.col("n_customers")
    return (
        joined.withColumn("active_months", months)
        .withColumns({"apv": safe_ratio("monetary", "frequency"), "pf": safe_ratio("frequency", basis)})
        .withColumn("clv", safe_ratio(F.col("apv") * F.col("pf"), "churn_rate"))
        .select(
            "customer_id",
            "recency",
            "frequency",
            "monetary",
            "signup_date",
            "active_months",
            "apv",
            "pf",
            "clv",
        )
    )


def active_customers(clv: DataFrame, days: int = CHURN_DAYS) -> DataFrame:
    return clv.filter(F.col("recency") <= days)


def value_tiers(clv: DataFrame) -> DataFrame:
    """Bronze to Platinum by value quantiles, with a rank (1 = Platinum) for ordering."""
    edges = bin_edges(clv, ["clv"], TIER_PROBS)["clv"]
    if len(set(edges)) != len(edges):
        raise ValueError("tier edges repeat; the value column is too concentrated for the tiers")
    level = quantile_score("clv", edges)
    names = F.array(*[F.lit(t) for t in TIERS])
    return clv.withColumn("tier", F.element_at(names, level)).withColumn(
        "tier_rank", (F.lit(len(TIERS) + 1) - level).cast("int")
    )


def tier_summary(tiers: DataFrame) -> DataFrame:
    """Customers and mean metrics per tier."""
    metrics = ("recency", "frequency", "monetary", "apv", "pf", "clv")
    return tiers.groupBy("tier", "tier_rank").agg(
        F.count("customer_id").alias("customers"), *[F.round(F.avg(c), 2).alias(f"avg_{c}") for c in metrics]
    )


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """First ``k`` rows of a total order; Spark keeps ``k`` rows per task, no full sort."""
    return df.orderBy(*order).limit(k)

