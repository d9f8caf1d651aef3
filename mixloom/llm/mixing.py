"""Mixing sources to target weights: temperature, entropy or repetition target, block permutations.

Source weights are token shares raised to an exponent and normalised. The exponent is bisected: the
entropy of the weights and the largest number of repetitions both fall as it grows. The weights are
realised as whole passes over a source plus a partial one. Each pass is a permutation of blocks of
documents; the partial pass takes the documents in front of the token budget.

A block, and a document in it, has its place by a hash, so the partial pass is three values per
source: the key of the block that holds the limit, and the key in it up to which documents fit. They
come from block totals and from that one block. Whether a document is taken, and how often, is then
decided where it is read; texts are never shuffled, whatever the share of a source.

Defined cases: documents without source form a source of their own; documents without a word (or
with a null text) have no tokens and are left out, as is a source that only has such documents;
repeated rows have the same place and are taken or left together; an empty table stays empty. A target
that no exponent up to the largest one meets is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SECTIONS = 32
MAX_EXPONENT = 1.0  # 0 makes all sources equal, 1 keeps the shares as they are, more sharpens them
BROADCAST_SOURCES = 10_000  # a source has one row of about 100 bytes


def _place(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def _measures(stats: DataFrame, exponents: list[float], budget_share: float) -> list[tuple[float, float, float]]:
    """Exponent, entropy over its maximum, and most repetitions, for a few exponents in one aggregate."""
    p, x = F.col("share"), F.col("x")
    rows = (
        stats.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("x"))
        .groupBy("x")
        .agg(
            F.sum(F.pow(p, x)).alias("z"),
            F.sum(F.pow(p, x) * F.log(p)).alias("s"),
            F.max(F.pow(p, x - 1)).alias("most"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("x", (F.log("z") - x * F.col("s") / F.col("z")).alias("h"), F.log("n").alias("top"), (F.col("most") / F.col("z") * budget_share).alias("r"))
        .collect()
    )
    return sorted((r["x"], 1.0 if r["top"] == 0 else r["h"] / r["top"], r["r"]) for r in rows)


def _bisect(stats: DataFrame, budget_share: float, met, largest: float, digits: int = 6) -> float:
    """Smallest exponent in [0, ``largest``] from which on ``met(entropy, repetitions)`` holds, rounded up; ``largest`` if none does.

    Each step looks at several exponents at once and keeps the section where the answer changes.
    """
    low, high = 0.0, largest
    while high - low > 0.01 * 10**-digits:
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        rows = _measures(stats, grid, budget_share)
        holds = [i for i, (_, h, r) in enumerate(rows) if met(h, r)]
        first = holds[0] if holds else SECTIONS
        if first == 0:
            return low
        low, high = rows[first - 1][0], rows[first][0]
    scale = 10**digits
    return -(-round(high * scale, 1) // 1) / scale


def source_weights(
    sized: DataFrame,
    scratch: Scratch,
    target_entropy: float | None = 0.9,
    max_repetitions: float | None = 2.0,
    budget: int | None = None,
    max_exponent: float = MAX_EXPONENT,
) -> DataFrame:
    """Per source: tokens, exponent, weight, target tokens, whole passes and tokens of the partial pass.

    ``target_entropy`` is a share of the largest possible entropy: shares are evened out until the
    weights reach it, and left as they are if they do already. ``max_repetitions`` then raises the
    exponent until no source is repeated more often; with a ``max_exponent`` above 1 both may sharpen the
    shares. A repetition limit that stays out of reach is a ValueError, and so is an entropy that the
    sharpest shares allowed still exceed; without sharpening, such shares are even enough and stay.
    ``budget`` is the total number of tokens, by default as many as there are.
    """
    per_source = sized.groupBy("_m_source").agg(F.sum("_m_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    per_source = scratch.keep(per_source.filter("tokens > 0"))
    total = per_source.agg(F.sum("tokens")).first()[0]
    if not total:
        return per_source.select(
            "*", *[F.lit(0.0).alias(c) for c in ("exponent", "weight")], *[F.lit(0).cast("long").alias(c) for c in ("target", "passes", "rest")]
        )
    budget = total if budget is None else budget
    stats = per_source.withColumn("share", F.col("tokens") / F.lit(total))
    exponent = 0.0
    if target_entropy is not None:
        exponent = _bisect(stats, budget / total, lambda h, r: h <= target_entropy, max_exponent)
    if max_repetitions is not None:
        exponent = max(exponent, _bisect(stats, budget / total, lambda h, r: r <= max_repetitions, max_exponent))
    (_, entropy, repetitions) = _measures(stats, [exponent], budget / total)[0]
    if max_repetitions is not None and repetitions > max_repetitions + 1e-4:
        raise ValueError(f"some source is repeated {repetitions:.3f} times with exponent {exponent}; the limit is {max_repetitions}")
    if target_entropy is not None and max_exponent > 1 and entropy > target_entropy + 1e-4:
        raise ValueError(f"entropy is {entropy:.6f} with exponent {exponent}; the target is {target_entropy}")
    z = stats.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0]
    return (
        stats.withColumn("exponent", F.lit(exponent))
        .withColumn("weight", F.pow("share", F.lit(exponent)) / F.lit(z))
        .withColumn("target", F.round(F.col("weight") * budget).cast("long"))
        .withColumn("passes", F.floor(F.col("target") / F.col("tokens")))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("tokens"))
        .drop("share")
    )


def mix_sources(
    docs: DataFrame,
    scratch: Scratch,
    target_entropy: float | None = 0.9,
    max_repetitions: float | None = 2.0,
    budget: int | None = None,
    block_docs: int = 1024,
    seed: str = "mix",
    max_exponent: float = MAX_EXPONENT,
) -> DataFrame:
    """The documents of the mixture, repeated as often as they are taken.

    Adds ``_m_tokens``, ``_m_pass`` (from 1), ``_m_weight``, ``_m_exponent``, and ``_m_block`` and
    ``_m_place``, by which the permutation of a pass is sorted.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower().startswith("_m_")])
    sized = docs.withColumns(
        {
            "_m_source": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
            "_m_tokens": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        }
    )
    light = scratch.keep(sized.filter("_m_tokens > 0").select("doc_id", "_m_source", "_m_tokens"))
    weights = source_weights(light, scratch, target_entropy, max_repetitions, budget, max_exponent)
    # Hexadecimal digits of a block: as many as keep blocks small.
    digits = F.greatest(F.lit(0), F.ceil(F.log(F.col("docs") / block_docs) / F.log(F.lit(16.0)))).cast("int")
    weights = scratch.keep(weights.withColumn("digits", digits))
    few = weights.count() <= BROADCAST_SOURCES
    lookup = (lambda t: F.broadcast(t)) if few else (lambda t: t)

    def placed(rows: DataFrame, turn: Column) -> DataFrame:
        """With the keys of block and document in pass ``turn``."""
        name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
        block = F.expr(f"substring(md5(cast(concat_ws('|', '{seed}', coalesce(cast(doc_id AS string), 'null')) AS binary)), 1, digits)")
        return rows.withColumn("_b", block).withColumns(
            {
                "_m_block": _place(F.lit(seed), turn.cast("string"), "_m_source", "_b"),
                "_m_place": _place(F.lit(seed), turn.cast("string"), "_m_source", name),
            }
        )

    # The partial pass: the block that holds the limit, then the place in it.
    last = (F.col("passes") + 1).cast("long")
    partial = placed(light.join(lookup(weights.filter("rest > 0")), "_m_source"), last)
    blocks = partial.groupBy("_m_source", "_m_block").agg(F.sum("_m_tokens").alias("sum"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("_m_source").orderBy("_m_block")
    cut = scratch.keep(
        blocks.withColumn("end", F.sum("sum").over(upto))
        .filter("end > rest and end - sum <= rest")
        .groupBy("_m_source")
        .agg(F.min(F.struct("_m_block", (F.col("rest") - F.col("end") + F.col("sum")).alias("left"))).alias("x"))
        .select("_m_source", F.col("x._m_block").alias("cut_block"), F.col("x.left").alias("left"))
    )
    inside = partial.join(lookup(cut), "_m_source").filter("_m_block = cut_block")
    # Ordered by range, so that equal places share one running total.
    running = Window.partitionBy("_m_source").orderBy("_m_place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    place = inside.withColumn("end", F.sum("_m_tokens").over(running)).filter("end <= left").groupBy("_m_source").agg(F.max("_m_place").alias("cut_place"))
    plan = weights.join(cut.drop("left"), "_m_source", "left").join(place, "_m_source", "left")
    plan = scratch.keep(plan.select("_m_source", "exponent", "weight", "passes", "rest", "digits", "cut_block", "cut_place"))

    rows = placed(sized.filter("_m_tokens > 0").join(lookup(plan), "_m_source"), last)
    before = (F.col("_m_block") < F.col("cut_block")) | F.col("cut_block").isNull()
    within = (F.col("_m_block") == F.col("cut_block")) & (F.col("_m_place") <= F.col("cut_place"))
    extra = F.coalesce((F.col("rest") > 0) & (before | within), F.lit(False)).cast("long")
    turns = F.when(F.col("passes") + extra > 0, F.sequence(F.lit(1).cast("long"), F.col("passes") + extra))
    taken = rows.withColumn("_m_pass", F.explode(turns))
    return placed(taken.drop("_m_block", "_m_place", "_b"), F.col("_m_pass")).select(
        *docs.columns,
        "_m_tokens",
        "_m_pass",
        "_m_block",
        "_m_place",
        F.round("weight", 12).alias("_m_weight"),
        F.col("exponent").alias("_m_exponent"),
    )
