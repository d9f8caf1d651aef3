"""Corpus pipeline: quality rules, line dedup, near-duplicates, mixing and packing over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixloom.llm.linededup import dedup_lines
from mixloom.llm.mixing import mix_sources
from mixloom.llm.neardup import near_duplicates
from mixloom.llm.packing import pack, tokenizer_path
from mixloom.llm.quality import quality_rules
from mixloom.llm.scratch import Scratch

#: Intermediate tables of the last stage that ran; they go when the next stage has its input.
_SCRATCH: list[Scratch] = []


def _fresh(spark: SparkSession) -> Scratch:
    """A scratch space for one stage. The stage before is written and reread by now, so its space is closed."""
    while _SCRATCH:
        _SCRATCH.pop().close()
    _SCRATCH.append(Scratch(spark))
    return _SCRATCH[0]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs, _fresh(spark)).filter("_q_kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; documents that consist of such copies only go."""
    return dedup_lines(docs, _fresh(spark)).filter("not _l_emptied").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: five-word shingles, similarity of 0.8 or more.

    Decided by row, under a written row number: rows that share a doc_id stay if their texts differ, and
    rows without one are compared like all others. The row with the smallest doc_id stays, of several the
    first. Rows without words are in no group and stay.
    """
    scratch = _fresh(spark)
    numbered = scratch.keep(docs.select(F.struct(*docs.columns).alias("_doc")).withColumn("_row", F.monotonically_increasing_id()))
    rows = numbered.select(F.col("_row").alias("doc_id"), F.col("_doc.text").alias("text"))
    groups = near_duplicates(rows, scratch).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    chosen = (
        groups.join(numbered.select("_row", F.col("_doc.doc_id").alias("doc_id")), "_row")
        .groupBy("_group")
        .agg(F.min(order)["_row"].alias("_row"))
    )
    return numbered.join(chosen, "_row", "left_semi").select("_doc.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mix_sources(docs, _fresh(spark)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows at the proportions of the mixture."""
    return pack(docs, _fresh(spark), tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]
#: Tokenising and the rank-based line dedup are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and reread as input of the next.

    The result reads tables of the last stage; it is to be written or collected before the next run.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    handed = Scratch(spark)
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = handed.keep(docs)
    return docs
