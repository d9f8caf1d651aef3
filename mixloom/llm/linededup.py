"""Line dedup: maximal runs of lines that occur earlier in the corpus, by a suffix array of line IDs.

Every line with a word gets a number; a document is the sequence of its line numbers. Prefix
doubling names all windows of 1, 2, 4, ... lines that occur at least twice: a window of 2w lines is
named by the names of its halves, and names keep the sort order of what they stand for, so the last
ones rank the suffixes. From the longest windows downwards, suffixes are then gathered in
longest-common-prefix intervals: an interval is known by its length and its earliest suffix, and
each step splits it by the name of the next window. A suffix whose longest interval has an earlier
member starts a maximal repeated run. Runs with enough words are deleted; the earliest copy stays.

Only names, counts and positions move between tasks, never text, and windows that occur once leave
the work at once. Keys that hold many rows only meet in aggregates, which combine on the map side,
and in joins to one row per key, which adaptive execution splits.

Defined cases: documents are ordered by doc_id (nulls first), then by text hash; rows that share
both are one document and get the same result. A null or empty text has no lines and stays as it
is. Lines without a word belong to no run and go with the deleted lines around them. A document of
which nothing is left gets an empty text and is marked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
DOC = ["_l_id", "_l_hash"]


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_l_id": F.col("doc_id"), "_l_hash": F.xxhash64("text")})


def _numbered_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per line with a word: position ``p`` in the corpus, two hashes, words, lines left in the document.

    Positions follow the document order, and the lines of a document have consecutive ones.
    """

    def line(text: Column, at: Column) -> Column:
        return F.struct(
            at.alias("line"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(F.lit(1), text).alias("h2"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        )

    order = [F.col(c).asc_nulls_first() for c in DOC]
    lines = F.filter(F.transform(F.split("text", "\n"), line), lambda x: x["words"] > 0)
    # Written first: dealing out by range reads its input twice, and only the texts are large.
    hashed = _with_key(docs.filter("text is not null").select("doc_id", "text")).select(*DOC, lines.alias("lines"))
    hashed = scratch.keep(hashed.filter(F.size("lines") > 0))
    return (
        hashed.repartitionByRange(*order)
        .withColumn("_copy", F.row_number().over(Window.partitionBy(*DOC).orderBy(*order)))
        .filter("_copy = 1")
        .sortWithinPartitions(*order)
        .select(*DOC, F.size("lines").alias("n"), F.posexplode("lines").alias("at", "x"))
        .withColumn("p", F.monotonically_increasing_id())
        .select("p", *DOC, (F.col("n") - F.col("at")).alias("rest"), "x.line", "x.h1", "x.h2", "x.words")
    )


def _named(windows: DataFrame, left: str, right: str) -> DataFrame:
    """``windows`` whose (left, right) occurs twice or more, with a name that sorts like the pair."""
    names = (
        windows.groupBy(left, right)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .repartitionByRange(left, right)
        .sortWithinPartitions(left, right)
        .select(left, right, F.monotonically_increasing_id().alias("name"))
    )
    return windows.join(names, [left, right]).select("p", "name", "words", "rest")


def _repeated_windows(lines: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """Prefix doubling: per level k the repeated windows of 2^k lines, with position, name and words."""
    levels, level = [], scratch.keep(_named(lines, "h1", "h2"))
    while not level.isEmpty():
        levels.append(level)
        width = 1 << (len(levels) - 1)
        first = level.filter(F.col("rest") >= 2 * width).withColumnRenamed("name", "a")
        second = level.select((F.col("p") - width).alias("p"), F.col("name").alias("b"), F.col("words").alias("more"))
        pairs = first.join(second, "p").select("p", "a", "b", (F.col("words") + F.col("more")).alias("words"), "rest")
        level = scratch.keep(_named(pairs, "a", "b"))
    return levels


def _intervals(levels: list[DataFrame], scratch: Scratch) -> DataFrame:
    """Per repeated suffix ``p`` its longest common prefix with an earlier suffix: ``p``, lines, words.

    A row says that suffix ``p`` belongs to the interval of the suffixes that share ``len`` lines
    with ``first``. The step of level k moves the members that go on alike for 2^k lines to an
    interval of their own; its earliest member also stays behind, to stand for them there.
    """
    rows = levels[0].select(
        F.lit(-1).cast("long").alias("first"), F.lit(0).alias("len"), F.lit(0).alias("sum"), "p", "rest"
    )
    group, held = ["first", "len", "name"], None
    for k in reversed(range(len(levels))):
        width = 1 << k
        windows = levels[k].select(F.col("p").alias("at"), "name", F.col("words").alias("more"))
        probe = scratch.keep(
            rows.withColumn("at", F.when(F.col("len") + width <= F.col("rest"), F.col("p") + F.col("len")).otherwise(-F.col("p") - 2))
            .join(windows, "at", "left")
            .drop("at")
        )
        met = probe.filter("name is not null")
        # Written, so that the join to it stands alone and a hot group in it can be split.
        sizes = scratch.keep(met.groupBy(*group).agg(F.min("p").alias("lead"), F.count(F.lit(1)).alias("n")))
        stay = F.struct("first", "len", "sum")
        move = F.struct(
            F.col("lead").alias("first"), (F.col("len") + width).alias("len"), (F.col("sum") + F.col("more")).alias("sum")
        )
        where = (
            F.when(F.col("n") == 1, F.array(stay))
            .when(F.col("p") == F.col("lead"), F.array(stay, move))
            .otherwise(F.array(move))
        )
        split = met.join(sizes, group).select(F.explode(where).alias("x"), "p", "rest").select("x.*", "p", "rest")
        rows = scratch.keep(split.unionByName(probe.filter("name is null").select(*split.columns)))
        scratch.drop(probe, sizes, *([held] if held is not None else []))
        held = rows
    longest = F.max(F.struct("len", "sum")).alias("x")
    return rows.filter("first >= 0 and first < p").groupBy("p").agg(longest).select("p", "x.len", F.col("x.sum").alias("words"))


def repeated_runs(docs: DataFrame, scratch: Scratch, min_words: int = 5) -> DataFrame:
    """Runs of lines to delete: document key, first and last line (0-based, inclusive); runs of a document are disjoint."""
    lines = scratch.keep(_numbered_lines(docs, scratch))
    levels = _repeated_windows(lines, scratch)
    place = lines.select("p", *DOC, "line")
    if not levels:
        return place.select(*DOC, F.col("line").alias("from"), F.col("line").alias("to")).limit(0)
    runs = _intervals(levels, scratch).filter(F.col("words") >= min_words).select("p", (F.col("p") + F.col("len")).alias("end"))
    in_doc = Window.partitionBy(*DOC).orderBy("p")
    before = in_doc.rowsBetween(Window.unboundedPreceding, -1)
    merged = (
        runs.join(place.drop("line"), "p")
        .withColumn("fresh", F.coalesce(F.col("p") > F.max("end").over(before), F.lit(True)).cast("int"))
        .withColumn("run", F.sum("fresh").over(in_doc))
        .groupBy(*DOC, "run")
        .agg(F.min("p").alias("p"), (F.max("end") - 1).alias("last"))
    )
    at = place.select("p", F.col("line").alias("from"))
    to = place.select(F.col("p").alias("last"), F.col("line").alias("to"))
    return merged.join(at, "p").join(to, "last").select(*DOC, "from", "to")


def dedup_lines(docs: DataFrame, scratch: Scratch, min_words: int = 5) -> DataFrame:
    """``docs`` without the later copies of repeated runs of at least ``min_words`` words.

    Adds ``_l_lines`` and ``_l_deleted`` (lines before and deleted), ``_l_runs`` (deleted from-to
    spans) and ``_l_emptied`` (the text had words and has none left).
    """
    runs = (
        repeated_runs(docs, scratch, min_words)
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("_l_runs"))
        .withColumnsRenamed({c: f"r{c}" for c in DOC})
    )
    clash = [c for c in docs.columns if c.lower().startswith("_l_")]
    keyed = _with_key(docs.drop(*clash))
    same = F.col("_l_id").eqNullSafe(F.col("r_l_id")) & (F.col("_l_hash") == F.col("r_l_hash"))
    none = F.array().cast("array<struct<from:int,to:int>>")
    joined = keyed.join(runs, same, "left").withColumn("_l_runs", F.coalesce("_l_runs", none)).drop(*DOC, "r_l_id", "r_l_hash")
    cut = F.col("_l_runs")
    lines = F.split("text", "\n")
    # Kept stretches lie between the deleted runs.
    starts = F.concat(F.array(F.lit(0)), F.transform(cut, lambda r: r["to"] + 1))
    stops = F.concat(F.transform(cut, lambda r: r["from"]), F.array(F.size(lines)))
    kept = F.flatten(F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda s: F.slice(lines, s["a"] + 1, s["b"] - s["a"])))
    text = F.when(F.size(cut) == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    deleted = F.aggregate(cut, F.lit(0), lambda n, r: n + r["to"] - r["from"] + 1)
    return (
        joined.withColumns({"_l_lines": F.coalesce(F.size(lines), F.lit(0)), "_l_deleted": deleted, "_l_text": text})
        .withColumn("_l_emptied", (F.col("_l_deleted") > 0) & ~F.col("_l_text").rlike(WORD))
        .withColumn("text", F.when(F.col("_l_emptied"), F.lit("")).otherwise(F.col("_l_text")))
        .drop("_l_text")
    )
