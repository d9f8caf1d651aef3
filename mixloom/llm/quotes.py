"""Chat formatting: quoted passages are linked to the messages they come from, and left out.

A line's quote level is the number of ``>`` in front of it. Consecutive lines of one level without an
empty line form a passage; its words in lower case, joined by single spaces, are hashed. A quoted
passage is looked up among the passages and lines that earlier messages of the conversation wrote
themselves; the latest one counts. A message replies to the message that most of its
level-one passages come from (the latest, if several), or else to the message before it. Depths
follow by pointer doubling. The own lines remain as text.

The look-up takes hashes and turns only. It works on stretches of turns, so one conversation or one
phrase that is everywhere is spread over tasks; texts are not shuffled.

Defined cases: a null text is empty; a message whose conversation or turn is null, or that shares
both with another one, keeps its row: it is linked like any other, and rows that share conversation
and turn are one message (a reply to it is to that turn); an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.running import latest_before
from mixloom.llm.scratch import Scratch

MARKS = r"^(?:\x20{0,3}>)+"
#: A line that introduces a quote, as mail programs write it.
INTRODUCTION = r"^\s*(?:On\b.*\bwrote|Am\b.*\bschrieb\b.*|Le\b.*\ba écrit|El\b.*\bescribió)\s*:\s*$"
KEY = ["conv_id", "turn"]


def _lines(text: Column) -> Column:
    """Lines as structs of quote level, body and normalised words."""

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        body = F.substring(line, F.length(marks) + 1, F.length(line))
        return F.struct(level.alias("level"), body.alias("body"), normalised(body).alias("words"))

    return F.transform(F.split(text, "\n"), parsed)


def normalised(body: Column) -> Column:
    """Lower-case words joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(body), r"[\x20\x09-\x0D]+", " "))


def _passages(lines: Column) -> Column:
    """Passages of the lines: level, hash of the joined words and hashes of the lines, in order.

    ``lines`` must be a column that is there, not an expression: it is looked into line by line. Whether a line starts a passage depends on the line before it only, so passages are slices
    between starts.
    """
    n = F.size(lines)
    index = F.sequence(F.lit(0), n - 1)
    blank = lambda i: F.get(lines, i)["words"] == ""

    def starts(i: Column) -> Column:
        return (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]) | blank(i) | blank(i - 1)

    heads = F.filter(index, starts)
    bounds = F.arrays_zip(heads.alias("a"), F.concat(F.slice(heads, 2, F.size(heads)), F.array(n)).alias("b"))

    def passage(bound: Column) -> Column:
        part = F.slice(lines, bound["a"] + 1, bound["b"] - bound["a"])
        words = F.transform(part, lambda x: x["words"])
        return F.struct(
            F.get(lines, bound["a"])["level"].alias("level"),
            F.array_join(words, " ").alias("words"),
            F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"),
        )

    found = F.filter(F.transform(bounds, passage), lambda p: p["words"] != "")
    return F.transform(found, lambda p: F.struct(p["level"].alias("level"), F.xxhash64(p["words"]).alias("hash"), p["hashes"].alias("hashes")))


def _own_text(lines: Column) -> Column:
    """Lines of level 0, without introductions of a quote; empty lines at the ends go."""
    n = F.size(lines)

    def keep(line: Column, i: Column) -> Column:
        introduces = line["body"].rlike(INTRODUCTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
        return (line["level"] == 0) & ~introduces & (i < n)

    kept = F.transform(F.filter(lines, keep), lambda x: x["body"])
    return F.regexp_replace(F.array_join(kept, "\n"), r"^\s*\n|\s+$", "")


def link_quotes(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """Per row of ``messages``: its columns with ``text`` without quotes, and what it replies to.

    Adds ``_c_reply_to`` (turn), ``_c_by_quote`` (whether a quote says so), ``_c_depth`` (messages above it),
    ``_c_passages`` (quoted) and ``_c_linked`` (of these, found in an earlier message). In order of
    conversation, depth and turn every message follows the one that it replies to.
    """
    messages = messages.drop(*[c for c in messages.columns if c.lower().startswith("_c_")])
    lines = _lines(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = messages.withColumn("_c_lines", lines)
    quoting = F.coalesce(F.col("text"), F.lit("")).rlike(r"(?m)^\x20{0,3}>")
    split = scratch.keep(messages.select(*KEY, lines.alias("lines"), quoting.alias("quoting")))
    parsed = scratch.keep(split.select(*KEY, _passages(F.col("lines")).alias("passages"), "quoting"))
    scratch.drop(split)

    # Only conversations with a quote take part in the look-up.
    talks = parsed.filter("quoting and conv_id is not null and turn is not null").select("conv_id").distinct()
    each = parsed.join(talks, "conv_id", "left_semi").select(*KEY, F.explode("passages").alias("p"))
    own = each.filter("p.level = 0").select(*KEY, F.explode(F.array_union(F.array("p.hash"), "p.hashes")).alias("hash"))
    own = own.distinct().withColumn("origin", F.col("turn"))
    # A passage is looked up as a whole, and by its lines for quotes of a part.
    quoted = each.filter("p.level > 0").select(*KEY, F.col("p.level").alias("level"), F.col("p.hash").alias("passage"), "p.hashes")
    asked = quoted.select(*KEY, F.explode(F.array_union(F.array("passage"), "hashes")).alias("hash")).distinct()
    both = own.unionByName(asked.withColumn("origin", F.lit(None).cast("long")))
    # A message that writes what it quotes has a row of each kind; both get the same answer.
    answers = latest_before(both, ["conv_id", "hash"], "turn", "origin", "found").filter("origin is null").select(*KEY, "hash", "found")
    whole = answers.select(*KEY, F.col("hash").alias("passage"), F.col("found").alias("whole"))
    lines_of = quoted.withColumn("hash", F.explode("hashes")).join(answers, [*KEY, "hash"], "left")
    by_line = lines_of.groupBy(*KEY, "level", "passage").agg(F.max("found").alias("by_line"), F.count(F.lit(1)).alias("n"))
    linked = scratch.keep(by_line.join(whole, [*KEY, "passage"], "left").select(*KEY, "level", F.coalesce("whole", "by_line").alias("origin")))

    votes = linked.filter("level = 1 and origin is not null").groupBy(*KEY, "origin").agg(F.count(F.lit(1)).alias("n"))
    parents = votes.groupBy(*KEY).agg(F.max(F.struct("n", "origin")).alias("x")).select(*KEY, F.col("x.origin").alias("quoted_turn"))
    counts = linked.groupBy(*KEY).agg(F.count(F.lit(1)).alias("passages"), F.count("origin").alias("linked"))

    turns = parsed.filter("conv_id is not null and turn is not null").select(*KEY).distinct().withColumn("own_turn", F.col("turn"))
    chain = latest_before(turns, ["conv_id"], "turn", "own_turn", "previous").select(*KEY, "previous")
    above = scratch.keep(
        chain.join(parents, KEY, "left").select(*KEY, F.coalesce("quoted_turn", "previous").alias("parent"), F.col("quoted_turn").isNotNull().alias("by_quote"))
    )
    depths = _depths(above, scratch)
    facts = above.join(depths, KEY).join(counts, KEY, "left").select(
        F.col("conv_id").alias("_c_conv"),
        F.col("turn").alias("_c_turn"),
        F.col("parent").alias("_c_reply_to"),
        F.col("by_quote").alias("_c_by_quote"),
        F.col("depth").alias("_c_depth"),
        F.coalesce("passages", F.lit(0)).alias("_c_passages"),
        F.coalesce("linked", F.lit(0)).alias("_c_linked"),
    )
    same = (F.col("conv_id") == F.col("_c_conv")) & (F.col("turn") == F.col("_c_turn"))
    out = rows.withColumn("text", _own_text(F.col("_c_lines"))).drop("_c_lines").join(facts, same, "left").drop("_c_conv", "_c_turn")
    return out.withColumns(
        {
            "_c_by_quote": F.coalesce("_c_by_quote", F.lit(False)),
            "_c_depth": F.coalesce("_c_depth", F.lit(0).cast("long")),
            "_c_passages": F.coalesce("_c_passages", F.lit(0).cast("long")),
            "_c_linked": F.coalesce("_c_linked", F.lit(0).cast("long")),
        }
    )


def _depths(above: DataFrame, scratch: Scratch) -> DataFrame:
    """Number of messages above each one: pointers to ancestors double in each round.

    A message whose pointer has reached the first one is done and takes no further part but as a target.
    """
    steps = F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long")
    jumps = scratch.keep(above.select(*KEY, F.col("parent").alias("to"), steps.alias("depth")))
    while True:
        todo = jumps.filter("to is not null")
        if todo.isEmpty():
            return jumps.select(*KEY, "depth")
        over = jumps.select("conv_id", F.col("turn").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"))
        moved = todo.join(over, ["conv_id", "to"]).select(
            *KEY, F.col("next").alias("to"), (F.col("depth") + F.col("more")).alias("depth")
        )
        fresh = scratch.keep(moved.union(jumps.filter("to is null")))
        scratch.drop(jumps)
        jumps = fresh
