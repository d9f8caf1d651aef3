"""Personal data: fixed formats as seeds, lexical patterns around them, and what else stands in those patterns.

Base spans are e-mail addresses, IP addresses, payment cards and phone numbers in their usual forms.
Candidates are runs of words with a digit or an at sign. Their surroundings are lexical patterns:
the two words before, the word on either side; words of marks alone are passed over, as long as
another one is among the four next to the candidate. Patterns and candidate texts (instances) form a
graph. Instances of base form have score 1 for their kind; a pattern is trusted as far as its
distinct instances have that kind, and an instance as far as some pattern around it is trusted. The
scores are iterated, and candidates in trusted patterns that overlap no base span are added.

The graph has one edge per pattern and distinct instance, so copies of a document add nothing to the
trust in a pattern, and words that are everywhere only add to counts that combine before shuffling.
Texts are read once and never shuffled. Work is linear in a text: places are summed up in blocks of
matches, and neighbouring words are taken from the parts between the matches.

Defined cases: a null text is empty; repeated rows are judged one by one and alike; an empty table
gives no row, no seeds give base spans only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")

# The formats, written so that a scan of a text is linear: a match only starts where a run of its
# characters does, or where the match before ended, and runs are not given back.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Whole runs of digits with single separators that have 14 to 19 digits; others fail anyway.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+"
NEAR = 4  # words next to a candidate among which its neighbours with a letter or digit are looked for
CELL = 64  # code points of a text in which spans are held against each other
BLOCK = 256  # matches whose places are summed up together
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

SPAN = "array<struct<start:int,end:int,text:string>>"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(text: Column, pattern: str) -> Column:
    """Every match ``f`` with what lies before it, ``b``."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda f: F.arrays_zip(F.slice(between, 1, F.size(f)).alias("b"), f.alias("f")))


def _placed(parts: Column) -> Column:
    """Places of the matches in code points: lengths of the parts summed up within blocks, then over the blocks."""
    none = F.array().cast(SPAN)

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["b"])
        end = begin + F.length(pair["f"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["f"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def block(i: Column) -> Column:
        return F.aggregate(F.slice(parts, i * BLOCK + 1, F.lit(BLOCK)), F.struct(F.lit(0).alias("at"), none.alias("spans")), step)

    def add(state: Column, one: Column) -> Column:
        return F.struct((state["at"] + one["at"]).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    def shifted(one: Column, at: Column) -> Column:
        return F.transform(
            one["spans"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["text"].alias("text"))
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), block)
    summed = _let(blocks, lambda bs: F.flatten(F.zip_with(bs, F.aggregate(bs, first, add, lambda s: s["starts"]), shifted)))
    return F.when(F.size(parts) > 0, summed).otherwise(none)


def _spans(text: Column, pattern: str) -> Column:
    """All matches with their place in code points."""
    return _let(_parts(text, pattern), _placed)


def _luhn(text: Column) -> Column:
    digits = F.reverse(F.regexp_replace(text, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Valid spans of each kind; texts without the characters a kind needs are not searched for it."""
    none = F.array().cast(SPAN)
    digits = lambda m: F.length(F.regexp_replace(m, "[^0-9]", ""))
    return {
        "email": F.when(F.contains(text, F.lit("@")), _spans(text, EMAIL)).otherwise(none),
        "ip": F.when(
            text.rlike(r"[0-9]\.[0-9]"),
            F.filter(_spans(text, IP), lambda s: s["text"].rlike(rf"^(?:{BYTE}\.){{3}}{BYTE}$")),
        ).otherwise(none),
        "card": F.when(text.rlike(CARD), F.filter(_spans(text, CARD), lambda s: _luhn(s["text"]))).otherwise(none),
        "phone": F.when(
            F.contains(text, F.lit("+")), F.filter(_spans(text, PHONE), lambda s: digits(s["text"]).between(10, 15))
        ).otherwise(none),
    }


def _kind_of(text: Column) -> Column:
    """Kind of an instance that holds a base span, for the first kind that it holds; null for others."""
    found = base_spans(text)
    return F.coalesce(*[F.when(F.size(found[k]) > 0, F.lit(k)) for k in KINDS])


def _candidates(text: Column) -> Column:
    """Candidates with the two words before and the word after, lower-cased and without marks at their ends."""

    def ends(part: Column) -> Column:
        """The first and the last words of a part."""
        words = F.filter(F.split(part, r"\s+"), lambda w: w != "")
        return _let(
            words,
            lambda w: F.struct(F.slice(w, 1, NEAR).alias("head"), F.slice(w, F.greatest(F.size(w) - NEAR + 1, F.lit(1)), F.lit(NEAR)).alias("tail")),
        )

    def bare(words: Column) -> Column:
        return F.filter(F.transform(words, lambda w: F.btrim(F.lower(w), F.lit(MARKS))), lambda w: w != "")

    def around(parts: Column, last: Column) -> Column:
        none = F.array().cast("array<string>")
        sides = F.transform(
            F.concat(parts, F.array(F.struct(last.alias("b"), F.lit("").alias("f")))),
            lambda p: F.struct(ends(p["b"]).alias("b"), ends(p["f"]).alias("f")),
        )

        def candidate(side: Column, s: Column, i: Column) -> Column:
            def part(k: int, which: str, end: str) -> Column:
                return F.coalesce(F.get(side, i + k)[which][end], none)

            # A match has a word at least, so NEAR matches on either side hold enough.
            before = F.concat(*[x for k in range(-NEAR, 0) for x in (part(k, "f", "tail"), part(k + 1, "b", "tail"))])
            after = F.concat(*[x for k in range(1, NEAR + 1) for x in (part(k, "b", "head"), part(k, "f", "head"))])
            left = bare(F.slice(before, F.greatest(F.size(before) - NEAR + 1, F.lit(1)), F.lit(NEAR)))
            right = bare(F.slice(after, 1, NEAR))
            opened = F.ltrim(s["text"], F.lit("\"'([<"))
            inner = F.rtrim(opened, F.lit(".,;:!?\"')]>"))
            start = s["start"] + F.length(s["text"]) - F.length(opened)
            return F.struct(
                start.alias("start"),
                (start + F.length(inner)).alias("end"),
                inner.alias("text"),
                F.coalesce(F.try_element_at(left, F.lit(-2)), F.lit("")).alias("l2"),
                F.coalesce(F.try_element_at(left, F.lit(-1)), F.lit("")).alias("l1"),
                F.coalesce(F.try_element_at(right, F.lit(1)), F.lit("")).alias("r1"),
            )

        return _let(sides, lambda side: F.transform(_placed(parts), lambda s, i: candidate(side, s, i)))

    last = F.element_at(F.split(text, CANDIDATE, -1), -1)
    found = _let(_parts(text, CANDIDATE), lambda parts: _let(last, lambda end: around(parts, end)))
    return F.when(text.rlike("[0-9@]"), F.filter(found, lambda c: c["end"] > c["start"]))


def _patterns(c: Column) -> Column:
    """Patterns of a candidate; a pattern needs at least one word."""
    both = F.when((c["l2"] != "") & (c["l1"] != ""), F.concat(F.lit("2 "), c["l2"], F.lit(" "), c["l1"]))
    side = F.when((c["l1"] != "") & (c["r1"] != ""), F.concat(F.lit("1 "), c["l1"], F.lit(" _ "), c["r1"]))
    near = F.when(c["l1"] != "", F.concat(F.lit("0 "), c["l1"]))
    return F.filter(F.array(both, side, near), lambda p: p.isNotNull())


def trusted_patterns(
    edges: DataFrame, seeds: DataFrame, scratch: Scratch, support: float = 4.0, trust: float = 0.8, rounds: int = 50
) -> DataFrame:
    """Patterns (with kind and trust) after iterating scores over the graph of ``edges`` (pattern, instance).

    ``seeds`` are instances with their kind. The trust in a pattern is the sum of its instances' scores
    for the kind over their number plus one; ``support`` is the least such sum. Seeds keep score 1
    for their kind and none for others. Ends when patterns and scores stay the same to six digits, or
    after ``rounds``, which only scores that keep going to and fro reach.
    """
    sizes = scratch.keep(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= support))
    useful = scratch.keep(edges.join(sizes.select("pattern"), "pattern"))
    fixed = seeds.withColumn("score", F.lit(1.0))
    labels, before, patterns = fixed, None, None
    for _ in range(rounds):
        sums = useful.join(labels, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
        fresh = scratch.keep(
            sums.filter(F.col("sum") >= support)
            .join(sizes, "pattern")
            .withColumn("trust", F.col("sum") / (F.col("n") + 1))
            .filter(F.col("trust") >= trust)
            .select("pattern", "kind", "trust")
        )
        if patterns is not None:
            scratch.drop(patterns)
        patterns = fresh
        state = F.xxhash64("pattern", "kind", F.round("trust", 6)).cast("decimal(38,0)")
        now = tuple(fresh.agg(F.count(F.lit(1)), F.sum(state)).first())
        if now == before or now[0] == 0:
            break
        before = now
        # Noisy or: an instance is of a kind unless all its trusted patterns are wrong.
        doubt = F.exp(F.sum(F.log(1 - F.col("trust"))))
        found = useful.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - doubt).alias("score"))
        labels = fixed.unionByName(found.join(seeds.select("instance"), "instance", "left_anti"))
    scratch.drop(sizes, useful)
    return patterns


def _overlapping(spans: DataFrame, read: DataFrame) -> DataFrame:
    """The (row, start, end) of ``spans`` that overlap a base span of their row; both meet by cells of the text."""

    def cells(df: DataFrame, start: str, end: str) -> DataFrame:
        return df.withColumn("cell", F.explode(F.sequence(F.floor(F.col(start) / CELL), F.floor((F.col(end) - 1) / CELL))))

    base = read.select("row", F.explode("base").alias("s")).select("row", F.col("s.start").alias("from"), F.col("s.end").alias("to"))
    met = cells(spans.select("row", "start", "end"), "start", "end").join(cells(base, "from", "to"), ["row", "cell"])
    return met.filter((F.col("from") < F.col("end")) & (F.col("to") > F.col("start"))).select("row", "start", "end").distinct()


def find_pii(docs: DataFrame, scratch: Scratch, support: float = 4.0, trust: float = 0.8, rounds: int = 50) -> DataFrame:
    """Per row of ``docs``: doc_id, ``base`` and ``added`` spans (kind, start, end), sorted by start and kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = base_spans(F.col("_text"))

    def labelled(kind: str) -> Column:
        at = F.lit(KINDS.index(kind))
        return F.transform(base[kind], lambda s: F.struct(s["start"].alias("start"), at.alias("at"), s["end"].alias("end")))

    read = scratch.keep(
        docs.select("doc_id", text.alias("_text"))
        .select("doc_id", F.array_sort(F.concat(*[labelled(k) for k in KINDS])).alias("base"), _candidates(F.col("_text")).alias("candidates"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    each = read.select("row", F.explode("candidates").alias("c"))
    linked = each.select("row", F.col("c.start").alias("start"), F.col("c.end").alias("end"), F.col("c.text").alias("instance"), F.explode(_patterns(F.col("c"))).alias("pattern"))
    edges = linked.select("pattern", "instance").distinct()
    seeds = scratch.keep(each.select(F.col("c.text").alias("instance")).distinct().withColumn("kind", _kind_of(F.col("instance"))).filter("kind is not null"))
    patterns = trusted_patterns(edges, seeds, scratch, support, trust, rounds)

    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    best = F.max(F.struct("trust", (-order).alias("at"))).alias("x")
    judged = scratch.keep(linked.join(patterns, "pattern").groupBy("row", "start", "end").agg(best).select("row", "start", "end", (-F.col("x.at")).alias("at")))
    added = (
        judged.join(_overlapping(judged, read), ["row", "start", "end"], "left_anti")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "at", "end"))).alias("added"))
    )

    def named(spans: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(F.element_at(F.array(*map(F.lit, KINDS)), s["at"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )

    none = F.array().cast("array<struct<start:int,at:int,end:int>>")
    rows = read.select("row", "doc_id", "base").join(added, "row", "left").withColumn("added", F.coalesce("added", none))
    return rows.select("doc_id", named(F.col("base")).alias("base"), named(F.col("added")).alias("added"), named(F.array_sort(F.concat("base", "added"))).alias("all"))
