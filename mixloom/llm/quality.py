"""Quality rules: how far a document's make-up is from that of its best-fitting language.

Two histograms describe a text: characters by class and words by common word. References are the
same histograms over all documents of a language. A text is rejected when its Jensen-Shannon
distance to every language reference is above a limit; texts too short for a stable histogram are
guarded by a minimum length, below which that distance is not judged.

Every language of 1,000 words, or of 0.5 % of all words, has a reference. Those of the 200 largest
languages are compared with every text; any other is joined to the rows of its own language.

Defined cases: a null or empty text has no words and fails the length rule; rows without a
language are judged by the 200 largest languages but lend nothing to a reference; repeated rows are
judged one by one; a row of a language that has no reference gets no distance and no rejection by
distance, as all foreign references may be far from a clean text; an empty table, or one without any
reference language, gives none either.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.llm.scratch import Scratch

CLASSES = ("lower", "upper", "digit", "space", "sentence", "symbol")
SENTENCE_MARKS = ".,;:?'\"-()’–"
SYMBOL_MARKS = "#*$%&|<>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "best_lang string, class_distance double, word_distance double"
)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class number of every code point."""
    table = np.full(0x110000, CLASSES.index("symbol"), dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] in "LM":
            table[code] = CLASSES.index("upper" if kind in ("Lu", "Lt") else "lower")
        elif kind[0] == "N":
            table[code] = CLASSES.index("digit")
        elif kind[0] == "Z" or 9 <= code <= 13:
            table[code] = CLASSES.index("space")
    for mark in SENTENCE_MARKS:
        table[ord(mark)] = CLASSES.index("sentence")
    return table


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.bincount(class_table()[codes], minlength=len(CLASSES))


def js_distances(p: np.ndarray, q: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Square roots of Jensen-Shannon divergences in bits: 0 for equal, 1 for disjoint histograms.

    ``p`` and ``q`` hold histograms of sum 1 behind one another, which begin at ``starts``.
    """
    middle = (p + q) / 2
    terms = np.zeros(len(p))
    for side in (p, q):
        some = side > 0
        terms[some] += side[some] * np.log2(side[some] / middle[some]) / 2
    return np.sqrt(np.maximum(np.add.reduceat(terms, starts), 0.0))


def _counts_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and language: class counts (keys 0..n-1 of kind ``class``) and word counts."""
    for batch in batches:
        langs, texts = batch.column(0), pc.fill_null(batch.column(1), "")
        for lang in langs.unique().to_pylist():
            own = texts.filter(pc.equal(langs, lang))
            classes = sum((class_counts(t.as_py()) for t in own), np.zeros(len(CLASSES), dtype=np.int64))
            words = pc.value_counts(pc.list_flatten(pc.ascii_split_whitespace(pc.utf8_lower(own))))
            keep = pc.not_equal(words.field("values"), "")
            words = words.filter(keep)
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (n + len(CLASSES))),
                    pa.concat_arrays([pa.array(CLASSES), words.field("values").cast(pa.string())]),
                    pa.array([True] * len(CLASSES) + [False] * n),
                    pa.concat_arrays([pa.array(classes), words.field("counts").cast(pa.int64())]),
                ],
                names=["lang", "item", "is_class", "n"],
            )


def language_references(
    docs: DataFrame,
    scratch: Scratch,
    min_share: float = 0.002,
    min_lang_share: float = 0.005,
    min_lang_words: int = 1000,
    held: int = 200,
) -> tuple[dict, DataFrame | None]:
    """Class and common-word counts of each language, over all documents.

    A word is common when it makes up ``min_share`` of the words of its language, and a language
    is one that has ``min_lang_share`` of all words or ``min_lang_words`` words. The ``held`` largest
    languages with 1/min_share words each come to the driver, whatever the corpus holds; further
    ones are a table with one row per language, or None.
    """
    counted = scratch.keep(
        docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
        .filter("lang is not null and text is not null")
        .mapInArrow(_counts_by_language, "lang string, item string, is_class boolean, n long")
        .groupBy("lang", "is_class", "item")
        .agg(F.sum("n").alias("n"))
    )
    totals = counted.filter("not is_class").groupBy("lang").agg(F.sum("n").alias("words"))
    all_words = totals.agg(F.sum("words").alias("all_words"))
    large = (F.col("words") >= min_lang_share * F.col("all_words")) | (F.col("words") >= min_lang_words)
    known = scratch.keep(totals.crossJoin(F.broadcast(all_words)).filter(large).select("lang", "words"))
    first = known.orderBy(F.desc("words"), "lang").limit(held)
    usual = F.col("is_class") | (F.col("n") >= min_share * F.col("words"))
    rows = counted.join(F.broadcast(first), "lang").filter(usual).collect()
    references: dict = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["item"])):
        own = references.setdefault(row["lang"], {"words": row["words"], "classes": {}, "common": {}})
        own["classes" if row["is_class"] else "common"][row["item"]] = row["n"]
    further = None
    if len(references) == held:
        rest = known.filter(~F.col("lang").isin(list(references)))
        items = F.collect_list(F.struct("item", "is_class", "n")).alias("items")
        further = counted.join(rest, "lang").filter(usual).groupBy("lang").agg(F.first("words").alias("words"), items)
        further = scratch.keep(further)
        if further.isEmpty():
            scratch.drop(further)
            further = None
    scratch.drop(counted, known)
    return references, further


class Judge:
    """Distances of one text to the references, and the plain counts of the base rules."""

    def __init__(self, references: dict):
        self.langs = sorted(references)
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for r in references.values() for w in r["common"]}))}
        self.classes = np.array([[references[x]["classes"][c] for c in CLASSES] for x in self.langs], dtype=float)
        # The word histograms of all languages lie behind one another; each ends with the count of all other words.
        common, shares = [], []
        for lang in self.langs:
            own = references[lang]
            words = sorted(own["common"])
            common.append(np.array([*(self.vocabulary[w] for w in words), len(self.vocabulary)], dtype=np.int64))
            known = [own["common"][w] for w in words]
            shares.append(np.array([*known, own["words"] - sum(known)], dtype=float))
        sizes = np.array([len(x) for x in common], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        self.starts, self.sizes = self.ends - sizes, sizes
        if self.langs:
            self.common = np.concatenate(common)
            self.shares = np.concatenate([x / x.sum() for x in shares])
            self.classes /= self.classes.sum(axis=1, keepdims=True)
            self.class_starts = np.arange(len(self.langs)) * len(CLASSES)

    def distances(self, words: list[str], text: str) -> tuple[str | None, float | None, float | None]:
        """The language with the smallest sum of both distances, and these."""
        if not words or not self.langs:
            return None, None, None
        classes = class_counts(text).astype(float)
        found = np.zeros(len(self.vocabulary) + 1, dtype=float)
        vocabulary = self.vocabulary
        for word, n in Counter(WORD.findall(text.lower())).items():
            if (at := vocabulary.get(word)) is not None:
                found[at] += n
        own = found[self.common]
        own[self.ends - 1] = np.maximum(len(words) - np.add.reduceat(own, self.starts), 0.0)
        own /= np.repeat(np.add.reduceat(own, self.starts), self.sizes)
        by_word = js_distances(own, self.shares, self.starts)
        by_class = js_distances(np.tile(classes / classes.sum(), len(self.langs)), self.classes.ravel(), self.class_starts)
        best = int((by_word + by_class).argmin())
        return self.langs[best], float(by_class[best]), float(by_word[best])

    def features(self, text: str | None, lang: str | None = None, own: Judge | None = None) -> tuple:
        """``own`` is the judge of the reference of ``lang``, if that is not among these references."""
        text = text or ""
        words = WORD.findall(text)
        lines = [line for line in text.split("\n") if WORD.search(line)]
        best = None, None, None
        if lang is None or own or lang in self.langs:
            best = self.distances(words, text)
            if own and words:
                best = min(best, own.distances(words, text), key=lambda d: (d[1] + d[2], d[0]))
        return (
            len(words),
            sum(map(len, words)),
            sum(map(text.count, SYMBOL_MARKS)),
            len(lines) - len(set(lines)),
            repeated_words(words),
            *best,
        )


def repeated_words(words: list[str], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total, covered = 0, 0
    for start, window in enumerate(windows):
        if seen[window] > 1:
            total += start + width - max(start, covered)
            covered = start + width
    return total


def score(
    docs: DataFrame, references: dict, columns: list[str] | None = None, further: DataFrame | None = None
) -> DataFrame:
    """``columns`` of ``docs`` (all, if None) with the counts and distances of every text.

    Same rows, in one pass without a shuffle; columns that are not asked for don't come back from Python.
    Only rows of languages outside ``references`` are joined to ``further``, the references of such languages.
    """
    clash = [c for c in docs.columns if c.lower().startswith("_q_")]
    docs = docs.drop(*clash)
    columns = [c for c in docs.columns if columns is None or c in columns]
    docs = docs.select(*dict.fromkeys([*columns, "text"]), F.col("lang").cast("string").alias("_q_lang"))
    judge = Judge(references)
    at, keep = docs.columns.index("text"), [docs.columns.index(c) for c in columns]
    lang_at = docs.columns.index("_q_lang")
    names = [part.split()[0] for part in FEATURES.split(", ")]
    fresh = [f"_q_{n}" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.string(), pa.float64(), pa.float64()]
        judges: dict = {}
        for batch in batches:
            rows = []
            own = batch.column(lang_at + 1) if batch.num_columns > lang_at + 1 else None
            for i, (text, lang) in enumerate(zip(batch.column(at), batch.column(lang_at).to_pylist(), strict=True)):
                if own is not None and lang not in judges:
                    if len(judges) >= 256:
                        judges.clear()
                    judges[lang] = _own_judge(lang, own[i].as_py())
                rows.append(judge.features(text.as_py(), lang, judges.get(lang)))
            found = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            arrays = [pa.array(c, type=k) for c, k in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *arrays], names=[*columns, *fresh])

    fields = ", ".join(f"_q_{part}" for part in FEATURES.split(", "))
    extra = T.StructType.fromDDL(fields)
    schema = T.StructType([*(docs.schema[c] for c in columns), *extra.fields])
    if further is None:
        return docs.mapInArrow(run, schema)
    usual = F.col("_q_lang").isNull() | F.col("_q_lang").isin(list(references))
    own = further.select(F.col("lang").alias("_q_lang"), F.struct("words", "items").alias("_q_own"))
    others = docs.filter(~usual).join(own, "_q_lang", "left").select(*docs.columns, "_q_own")
    return docs.filter(usual).mapInArrow(run, schema).union(others.mapInArrow(run, schema))


def _own_judge(lang: str, row: dict | None) -> Judge | None:
    """Judge of a single reference, from its row of the joined table."""
    if row is None:
        return None
    classes = {x["item"]: x["n"] for x in row["items"] if x["is_class"]}
    common = {x["item"]: x["n"] for x in row["items"] if not x["is_class"]}
    return Judge({lang: {"words": row["words"], "classes": classes, "common": common}})


def quality_rules(
    docs: DataFrame,
    scratch: Scratch,
    max_class_distance: float = 0.28,
    max_word_distance: float = 0.42,
    min_chars: int = 200,
    min_words: int = 50,
    columns: list[str] | None = None,
    held: int = 200,
) -> DataFrame:
    """``docs`` with ``_q_*`` columns: counts, distances, ``_q_base_failed`` and ``_q_kept``.

    A class distance is judged from ``min_chars`` characters on, a word distance from ``min_words`` words on.
    """
    references, further = language_references(docs, scratch, held=held)
    scored = score(docs, references, columns, further)
    n, repeats = F.col("_q_n_words"), F.col("_q_n_repeat_words")
    far = F.coalesce(
        (F.col("_q_word_chars") >= min_chars) & (F.col("_q_class_distance") > max_class_distance), F.lit(False)
    ) | F.coalesce((n >= min_words) & (F.col("_q_word_distance") > max_word_distance), F.lit(False))
    scored = scored.withColumn("_q_base_failed", (n < 50) | (100 * repeats > 50 * n))
    return scored.withColumn("_q_kept", ~F.col("_q_base_failed") & ~far)
