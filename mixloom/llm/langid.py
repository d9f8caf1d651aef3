"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is the counts of its one- to three-letter sequences (letters folded to lower case, everything
else one space), hashed to a fixed number of columns; log counts are weighted by inverse document
frequency over all training documents and scaled to length 1. Weights are trained by
follow-the-regularised-leader with an elastic-net penalty, which leaves columns that don't help at
exactly 0; then one temperature is fitted on held-back sample rows, so that the score is a probability.

Document frequencies cover all training documents; weights come from a sample of them bounded by
``sample`` and taken by hash. Whole texts are predicted where they are read.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without any training
document, or language, everything is. Rows without language or with a null id are no training rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1 << 15
UNKNOWN = "und"
HELD_OUT = 2
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point to itself if it is a letter, else to a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], dtype=np.uint32)


def columns_of(text: str | None, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the n-grams that occur, and their counts; none for a text without letters."""
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    codes = letters()[np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    if not (codes != 32).any():
        return counts[:0], counts[:0]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint32)
    for at in range(0, len(codes), step):
        part = codes[at : at + step + 2]
        sums = np.zeros(len(part), dtype=np.uint32)
        for n, factor in enumerate(_FACTORS):
            size = len(part) - n
            if size <= 0:
                break
            sums = (sums[:size] ^ (part[n:] * factor)) * np.uint32(0x27D4EB2F) + np.uint32(n)
            hashed = (sums ^ (sums >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount((hashed[:step] >> np.uint32(17)), minlength=DIMENSIONS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def weighted(columns: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = np.log1p(counts) * idf[columns]
    size = math.sqrt(float((values**2).sum()))
    return values / size if size else values


class FtrlRegression:
    """Multinomial logistic regression, trained one row at a time with per-column steps."""

    def __init__(self, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.z = np.zeros((classes, DIMENSIONS))
        self.n = np.zeros((classes, DIMENSIONS))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, columns) -> np.ndarray:
        z, n = self.z[:, columns], self.n[:, columns]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, columns: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(columns)
        p = softmax(w @ values)
        p[label] -= 1.0
        gradient = p[:, None] * values[None, :]
        before = self.n[:, columns]
        after = before + gradient**2
        self.z[:, columns] += gradient - (np.sqrt(after) - np.sqrt(before)) / self.alpha * w
        self.n[:, columns] = after


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Divisor of the logits with the least negative log likelihood, by golden section on its logarithm."""

    def loss(log_t: float) -> float:
        x = logits / math.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(labels)), labels]).mean())

    low, high, ratio = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return math.exp((low + high) / 2)


class LanguageModel:
    """Languages, idf, sparse weights and temperature; small enough to be sent to every task."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.langs, self.idf, self.temperature = langs, idf.astype(np.float32), temperature
        self.weights = weights.astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        columns, counts = columns_of(text)
        if not len(columns) or not self.langs:
            return UNKNOWN, 0.0
        p = softmax(self.weights[:, columns] @ weighted(columns, counts, self.idf) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train(
    docs: DataFrame, sample: int = 4000, passes: int = 3, per_language: int = 50, languages: int = 100, **penalties
) -> LanguageModel:
    """A model from the documents that have a language and whose checksum leaves no remainder of ``HELD_OUT``.

    N-grams of about ``sample`` rows come to the driver, shared out by the size of the languages, and of
    ``per_language`` rows of each smaller one; every fourth row only sets the temperature. The
    ``languages`` largest languages are learned (ties: by name), whatever their share of the table.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != HELD_OUT))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                columns, _ = columns_of(text.as_py())
                seen[columns] += 1
                total += bool(len(columns))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(seen[found], total))], names=["column", "n"]
        )

    # One row per column and task, then at most one per column: a bound that the corpus doesn't move.
    found = rows.select("text").mapInArrow(frequencies, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()
    total = next((r["n"] for r in found if r["column"] == -1), 0)
    seen = np.zeros(DIMENSIONS)
    for r in found:
        if r["column"] >= 0:
            seen[r["column"]] = r["n"]
    idf = np.log((1 + total) / (1 + seen)) + 1

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [columns_of(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([c.astype(np.int32) for c, _ in pairs], pa.list_(pa.int32())),
                    pa.array([np.minimum(n, 1 << 30).astype(np.int32) for _, n in pairs], pa.list_(pa.int32())),
                ],
                names=["place", "lang", "columns", "counts"],
            )

    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    quota = {r["lang"]: max(math.ceil(sample * r["count"] / max(total, 1)), min(r["count"], per_language)) for r in sizes}
    # Rows of a language in order of a hash: about its quota lies below a limit, three spreads above it to be sure.
    limits = {r["lang"]: min(1.0, (quota[r["lang"]] + 3 * math.sqrt(quota[r["lang"]]) + 3) / r["count"]) for r in sizes}
    limit = F.lit(-1)
    if limits:
        limit = F.create_map(*[F.lit(x) for lang, share in limits.items() for x in (lang, int(share * (1 << 40)))])[F.col("lang")]
    place = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 40))
    near = rows.withColumn("place", place).filter(F.col("place") <= limit).select("place", "lang", "text")
    picked = near.mapInArrow(grams, "place long, lang string, columns array<int>, counts array<int>")
    # Repeated rows share a place; they can't take more than twice what is wanted.
    picked = picked.limit(2 * (sum(quota.values()) + len(quota))).toArrow().sort_by([("place", "ascending"), ("lang", "ascending")])
    left, chosen = dict(quota), []
    for i, lang in enumerate(picked.column("lang").to_pylist()):
        if left[lang]:
            left[lang] -= 1
            chosen.append(i)
    picked = picked.take(pa.array(chosen, pa.int64()))
    langs = sorted(set(picked.column("lang").to_pylist()))
    examples = []
    for lang, columns, counts in zip(picked.column("lang").to_pylist(), picked.column("columns"), picked.column("counts"), strict=True):
        columns, counts = columns.values.to_numpy(), counts.values.to_numpy()
        if len(columns):
            examples.append((columns, weighted(columns, counts, idf), langs.index(lang)))
    model = FtrlRegression(len(langs), **penalties)
    fitted, held = [x for i, x in enumerate(examples) if i % 4], examples[::4]
    fitted = fitted or held
    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(fitted)):
            model.learn(*fitted[i])
    weights = model.weights(slice(None))
    temperature = 1.0
    if held and len(langs) > 1:
        logits = np.array([weights[:, c] @ v for c, v, _ in held])
        temperature = fit_temperature(logits, np.array([y for _, _, y in held]))
    return LanguageModel(langs, idf, weights, temperature)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred and score, from the text alone."""
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col("text").cast("string"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([min(1.0, s) for _, s in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
