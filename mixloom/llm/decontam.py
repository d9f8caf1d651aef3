"""Benchmark decontamination: longest matches of training text in a suffix automaton of the test items.

The words of the items (runs without ASCII punctuation, white space and control characters, A-Z
lower-cased) form a generalised suffix automaton. Every text is streamed through it, word by word; the
length of the longest match that ends at a word tells which windows end there. A window is ``window``
consecutive words of an item; an item of fewer words is one window. Words inside any occurrence of a
window are hit, whatever their number; ``remove_hits`` cuts them out, and drops texts of which more than
a given share is hit.

The automaton works on many stretches of text at once: words that no item has end a match, so only runs
of item words of the least window length are streamed; long runs are cut into stretches that begin
``window`` - 1 words early, which leaves all matches up to the length of a window exact.

Items are dealt into blocks of about ``block_words`` words (items longer than a quarter of that into
overlapping pieces), each of which becomes one automaton, built in a task and broadcast: its size is
bounded, however many items there are. Texts pass through the automata where they are read; no text is
shuffled or collected, and a text's result needs no other row.

Defined cases: a null text has no words and is not contaminated; an empty or null item has no window;
rows that share an item_id are one item when items are counted, a null item_id is written as an empty
string; rows that share a doc_id, or have none, are looked at one by one; without items nothing is hit;
columns of ``docs`` stay, the added ones begin with ``_b_``.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.llm.scratch import Scratch
from mixloom.llm.shingles import slices

STRETCH = 64  # words that a stretch adds to its run-up
#: Words are runs of digits, lower-cased letters and everything beyond ASCII.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Added columns.
ADDED = {"_b_words": "bigint", "_b_hit": "bigint", "_b_items": "array<string>", "_b_spans": "array<struct<start:bigint,stop:bigint>>"}


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and the offsets of the texts in them."""
    if not len(texts):
        return pa.array([], pa.large_string()), np.zeros(1, dtype=np.int64)
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")[int(offsets[0]) : int(offsets[-1])]
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(bytes(data).translate(_FOLD))]
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), buffers)
    split = pc.ascii_split_whitespace(plain)
    words, ends = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    ends -= ends[0]
    # Splitting leaves empty strings at the ends of a text; they are no words.
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not real.all():
        words = words.filter(pa.array(real))
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
    return words, ends


def runs(marked: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of the maximal runs of marked words within a text."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    inner = np.unique(ends[(ends > 0) & (ends < len(marked))])
    inner = inner[marked[inner - 1] & marked[inner]]
    return np.sort(np.concatenate([np.flatnonzero(edge == 1), inner])), np.sort(np.concatenate([np.flatnonzero(edge == -1), inner]))


class Automaton:
    """Generalised suffix automaton over item words, as arrays that are searched for many positions at once."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        """``items``: id and words of each; pieces of one item carry the same id."""
        vocabulary = sorted({w for _, words in items for w in words})
        code = {w: i for i, w in enumerate(vocabulary)}
        coded = [(name, [code[w] for w in words]) for name, words in items if words]
        step, link, length = [{}], [-1], [0]
        for _, words in coded:
            last = 0
            for c in words:
                last = self._extend(step, link, length, last, c)
        self.window, self.vocabulary = window, pa.array(vocabulary, pa.large_string())
        self.link, self.length = np.array(link, dtype=np.int32), np.array(length, dtype=np.int32)
        edges = sorted((s * len(vocabulary) + c, t) for s, targets in enumerate(step) for c, t in targets.items())
        self.keys = np.array([k for k, _ in edges], dtype=np.int64)
        self.targets = np.array([t for _, t in edges], dtype=np.int32)
        self._windows(coded, step)

    @staticmethod
    def _extend(step: list[dict[int, int]], link: list[int], length: list[int], last: int, c: int) -> int:
        """The state of ``last`` + c after that string was added to the automaton."""

        def split(p: int, q: int) -> int:
            copy = len(step)
            step.append(dict(step[q]))
            link.append(link[q])
            length.append(length[p] + 1)
            link[q] = copy
            while p >= 0 and step[p].get(c) == q:
                step[p][c] = copy
                p = link[p]
            return copy

        if c in step[last]:  # an earlier item had the same words
            q = step[last][c]
            return q if length[q] == length[last] + 1 else split(last, q)
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def _windows(self, coded: list[tuple[str, list[int]]], step: list[dict[int, int]]) -> None:
        """``ends[k]``: window number of each state whose matches end with a window of k words, else -1; its items."""
        found: dict[tuple[int, int], set[str]] = {}
        for name, words in coded:
            k = min(self.window, len(words))
            # Stream the item through its own automaton, holding the match at k words.
            state, matched = 0, 0
            for c in words:
                state, matched = step[state][c], matched + 1
                if matched > k:
                    matched = k
                    while self.length[self.link[state]] >= k:
                        state = int(self.link[state])
                if matched == k:
                    found.setdefault((k, state), set()).add(name)
        numbers = {key: i for i, key in enumerate(sorted(found))}
        self.items = [sorted(found[key]) for key in sorted(found)]
        self.ends: dict[int, np.ndarray] = {}
        order = np.argsort(self.length, kind="stable")
        for k in sorted({k for k, _ in found}):
            own = np.full(len(self.link), -1, dtype=np.int32)
            for (size, state), number in numbers.items():
                if size == k:
                    own[state] = number
            # A state inherits from the suffix whose lengths contain k; links lead to shorter states.
            at = np.full(len(self.link), -1, dtype=np.int32)
            for s in order.tolist():
                up = self.link[s]
                at[s] = own[s] if self.length[s] >= k and (up < 0 or self.length[up] < k) else (at[up] if up >= 0 else -1)
            self.ends[k] = at

    def search(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and match length (exact up to ``window``) at every word of the runs ``starts``..``stops``.

        ``codes``: word numbers of the batch, those in a run all known.
        """
        states, lengths = np.zeros(len(codes), dtype=np.int32), np.zeros(len(codes), dtype=np.int32)
        # Stretches of the runs, with a run-up.
        counts = -(-(stops - starts) // STRETCH)
        first = np.repeat(starts, counts)
        nth = np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = first + nth * STRETCH
        stop = np.minimum(begin + STRETCH, np.repeat(stops, counts))
        at = np.maximum(begin - (self.window - 1), first)
        by_size = np.argsort(at - stop, kind="stable")  # longest first, so that those at work are a prefix
        begin, stop, at = begin[by_size], stop[by_size], at[by_size]
        state, matched = np.zeros(len(at), dtype=np.int32), np.zeros(len(at), dtype=np.int32)
        live = len(at)
        sizes = stop - at
        for i in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes[:live], -i, side="left"))
            here = at[:live] + i
            self._advance(state[:live], matched[:live], codes[here])
            own = here >= begin[:live]
            states[here[own]], lengths[here[own]] = state[:live][own], matched[:live][own]
        return states, lengths

    def _advance(self, state: np.ndarray, matched: np.ndarray, code: np.ndarray) -> None:
        """One word further, in place; each match falls back to shorter suffixes until one goes on."""
        todo = np.arange(len(state))
        while len(todo):
            key = state[todo].astype(np.int64) * len(self.vocabulary) + code[todo]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[at] == key
            done = todo[goes]
            state[done] = self.targets[at[goes]]
            matched[done] += 1
            todo = todo[~goes]  # the root has every word of the vocabulary
            state[todo] = self.link[state[todo]]
            matched[todo] = self.length[state[todo]]

    def hits(self, words: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end (exclusive) of every occurrence of a window in the words, and the window's number."""
        nothing = np.zeros(0, dtype=np.int64)
        codes = pc.fill_null(pc.index_in(words, self.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = codes >= 0
        starts, stops = runs(known, ends)
        least = min(self.ends, default=0)
        enough = stops - starts >= max(least, 1)
        if not self.ends or not enough.any():
            return nothing, nothing, nothing
        states, lengths = self.search(codes, starts[enough], stops[enough])
        found = []
        for k, number in self.ends.items():
            at = np.flatnonzero(lengths >= k)
            which = number[states[at]]
            at, which = at[which >= 0], which[which >= 0]
            found.append((at + 1 - k, at + 1, which.astype(np.int64)))
        return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))

    def dump(self) -> bytes:
        out = io.BytesIO()
        sizes = [len(x) for x in self.items]
        np.savez(
            out,
            window=self.window,
            words=np.frombuffer("\n".join(self.vocabulary.to_pylist()).encode(), dtype=np.uint8),
            link=self.link,
            length=self.length,
            keys=self.keys,
            targets=self.targets,
            items=np.frombuffer("\x00".join(i.replace("\x00", "�") for x in self.items for i in x).encode(), dtype=np.uint8),
            sizes=np.array(sizes, dtype=np.int64),
            **{f"ends{k}": v for k, v in self.ends.items()},
        )
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        held, self = np.load(io.BytesIO(data)), cls.__new__(cls)
        text = held["words"].tobytes().decode()
        self.window, self.vocabulary = int(held["window"]), pa.array(text.split("\n") if text else [], pa.large_string())
        self.link, self.length, self.keys, self.targets = (held[k] for k in ("link", "length", "keys", "targets"))
        names, stops = held["items"].tobytes().decode().split("\x00"), np.cumsum(held["sizes"])
        self.items = [names[b - n : b] for b, n in zip(stops.tolist(), held["sizes"].tolist(), strict=True)]
        self.ends = {int(k[4:]): held[k] for k in held.files if k.startswith("ends")}
        return self


def build_automata(items: DataFrame, scratch: Scratch, window: int = 10, block_words: int = 250_000) -> list:
    """One broadcast automaton for each block of the items (columns item_id, text)."""
    piece = max(block_words // 4, 2 * window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of each item; long items in pieces that share ``window`` - 1 words with the next."""
        for batch in batches:
            words, ends = split_words(batch.column(1))
            names = batch.column(0).to_pylist()
            out = [
                (name, at, " ".join(words.slice(at, min(at + piece, stop) - at).to_pylist()), min(at + piece, stop) - at)
                for name, start, stop in zip(names, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                for at in range(start, max(stop - window + 1, start + 1), piece - window + 1)
                if stop > start
            ]
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "at", "words", "n"])

    def built(group: pd.DataFrame) -> pd.DataFrame:
        made = Automaton([(i, w.split(" ")) for i, w in zip(group["item"], group["words"], strict=True)], window)
        return pd.DataFrame({"block": [group["block"].iloc[0]], "data": [made.dump()]})

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))
    pieces = scratch.keep(rows.mapInArrow(cut, "item string, at long, words string, n long"))
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    # Pieces are small against a block, so that a hash deals them out evenly.
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "at", "words"), F.lit(blocks)))
    automata = scratch.keep(dealt.groupBy("block").applyInPandas(built, "block long, data binary"))
    context = scratch.spark.sparkContext
    # One block at a time passes the driver.
    return [context.broadcast(row["data"]) for row in automata.orderBy("block").toLocalIterator()]


def _pass(automata: list):
    """The function for ``mapInArrow``: batches that end with the text, found items and spans get the columns of ``ADDED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = [Automaton.load(a.value) for a in automata]
        for batch in batches:
            at, width = 0, batch.num_columns - 3
            for part in slices(batch.column(width)):
                rows = batch.slice(at, len(part))
                at += len(part)
                judged = _judged(part, rows.column(width + 1), rows.column(width + 2), loaded)
                yield pa.RecordBatch.from_arrays([*rows.columns[:width], *judged], names=[*batch.schema.names[:width], *ADDED])

    return run


def _judged(texts: pa.Array, items_before: pa.Array, spans_before: pa.Array, loaded: list[Automaton]) -> list[pa.Array]:
    words, ends = split_words(texts)
    covered = np.zeros(len(words) + 1, dtype=np.int64)

    def cover(starts: np.ndarray, stops: np.ndarray) -> None:
        covered[:] += np.bincount(starts, minlength=len(covered)) - np.bincount(stops, minlength=len(covered))

    items: dict[int, set[str]] = {}
    for t, (found, spans) in enumerate(zip(items_before.to_pylist(), spans_before.to_pylist(), strict=True)):
        if found:
            items[t] = set(found)
            cover(*(ends[t] + np.array([[s["start"] for s in spans], [s["stop"] for s in spans]], dtype=np.int64)))
    for automaton in loaded:
        starts, stops, numbers = automaton.hits(words, ends)
        if len(starts):
            cover(starts, stops)
            owners = np.searchsorted(ends, starts, side="right") - 1
            for t, number in np.unique(np.stack([owners, numbers]), axis=1).T.tolist():
                items.setdefault(t, set()).update(automaton.items[number])
    hit = np.cumsum(covered)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(hit)])
    firsts, lasts = runs(hit, ends)
    owners = np.searchsorted(ends, firsts, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array(firsts - ends[owners], pa.int64()), pa.array(lasts - ends[owners], pa.int64())], names=["start", "stop"])
    offsets = np.searchsorted(owners, np.arange(len(texts) + 1), side="left")
    return [
        pa.array(np.diff(ends), pa.int64()),
        pa.array(before[ends[1:]] - before[ends[:-1]], pa.int64()),
        pa.array([sorted(items.get(t, ())) for t in range(len(texts))], pa.list_(pa.string())),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
    ]


def decontaminate(
    docs: DataFrame, items: DataFrame, scratch: Scratch, window: int = 10, block_words: int = 250_000, at_once: int = 8, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` (all) of ``docs`` with the number of words, hit words, items with occurring windows, and spans of hit words.

    A pass over the texts holds ``at_once`` automata at most; between passes the texts are written.
    """
    automata = build_automata(items, scratch, window, block_words)
    names = docs.columns if columns is None else columns
    added = T.StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in ADDED.items())).fields
    kept = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(names)]
    text = T.StructField("_text", T.StringType())
    rows = docs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)], F.col("text").cast("string").alias("_text"))
    for at in range(0, max(len(automata), 1), at_once):
        if at:
            rows = scratch.keep(rows.select(*[f.name for f in kept], "_text", "_b_items", "_b_spans"))
        else:
            rows = rows.withColumns({c: F.lit(None).cast(ADDED[c]) for c in ("_b_items", "_b_spans")})
        last = at + at_once >= len(automata)
        if not last:  # the text goes on to the next pass
            rows = rows.select(*[f.name for f in kept], "_text", F.col("_text").alias("_read"), "_b_items", "_b_spans")
        rows = rows.mapInArrow(_pass(automata[at : at + at_once]), T.StructType([*kept, *([] if last else [text]), *added]))
    return rows.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)], *ADDED)


def remove_hits(judged: DataFrame, most_share: float = 0.5) -> DataFrame:
    """Texts without their hit words; texts of which more than ``most_share`` of the words is hit go.

    Needs all columns of ``decontaminate``. What stands between two words goes with the first of them.
    """
    kept = judged.filter((F.col("_b_hit") == 0) | (F.col("_b_hit") <= F.col("_b_words") * F.lit(float(most_share))))
    # A word and what follows it, from the first word on; what stands before that stays.
    word = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"
    parts = F.regexp_extract_all("text", F.lit(word), F.lit(1))
    head = F.regexp_extract("text", r"^([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", 1)
    # Stretches between the spans.
    gaps = F.transform(
        F.sequence(F.lit(0), F.size("_b_spans")),
        lambda i: F.slice(
            F.col("_parts"),
            (F.when(i == 0, F.lit(0)).otherwise(F.try_element_at("_b_spans", i)["stop"]) + 1).cast("int"),
            (
                F.coalesce(F.try_element_at("_b_spans", i + 1)["start"], F.size("_parts"))
                - F.when(i == 0, F.lit(0)).otherwise(F.try_element_at("_b_spans", i)["stop"])
            ).cast("int"),
        ),
    )
    rest = F.concat(head, F.array_join(F.flatten(gaps), ""))
    text = F.when(F.col("_b_hit") > 0, rest).otherwise(F.col("text"))
    return kept.withColumn("_parts", parts).withColumn("text", text).drop("_parts")


def digest(found: DataFrame) -> DataFrame:
    """What the registered query reports of ``decontaminate``."""
    return found.select(
        "doc_id",
        F.col("_b_words").alias("n_words"),
        F.col("_b_hit").alias("n_hit"),
        F.size("_b_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_b_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("_b_hit") > 0).alias("contaminated"),
    )
