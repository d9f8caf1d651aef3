"""Spelling variants: words one edit apart, found by a frontier that walks a relational trie.

Words are counted over whole texts. All words form a trie, written as an edge table (node, symbol,
child); a second trie holds them backwards. A frontier of states (word, position, node, edits) is joined
with the edge table, level by level. Of two words one edit apart, one has the edit in the second half
of the word that searches, or of that word backwards; so a word enters each trie at the nodes of its
own second half, without an edit, and branches there: into another symbol (edit 1: replaced), or into
a symbol more (edit 1: inserted; a deletion is the insertion of the other word). Then it may only go
on with its own symbols. A state that reaches the end of a word with its own end is a pair.

That keeps the frontier small: nobody branches near the root, where nodes have many words; nodes with
one way on need no state; a node below which there is one word only is a tail, whose rest is compared
at once. A level is joined to one row per (node, symbol), so a node that many words pass is no
product. Nodes are 64-bit hashes of the prefixes, and every pair is confirmed on its words.

A word has at most (2 * length + 1) * alphabet neighbours, so nothing grows with the square of a
group. A word's form is its most frequent neighbour, if that is ``ratio`` times as frequent; roots
follow by pointer doubling, whose rounds are bounded by the logarithm of the largest count, as each
step multiplies the count by ``ratio``.

Defined cases: a null or empty text has no words; the misprints that ``misprint_every`` asks for depend
on doc_id and word only (a null doc_id is written as an empty string); repeated rows count again;
neighbours with equal counts are taken in code-point order; a ``ratio`` above 1 is needed, so that
forms can't lead in a circle; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch
from mixloom.llm.shingles import mix, slices

END = -1  # the symbol after the last of a word
LONG = 64  # bytes; checksums of longer words are taken one by one
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of the texts, A-Z lower-cased, and the offsets of the texts in them."""
    if not len(texts):
        return pa.array([], pa.large_string()), np.zeros(1, dtype=np.int64)
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[int(offsets[0]) : int(offsets[-1])]
    wide = data == _LEAD
    kept = _LETTER[data] | wide
    kept[1:] |= wide[:-1]  # the second byte of such a letter
    plain = np.where(kept, data, 32).astype(np.uint8)
    plain[(plain >= 65) & (plain <= 90)] += 32
    buffers = [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(plain.tobytes())]
    split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), buffers))
    words, ends = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    ends -= ends[0]
    # Splitting leaves empty strings at the ends of a text; they are no words.
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not real.all():
        words = words.filter(pa.array(real))
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
    return words, ends


def checksums(names: list[bytes], owners: np.ndarray, codes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """CRC-32 of ``names[owner] + words[code]``.

    The checksum of a joined string is that of its first part, moved on by as many zero bytes as the
    second has, xor that of the second.
    """
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    own = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    most = int(min(sizes.max(initial=0), LONG))
    moved = np.zeros((most + 1, len(names)), dtype=np.uint32)
    moved[0] = [zlib.crc32(n) for n in names]
    for i in range(most):
        moved[i + 1] = (moved[i] >> np.uint32(8)) ^ _CRC[moved[i] & np.uint32(255)]
    out = moved[np.minimum(sizes, most)[codes], owners] ^ own[codes]
    for at in np.flatnonzero(sizes[codes] > LONG).tolist():
        out[at] = zlib.crc32(words[codes[at]], int(moved[0, owners[at]]))
    return out


def count_words(docs: DataFrame, least_length: int = 6, misprint_every: int = 0) -> DataFrame:
    """``word``, ``n``: letter runs of at least ``least_length`` code points of all texts and how often they occur.

    With ``misprint_every``, a run loses one code point wherever the CRC-32 of ``<doc_id>:<run>`` is a
    multiple of it: the one at the checksum modulo the run's length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                names = batch.column(0).slice(at, len(part))
                at += len(part)
                runs, ends = letter_runs(part)
                coded = runs.dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                vocabulary = coded.dictionary.cast(pa.large_string())
                counts, extra = np.bincount(codes, minlength=len(vocabulary)), {}
                if misprint_every and len(codes):
                    raw = [w.encode() for w in vocabulary.to_pylist()]
                    owners = np.repeat(np.arange(len(part)), np.diff(ends))
                    sums = checksums([f"{n}:".encode() for n in names.to_pylist()], owners, codes, raw)
                    struck = np.flatnonzero(sums % np.uint32(misprint_every) == 0)
                    counts -= np.bincount(codes[struck], minlength=len(vocabulary))
                    for code, h in zip(codes[struck].tolist(), sums[struck].tolist(), strict=True):
                        word = raw[code].decode()
                        drop = h % len(word)
                        word = word[:drop] + word[drop + 1 :]
                        extra[word] = extra.get(word, 0) + 1
                fits = (counts > 0) & (pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False) >= least_length)
                found = vocabulary.filter(pa.array(fits)).to_pylist()
                more = {w: n for w, n in extra.items() if len(w) >= least_length}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*found, *more], pa.string()), pa.array([*counts[fits].tolist(), *more.values()], pa.int64())], names=["word", "n"]
                )

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _paths(words: DataFrame) -> DataFrame:
    """Every position of every word in the second half, forwards and backwards: its node, symbol and child, and hashes of the rest.

    ``follows`` is the symbol after ``symbol``; ``rest`` is of the symbols from the position on, ``tail`` of those after it. Positions begin at the
    third symbol: shorter prefixes are no node that a word enters or passes.
    """

    def hashed(points: np.ndarray, seed: int) -> np.ndarray:
        """Chained hash of every prefix (columns: length) of the rows of ``points``."""
        out = np.empty((len(points), points.shape[1] + 1), dtype=np.uint64)
        out[:, 0] = mix(np.uint64(seed) * np.uint64(0xD6E8FEB86659FD93))  # seeds differ in more bits than symbols do
        for i in range(points.shape[1]):
            out[:, i + 1] = mix((out[:, i] ^ points[:, i]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            words = batch.column(1).to_pylist()
            order = sorted(range(len(words)), key=lambda i: len(words[i]))
            at = 0
            while at < len(order):
                # Words of similar length, two million symbols at most, or one word.
                size = len(words[order[at]])
                stop = at + 1
                while stop < len(order) and len(words[order[stop]]) <= size + 2 and (stop - at) * (size + 3) < 2_000_000:
                    stop += 1
                part = order[at:stop]
                at = stop
                width = len(words[part[-1]])
                raw = b"".join(words[i].ljust(width, "\0").encode("utf-32-le") for i in part)
                points = np.frombuffer(raw, dtype="<u4").reshape(len(part), width).astype(np.uint64)
                sizes = np.fromiter((len(words[i]) for i in part), dtype=np.int64, count=len(part))
                yield from _rows(ids[part], points, sizes)

    def _rows(ids: np.ndarray, points: np.ndarray, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
        count, width = points.shape
        places = np.arange(width)
        back = np.where(places < sizes[:, None], points[np.arange(count)[:, None], (sizes[:, None] - 1 - places) % max(width, 1)], np.uint64(0))
        with np.errstate(over="ignore"):
            for backwards, forth, other in ((False, points, back), (True, back, points)):
                nodes, rests = hashed(forth, 11 + backwards), hashed(other, 21 + backwards)
                row, pos = np.nonzero((np.arange(width + 1) >= 3) & (np.arange(width + 1) <= sizes[:, None]))
                last = pos == sizes[row]
                symbol = np.where(last, END, forth[row, np.minimum(pos, width - 1)].astype(np.int64))
                follows = np.where(pos + 1 < sizes[row], forth[row, np.minimum(pos + 1, width - 1)].astype(np.int64), END)
                child = nodes[row, np.minimum(pos + 1, width)]
                # The hash of the last k symbols is that of the first k backwards.
                rest = rests[row, sizes[row] - pos]
                tail = rests[row, np.maximum(sizes[row] - pos - 1, 0)]
                columns = [ids[row], np.full(len(row), backwards), pos, nodes[row, pos].view(np.int64), symbol, follows, child.view(np.int64), rest.view(np.int64), tail.view(np.int64), sizes[row]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["id", "backwards", "pos", "node", "symbol", "follows", "child", "rest", "tail", "size"]
    kinds = ", ".join(f"{c} {'boolean' if c == 'backwards' else 'long'}" for c in names)
    return words.select("id", "word").mapInArrow(run, kinds)


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of ids (a, b), once each, of words (id, word; distinct, three symbols at least) that are one edit apart."""
    paths = scratch.keep(_paths(words))

    def bit(symbol: str) -> Column:
        return F.expr(f"shiftleft(1L, cast({symbol} & 63 as int))")

    # The edge table. Below an edge with one word, that word's rest is the tail; ``ahead`` is a bit set of
    # the symbols (modulo 64) that lead on from the child.
    edges = paths.groupBy("node", "symbol").agg(
        F.count(F.lit(1)).alias("words"),
        F.min("child").alias("child"),
        F.min("id").alias("only"),
        F.min("tail").alias("only_tail"),
        F.min("size").alias("only_size"),
        F.bit_or(bit("follows")).alias("ahead"),
    )
    edges = scratch.keep(edges)
    # Level 0: own nodes of the second half that lead on in several ways, and all ways from there. An
    # alphabet of them at most.
    ways = F.collect_list(F.struct("symbol", "words", "child", "only", "only_tail", "only_size", "ahead"))
    branching = edges.groupBy("node").agg(ways.alias("ways")).filter("size(ways) > 1")
    start = paths.filter("pos >= floor(size / 2)").join(branching, "node")
    start = start.select("id", "backwards", "pos", "symbol", "rest", "tail", "size", bit("symbol").alias("here"), bit("follows").alias("next"), F.explode("ways").alias("way"))
    start = start.filter((F.col("way.symbol") != END) & (F.col("way.symbol") != F.col("symbol")))
    # Replaced (once for both words: by the larger symbol), or inserted (at the end of a run of the symbol).
    # What can't go on with its own next symbol is no state.
    edits = F.array(
        F.when(
            (F.col("symbol") != END) & (F.col("way.symbol") > F.col("symbol")) & (F.col("way.ahead").bitwiseAND(F.col("next")) != 0),
            F.struct((F.col("pos") + 1).alias("pos"), F.col("tail").alias("rest"), F.lit(0).alias("more")),
        ),
        F.when(F.col("way.ahead").bitwiseAND(F.col("here")) != 0, F.struct("pos", "rest", F.lit(1).alias("more"))),
    )
    branched = start.select("id", "backwards", "size", "way", F.explode(edits).alias("e")).filter("e is not null")
    branched = branched.filter((F.col("way.words") > 1) | ((F.col("way.only_tail") == F.col("e.rest")) & (F.col("way.only_size") == F.col("size") + F.col("e.more"))))
    branched = scratch.keep(branched.select("id", "backwards", "size", "e.pos", "e.more", F.col("way.child").alias("node"), "way.words", "way.only"))
    found = [branched.filter("words = 1").select(F.col("id").alias("a"), F.col("only").alias("b"))]
    # States go on with their own symbols.
    spelled = words.select("id", "word")
    frontier = branched.filter("words > 1").join(spelled, "id")
    frontier = frontier.select("id", F.when(F.col("backwards"), F.reverse("word")).otherwise(F.col("word")).alias("word"), "size", "pos", "more", "node")
    while True:
        ahead = F.when(F.col("pos") < F.col("size"), F.ascii(F.substring("word", F.col("pos").cast("int") + 1, F.lit(1)))).otherwise(F.lit(END))
        level = frontier.withColumn("symbol", ahead.cast("long")).join(edges, ["node", "symbol"])
        level = level.filter((F.col("words") > 1) | (F.col("only_size") == F.col("size") + F.col("more")))
        level = scratch.keep(level.select("id", "word", "size", (F.col("pos") + 1).alias("pos"), "more", F.col("child").alias("node"), "words", "only"))
        found.append(level.filter("words = 1").select(F.col("id").alias("a"), F.col("only").alias("b")))
        frontier = level.filter("words > 1 and pos <= size").select("id", "word", "size", "pos", "more", "node")
        if frontier.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    first = spelled.select(F.col("id").alias("a"), F.col("word").alias("_wa"))
    second = spelled.select(F.col("id").alias("b"), F.col("word").alias("_wb"))
    return pairs.join(first, "a").join(second, "b").filter(F.levenshtein("_wa", "_wb", 1) == 1).select("a", "b")


def spelling_forms(words: DataFrame, scratch: Scratch, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n; words distinct)."""
    if ratio < 2:
        raise ValueError("ratio must be above 1")
    table = scratch.keep(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()))
    pairs = scratch.keep(near_pairs(table, scratch))
    both = pairs.union(pairs.select("b", "a")).toDF("id", "other")
    # A word's best neighbour: the largest count, then the smallest word.
    around = both.join(table.select(F.col("id").alias("other"), F.col("word").alias("_word"), F.col("n").alias("_n")), "other")
    best = around.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_n")).alias("less"), F.col("_word").alias("word"), F.col("other").alias("id"))).alias("top")
    )
    led = table.join(best, "id", "left").withColumn("_led", -F.col("top.less") >= F.col("n") * ratio)
    led = led.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(F.col("_led"), c).alias(name) for name, c in (("form", F.col("top.word")), ("form_n", -F.col("top.less")), ("to", F.col("top.id")))],
    )
    led = scratch.keep(led)
    # Each step multiplies the count by ratio at least, so a way has that many steps at most; doubled each round.
    low, high = table.agg(F.min("n"), F.max("n")).first()
    steps = math.log(high / max(low, 1), ratio) if high else 0
    hops = led.filter("to is not null").select("id", "to", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1)) if steps > 0 else 0):
        ahead = hops.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("root").alias("_root"))
        hops = scratch.keep(hops.join(ahead, "to", "left").select("id", F.coalesce("_to", "to").alias("to"), F.coalesce("_root", "root").alias("root")))
    out = led.join(hops.select("id", "root"), "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, scratch: Scratch, least_length: int = 6, least_count: int = 5, ratio: int = 5, misprint_every: int = 0) -> DataFrame:
    """``spelling_forms`` of the words of ``docs`` (doc_id, text) with at least ``least_length`` code points and ``least_count`` occurrences."""
    if least_length < 6:
        raise ValueError("words of fewer than six letters enter the trie too near to the root")
    counted = scratch.keep(count_words(docs, least_length, misprint_every).filter(F.col("n") >= least_count))
    return spelling_forms(counted, scratch, ratio)
