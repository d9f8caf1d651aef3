"""Packing whole documents into token windows by deficit round-robin over sources.

Every source is a queue of its documents' token pieces. In each round a source may send its quantum,
its share of the target mixture of one window; what it cannot send yet is its deficit and stays for
the next round. A piece whose last token is the c-th of its queue is therefore sent in the first
round whose quanta add up to c: the round is a formula of the queue position, and so are all
deficits, across windows and partitions. The pieces in order of round, source and queue position are
laid end to end and cut where a window is full, so every window but the last is full, and over any
number of windows a source is ahead or behind its target by no more than one piece.

Queue positions and window offsets are running sums over blocks of bounded size and over block
totals. Token ids are made once, stored as 16- or 32-bit integers, and only looked up again for the
checksums; the layout works on counts.

Defined cases: a null or empty text has only the end token; a null source is a queue of its own;
repeated rows are packed one by one; an empty table gives no piece.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.running import running_total
from mixloom.llm.scratch import Scratch
from mixloom.llm.shingles import slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
CACHED_WORDS = 600_000  # per Python worker; a full cache starts anew


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of an installed public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of a tokenizer whose tokens don't cross white space, with the ids of known words kept.

    A text is split at ASCII white space, and every distinct word of a batch is encoded once. If the
    tokenizer folds case and splits marks from letters, words that are letters with one mark at
    most are looked up as folded letters and mark; all other words are encoded as they are. The ids
    of the texts are then gathered by word.
    """

    LETTERS = "A-Za-zÀ-ÖØ-öø-į"  # none of these composes with another or changes length when folded

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        # Words without the string of an added token are encoded alone; texts with one as they are.
        self.whole = Tokenizer.from_file(path)
        self.added = [t.content for t in t.get_added_tokens_decoder().values() if t.content]
        t.encode_special_tokens = True
        self.code = "H" if t.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code).newbyteorder("<")
        self.end = array(self.code, [end_id]).tobytes()
        self.folds = bool(
            t.normalizer
            and t.pre_tokenizer
            and t.normalizer.normalize_str("Aé ÉZ") == "aé éz"
            and [len(t.pre_tokenizer.pre_tokenize_str(x)) for x in ("aé", "aé.", "aé,", "aé éz")] == [1, 2, 2, 2]
        )
        self.known: dict[str, bytes] = {}

    def _plain(self, words: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of folded words of letters: one pre-token each."""
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ".join(words))
        if len(pieces) != len(words):
            return self._plain(words)
        tokenize = self.tokenizer.model.tokenize
        return [array(self.code, [t.id for t in tokenize(piece)]).tobytes() for piece, _ in pieces]

    def _lookup(self, keys: list[str]) -> list[bytes]:
        """Ids of distinct keys: folded letters, or a space and any word."""
        known = self.known
        if len(known) > CACHED_WORDS:
            known = self.known = {}
        fresh = [k for k in keys if k not in known]
        letters = [k for k in fresh if k[0] != " "]
        known.update(zip(letters, self._letters(letters), strict=True))
        others = [k for k in fresh if k[0] == " "]
        known.update(zip(others, self._plain([k[1:] for k in others]), strict=True))
        return [known[k] for k in keys]

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, end to end, and how many each word has."""
        n = len(words)
        if self.folds:
            letters = pc.match_substring_regex(words, f"^[{self.LETTERS}]+[.,]?$")
            bare = pc.utf8_rtrim(words, characters=".,")
            keys = pc.if_else(letters, pc.utf8_lower(bare), pc.binary_join_element_wise(" ", words, ""))
            marked = pc.and_(letters, pc.not_equal(pc.binary_length(words), pc.binary_length(bare)))
            mark = np.where(marked.to_numpy(zero_copy_only=False), np.where(pc.ends_with(words, ",").to_numpy(zero_copy_only=False), 2, 1), 0)
        else:
            keys, mark = pc.binary_join_element_wise(" ", words, ""), np.zeros(n, dtype=np.int64)
        coded = keys.dictionary_encode()
        parts = [*self._lookup(coded.dictionary.to_pylist()), b"", *self._plain([".", ","])]
        first = coded.indices.to_numpy(zero_copy_only=False)
        both = np.column_stack([first, len(parts) - 3 + mark]).reshape(-1)
        ids, sizes = self._gather(parts, both)
        return ids, sizes.reshape(n, 2).sum(axis=1)

    def _gather(self, parts: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, parts), dtype=np.int32, count=len(parts)) // self.dtype.itemsize
        return gather(np.frombuffer(b"".join(parts), dtype=self.dtype), lengths, codes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text followed by the end id, and the offsets of the texts in them."""
        special = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            special |= pc.fill_null(pc.match_substring(texts, token, ignore_case=True), False).to_numpy(zero_copy_only=False)
        if not special.any():
            return self._encode_words(texts)
        ids, offsets = self._encode_words(pc.if_else(pa.array(special), "", texts))
        at = np.flatnonzero(special)
        parts = [np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype=self.dtype) for i in at.tolist()]
        sizes = np.diff(offsets)
        sizes[at] += np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        # Before the end id of their text.
        pieces = np.split(ids, offsets[at])
        joined = [pieces[0], *[x for pair in zip(parts, pieces[1:], strict=True) for x in pair]]
        return np.concatenate(joined), np.concatenate([[0], np.cumsum(sizes)])

    def _encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = split.flatten().dictionary_encode()
        words = flat.dictionary
        pool, lengths = self._ids_of(words)
        pool = np.append(pool, np.frombuffer(self.end, dtype=self.dtype))
        offsets = split.offsets.to_numpy().astype(np.int64)
        codes = np.insert(flat.indices.to_numpy(zero_copy_only=False), offsets[1:] - offsets[0], len(words))
        ids, sizes = gather(pool, np.append(lengths, 1), codes)
        return ids, np.concatenate([[0], np.cumsum(sizes)[codes == len(words)]])


def gather(pool: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``pool`` that ``codes`` name, end to end, and their sizes."""
    first = np.cumsum(lengths) - lengths
    sizes = lengths[codes]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(first[codes] - (ends - sizes), sizes) + np.arange(total)], sizes


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, source, number of tokens and ids (bytes) of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(tokenizer, end_id)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(2)):
                ids, offsets = words.encode(texts)
                data = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(texts),
                    [None, pa.py_buffer(offsets * words.dtype.itemsize), pa.py_buffer(ids)],
                )
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(offsets)), data.cast(pa.binary())],
                    names=["doc_id", "source", "n", "ids"],
                )

    return rows.mapInArrow(run, "doc_id long, source string, n long, ids binary")


def layout(sizes: DataFrame, window: int, piece: int, scratch: Scratch, shares: dict[str, float] | None = None) -> DataFrame:
    """Pieces of the documents ``sizes`` (row, source, n): row, start, length, sequence_id, offset.

    ``shares`` are the target proportions by source; by default those of the tokens themselves, with
    which all queues end in the same round. A source without a share is sent after all others.
    """
    sizes = sizes.withColumn("_queue", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    queues = sizes.groupBy("_queue").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    whole = queues.agg(F.sum("tokens").alias("all_tokens"), F.sum("docs").alias("all_docs")).first()
    all_tokens, all_docs = whole["all_tokens"] or 1, whole["all_docs"] or 1
    if shares is None:
        quantum = F.col("tokens") * F.lit(window / all_tokens)
    else:
        given = F.create_map(*[F.lit(x) for k, v in shares.items() for x in (f"={k}", v / sum(shares.values()))])
        quantum = F.coalesce(F.try_element_at(given, F.col("_queue")), F.lit(1e-9)) * window
    queues = queues.select("_queue", quantum.alias("quantum"))

    # Queue positions. A block has about 4,096 documents of all sources together.
    blocks = -(-all_docs // 4096)
    placed = running_total(sizes, ["_queue"], F.pmod(F.xxhash64("row"), F.lit(blocks)), ["row"], "n", "at")
    placed = scratch.keep(placed.join(queues, "_queue"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(piece).cast("long"))
    pieces = placed.select("row", "_queue", "quantum", "at", "n", F.explode(starts).alias("start")).withColumn(
        "length", F.least(F.lit(piece).cast("long"), F.col("n") - F.col("start"))
    )
    end = F.col("at") + F.col("start") + F.col("length")
    pieces = pieces.withColumn("round", F.ceil(end / F.col("quantum"))).withColumn("end", end)

    # Window offsets: a block has 64 rounds, that is about as many windows.
    laid = running_total(pieces, [], F.floor(F.col("round") / 64), ["round", "_queue", "end"], "length", "to")
    first = F.floor(F.col("to") / window)
    room = (first + 1) * window - F.col("to")
    head = F.struct(
        "start", F.least("length", room).alias("length"), first.alias("sequence_id"), (F.col("to") - first * window).alias("offset")
    )
    tail = F.struct(
        (F.col("start") + room).alias("start"),
        (F.col("length") - room).alias("length"),
        (first + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    cut = F.when(F.col("length") > room, F.array(head, tail)).otherwise(F.array(head))
    return laid.select("row", F.explode(cut).alias("x")).select("row", "x.*")


def pack(
    docs: DataFrame,
    scratch: Scratch,
    tokenizer: str,
    end_id: int = 2,
    window: int = 4096,
    piece: int = 256,
    shares: dict[str, float] | None = None,
) -> DataFrame:
    """One row per piece of a document: where it starts in it, and its sequence and place there.

    ``ids_crc32`` is the checksum of the piece's ids as little-endian unsigned 32-bit integers. A
    piece has at most ``piece`` tokens and lies in one sequence of at most ``window`` tokens.
    """
    if piece > window:
        raise ValueError("a piece can't be longer than a window")
    table = token_table(docs, tokenizer, end_id).withColumn("row", F.monotonically_increasing_id())
    # Written once: row numbers, counts and ids stay the same for all that follows.
    tokens = scratch.keep(table, compression="zstd")
    places = layout(tokens.select("row", "source", "n"), window, piece, scratch, shares)
    place = F.struct("start", "length", "sequence_id", "offset")
    # A document's pieces are as many as its own length asks for.
    per_doc = places.groupBy("row").agg(F.collect_list(place).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(3)
            flat = places.flatten()
            counts = pc.list_value_length(places).to_numpy(zero_copy_only=False)
            start, length, sequence, offset = (flat.field(i) for i in range(4))
            width = batch.column(1).to_numpy(zero_copy_only=False)
            sums, at = [], 0
            begins, sizes = start.to_pylist(), length.to_pylist()
            for data, n, count in zip(batch.column(2), width.tolist(), counts.tolist(), strict=True):
                raw = data.as_buffer()
                ids = np.frombuffer(raw, dtype=f"<u{raw.size // n}").astype("<u4").view(np.uint8).data
                for i in range(at, at + count):
                    sums.append(zlib.crc32(ids[4 * begins[i] : 4 * (begins[i] + sizes[i])]))
                at += count
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts))),
                    start,
                    length,
                    pa.array(sums, pa.int64()),
                    pa.array(np.repeat(width, counts)),
                    sequence,
                    offset,
                ],
                names=[part.split()[0] for part in PIECES.split(", ")],
            )

    return tokens.join(per_doc, "row").select("doc_id", "n", "ids", "places").mapInArrow(run, PIECES)
