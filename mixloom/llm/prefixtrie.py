"""Conversation prefix trie: shared beginnings of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is a head, taken from the first turns of a base conversation, and a suffix of a
conversation's own turns. The fingerprint of a sequence of turns is the polynomial sum of x_i * g^i over
its turn values x_i, modulo primes of 31 bits; together with the number of turns it is a monoid: the
product of two sequences is (m + n, A + g^m * B). So the fingerprint of every prefix of every rebuilt
conversation follows from prefix fingerprints of the original ones: the head's, and the difference of
two of the own ones, shifted by a power of g. No rebuilt text is ever made.

Prefix fingerprints of the originals are a distributed scan: rows are dealt out by range of
(conversation, turn), each range is scanned on its own, and the products of whole ranges are combined
for the few conversations that cross from one range to the next. A conversation may hold any share of
the rows.

Nodes are groups of equal depth and fingerprint. A group is one sequence if its members have one
previous fingerprint and one last turn; and turns with one value are equal if their stored role and
text are: both are checked, through the texts that the turn values refer to, and the search starts
again with other constants if ever they differ.

Sums over subtrees need no walk. Of the members of a node, each owns the nodes of which it is the
smallest member; these are the lower end of its path. So the distinct nodes below a node are the owned
nodes of its members, and sums over them are sums over members, one aggregate.

Defined cases: a null role or text is an empty one; turns with a null number come first; turns of a
conversation with the same number are ordered by the SHA-256 of role and text; a null conv_id is no
conversation; a base that is not there gives no head; a conversation may be rebuilt without turns and
belongs to the root then; an empty table has no node, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch

#: Primes below 2^31: products of two residues fit a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
PRINTS = [f"f{i}" for i in range(len(PRIMES))]  # fingerprints up to and with a turn
TERMS = [f"t{i}" for i in range(len(PRIMES))]  # what the turn itself adds to them
KEY = ["depth", "k0", "k1"]
PIECE_IDS = 512  # ids that are written into one piece of text


def _bases(seed: int) -> list[int]:
    rng = np.random.default_rng(7919 + seed)
    return [int(rng.integers(1 << 20, p - 1)) for p in PRIMES]


def _turn_rows(turns: DataFrame, seed: int) -> DataFrame:
    """conv, turn, value of the turn's role and text, its code points, and a digest that orders ties."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.select(
        "conv",
        "turn",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("tie"),
        F.xxhash64(F.lit(seed), "role", "text").alias("x"),
        F.length("text").cast("long").alias("chars"),
    )


def _values_clash(turns: DataFrame, seed: int) -> bool:
    """Whether turns of one value differ in role or text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id is not null").select(role.alias("role"), text.alias("text")).withColumn("x", F.xxhash64(F.lit(seed), "role", "text"))
    stored = rows.groupBy("x", "role", "text").agg(F.lit(1).alias("_one"))
    return not stored.groupBy("x").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


SCANNED = ["range", "conv", "at", "x", "chars", "before", *PRINTS, *TERMS]


def _scan(bases: list[int]):
    """Number, prefix fingerprints and code points before, of the turns of each conversation within a range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before_conv, count, length = None, 0, 0
        prints = [0] * len(PRIMES)
        for batch in batches:
            conv, x, chars = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            n = len(conv)
            if not n:
                continue
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.concatenate([first, [n]]))
            goes_on = before_conv == conv[0]
            local = np.arange(n) - np.repeat(first, sizes)
            local[: sizes[0]] += count if goes_on else 0
            total = np.cumsum(chars)
            chars_before = total - chars - np.repeat((total - chars)[first], sizes)
            chars_before[: sizes[0]] += length if goes_on else 0
            columns, added = [batch.column(0), batch.column(1), pa.array(local), batch.column(2), batch.column(3), pa.array(chars_before)], []
            most = int(local.max()) + 1
            for i, (p, g) in enumerate(zip(PRIMES, bases, strict=True)):
                terms = (x.view(np.uint64) % np.uint64(p)).astype(np.int64) * _powers(g, p, most)[local] % p
                sums = np.cumsum(terms)  # below 2^31 each
                sums = sums - np.repeat((sums - terms)[first], sizes)
                sums[: sizes[0]] += prints[i] if goes_on else 0
                sums %= p
                columns.append(pa.array(sums))
                added.append(pa.array(terms))
                prints[i] = int(sums[-1])
            before_conv, count, length = conv[-1], int(local[-1]) + 1, int(chars_before[-1] + chars[-1])
            yield pa.RecordBatch.from_arrays([*columns, *added], names=SCANNED)

    return run


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(g: int, p: int, n: int) -> np.ndarray:
    """g^0 .. g^(n-1) modulo p, by doubling."""
    held = _POWERS.get((g, p), np.ones(1, dtype=np.int64))
    while len(held) < n:
        held = np.concatenate([held, held * pow(g, len(held), p) % p])
    _POWERS[g, p] = held
    return held


def _times(a: Column, factor: Column, p: int) -> Column:
    return (a * factor) % F.lit(p)


def prefix_products(turns: DataFrame, scratch: Scratch, seed: int = 0) -> DataFrame:
    """conv, at (from 0), value, code points, code points before, and the fingerprint up to and with each turn."""
    bases = _bases(seed)
    spark = scratch.spark
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("tie")]
    dealt = _turn_rows(turns, seed).repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = dealt.select(F.spark_partition_id().cast("long").alias("range"), "conv", "x", "chars")
    local = scratch.keep(rows.mapInArrow(_scan(bases), ", ".join(f"{c} long" for c in SCANNED)))
    # Products of whole ranges, for conversations that lie in several: one row per range but the first at most.
    ends = local.groupBy("conv", "range").agg(F.max_by(F.struct("at", (F.col("before") + F.col("chars")).alias("chars"), *PRINTS), "at").alias("e"))
    several = local.groupBy("conv").agg(F.min("range").alias("a"), F.max("range").alias("b")).filter("a < b").select("conv")
    crossing = ends.join(several, "conv", "left_semi")
    carried = []
    state: dict[int, tuple] = {}
    for row in crossing.orderBy("conv", "range").toLocalIterator():
        done, e = state.get(row["conv"], (0, 0, *[0] * len(PRIMES))), row["e"]
        shift = [pow(g, done[0], p) for g, p in zip(bases, PRIMES, strict=True)]
        carried.append((row["conv"], row["range"], done[0], done[1], *done[2:], *shift))
        prints = [(a + s * e[f]) % p for a, s, f, p in zip(done[2:], shift, PRINTS, PRIMES, strict=True)]
        state = {row["conv"]: (done[0] + e["at"] + 1, done[1] + e["chars"], *prints)}
    if not carried:
        return local.drop("range")
    names = ["conv", "range", "_at", "_before", *[f"_c{f}" for f in PRINTS], *[f"_s{f}" for f in PRINTS]]
    carry = F.broadcast(spark.createDataFrame(carried, ", ".join(f"{c} long" for c in names)))
    joined = local.join(carry, ["conv", "range"], "left")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    terms = [_times(F.col(t), F.coalesce(F.col(f"_s{f}"), one), p).alias(t) for t, f, p in zip(TERMS, PRINTS, PRIMES, strict=True)]
    whole = [((F.coalesce(F.col(f"_c{f}"), zero) + _times(F.col(f), F.coalesce(F.col(f"_s{f}"), one), p)) % F.lit(p)).alias(f) for f, p in zip(PRINTS, PRIMES, strict=True)]
    at, before = F.col("at") + F.coalesce("_at", zero), F.col("before") + F.coalesce("_before", zero)
    return joined.select("conv", at.alias("at"), "x", "chars", before.alias("before"), *whole, *terms)


def head_turns(conv: Column, most: int) -> Column:
    """Turns that a rebuilt conversation takes from its base: by checksum, 0 to ``most``."""
    return F.crc32(conv.cast("string").cast("binary")) % (most + 1)


def rebuilt_prefixes(products: DataFrame, scratch: Scratch, seed: int, every: int = 100, most_head: int = 5) -> DataFrame:
    """The prefixes of all rebuilt conversations, from the empty one on.

    conv, depth, key and key of the prefix before, value and code points of the last turn, code points
    before it, turns and code points of the whole conversation.
    """
    bases = _bases(seed)
    conv, zero = F.col("conv"), F.lit(0).cast("long")
    # One row per conversation: its size, and its first turns.
    start = F.when(F.col("at") < most_head, F.struct("at", "x", "chars", "before", *PRINTS, *TERMS))
    total = F.max(F.col("before") + F.col("chars")).alias("total")
    facts = scratch.keep(products.groupBy("conv").agg(F.max(F.col("at") + 1).alias("n"), total, F.array_sort(F.collect_list(start)).alias("first")))
    heads = facts.filter(conv % every == 0).select(conv.alias("base"), F.col("first").alias("head"))
    plans = facts.withColumn("base", conv - conv % every).withColumn("h", head_turns(conv, most_head)).join(heads, "base", "left")
    plans = plans.withColumn("head", F.slice(F.coalesce("head", F.slice("first", 1, 0)), 1, F.col("h").cast("int")))
    last = F.try_element_at("head", F.lit(-1))
    cut = F.when(F.col("h") > 0, F.try_element_at("first", F.least(F.col("h").cast("int"), F.size("first"))))

    def of(end: Column, field: str) -> Column:
        return F.coalesce(end[field], zero)

    head_chars, cut_chars = of(last, "before") + of(last, "chars"), of(cut, "before") + of(cut, "chars")
    own_turns = F.col("n") - F.least("h", "n")
    plans = plans.select(
        "conv",
        "head",
        "h",
        F.size("head").cast("long").alias("taken"),
        (F.size("head") + own_turns).alias("turns"),
        (head_chars + F.col("total") - cut_chars).alias("all_chars"),
        (head_chars - cut_chars).alias("moved"),
        *[of(last, f).alias(f"_h{f}") for f in PRINTS],
        *[of(cut, f).alias(f"_k{f}") for f in PRINTS],
    )
    plans = scratch.keep(plans)
    # The rest of the own turns: what lies between the cut and the turn, shifted to stand behind the head.
    own = products.join(plans.drop("head"), "conv").filter("at >= h")
    prints, terms = [], []
    for f, t, p, g in zip(PRINTS, TERMS, PRIMES, bases, strict=True):
        shifts = F.array(*[F.lit(pow(g, e, p)).cast("long") for e in range(-most_head, most_head + 1)])
        shift = F.element_at(shifts, (F.col("taken") - F.col("h") + most_head + 1).cast("int"))
        between = (F.col(f) - F.col(f"_k{f}") + F.lit(p)) % F.lit(p)
        prints.append(((F.col(f"_h{f}") + _times(between, shift, p)) % F.lit(p)).alias(f))
        terms.append(_times(F.col(t), shift, p).alias(t))
    depth = (F.col("at") - F.col("h") + F.col("taken") + 1).alias("depth")
    whole = ["turns", "all_chars"]
    tail = own.select("conv", depth, "x", "chars", (F.col("before") + F.col("moved")).alias("before"), *prints, *terms, *whole)
    first = plans.select("conv", F.explode("head").alias("t"), *whole)
    first = first.select("conv", (F.col("t.at") + 1).alias("depth"), "t.x", "t.chars", "t.before", *[F.col(f"t.{c}") for c in (*PRINTS, *TERMS)], *whole)
    root = plans.select("conv", *[zero.alias(c) for c in ("depth", "x", "chars", "before", *PRINTS, *TERMS)], *whole)
    rows = tail.unionByName(first).unionByName(root)
    # Two longs for four residues.
    pairs = ((0, 1, "0"), (2, 3, "1"))
    key = [(F.col(PRINTS[a]) * F.lit(1 << 31) + F.col(PRINTS[b])).alias(f"k{c}") for a, b, c in pairs]
    less = [(F.col(f) - F.col(t) + F.lit(p)) % F.lit(p) for f, t, p in zip(PRINTS, TERMS, PRIMES, strict=True)]
    previous = [(less[a] * F.lit(1 << 31) + less[b]).alias(f"p{c}") for a, b, c in pairs]
    return rows.select("conv", "depth", *key, *previous, "x", "chars", "before", *whole)


def _member_digests(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """Key and SHA-256 of the members (conv, ascending, comma-joined) of every node where conversations end.

    Ids are sorted and written out by range; only their joined pieces meet, and are streamed through the hash.
    """
    ranges = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["k0", "k1", "depth", "conv"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            table = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            n = batch.num_rows
            change = np.ones(n, dtype=bool)
            change[1:] = np.any([c[1:] != c[:-1] for c in table[1:4]], axis=0) if n > 1 else False
            first = np.flatnonzero(change)
            within = np.arange(n) - np.repeat(first, np.diff(np.concatenate([first, [n]])))
            first = np.flatnonzero(within % PIECE_IDS == 0)
            ids, stops = table[4].tolist(), [*first[1:].tolist(), n]
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(first.tolist(), stops, strict=True)]
            pieces = pa.array(np.arange(number, number + len(first)))
            number += len(first)
            yield pa.RecordBatch.from_arrays([*[pa.array(c[first]) for c in table[:4]], pieces, pa.array(texts, pa.string())], names=["range", "k0", "k1", "depth", "piece", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            out = []
            for *key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == held:
                    state.update(b"," + text.encode())
                else:
                    if held is not None:
                        out.append((*held, state.hexdigest()))
                    held, state = key, hashlib.sha256(text.encode())
            yield _digest_batch(out)
        if held is not None:
            yield _digest_batch([(*held, state.hexdigest())])

    dealt = ends.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = dealt.select(F.spark_partition_id().cast("long").alias("range"), *order)
    pieces = scratch.keep(rows.mapInArrow(joined, "range long, k0 long, k1 long, depth long, piece long, ids string"))
    met = pieces.repartition(ranges, *KEY).sortWithinPartitions("k0", "k1", "depth", "range", "piece").select("k0", "k1", "depth", "ids")
    return met.mapInArrow(hashed, "k0 long, k1 long, depth long, sha string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["k0", "k1", "depth", "sha"])


def prefix_trie(turns: DataFrame, scratch: Scratch, every: int = 100, most_head: int = 5) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    for seed in range(8):
        trie = None if _values_clash(turns, seed) else _trie(turns, scratch, seed, every, most_head)
        if trie is not None:
            return trie
    raise RuntimeError("turn values or fingerprints clash under eight seeds")


def _trie(turns: DataFrame, scratch: Scratch, seed: int, every: int, most_head: int) -> DataFrame | None:
    """The nodes, or nothing if a fingerprint stands for two sequences."""
    products = scratch.keep(prefix_products(turns, scratch, seed))
    rows = scratch.keep(rebuilt_prefixes(products, scratch, seed, every, most_head))
    one = ("x", "p0", "p1")
    nodes = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("rep"),
        F.max("before").alias("before"),
        *[F.min(c).alias(c) for c in one],
        *[F.max(c).alias(f"_{c}") for c in one],
    )
    nodes = scratch.keep(nodes)
    if not nodes.filter(" or ".join(f"{c} <> _{c}" for c in one)).isEmpty():
        return None
    nodes = nodes.select(*KEY, "n", "rep", "before", "p0", "p1")
    above = [(F.col("depth") - 1).alias("depth"), F.col("p0").alias("k0"), F.col("p1").alias("k1")]
    below = nodes.filter("depth > 0").select(*above).groupBy(*KEY).agg(F.count(F.lit(1)).alias("children"))
    nodes = scratch.keep(nodes.join(below, KEY, "left").withColumn("children", F.coalesce("children", F.lit(0).cast("long"))))
    # What each conversation owns: nodes from some depth on, and the leaf at its end.
    owned = nodes.groupBy("rep").agg(F.min("before").alias("from"), F.max((F.col("children") == 0).cast("long")).alias("leaf")).withColumnRenamed("rep", "conv")
    zero = F.lit(0).cast("long")
    members = rows.join(owned, "conv", "left").select(
        *KEY, "conv", "all_chars", F.coalesce(F.col("all_chars") - F.col("from"), zero).alias("own"), F.coalesce("leaf", zero).alias("leaf")
    )
    sums = members.groupBy(*KEY).agg(
        F.sum("all_chars").alias("all"), F.sum("own").alias("own"), F.sum("leaf").alias("leaves"), F.min_by("all_chars", "conv").alias("rep_all"), F.min_by("own", "conv").alias("rep_own")
    )
    digests = _member_digests(rows.filter("depth = turns").select(*KEY, "conv"), scratch)
    parents = nodes.select(F.col("depth").alias("_d"), F.col("k0").alias("p0"), F.col("k1").alias("p1"), F.col("rep").alias("parent"))
    found = nodes.join(sums, KEY).join(digests, KEY, "left").withColumn("_d", F.col("depth") - 1).join(parents, ["_d", "p0", "p1"], "left")
    # Turns of all members below the node, less those of the distinct nodes there.
    distinct = F.col("rep_all") - F.col("before") + F.col("own") - F.col("rep_own")
    return found.select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("all") - F.col("n") * F.col("before") - distinct).alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
