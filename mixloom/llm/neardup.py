"""Near-duplicates: MinHash signatures, a multi-index Hamming join, and a check on the full shingle sets.

Texts with equal shingle sets form a class and go on as one. A class has a signature of
``chunks`` x 8 one-byte MinHash values. Two signatures that differ in fewer than 2 * ``chunks``
values have, by the pigeonhole principle, a chunk with at most one difference; so each chunk is
looked up with each of its values left out in turn, and every pair below that distance meets. Pairs
further apart meet too, unless every chunk has two differences. There are as many chunks as make the
chance of that 3e-6 or less for a pair just at the threshold: 12 at a similarity of 0.85 (0.34 per
chunk), 19 at 0.8 (0.49).

Classes that meet are not paired all with all. First, every class is compared with one lead of its
buckets, on the full sets, and what is linked is joined to components. Only buckets that still
hold different components go on. Small ones pair their members across components. The members of
large ones are gathered to groups, and a link in a group shows in the rare shingles of its sets: in
any order of the shingles, two linked sets share one of their first few, as many as may differ and
one more. The order is by how many sets of the group hold a shingle, so pages of one template, which
meet but are just too different, share none of them and are never compared. Shingles that many sets
have among their first are left to blocks, which are compared block by block and give back a spanning
forest of the links. So no links between different texts are lost, and no group meets in one task.

Defined cases: a null text, or one without words, has no shingles and is linked with nothing; rows
that share doc_id are one document, also if their texts differ; a row without doc_id links nothing,
it carries the component of its shingle set if a document has the same; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.components import connected_components
from mixloom.llm.scratch import Scratch
from mixloom.llm.shingles import mix, shingle_sets

CHUNK = 8  # values (bytes) per chunk: one 64-bit word
CELL_BITS = 17  # a group's shingles are counted in this many bits of their hash
SLICE_BITS = 12  # and the counts go on in slices of this many bits


def chunks_for(percent: int, missed: float = 3e-6) -> int:
    """Fewest chunks with which a pair at the threshold has two differences in each with a chance of ``missed`` at most."""
    differing = (1 - percent / 100) * 255 / 256
    apart = 1 - (1 - differing) ** CHUNK - CHUNK * differing * (1 - differing) ** (CHUNK - 1)
    return max(1, math.ceil(math.log(missed) / math.log(apart))) if apart > 0 else 1


def _permutations(values: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240)
    return rng.integers(1, 1 << 31, values, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, values, dtype=np.uint32)


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray, step: int = 4096) -> np.ndarray:
    """One byte of the smallest image of the set under each permutation."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), step):
        images = np.multiply.outer(factors, short[at : at + step])
        images += shifts[:, None]
        np.minimum(least, images.min(axis=1), out=least)
    return (mix(least.astype(np.uint64) + np.uint64(1)) >> np.uint64(56)).astype(np.uint8)


def signatures(docs: DataFrame, width: int, chunks: int) -> DataFrame:
    """doc_id, set size, two set digests and the signature of every text."""
    factors, shifts = _permutations(chunks * CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, marks = [], [], [], []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column(1), width):
                    sizes.append(len(s))
                    first.append(s.sum(dtype=np.uint64))
                    second.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    marks.append(signature(s, factors, shifts).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.array(first, dtype=np.uint64).view(np.int64)),
                    pa.array(np.array(second, dtype=np.uint64).view(np.int64)),
                    pa.array(marks, pa.binary()),
                ],
                names=["doc_id", "n", "h1", "h2", "sig"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, sig binary")


def _keys(classes: DataFrame, chunks: int) -> DataFrame:
    """For every chunk and every value left out: a key that says which, and the seven values that remain."""
    drops = np.arange(CHUNK, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = (np.uint64(1) << (drops * np.uint64(8))) - np.uint64(1)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                words = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype="<u8").reshape(len(ids), chunks, 1)
                low = words & below
                high = (words >> np.uint64(8)) & ~below
                # One to one for up to 32 chunks; beyond, a rare clash only lets more pairs meet.
                tag = np.arange(chunks * CHUNK, dtype=np.uint64).reshape(1, chunks, CHUNK) * np.uint64(0x9E3779B97F4A7C15)
                keys = ((low | high) << np.uint64(8)) ^ tag
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, chunks * CHUNK))],
                    names=["key", "id"],
                )

    return classes.select("id", "sig").mapInArrow(run, "key long, id long")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted distinct arrays."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (small + large - shared)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rights = shingle_sets(part.column(3), width)
                ids, last, left, keep = part.column(0).to_pylist(), None, None, []
                texts_a = part.column(2)
                for i, right in enumerate(rights):
                    if ids[i] != last:
                        last, left = ids[i], next(shingle_sets(texts_a.slice(i, 1), width))
                    keep.append(linked(left, right, percent))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _close(pairs: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """The pairs whose signatures differ in at most ``most`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3)]
            keep = (sides[0] != sides[1]).sum(axis=1) <= most if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(classes.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
    both = with_b.join(classes.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _block_links(rows: DataFrame, width: int, percent: int, most: int, chunks: int) -> DataFrame:
    """Links between members of a group in different components, as a spanning forest per pair of blocks.

    ``rows``: grp, i, j (the blocks of the pair), id, component, block, text.
    """
    factors, shifts = _permutations(chunks * CHUNK)

    def run(table: pa.Table) -> pa.Table:
        ids, comps, blocks = (table.column(c).to_pylist() for c in ("id", "component", "block"))
        sets = list(shingle_sets(table.column("text").combine_chunks(), width))
        marks = np.array([signature(s, factors, shifts) for s in sets])
        first, second = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        root = {c: c for c in comps}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        right = np.array([i for i, b in enumerate(blocks) if b == second])
        for i in (i for i, b in enumerate(blocks) if b == first):
            for j in right[(marks[right] != marks[i]).sum(axis=1) <= most]:
                if (first != second or j > i) and find(comps[i]) != find(comps[j]) and linked(sets[i], sets[j], percent):
                    root[find(comps[i])] = find(comps[j])
                    found.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return rows.groupBy("grp", "i", "j").applyInArrow(run, "a long, b long")


def _levels(members: DataFrame, width: int) -> DataFrame:
    """Per group and slice of cells, how many sets hold shingles of a cell: one byte, the binary logarithm. ``members``: grp, text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            for at in np.unique(groups):
                own = batch.column(1).filter(pa.array(groups == at))
                parts = [np.unique(s >> np.uint64(64 - CELL_BITS)) for s in shingle_sets(own, width)]
                cells, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), at)), pa.array(cells.astype(np.int32)), pa.array(n.astype(np.int64))], names=["grp", "cell", "n"]
                )

    def gather(table: pa.Table) -> pa.Table:
        levels = np.zeros(1 << SLICE_BITS, dtype=np.uint8)
        levels[table.column("cell").to_numpy() & ((1 << SLICE_BITS) - 1)] = np.log2(table.column("n").to_numpy()).astype(np.uint8) + 1
        return pa.table({"grp": table.column("grp")[:1], "slice": table.column("slice")[:1], "levels": pa.array([levels.tobytes()], pa.binary())})

    counted = members.select("grp", "text").mapInArrow(count, "grp long, cell int, n long").groupBy("grp", "cell").agg(F.sum("n").alias("n"))
    sliced = counted.withColumn("slice", F.shiftright("cell", SLICE_BITS))
    return sliced.groupBy("grp", "slice").applyInArrow(gather, "grp long, slice int, levels binary")


def prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """How many first shingles of a set of ``n`` meet those of a linked set: one that is not smaller, and any."""
    return n - -(-2 * percent * n // (100 + percent)) + 1, n - -(-percent * n // 100) + 1


def _prefixes(members: DataFrame, levels: DataFrame, width: int, percent: int) -> DataFrame:
    """First shingles of every set in the order of its group; ``inner`` are those that meet any set that is not smaller.

    ``members``: grp, block, id, component, text.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, sizes, counts, inner = [], [], [], []
        if left.num_rows:
            order = np.zeros((1 << (CELL_BITS - SLICE_BITS), 1 << SLICE_BITS), dtype=np.uint8)
            for at, levels in zip(right.column("slice").to_pylist(), right.column("levels").to_pylist(), strict=True):
                order[at] = np.frombuffer(levels, dtype=np.uint8)
            order = order.ravel()
            for s in shingle_sets(left.column("text").combine_chunks(), width):
                least, most = prefix_sizes(len(s), percent)
                first = s[np.lexsort((s, order[s >> np.uint64(64 - CELL_BITS)]))[:most]]
                keys.append(first)
                sizes.append(len(s))
                counts.append(len(first))
                inner.append(np.arange(len(first)) < least)
        counts = np.array(counts, dtype=np.int64)

        def spread(values) -> pa.Array:
            return pa.array(np.repeat(np.asarray(values, dtype=np.int64), counts))

        return pa.table(
            {
                "grp": spread(left.column("grp").to_numpy()),
                "key": pa.array((np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)).view(np.int64)),
                "id": spread(left.column("id").to_numpy()),
                "component": spread(left.column("component").to_numpy()),
                "n": spread(sizes),
                "inner": pa.array(np.concatenate(inner) if inner else np.zeros(0, dtype=bool)),
            }
        )

    of_block = members.select("grp", "block").distinct().join(levels, "grp").select(F.col("grp").alias("g"), F.col("block").alias("b"), "slice", "levels")
    schema = "grp long, key long, id long, component long, n long, inner boolean"
    return members.groupBy("grp", "block").cogroup(of_block.groupBy("g", "b")).applyInArrow(run, schema)


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """``members`` (grp, id, component) with their block, and the number of blocks, of about ``block`` members."""
    sizes = members.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    return members.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))


def _with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    return rows.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    width: int = 5,
    percent: int = 80,
    chunks: int | None = None,
    small: int = 16,
    block: int = 128,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Two documents are linked when 100 * intersection >= ``percent`` * union of their ``width``-word
    shingle sets. ``small`` is the bucket size up to which members are paired directly, ``block``
    the block size beyond; neither changes the result. ``chunks`` follows from ``percent`` if None.
    """
    chunks = chunks_for(percent) if chunks is None else chunks
    values = chunks * CHUNK
    differing = (1 - percent / 100) * 255 / 256
    # Pairs further apart than this are links with a chance below 1e-9.
    most = math.ceil(values * differing + 6.5 * math.sqrt(values * differing * (1 - differing)))

    marks = scratch.keep(signatures(docs, width, chunks))
    sets = marks.filter("n > 0 and doc_id is not null").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("lead_doc"), F.first("sig").alias("sig"))
    # Ids of classes sort like their smallest documents, so the smallest class of a component has its smallest document.
    classes = scratch.keep(
        sets.repartitionByRange("lead_doc", "h1").sortWithinPartitions("lead_doc", "h1").withColumn("id", F.monotonically_increasing_id())
    )
    keys = scratch.keep(_keys(classes, chunks))
    # Written, so that the join to it stands alone and a hot bucket in it can be split.
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("lead")).filter("size > 1")
    buckets = scratch.keep(buckets)
    met = scratch.keep(keys.join(buckets, "key"))
    scratch.drop(keys, buckets)

    needed = met.select("id").distinct().join(classes.select("id", "lead_doc", "h1"), "id")
    texts = scratch.keep(_class_texts(docs, needed, width))

    # One lead per class: that of most of its buckets.
    leads = met.filter("id <> lead").groupBy("id", "lead").agg(F.count(F.lit(1)).alias("n"))
    best = leads.groupBy("id").agg(F.max(F.struct("n", -F.col("lead"))).alias("x"))
    tested = scratch.keep(best.select((-F.col("x.col2")).alias("a"), F.col("id").alias("b")))
    links = scratch.keep(_verified(tested, texts, width, percent).union(_same_document(marks, classes)))
    components = scratch.keep(connected_components(links, scratch))

    # Buckets with several components left.
    labelled = scratch.keep(_with_component(met, components))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    mixed = scratch.keep(mixed)
    rest = scratch.keep(labelled.join(mixed, "key"))
    scratch.drop(labelled, met, mixed)

    few = rest.filter(F.col("size") <= small).select("key", "id", "component")
    other = few.select("key", F.col("id").alias("b"), F.col("component").alias("component_b"))
    pairs = (
        few.withColumnRenamed("id", "a")
        .join(other, "key")
        .filter("a < b and component <> component_b")
        .select("a", "b")
        .distinct()
        .join(tested, ["a", "b"], "left_anti")
    )
    many = rest.filter(F.col("size") > small)
    crowd = None
    if not many.isEmpty():
        groups = connected_components(many.filter("id <> lead").select(F.col("id").alias("a"), F.col("lead").alias("b")), scratch)
        members = many.select("id", "component").distinct().join(groups.withColumnRenamed("component", "grp"), "id")
        members = scratch.keep(_in_blocks(members, block))
        with_text = members.join(texts, "id")
        prefixes = scratch.keep(_prefixes(with_text, _levels(with_text, width), width, percent))
        shared = prefixes.groupBy("grp", "key").agg(
            F.count_if("inner").alias("held"), F.count(F.lit(1)).alias("seen"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("id").alias("lead")
        )
        # Written, so that the join to it stands alone and a hot shingle in it can be split.
        shared = scratch.keep(shared.filter("held > 0 and lo <> hi").select("grp", "key", "lead", (F.col("held") * F.col("seen") <= small * small).alias("paired")))
        meeting = scratch.keep(prefixes.join(shared, ["grp", "key"]))
        scratch.drop(prefixes, shared)
        apart = meeting.filter("paired").select("grp", "key", "id", "component", "n")
        smaller = meeting.filter("paired and inner").select("grp", "key", *[F.col(c).alias(f"{c}_s") for c in ("id", "component", "n")])
        near = (
            smaller.join(apart, ["grp", "key"])
            .filter(f"id <> id_s and component <> component_s and n_s <= n and 100 * n_s >= {percent} * n")
            .select(F.least("id", "id_s").alias("a"), F.greatest("id", "id_s").alias("b"))
        )
        pairs = pairs.union(near.distinct().join(tested, ["a", "b"], "left_anti")).distinct()
        crowd = meeting.filter("not paired")
    more = scratch.keep(_verified(_close(pairs, classes, most), texts, width, percent))

    if crowd is not None and not crowd.isEmpty():
        groups = connected_components(crowd.filter("id <> lead").select(F.col("id").alias("a"), F.col("lead").alias("b")), scratch)
        members = crowd.select("id", "component").distinct().join(groups.withColumnRenamed("component", "grp"), "id")
        cells = _in_blocks(members, block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "grp",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "id",
            "component",
            "block",
        )
        more = scratch.keep(more.union(_block_links(cells.join(texts, "id"), width, percent, most, chunks)))
    # Components of components.
    upper = more.select(F.col("a").alias("id"), "b")
    upper = _with_component(upper, components).select(F.col("component").alias("a"), F.col("b").alias("id"))
    upper = _with_component(upper, components).select("a", F.col("component").alias("b"))
    top = connected_components(upper, scratch).select(F.col("id").alias("component"), F.col("component").alias("top"))
    final = components.join(top, "component", "full").select(F.coalesce("id", "component").alias("id"), F.coalesce("top", "component").alias("top"))

    # From classes back to documents.
    lead_of = classes.select(F.col("id").alias("top"), F.col("lead_doc").alias("component_doc"))
    labels = classes.select("id", "h1", "h2", "n", "lead_doc").join(final, "id", "left")
    labels = labels.join(lead_of, "top", "left").select("h1", "h2", "n", F.coalesce("component_doc", "lead_doc").alias("component_id"))
    found = marks.drop("sig").join(labels, ["h1", "h2", "n"], "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.col("component_id").isNull()).alias("kept"),
    )


def _class_texts(docs: DataFrame, needed: DataFrame, width: int) -> DataFrame:
    """One text per needed class (id, lead_doc, h1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                sums = np.array([s.sum(dtype=np.uint64) for s in shingle_sets(batch.column(2), width)], dtype=np.uint64)
            keep = pa.array(sums.view(np.int64) == batch.column(1).to_numpy(zero_copy_only=False), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["id", "text"]).filter(keep)

    rows = docs.select(F.col("doc_id").cast("long").alias("lead_doc"), F.col("text").cast("string")).filter("text is not null")
    # A document may be there several times, also with other texts; grouping reuses the join's partitioning.
    joined = needed.join(rows, "lead_doc").groupBy("lead_doc", "id", "h1", F.xxhash64("text")).agg(F.first("text").alias("text"))
    return joined.select("id", "h1", "text").mapInArrow(run, "id long, text string")


def _same_document(marks: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a document that is there with several texts."""
    rows = marks.filter("n > 0 and doc_id is not null").select("doc_id", "h1", "h2", "n")
    several = rows.groupBy("doc_id").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).filter("lo <> hi")
    ids = rows.join(several.select("doc_id"), "doc_id").join(classes.select("id", "h1", "h2", "n"), ["h1", "h2", "n"]).select("doc_id", "id")
    first = ids.groupBy("doc_id").agg(F.min("id").alias("a"))
    return ids.join(first, "doc_id").filter("id <> a").select("a", F.col("id").alias("b"))
