"""Exact inner-product search: vectors in buckets of similar length, pruned per bucket.

Components become integers, so products are exact. Vectors are sorted by length and cut into
buckets; a query's current fifth-best product, divided by its own length and the longest vector of a
bucket, is the cosine that a vector there must have. Above 1 the bucket is skipped. A high cosine
bounds every coordinate of the normalised vector, so the coordinates in which the query is largest
select candidates; with a low one only the lengths do. Candidates' products are then computed.

Queries come in blocks. A first round over the bucket of the longest vectors gives every query a
threshold; then each pair of a query block and a bucket that can still hold a better vector is one
task of bounded size, which returns the best of its bucket. Equal scores are never pruned, so ties go
to the smaller id.

Defined cases: vectors that are null or have null or non-finite components take no part, nor do rows
without vec_id; of rows that share vec_id the smallest vector stands; components that a shorter
vector lacks count as 0; products must fit into 64 bits; an empty table gives no row; a query without candidates has no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch

FOUND = "query_id long, vec_id long, score long"
STEP = 512  # vectors per local bucket
FOCUS = 3  # coordinates that select candidates
COORDINATE_FROM = 0.35  # local cosine from which coordinates prune better than lengths


def quantized(vectors: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, integer components ``v`` and length of the vectors that take part."""
    double = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(double, lambda x: F.floor(x * scale))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite)
    one = rows.select(F.col("vec_id").cast("long"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return one.withColumn("length", F.sqrt(square))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows padded with zeros, as exact doubles or, if products could pass 2^53, as integers."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def best_of_bucket(
    queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """Per query its ``k`` best of ``vectors`` with a score of at least its floor (-inf: none yet)."""
    big = max(float(np.abs(queries).max(initial=0)), 1.0) * max(float(np.abs(vectors).max(initial=0)), 1.0) * queries.shape[1]
    if big < 2.0**52:
        queries, vectors = queries.astype(np.float64), vectors.astype(np.float64)
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    vectors, ids, lengths = vectors[order], ids[order], lengths[order]
    safe = np.where(lengths > 0, lengths, 1.0)
    unit = vectors / safe[:, None]
    found = []
    for query, own, floor in zip(queries, query_ids.tolist(), floors.tolist(), strict=True):
        size = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        direction = query / size if size else query.astype(np.float64)
        focus = np.argsort(-np.abs(direction))[:FOCUS]
        scores, names = np.zeros(0, dtype=vectors.dtype), np.zeros(0, dtype=np.int64)
        for at in range(0, len(ids), STEP):
            longest = lengths[at]
            if floor > size * longest * (1 + 1e-12):
                break  # vectors only get shorter
            stop = min(at + STEP, len(ids))
            cosine = min(1.0, floor / (size * longest)) if size * longest > 0 else -1.0
            if cosine >= COORDINATE_FROM:
                # A vector within the angle of the query has each coordinate's angle within it, too.
                keep, angle = np.ones(stop - at, dtype=bool), np.arccos(cosine)
                for f in focus:
                    axis = np.arccos(np.clip(direction[f], -1, 1))
                    near, far = np.cos(max(0.0, axis - angle)), np.cos(min(np.pi, axis + angle))
                    keep &= (unit[at:stop, f] <= near + 1e-9) & (unit[at:stop, f] >= far - 1e-9)
                picked = at + np.flatnonzero(keep)
            elif cosine > 0:
                picked = np.arange(at, at + int((lengths[at:stop] * size * (1 + 1e-12) >= floor).sum()))
            else:
                picked = np.arange(at, stop)
            picked = picked[ids[picked] != own]
            products = vectors[picked] @ query
            good = products >= floor
            scores, names = np.append(scores, products[good]), np.append(names, ids[picked[good]])
            if len(scores) >= k:
                top = np.lexsort((names, -scores))[:k]
                scores, names = scores[top], names[top]
                floor = max(floor, float(np.nextafter(float(scores[-1]), -np.inf)))
        found += [(own, n, s) for n, s in zip(names.tolist(), map(int, scores.tolist()), strict=True)]
    return found


def top_k(vectors: DataFrame, scratch: Scratch, k: int = 5, every: int = 50, bucket: int = 8192, block: int = 2048) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest products of every query.

    Queries are the rows of ``vectors`` (vec_id, v, length; see ``quantized``) whose id is divisible
    by ``every``. ``bucket`` and ``block`` are the largest numbers of vectors and queries per task.
    """
    base = scratch.keep(vectors)
    size = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.sum((F.col("vec_id") % every == 0).cast("int")).alias("m")).first()
    buckets, blocks, width = -(-size["n"] // bucket) or 1, -(-(size["m"] or 0) // block) or 1, size["width"] or 0
    order = [F.col("length").desc(), F.col("vec_id")]
    # Written with its number, so that a lost task can't deal the buckets anew.
    table = scratch.keep(base.repartitionByRange(buckets, *order).withColumn("bucket", F.spark_partition_id()))
    queries = base.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "length", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")
    )

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """One query block (left) and one bucket (right)."""
        floors = left.column("floor").to_numpy().astype(np.float64)
        # One step down, as a double may be above the integer that it stands for.
        floors = np.where(np.isnan(floors), -np.inf, np.nextafter(floors, -np.inf))
        rows = []
        if left.num_rows and right.num_rows:
            rows = best_of_bucket(
                _matrix(left.column("q"), width),
                left.column("query_id").to_numpy(),
                floors,
                _matrix(right.column("v"), width),
                right.column("vec_id").to_numpy(),
                k,
            )
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in FOUND.split(", ")])

    def cells(asked: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
        # New names on either side: both come from the same tables.
        left = asked.join(pairs, "block").select(F.col("block").alias("l_block"), F.col("bucket").alias("l_bucket"), "query_id", "q", "floor")
        right = rows.join(pairs, "bucket").select(F.col("block").alias("r_block"), F.col("bucket").alias("r_bucket"), "vec_id", "v")
        return left.groupBy("l_block", "l_bucket").cogroup(right.groupBy("r_block", "r_bucket")).applyInArrow(search, FOUND)

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    used = table.groupBy("bucket").agg(F.max("length").alias("longest"))
    longest = used.agg(F.min("bucket")).first()[0]
    first_pairs = used.filter(F.col("bucket") == F.lit(longest)).select("bucket", every_block)
    first = scratch.keep(cells(queries.withColumn("floor", F.lit(None).cast("double")), table, first_pairs))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    floors = first.withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select("query_id", F.col("score").cast("double").alias("floor"))
    asked = scratch.keep(queries.join(floors, "query_id", "left"))

    # Pairs of block and bucket in which some query can still find as good a vector.
    need = F.when(F.col("floor").isNull() | (F.col("floor") <= 0), F.lit(0.0)).otherwise(F.col("floor") / F.col("length"))
    least = asked.groupBy("block").agg(F.min(need).alias("need"))
    others = used.filter(F.col("bucket") != F.lit(longest)).select("bucket", "longest", every_block)
    pairs = scratch.keep(others.join(least, "block").filter(F.col("longest") * (1 + 1e-12) >= F.col("need")).select("block", "bucket"))
    return (
        first.union(cells(asked, table, pairs))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
