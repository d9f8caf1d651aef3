import math
import random

import pytest

from mixloom.llm.scratch import Scratch
from mixloom.llm.topk import quantized, top_k

SCHEMA = "vec_id long, embedding array<float>"


def run(spark, rows, schema=SCHEMA, **more):
    scratch = Scratch(spark)
    out = top_k(quantized(spark.createDataFrame(rows, schema)), scratch, **more).collect()
    scratch.close()
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in out}


def brute(rows, k=5, every=50):
    import numpy as np

    whole = {}
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        whole[i] = min(whole.get(i, q), q)
    out = {}
    for i, q in whole.items():
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole.items() if j != i)[:k]
            out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(scored)}
    return out


def vectors(seed, n, width, spread):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice(spread)
        out.append((i, [rng.gauss(0, size) for _ in range(width)]))
    return out


@pytest.mark.parametrize(("spread", "bucket", "block"), [((0.1,), 8192, 2048), ((0.01, 0.1, 0.5, 3.0), 60, 3), ((0.2, 0.21), 700, 5)])
def test_equals_brute_force(spark, spread, bucket, block):
    rows = vectors(3, 900, 12, spread)
    # Near and exact copies make high cosines and ties.
    rows += [(1000 + i, rows[i % 7][1]) for i in range(100)]
    rows += [(2000 + i, [x + 0.004 for x in rows[50 * (i % 5)][1]]) for i in range(60)]
    assert run(spark, rows, bucket=bucket, block=block) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "a"),
        (50, [0.0, 0.0], "b"),
        (100, None, "c"),
        (150, [None, 1.0], "d"),
        (200, [nan, 1.0], "e"),
        (1, [inf, 1.0], "f"),
        (2, [-1.0, 2.0], "g"),
        (2, [-1.0, 1.0], "h"),
        (3, [], "i"),
        (4, [2.0, 0.5, 9.0], "j"),
        (None, [5.0, 5.0], "k"),
        (250, [-3.0, -3.0], "l"),
    ]
    got = run(spark, rows, SCHEMA + ", score string")
    assert got == brute([(i, v) for i, v, _ in rows])


def test_large_components_and_single_rows(spark):
    rows = [(0, [1e6, 2e6]), (1, [3e6, 1.0]), (2, [-1e6, 5e5])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0])]) == {}
    assert run(spark, []) == {}
