import hashlib
import math
from collections import Counter, defaultdict

import pytest

from mixloom.llm.mixing import mix_sources
from mixloom.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, source string"


def run(spark, docs, schema=SCHEMA, **more):
    scratch = Scratch(spark)
    rows = mix_sources(spark.createDataFrame(docs, schema), scratch, **more).collect()
    scratch.close()
    return rows


def md5(*parts):
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def brute(docs, exponent, budget, block_docs):
    """Copies per row index, by walking each source's permutations."""
    queues = defaultdict(list)
    for i, (d, t, s) in enumerate(docs):
        n = len((t or "").split())
        if n:
            queues["" if s is None else f"={s}"].append((i, "null" if d is None else str(d), n))
    tokens = {s: sum(x[2] for x in q) for s, q in queues.items()}
    total = sum(tokens.values())
    z = sum((n / total) ** exponent for n in tokens.values())
    copies = Counter()
    for s, queue in queues.items():
        target = round((tokens[s] / total) ** exponent / z * budget)
        digits = max(0, math.ceil(math.log(len(queue) / block_docs) / math.log(16)))
        passes, rest = divmod(target, tokens[s])
        for i, _, _ in queue:
            copies[i] += passes
        turn = str(passes + 1)
        keyed = [(md5("mix", turn, s, md5("mix", d)[:digits]), md5("mix", turn, s, d), i, n) for i, d, n in queue]
        for block, place, i, _ in keyed:
            if sum(x[3] for x in keyed if x[:2] <= (block, place)) <= rest:
                copies[i] += 1
    return copies


DOCS = [(i, "w " * (1 + i % 9), "big" if i % 4 else f"s{i % 3}") for i in range(240)] + [
    (500, None, "big"),
    (501, "", "empty source"),
    (502, "a b c", None),
    (503, "a b", "s1"),
    (503, "a b", "s1"),
    (None, "x y z", "s1"),
]


@pytest.mark.parametrize(("entropy", "repetitions", "block_docs"), [(0.95, None, 1024), (1.0, 1.5, 8), (None, 2.0, 20)])
def test_equals_brute_force(spark, entropy, repetitions, block_docs):
    rows = run(spark, DOCS, target_entropy=entropy, max_repetitions=repetitions, block_docs=block_docs)
    exponent = rows[0]["_m_exponent"]
    total = sum(len((t or "").split()) for _, t, _ in DOCS)
    copies = brute(DOCS, exponent, total, block_docs)
    got = Counter((r["doc_id"], r["source"]) for r in rows)
    expected = Counter()
    for i, n in copies.items():
        expected[(DOCS[i][0], DOCS[i][2])] += n
    assert got == +expected
    assert all(r["_m_pass"] >= 1 for r in rows)


def measures(docs, exponent):
    tokens = Counter()
    for _, t, s in docs:
        tokens[s] += len((t or "").split())
    shares = [n / sum(tokens.values()) for n in tokens.values() if n]
    z = sum(p**exponent for p in shares)
    weights = [p**exponent / z for p in shares]
    entropy = -sum(w * math.log(w) for w in weights) / math.log(len(weights))
    return entropy, max(w / p for w, p in zip(weights, shares))


def test_exponent_meets_the_targets(spark):
    even = run(spark, DOCS, target_entropy=0.95, max_repetitions=None)[0]["_m_exponent"]
    assert 0 < even < 1 and abs(measures(DOCS, even)[0] - 0.95) < 1e-4
    most = run(spark, DOCS, target_entropy=1.0, max_repetitions=1.5)[0]["_m_exponent"]
    assert most > 0 and 1.499 < measures(DOCS, most)[1] <= 1.5
    assert run(spark, DOCS, target_entropy=0.1, max_repetitions=None)[0]["_m_exponent"] == 1


def test_shares_are_sharpened_only_if_asked_to(spark):
    sharp = run(spark, DOCS, target_entropy=0.3, max_repetitions=None, max_exponent=8.0)[0]["_m_exponent"]
    assert sharp > 1 and abs(measures(DOCS, sharp)[0] - 0.3) < 1e-4
    rows = run(spark, DOCS, target_entropy=0.3, max_repetitions=None, max_exponent=8.0)
    copies = brute(DOCS, sharp, sum(len((t or "").split()) for _, t, _ in DOCS), 1024)
    assert len(rows) == sum(copies.values())


def test_targets_out_of_reach_are_errors(spark):
    even = [(i, "a b c d", f"s{i % 4}") for i in range(8)]
    with pytest.raises(ValueError, match="entropy"):
        run(spark, even, target_entropy=0.5, max_exponent=8.0)
    with pytest.raises(ValueError, match="repeated"):
        run(spark, even, budget=100, max_repetitions=2.0)


def test_shares_that_are_even_enough_keep_every_document(spark):
    docs = [(i, "a b c d", f"s{i % 4}") for i in range(80)]
    rows = run(spark, docs)
    assert sorted(r["doc_id"] for r in rows) == list(range(80))


def test_tables_without_tokens(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, "a"), (2, " ", None)]) == []


def test_clashing_columns(spark):
    rows = run(spark, [(1, "a b", "s", 5)], "doc_id long, text string, source string, _m_pass int")
    assert [(r["doc_id"], r["_m_pass"]) for r in rows] == [(1, 1)]
