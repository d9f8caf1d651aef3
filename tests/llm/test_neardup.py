import random
import re

import pytest

from mixloom.llm import neardup
from mixloom.llm.components import connected_components
from mixloom.llm.neardup import near_duplicates
from mixloom.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"


def shingles(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def roots(ids, edges):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(docs, width, percent):
    sets = [(d, shingles(t, width)) for d, t in docs]
    edges = [
        (a, b)
        for i, (a, x) in enumerate(sets)
        for b, y in sets[:i]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    return roots({d for d, _ in docs}, edges)


def run(spark, docs, schema=SCHEMA, **more):
    scratch = Scratch(spark)
    rows = near_duplicates(spark.createDataFrame(docs, schema), scratch, **more).collect()
    scratch.close()
    return rows


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("small", [64, 3])
def test_components_equal_brute_force(spark, small):
    rng = random.Random(5)
    texts = []
    for size in (2, 3, 8, 40):
        base = [f"b{rng.randrange(10**6)}" for _ in range(rng.choice([30, 80, 200]))]
        texts += family(rng, base, size, max(1, len(base) // 25))
    texts += ["one", "one", "One two", "one two", "", None, "  \n", "a b c", "A B C"]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    rows = run(spark, docs, width=3, percent=85, small=small, block=8)
    expected = brute(docs, 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {d: len(shingles(t, 3)) for d, t in docs}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    assert len(set(expected.values())) > 12


def test_chain_of_edits_and_a_very_long_text(spark):
    """Neighbours are links, the ends are not; the component is one."""
    rng = random.Random(1)
    words = [f"x{i}" for i in range(200)]
    docs = []
    for i in range(30):
        docs.append((i, " ".join(words)))
        for _ in range(3):
            words[rng.randrange(len(words))] = f"y{rng.randrange(10**6)}"
    long = " ".join(f"l{i}" for i in range(60000))
    docs += [(100, long), (101, long + " tail")]
    rows = run(spark, docs, width=3, percent=85, small=4, block=8)
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute(docs, 3, 85)


def test_nulls_repeated_rows_and_clashing_columns(spark):
    docs = [(1, "p q r s", 1), (1, "t u v w", 2), (2, "t u v w", 3), (None, "p q r s", 4), (None, "alone here now", 5), (3, None, 6), (3, None, 6)]
    rows = run(spark, docs, "doc_id long, text string, component_id int", width=3, percent=85)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"] or -1, r["kept"]) for r in rows)
    assert got == [
        (False, 1, 1, True),
        (False, 1, 1, True),
        (False, 2, 1, False),
        (False, 3, 3, True),
        (False, 3, 3, True),
        (True, 0, -1, True),
        (True, 0, 1, False),
    ]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    scratch = Scratch(spark)
    rows = connected_components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()
    scratch.close()
    ids = {x for e in edges for x in e if e[0] != e[1]}
    assert {r["id"]: r["component"] for r in rows} == roots(ids, [e for e in edges if e[0] != e[1]])


@pytest.mark.parametrize("percent", [75, 80, 85, 90])
def test_signature_chunks_follow_from_the_threshold(spark, percent):
    scratch = Scratch(spark)
    seen = []
    original = neardup._keys
    neardup._keys = lambda classes, chunks: seen.append(chunks) or original(classes, chunks)
    try:
        neardup.near_duplicates(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), scratch, 3, percent)
    finally:
        neardup._keys = original
        scratch.close()
    d = (1 - percent / 100) * 255 / 256
    at_most_one = (1 - d) ** 8 + 8 * d * (1 - d) ** 7
    assert (1 - at_most_one) ** seen[0] <= 3e-6


def test_prefixes_of_linked_sets_meet():
    """Any two sets at the threshold share a shingle of their prefixes, in any common order."""
    rng = random.Random(3)
    for _ in range(3000):
        percent, common = rng.choice([70, 80, 85, 95]), rng.randint(1, 60)
        a = set(range(common)) | {1000 + i for i in range(rng.randint(0, 12))}
        b = set(range(common)) | {2000 + i for i in range(rng.randint(0, 12))}
        if len(a) > len(b):
            a, b = b, a
        if 100 * len(a & b) < percent * len(a | b):
            continue
        order = {x: rng.random() for x in a | b}
        first = sorted(a, key=order.get)[: neardup.prefix_sizes(len(a), percent)[0]]
        second = sorted(b, key=order.get)[: neardup.prefix_sizes(len(b), percent)[1]]
        assert set(first) & set(second)


def template_pages(rng, n, core, own):
    base = [f"t{i}" for i in range(core)]
    return [" ".join(base + [f"o{rng.randrange(10**9)}" for _ in range(own)]) for _ in range(n)]


def test_pages_of_one_template_below_the_threshold(spark, monkeypatch):
    """They meet, but are not links: nothing is compared block by block; the few links among them are found."""
    rng = random.Random(8)
    texts = template_pages(rng, 600, 420, 40)
    for i in (3, 77, 500):
        texts.append(" ".join([*texts[i].split()[:-6], *(f"e{rng.randrange(10**9)}" for _ in range(6))]))
    compared = []
    original = neardup._block_links
    monkeypatch.setattr(neardup, "_block_links", lambda rows, *more: compared.append(rows.count()) or original(rows, *more))
    rows = run(spark, list(enumerate(texts)), width=3, percent=85)
    linked = {r["doc_id"]: r["component_id"] for r in rows if not r["kept"]}
    assert linked == {600: 3, 601: 77, 602: 500}
    assert not compared


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_recall_of_pairs_around_the_threshold(spark, width, percent):
    """Links found against all links, on pairs just above and below the threshold."""
    rng = random.Random(percent)
    docs = []
    for i in range(400):
        words = [f"p{i}x{j}" for j in range(rng.randint(60, 300))]
        twin = list(words)
        for at in rng.sample(range(len(words)), max(1, round(len(words) * rng.uniform(0.5, 1.3) * (100 - percent) / 200 / width))):
            twin[at] = f"q{rng.randrange(10**9)}"
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(twin))]
    links = set()
    for (a, x), (_, y) in zip(docs[::2], docs[1::2]):
        s, t = shingles(x, width), shingles(y, width)
        if 100 * len(s & t) >= percent * len(s | t):
            links.add(a)
    found = {r["component_id"] for r in run(spark, docs, width=width, percent=percent) if not r["kept"]}
    assert 100 < len(links) < 390
    assert found <= links and len(found) >= 0.99 * len(links)
