import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mixloom.llm.queries import ORACLE
from mixloom.llm.scratch import Scratch
from mixloom.llm.spelling import checksums, count_words, near_pairs, spelling_forms, spelling_variants

FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def counts(docs, every):
    out = Counter()
    for doc, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute(words, ratio=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed, alphabet="abé", n=400):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice(alphabet) for _ in range(rng.choice([5, 6, 7, 8, 9]))) for _ in range(n)]
    weights = [1 / (i + 1) for i in range(n)]
    docs = []
    for i in range(120):
        words = rng.choices(lexicon, weights, k=rng.randrange(120))
        docs.append((i if i % 11 else None, rng.choice([" ", "1", "-\n", "日"]).join(w.title() if rng.random() < 0.2 else w for w in words)))
    return docs + [(500, None), (501, ""), (502, "12 34"), (503, docs[3][1]), (503, docs[3][1])]


def run(spark, docs, schema="doc_id long, text string", **more):
    scratch = Scratch(spark)
    out = sorted((tuple(r) for r in spelling_variants(spark.createDataFrame(docs, schema), scratch, **more).collect()))
    scratch.close()
    return out


@pytest.mark.parametrize(("seed", "alphabet", "every"), [(1, "abé", 7), (2, "ab", 0), (3, "abcdefghÀÿ÷", 199)])
def test_equals_brute_force(spark, seed, alphabet, every):
    docs = corpus(seed, alphabet)
    words = {w: n for w, n in counts(docs, every).items() if len(w) >= 6 and n >= 5}
    got = run(spark, docs, misprint_every=every)
    assert len(got) > 20
    assert got == brute(words)


def test_checksums_of_joined_strings():
    names, words = [b"1:", b":", b"-77:"], [b"a", "éà".encode(), b"x" * 64, b"y" * 300]
    owners, codes = np.repeat(np.arange(3), 4), np.tile(np.arange(4), 3)
    expected = [zlib.crc32(names[o] + words[c]) for o, c in zip(owners, codes, strict=True)]
    assert checksums(names, owners, codes, words).tolist() == expected


def forms(spark, words):
    scratch = Scratch(spark)
    out = sorted(tuple(r) for r in spelling_forms(spark.createDataFrame(sorted(words.items()), "word string, n long"), scratch).collect())
    scratch.close()
    return out


def test_every_edit_of_a_word(spark):
    for base in ("kettle", "aaaaaa", "ababab", "zürich"):
        letters = sorted({*base, "b", "é"})
        edits = {base[:i] + c + base[i:] for i in range(len(base) + 1) for c in letters}
        edits |= {base[:i] + c + base[i + 1 :] for i in range(len(base)) for c in letters}
        edits |= {(base + "x")[:i] + (base + "x")[i + 1 :] for i in range(len(base) + 1)}
        words = {w: 5 + i % 3 for i, w in enumerate(sorted(w for w in edits if len(w) >= 6))} | {base: 1000}
        assert forms(spark, words) == brute(words)


def test_chain_of_forms(spark):
    chain = ["aaaaaaaaaa"[: 10 - i] + "bbbbbbbbbb"[:i] for i in range(10)]
    words = {w: 5**i for i, w in enumerate(chain)}
    got = forms(spark, words)
    assert got == brute(words)
    assert {r[2] for r in got} == {chain[-1]}


def test_hot_prefix_and_suffix(spark):
    rng = random.Random(8)
    tail = lambda: "".join(rng.choice("abcdxyz") for _ in range(3))
    words = {("internation" + tail() if i % 2 else tail() + "nisation"): rng.choice([5, 6, 30, 200]) for i in range(900)}
    assert forms(spark, words) == brute(words)


def test_very_long_words(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abc") for _ in range(40_000))
    words = {long: 50, long[:30_000] + "z" + long[30_000:]: 9, long[:100] + long[101:]: 8, "q" * 1000: 7, "q" * 1001: 40, "kettle": 5}
    assert forms(spark, words) == brute(words)


def test_long_text_is_linear(spark):
    docs = [(1, " ".join(f"{w}ing" for w in ("walk", "talk", "stalk")) * 1), (2, "walking talking stalking " * 200_000), (3, "x" * 2_000_000)]
    scratch = Scratch(spark)
    got = {r["word"]: r["n"] for r in count_words(spark.createDataFrame(docs, "doc_id long, text string"), misprint_every=199).collect()}
    assert got == {w: n for w, n in counts(docs, 199).items() if len(w) >= 6}
    scratch.close()


def test_empty_and_other_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "few words here")]) == []
    docs = corpus(4)
    words = {w: n for w, n in counts(docs, 199).items() if len(w) >= 6 and n >= 5}
    wide = [(*d, "w", 1, 2) for d in docs]
    assert run(spark, wide, "doc_id long, text string, word string, n long, id long", misprint_every=199) == brute(words)
    scratch = Scratch(spark)
    assert near_pairs(spark.createDataFrame([], "id long, word string"), scratch).collect() == []
    scratch.close()


def test_sql_states_the_same(spark):
    import duckdb

    docs = corpus(5)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    words = {w: n for w, n in counts(docs, 199).items() if len(w) >= 6 and n >= 5}
    assert sorted(con.execute(ORACLE["op11_spelling_variants"]).fetchall()) == brute(words)
