import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from mixloom.llm.decontam import decontaminate, digest, remove_hits
from mixloom.llm.queries import ORACLE
from mixloom.llm.scratch import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, window=10):
    known = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            known.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in known}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if names := known.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= names
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def corpus(seed, vocabulary=12):
    rng = random.Random(seed)
    letters = ["a", "Bé", "c9", "ß", "the", "of", "X", "日本", "d", "e", "f", "g"][:vocabulary]
    pick = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(letters) for _ in range(n))
    items = [(i, pick(rng.choice([1, 3, 9, 10, 11, 30, 60]) if i % 4 else 40)) for i in range(25)]
    items += [(7, pick(25)), (None, pick(12)), (98, ""), (99, None), (100, "?!"), (101, items[3][1])]
    docs = []
    for i in range(120):
        text = pick(rng.choice([0, 5, 40, 200]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            w = words(rng.choice(items)[1])
            at = rng.randrange(len(w) + 1)
            text += " " + " ".join(w[at : at + rng.choice([4, 9, 10, 11, 40])]).upper() + rng.choice([" ", " zz "])
        docs.append((i if i % 9 else None, text))
    return docs + [(500, None), (501, ""), (502, "?? !!"), (503, docs[1][1]), (503, docs[2][1])], items


def run(spark, docs, items, schema="doc_id long, text string", **more):
    scratch = Scratch(spark)
    found = decontaminate(spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string"), scratch, **more)
    out = sorted((tuple(r) for r in digest(found).collect()), key=str)
    scratch.close()
    return out


@pytest.mark.parametrize("more", [{}, {"block_words": 60}, {"block_words": 60, "at_once": 2}, {"window": 3}])
def test_equals_brute_force(spark, more):
    docs, items = corpus(5)
    assert run(spark, docs, items, **more) == brute(docs, items, more.get("window", 10))


def test_few_words_repeat_endlessly(spark):
    docs, items = corpus(6, vocabulary=2)
    docs += [(900, "a " * 5000), (901, "a bé " * 3000)]
    items += [(200, "a " * 700), (201, "a " * 9)]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, block_words=100) == brute(docs, items)


def test_windows_do_not_reach_into_the_next_text(spark):
    words_ = [f"w{i}" for i in range(12)]
    docs = [(1, " ".join(words_[:6])), (2, " ".join(words_[6:])), (3, " ".join(words_))]
    items = [(1, " ".join(words_))]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = corpus(7)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []
    scratch = Scratch(spark)
    odd = spark.createDataFrame([(1, "x", 2, 3)], "doc_id long, text string, _0 long, item_id long")
    got = decontaminate(odd, spark.createDataFrame([(1, "x")], "item_id long, text string"), scratch)
    assert got.columns[:4] == odd.columns
    assert tuple(got.first())[:6] == (1, "x", 2, 3, 1, 1)
    scratch.close()


def test_one_long_text_is_linear(spark):
    import time

    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(40))) for i in range(50)]
    long = " ".join(rng.choice("abcdefgh") for _ in range(600_000))
    begin = time.perf_counter()
    ((_, n, *_),) = run(spark, [(1, long)], items)
    assert n == 600_000
    assert time.perf_counter() - begin < 30


def test_hit_words_are_cut_out(spark):
    item = " ".join(f"w{i}" for i in range(10))
    docs = [(1, f"?Keep this, {item}; and that. " + "more " * 20), (2, item), (3, "no hit, at all"), (4, None), (5, "x " * 30 + item + ".")]
    scratch = Scratch(spark)
    found = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"), scratch)
    got = {r["doc_id"]: r["text"] for r in remove_hits(found).collect()}
    assert got == {1: "?Keep this, and that. " + "more " * 20, 3: "no hit, at all", 4: None, 5: "x " * 30}
    scratch.close()


def test_sql_states_the_same(spark):
    import duckdb

    docs, items = corpus(8)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    rows = sorted(con.execute(ORACLE["op12_decontamination"]).fetchall(), key=str)
    assert rows == run(spark, docs, items)
