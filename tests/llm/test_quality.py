import math
import random
import re
import unicodedata
from collections import Counter

import pytest

from mixloom.llm.quality import quality_rules, repeated_words
from mixloom.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def kind(c):
    if c in ".,;:?'\"-()’–":
        return "sentence"
    category = unicodedata.category(c)
    if category[0] in "LM":
        return "upper" if category in ("Lu", "Lt") else "lower"
    if category[0] == "N":
        return "digit"
    return "space" if category[0] == "Z" or "\t" <= c <= "\r" else "symbol"


def distance(p, q):
    keys = p.keys() | q.keys()
    a, b = sum(p.values()), sum(q.values())
    total = 0.0
    for k in keys:
        x, y = p.get(k, 0) / a, q.get(k, 0) / b
        m = (x + y) / 2
        total += (x * math.log2(x / m) if x else 0) / 2 + (y * math.log2(y / m) if y else 0) / 2
    return math.sqrt(max(total, 0))


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    covered = set()
    for i in range(len(words) - 2):
        same = [j for j in range(len(words) - 2) if words[j : j + 3] == words[i : i + 3]]
        if len(same) > 1:
            covered |= {i, i + 1, i + 2}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def brute(docs, max_class=0.28, max_word=0.42):
    """Verdict per row, with references counted plainly; rare languages are none in these tables."""
    classes, words = {}, {}
    for _, t, lang, *_ in docs:
        if t is not None and lang is not None:
            classes.setdefault(lang, Counter()).update(map(kind, t))
            words.setdefault(lang, Counter()).update(WORD.findall(t.lower()))
    everything = sum(sum(w.values()) for w in words.values())
    refs = {}
    for lang, w in words.items():
        total = sum(w.values())
        if total and total >= 0.005 * everything:
            common = {x: n for x, n in w.items() if n >= 0.002 * total}
            refs[lang] = (classes[lang], common | {"": total - sum(common.values())})
    out = []
    for _, t, *_ in docs:
        n, chars, symbols, dup, repeat = base(t)
        failed = n < 50 or 100 * repeat > 50 * n
        best = None
        for lang in sorted(refs):
            c, w = refs[lang]
            if not n:
                continue
            own = Counter(WORD.findall(t.lower()))
            mine = {x: own[x] for x in w if x and own[x]}
            d = distance(Counter(map(kind, t)), c), distance(mine | {"": n - sum(mine.values())}, w)
            if best is None or sum(d) < sum(best):
                best = d
        far = bool(best) and ((chars >= 200 and best[0] > max_class) or (n >= 50 and best[1] > max_word))
        out.append((n, chars, symbols, dup, repeat, failed, not failed and not far))
    return out


def prose(rng, n, lang):
    vocabulary = {"en": ["the", "of", "and", "to", "in"], "de": ["der", "und", "die", "zu", "für"]}[lang]
    own = [f"{rng.choice('abcdefgh')}{rng.choice('mnopqrst')}{rng.choice('aeiou')}{rng.randrange(0)if False else rng.choice('klmno')}" for _ in range(60)]
    return " ".join(rng.choice(vocabulary) if rng.random() < 0.5 else rng.choice(own) for _ in range(n)).capitalize() + "."


def run(spark, docs, schema=SCHEMA):
    scratch = Scratch(spark)
    rows = quality_rules(spark.createDataFrame(docs, schema), scratch).collect()
    scratch.close()
    return rows


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_equals_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.randint(20, 150), rng.choice(["en", "de"])), rng.choice(["en", "de", None])) for i in range(120)]
    docs += [(200 + i, prose(rng, 90, "en").upper().replace(" ", "!! "), "en") for i in range(4)]
    docs += [(300 + i, prose(rng, 90, "de").replace(" ", "%%% "), None) for i in range(4)]
    docs += [(400, "word " * 80, "en"), (401, None, "en"), (402, "", None), (403, " \n\t\n", "de"), (404, "a b c\na b c\n\n \na b c", "en")]
    docs += [(405, "😀 é\x85x y\x0bz 　 ß" * 40, "en"), docs[0], docs[0]]
    rows = run(spark, docs)
    got = Counter((r["doc_id"], *(r[f"_q_{c}"] for c in COLUMNS)) for r in rows)
    assert got == Counter((d[0], *x) for d, x in zip(docs, brute(docs)))
    kept = {r["doc_id"]: r["_q_kept"] for r in rows}
    assert not any(kept[i] for i in (*range(200, 204), *range(300, 304), *range(400, 405)))
    assert sum(kept[i] for i in range(120)) > 60


def test_no_language_clashing_columns_and_empty_table(spark):
    rng = random.Random(1)
    text = prose(rng, 80, "en")
    (row,) = run(spark, [(1, text, None, 5)], SCHEMA + ", _q_kept int")
    assert row["_q_kept"] is True and row["_q_best_lang"] is None and row["_q_class_distance"] is None
    assert run(spark, []) == []


@pytest.mark.parametrize("text", ["", "a", "a b c", "a a a a", "a b c x a b c", "a b a b a b", "x y z y z y z q"])
def test_repeated_words(text):
    assert repeated_words(text.split()) == base(text)[4]


def test_a_very_long_text(spark):
    rng = random.Random(2)
    text = " ".join(f"{rng.choice('abcdef')}{i}" for i in range(200_000))
    (row,) = run(spark, [(1, text, "en")])
    assert row["_q_n_words"] == 200_000 and row["_q_kept"]


def rare_language_table(langs=("sw", "yo"), clean=15):
    """English and German with 0.5 % and less of clean text in each other language; common words make up half of all."""
    rng = random.Random(5)
    docs = [(i, prose(rng, 100, ("en", "de")[i % 2]), ("en", "de")[i % 2]) for i in range(4200)]
    for k, lang in enumerate(langs):
        own = [f"{lang}{c}" for c in "abcde"]
        for i in range(clean):
            text = " ".join(rng.choice(own) if rng.random() < 0.5 else f"{lang}{rng.choice('klmnop')}{rng.randrange(10_000)}x" for _ in range(100))
            docs.append((10_000 + 100 * k + i, text.capitalize() + ".", lang))
    return docs


@pytest.mark.parametrize("held", [200, 2, 3])
def test_clean_text_of_a_rare_language_is_kept(spark, held):
    docs = rare_language_table()
    docs += [(20_000, docs[-1][1].replace(" ", "%%% "), "yo"), (20_001, docs[-2][1], None)]
    # Too few words for a reference: no verdict by distance.
    docs += [(30_000, docs[-3][1].replace("yo", "qu"), "qu")]
    scratch, fewer = Scratch(spark), {} if held == 200 else {"held": held}
    rows = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(docs, SCHEMA), scratch, **fewer).collect()}
    scratch.close()
    assert len(rows) == len(docs)
    for i, _, lang in docs[4200:4230]:
        assert rows[i]["_q_kept"] and rows[i]["_q_best_lang"] == lang
    assert not rows[20_000]["_q_kept"]
    if held == 200:
        assert rows[20_001]["_q_kept"] and rows[20_001]["_q_best_lang"] == "yo"
    assert rows[30_000]["_q_kept"] and rows[30_000]["_q_word_distance"] is None
