import random
import zlib

import numpy as np

from mixloom.llm.langid import FtrlRegression, columns_of, fit_temperature, predict_languages, train

SCHEMA = "doc_id long, text string, lang string"
PARTS = {
    "en": ["th", "ing", "er", "on", "the ", "and ", "of ", "tion"],
    "fr": ["eau", "é", "oi", "de ", "que ", "la ", "ê", "ou"],
    "de": ["sch", "ung", "ein", "der ", "und ", "ü", "keit", "ß"],
}


def texts(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(PARTS))
        out.append((i, "".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(10, 200))), lang))
    return out


def run(spark, docs, schema=SCHEMA, **more):
    df = spark.createDataFrame(docs, schema)
    return predict_languages(df, train(df, **more)).collect()


def test_held_out_accuracy(spark):
    docs = texts(1, 600)
    # Labels of held-out rows are never learned: here they are wrong.
    held = [zlib.crc32(str(d).encode()) % 4 == 2 for d, _, _ in docs]
    shown = [(d, t, "zz" if h else lang) for (d, t, lang), h in zip(docs, held)]
    rows = {r["doc_id"]: r for r in run(spark, shown, sample=300)}
    assert [rows[d]["held_out"] for d, _, _ in docs] == held
    right = [rows[d]["lang_pred"] == lang for (d, _, lang), h in zip(docs, held) if h]
    assert sum(right) / len(right) > 0.98 and len(right) > 100
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_a_rare_language_is_learned_whatever_its_share(spark):
    """12 of 4,000 documents, far below one in a sample of 200."""
    docs = texts(4, 4000)
    rng = random.Random(6)
    rare = [(10**6 + i, " ".join(rng.choice(["kwa", "ni", "wa", "mtu", "zaidi", "hii"]) for _ in range(80)), "sw") for i in range(12)]
    rows = {r["doc_id"]: r for r in run(spark, docs + rare, sample=200)}
    assert all(rows[d]["lang_pred"] == "sw" for d, _, _ in rare)
    assert sum(rows[d]["lang_pred"] == lang for d, _, lang in docs) > 0.98 * len(docs)


def test_languages_beyond_the_largest_are_not_learned(spark):
    docs = texts(9, 300) + [(10**6, "kwa ni wa mtu", "sw")]
    assert {r["lang_pred"] for r in run(spark, docs, languages=3)} == {"en", "fr", "de"}


def test_texts_without_letters_nulls_and_long_texts(spark):
    docs = texts(2, 200) + [(1000, None, "en"), (1001, "", None), (1002, "12 34 !?\n", "fr"), (None, "the and of the", "en"), (1003, "der und " * 100000, None), (5, docs_text := "the of", None), (5, docs_text, None)]
    rows = run(spark, docs, sample=200)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert len(rows) == len(docs)
    assert by[1000] == by[1001] == by[1002] == [("und", 0.0)]
    assert by[1003][0][0] == "de" and by[None][0][0] == "en" and len(by[5]) == 3


def test_no_training_rows(spark):
    assert run(spark, []) == []
    (row,) = run(spark, [(1, "some text", None)])
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_columns_are_the_same_in_parts():
    text = " ".join(random.Random(3).choice(["été", "the", "Straße"]) for _ in range(400))
    whole, parts = columns_of(text), columns_of(text, step=64)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_penalty_leaves_zeros_and_temperature_calibrates():
    rng = np.random.default_rng(1)
    model = FtrlRegression(2, l1=1.0)
    for i in range(500):
        noise = rng.integers(10, 1000, 5)
        model.learn(np.unique(np.append(noise, i % 2)), np.full(len(np.unique(np.append(noise, i % 2))), 0.4), i % 2)
    w = model.weights(slice(None))
    assert (w[:, 2000:] == 0).all() and (w[:, 10:1000] == 0).mean() > 0.3 and w[0, 0] > 0 > w[0, 1]
    truth = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=np.exp(x) / np.exp(x).sum()) for x in truth])
    assert abs(fit_temperature(truth * 3, labels) - 3) < 0.3
