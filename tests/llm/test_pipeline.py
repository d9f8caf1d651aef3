"""Each stage of the pipeline against the brute-force version of its operator, on the stage's own input."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_linededup, test_mixing, test_neardup, test_packing, test_quality

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # Null, empty, repeated and long rows go along.
    extra = [(9001, None, None, None, None), (9002, "", "en", "src1", 0), (9003, "word " * 9000, "en", None, 1)]
    docs = docs.select(*COLUMNS).union(spark.createDataFrame(extra, docs.select(*COLUMNS).schema)).union(docs.limit(2).select(*COLUMNS))
    results = []
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / f"in{at}"))
        docs = spark.read.parquet(str(tmp_path / f"in{at}"))
        results.append(docs)
        docs = stage(spark, docs, FOLDER)
        if at < 4:
            assert docs.columns == COLUMNS
    final = docs.collect()
    before = [rows_of(d) for d in results]

    verdicts = test_quality.brute([(d, t, lang) for d, t, lang, *_ in before[0]])
    assert Counter(before[1]) == Counter(r for r, v in zip(before[0], verdicts) if v[-1])
    assert 0 < len(before[1]) < len(before[0])

    unique = {(r[0], r[1]): r for r in before[1]}
    kept = test_linededup.brute([(d, t, None) for d, t in unique])
    expected = Counter((r[0], kept[r[0]]) for r in before[1] if kept[r[0]].split())
    assert Counter((r[0], r[1]) for r in before[2]) == expected

    components = test_neardup.brute([(r[0], r[1]) for r in before[2]], 5, 80)
    assert sorted(r[0] for r in before[3]) == sorted({c for c in components.values()})

    total = sum(len(r[1].split()) for r in before[3])
    exponent = corpus_pipeline.mix_sources(results[3], corpus_pipeline._fresh(spark)).agg(F.max("_m_exponent")).first()[0]
    copies = test_mixing.brute([(r[0], r[1], r[3]) for r in before[3]], exponent, total, 1024)
    wanted = Counter()
    for i, n in copies.items():
        wanted[before[3][i]] += n
    assert Counter(before[4]) == +wanted

    test_packing.check(final, [(r[0], r[1]) for r in before[4]], 4096, 256)


def test_near_duplicates_are_decided_by_row(spark):
    page = "one two three four five six seven eight nine ten eleven twelve"
    other = "red orange yellow green blue indigo violet black white grey"
    rows = [(1, page), (1, other), (1, page), (2, page), (None, page), (None, "some words of a row without an id"), (7, None), (7, ""), (7, " ")]
    rows += [(None, other), (8, "a lone page"), (None, "a lone page"), (None, "both without"), (None, "both without")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert out.columns == COLUMNS
    kept = Counter((r["doc_id"], r["text"]) for r in out.collect())
    lone = {(1, page): 1, (1, other): 1, (None, "some words of a row without an id"): 1, (8, "a lone page"): 1, (None, "both without"): 1}
    assert kept == Counter({**lone, (7, None): 1, (7, ""): 1, (7, " "): 1})


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0
