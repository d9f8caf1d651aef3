import random

import pytest

from mixloom.llm.linededup import dedup_lines
from mixloom.llm.scratch import Scratch

SCHEMA = "doc_id long, text string, source string"


def brute(docs, min_words=5):
    """Kept text per document by comparing every suffix with every earlier one."""
    docs = sorted(docs, key=lambda d: d[0])
    seqs = []
    for at, (_, text, _) in enumerate(docs):
        lines = (text or "").split("\n")
        seqs += [(at, i, len(x.split())) for i, x in enumerate(lines) if x.split()]
    lines_of = [(t or "").split("\n") for _, t, _ in docs]
    out = {d[0]: set() for d in docs}
    for i in range(len(seqs)):
        best = 0
        for j in range(i):
            n = 0
            while i + n < len(seqs) and seqs[i + n][0] == seqs[i][0] and seqs[j + n][0] == seqs[j][0]:
                if lines_of[seqs[i + n][0]][seqs[i + n][1]] != lines_of[seqs[j + n][0]][seqs[j + n][1]]:
                    break
                n += 1
            best = max(best, n)
        if best and sum(x[2] for x in seqs[i : i + best]) >= min_words:
            out[docs[seqs[i][0]][0]] |= {x[1] for x in seqs[i : i + best]}
    for (at, line, _), (then, following, _) in zip(seqs, seqs[1:]):
        gone = out[docs[at][0]]
        if at == then and line in gone and following in gone:
            gone |= set(range(line, following))
    kept = {}
    for at, (doc, text, _) in enumerate(docs):
        if text is None:
            kept[doc] = None
            continue
        left = [x for i, x in enumerate(lines_of[at]) if i not in out[doc]]
        kept[doc] = "\n".join(left) if not out[doc] or any(x.split() for x in left) else ""
    return kept


def run(spark, docs, schema=SCHEMA, **more):
    scratch = Scratch(spark)
    rows = dedup_lines(spark.createDataFrame(docs, schema), scratch, **more).collect()
    scratch.close()
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = ["a b", "c", "d e f", "long line of six words here", "", " ", "x y z"]
    docs = [(i, "\n".join(rng.choice(pool + [f"own {i} {j}"]) for j in range(rng.randint(0, 14))), "s") for i in range(25)]
    docs += [(100, docs[3][1], "t"), (101, None, None), (102, "", "s"), (103, docs[5][1] + "\nend", "s")]
    got = {r["doc_id"]: r["text"] for r in run(spark, docs)}
    assert got == brute(docs)


def test_self_repeats_ties_nulls_and_other_columns(spark):
    same = "one two three four five"
    docs = [(1, f"{same}\n{same}\n{same}", "s", 7), (2, same, "s", 8), (2, same, "s", 9), (None, "p q r s t u", "s", 1), (3, "p q r s t u", "s", 2)]
    rows = run(spark, docs, "doc_id long, text string, source string, _l_runs int")
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["text"], r["_l_emptied"]))
    assert got == {1: [(same, False)], 2: [("", True)] * 2, None: [("p q r s t u", False)], 3: [("", True)]}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_line_in_every_document_and_a_very_long_text(spark):
    shared = "this line is in every document"
    docs = [(i, f"{shared}\nown {i}", "s") for i in range(300)]
    long = "\n".join(f"line number {i} of a long text" for i in range(5000))
    docs += [(1000, long, "s"), (1001, "new head of five words\n" + long, "s")]
    got = {r["doc_id"]: r["text"] for r in run(spark, docs)}
    assert got[0] == f"{shared}\nown 0" and all(got[i] == f"own {i}" for i in range(1, 300))
    assert got[1000] == long and got[1001] == "new head of five words"
