import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from mixloom.llm.pii import KINDS, NEAR, _candidates, find_pii
from mixloom.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub(r"[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), KINDS.index(k), m.end()) for k, p in BASE.items() for m in re.finditer(p, text or "") if valid(k, m[0])]
    return [(KINDS[k], a, b) for a, k, b in sorted(spans)]


def run(spark, docs, schema=SCHEMA, **more):
    scratch = Scratch(spark)
    rows = find_pii(spark.createDataFrame(docs, schema), scratch, **more).collect()
    scratch.close()
    return rows


def plain(spans):
    return [(s["kind"], s["start"], s["end"]) for s in spans]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(4)
    parts = ["a@b.c", "_x@d.e", "@", ".", "1", "4111111111111111", "4111 1111-1111 1111", "  ", " ", "+", "+1 (555) 123-4567", "1.2.3.4", ".256.1", "00012.0.0.1", "é", "😀", "-", "5", "x", "\n", "+4", "12345678901", "a.b%c@"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(1500)]
    docs += [(2000, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 x@y@z.w"), (2001, None), (2002, ""), (2003, "1" * 50000 + " " + "a" * 50000 + " " + "1.1" * 20000), (2004, "a@" + "b." * 20000 + "c")]
    got = {r["doc_id"]: plain(r["base"]) for r in run(spark, docs)}
    for i, text in docs:
        assert got[i] == brute(text), text[:200]


def test_patterns_find_unseen_identifiers(spark):
    docs = [(i, f"please write to mail address: user{i}@mail.example.org today thanks") for i in range(8)]
    docs += [(20, "please write to mail address: user77(at)mail(dot)example today thanks")]
    docs += [(30 + i, f"some number of things {i} is here") for i in range(8)]
    docs += [(40, "some number of things 5550001 is here")]
    rows = {r["doc_id"]: r for r in run(spark, docs)}
    (span,) = plain(rows[20]["added"])
    assert span[0] == "email" and docs[8][1][span[1] : span[2]] == "user77(at)mail(dot)example"
    assert plain(rows[20]["all"]) == [span]
    assert all(r["added"] == [] for d, r in rows.items() if d != 20)
    assert plain(rows[3]["base"]) == brute(docs[3][1])


def test_copies_do_not_make_a_pattern(spark):
    docs = [(i, "contact point one@example.com now") for i in range(50)] + [(60, "contact point x9 now")]
    assert all(r["added"] == [] for r in run(spark, docs))


def test_a_second_round_reaches_further(spark):
    docs = [(i, f"mail {i}a@x.org please") for i in range(12)]
    # Unseen forms in the trusted pattern, which then make another pattern trusted.
    docs += [(100 + i, f"mail odd{i} please") for i in range(2)] + [(200 + i, f"reach odd{i % 2} or b{i}@y.org soon") for i in range(6)]
    docs += [(300 + i, f"ping b{i}@y.org soon") for i in range(8)] + [(400, "ping form9 soon")]
    rows = {r["doc_id"]: plain(r["added"]) for r in run(spark, docs, trust=0.6)}
    assert rows[400] and rows[100]


def words_around(text):
    """Candidates with their neighbouring words, by a plain walk over the words."""
    words = [(m.start(), m.end()) for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text)]
    runs = []
    for k, (a, b) in enumerate(words):
        if not re.search(r"[0-9@]", text[a:b]):
            continue
        if runs and runs[-1][1] == k - 1 and text[words[k - 1][1] : a] == " ":
            runs[-1][1] = k
        else:
            runs.append([k, k])

    def bare(ks):
        return [w for w in (text[slice(*words[k])].lower().strip(string.punctuation) for k in ks if 0 <= k < len(words)) if w]

    out = []
    for first, last in runs:
        start, run = words[first][0], text[words[first][0] : words[last][1]]
        inner = run.lstrip("\"'([<")
        start += len(run) - len(inner)
        inner = inner.rstrip(".,;:!?\"')]>")
        left, right = bare(range(first - NEAR, first)), bare(range(last + 1, last + 1 + NEAR))
        l2, l1 = ["", "", *left][-2:]
        if inner:
            out.append((start, start + len(inner), inner, l2, l1, (right or [""])[0]))
    return out


def test_candidates_equal_a_walk_over_the_words(spark):
    rng = random.Random(7)
    parts = ["a", "Word", "7", "x@y", "@", "-", "(5)", "..", "\"q1\",", " ", " ", " ", " ", "  ", "\n", "\t", "é9", "😀", "end."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    texts += [" ".join(f"w{i}" if i % 3 else "plain" for i in range(2000)), "\n".join(str(i) for i in range(700)), "1", " 1 "]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).select("doc_id", _candidates(F.col("text")).alias("c"))
    got = {r["doc_id"]: [tuple(c) for c in r["c"] or []] for r in df.collect()}
    for i, text in enumerate(texts):
        assert got[i] == words_around(text), text[:200]


def test_a_long_text_with_very_many_candidates(spark):
    rng = random.Random(8)
    forms = ["u{}@x.org", "10.0.{}.7", "+1 555 {:07d}", "id{}"]
    n = 60_000
    text = "\n".join(f"mail {forms[i % 4].format(rng.randint(0, 255))} sent" for i in range(n))
    began = time.monotonic()
    (row,) = run(spark, [(1, text)])
    assert plain(row["base"]) == brute(text)
    assert time.monotonic() - began < 120
    spans = [(s, e) for _, s, e in plain(row["added"])]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_repeated_rows_and_other_columns(spark):
    docs = [(1, "x@y.z", "q"), (1, "x@y.z", "q"), (None, "1.2.3.4", "r")]
    rows = run(spark, docs, SCHEMA + ", base string")
    assert sorted((r["doc_id"] or 0, plain(r["base"])) for r in rows) == [(0, [("ip", 0, 7)]), (1, [("email", 0, 5)]), (1, [("email", 0, 5)])]


def test_empty_table(spark):
    assert run(spark, []) == []
