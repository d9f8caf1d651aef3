import random
import re

from mixloom.llm.scratch import Scratch
from mixloom.llm.secrets import KINDS, Automaton, base_spans, classes, find_secrets, fit, likelihood

SCHEMA = "doc_id long, text string"


def brute(text):
    """The rules, letter by letter as they are stated."""
    any_case = "|".join(
        "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")
    )
    rules = (
        (rf"""({any_case})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        (r"AKIA[A-Z0-9]+", 0, 18),
        (r"[0-9a-f]+", 0, 16),
    )
    found = [(m.start(), k, m.end()) for k, (p, g, n) in enumerate(rules) for m in re.finditer(p, text or "") if len(m[g]) >= n]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def run(spark, docs, schema=SCHEMA, **more):
    scratch = Scratch(spark)
    df = spark.createDataFrame(docs, schema)
    rows = find_secrets(df, fit(df, scratch, **more)).collect()
    scratch.close()
    return rows


def plain(spans):
    return [(s["kind"], s["start"], s["end"]) for s in spans]


def secret(rng, n, alphabet="0123456789abcdef"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(2)
    parts = ["token", "Secret", "API_KEY", "apikey", "pAsswd", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "api_key: ", "abc", "\n", "é", "K", "ſecret", "zzzzzzzzzzzzz", "-", "."]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(1500)]
    docs += [(3000, None), (3001, ""), (3002, "a" * 200000), (3003, "token=" * 30000), (3004, "secret=api_key: AAAAAAAAAAAAAAA")]
    got = {r["doc_id"]: plain(r["base"]) for r in run(spark, docs)}
    for i, text in docs:
        assert got[i] == brute(text), text[:200]


def test_automaton_keeps_the_format():
    rng = random.Random(1)
    strings = {"UUdd" * rng.randint(1, 6): 1 for _ in range(40)}
    for _ in range(300):
        strings["UU" + "".join(rng.choice(["dd", "ll"]) for _ in range(rng.randint(1, 8)))] = 1
    table = Automaton(strings).table()
    assert len(table) < 40
    assert likelihood(table, "UUddllddlldd") > likelihood(table, "UUdldldldldl") + 10
    assert likelihood(table, "UUdd") > likelihood(table, "ddUU") + 10


def test_unseen_credentials_of_a_learned_format(spark):
    rng = random.Random(7)
    docs = [(i, f"some words password={secret(rng, 20)} more words") for i in range(150)]
    docs += [(200 + i, f"see release-notes-v{i}.html and report_{i}_final.docx or part{i}number99 for more") for i in range(60)]
    # Too short for a hexadecimal run, and without a word in front.
    found = secret(rng, 15)
    docs += [(500, f"forgotten here: {found} and left"), (501, "nothing but words, 12 of them"), (502, "call 555-123-4567 or mail7.example.com")]
    rows = {r["doc_id"]: r for r in run(spark, docs)}
    spans = plain(rows[500]["added"])
    assert [docs[[d for d, _ in docs].index(500)][1][a:b] for _, a, b in spans] == [found]
    assert all(r["added"] == [] for d, r in rows.items() if d != 500)
    assert plain(rows[3]["all"]) == plain(rows[3]["base"]) == brute(docs[3][1])


def test_repeated_rows_other_columns_and_no_labels(spark):
    docs = [(1, "token: abcdef123456", "x"), (1, "token: abcdef123456", "x"), (None, "plain", "y")]
    rows = run(spark, docs, SCHEMA + ", base string")
    assert [plain(r["base"]) for r in rows if r["doc_id"]] == [[("assign", 0, 19)]] * 2
    assert run(spark, []) == []


def test_classes_and_overlaps():
    assert classes("aZ9-gF") == "hLd-lH"
    assert [k for _, k, _, _ in base_spans("secret=0123456789abcdef0")] == [0, 2]


def test_long_text_is_linear():
    import time

    from mixloom.llm.secrets import Detector

    rng = random.Random(3)
    text = " ".join(rng.choice([f"token={secret(rng, 16)}", "0123456789abcdef01", f"part{i}number99xx"]) for i in range(100_000))
    detector = Detector({"assign": {"dldldldldldl": 1}, "other": {"llllddllllllddll": 1}}, 0.3)
    begin = time.perf_counter()
    base, added = detector.spans(text)
    assert time.perf_counter() - begin < 20 and len(base) > 60_000
