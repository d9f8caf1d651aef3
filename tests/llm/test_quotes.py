import random
import re
from collections import Counter

import pytest

from mixloom.llm.quotes import link_quotes
from mixloom.llm.scratch import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"
INTRO = re.compile(r"\s*(?:On\b.*\bwrote|Am\b.*\bschrieb\b.*|Le\b.*\ba écrit|El\b.*\bescribió)\s*:\s*$")


def norm(body):
    return " ".join(w for w in re.split(r"[\x20\x09-\x0D]+", body.lower()) if w)


def parse(text):
    out = []
    for line in (text or "").split("\n"):
        marks = re.match(r"(?: {0,3}>)*", line)[0]
        out.append((marks.count(">"), line[len(marks) :]))
    return out


def passages(lines):
    runs, last = [], None
    for level, body in lines:
        words = norm(body)
        if not words:
            last = None
            continue
        if last == level:
            runs[-1][1].append(words)
        else:
            runs.append((level, [words]))
        last = level
    return runs


def brute(rows):
    """Per (conversation, turn): reply_to, by quote, depth, passages, linked, own text."""
    keyed = [(c, t) for c, t, *_ in rows]
    parsed = {(c, t): parse(x) for c, t, _, x in rows}
    own = {k: {w for lvl, ls in passages(p) if lvl == 0 for w in (" ".join(ls), *ls)} for k, p in parsed.items()}
    out = {}

    def latest(conv, turn, words):
        found = [t for c, t in keyed if c == conv and t < turn and words in own[c, t]]
        return max(found, default=None)

    for c, t in sorted(keyed):
        votes, n, linked = Counter(), 0, 0
        quoted = {(lvl, " ".join(ls)): ls for lvl, ls in passages(parsed[c, t]) if lvl > 0}
        for (lvl, words), ls in quoted.items():
            origin = latest(c, t, words)
            if origin is None:
                origin = max((x for x in (latest(c, t, one) for one in ls) if x is not None), default=None)
            n, linked = n + 1, linked + (origin is not None)
            if lvl == 1 and origin is not None:
                votes[origin] += 1
        parent = max(votes, key=lambda o: (votes[o], o)) if votes else None
        by_quote = parent is not None
        if parent is None:
            parent = max((x for d, x in keyed if d == c and x < t), default=None)
        lines = parsed[c, t]
        kept = [
            b
            for i, (lvl, b) in enumerate(lines)
            if lvl == 0 and not (INTRO.match(b) and i + 1 < len(lines) and lines[i + 1][0] > 0)
        ]
        text = re.sub(r"\s+$", "", re.sub(r"^\s*\n", "", "\n".join(kept)))
        depth = 0 if parent is None else out[c, parent][2] + 1
        out[c, t] = (parent, by_quote, depth, n, linked, text)
    return out


def run(spark, rows, schema=SCHEMA):
    scratch = Scratch(spark)
    found = link_quotes(spark.createDataFrame(rows, schema), scratch).collect()
    scratch.close()
    return found


def got(rows):
    return {(r["conv_id"], r["turn"]): (r["_c_reply_to"], r["_c_by_quote"], r["_c_depth"], r["_c_passages"], r["_c_linked"], r["text"]) for r in rows}


def test_a_thread(spark):
    rows = [
        (1, 0, "user", "Hello  all,\nwhat is new?"),
        (1, 1, "assistant", "On Monday user wrote:\n> hello all,\n> What is new?\n\nNothing much."),
        (1, 2, "user", "An aside."),
        (1, 3, "user", ">> what is new?\n> Nothing   MUCH.\n\nReally?"),
        (2, 0, "user", "> Nothing much.\nfrom elsewhere"),
    ]
    found = got(run(spark, rows))
    assert found == brute(rows)
    assert found[1, 3] == (1, True, 2, 2, 2, "Really?")
    assert found[2, 0] == (None, False, 0, 1, 0, "from elsewhere")


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    phrases = ["a b", "A  b", "c", "d e f", "", " ", "On x wrote:", "g\th"]
    rows = []
    for conv in range(6):
        for turn in range(rng.randint(1, 9)):
            lines = [rng.choice(["", "", "> ", ">> ", ">", " > > ", "    > "]) + rng.choice(phrases) for _ in range(rng.randint(0, 7))]
            rows.append((conv, turn * 3, "user", "\n".join(lines)))
    rows += [(100, i * 200, "user", f"own {i}\n> own {i - 3}\n> own {i - 2}\n\n> everywhere") for i in range(12)]
    assert got(run(spark, rows)) == brute(rows)


def test_nulls_repeated_rows_and_clashing_columns(spark):
    rows = [(1, 0, "u", "first"), (1, 1, "u", None), (1, 1, "u", "> first\nx"), (None, 0, "u", "y"), (2, None, "u", "> y\nz")]
    found = run(spark, [(*r, 5) for r in rows], SCHEMA + ", _c_depth int")
    assert len(found) == 5
    facts = sorted((str(r["conv_id"]), str(r["turn"]), r["text"], r["_c_reply_to"], r["_c_depth"]) for r in found)
    assert facts == [("1", "0", "first", None, 0), ("1", "1", "", 0, 1), ("1", "1", "x", 0, 1), ("2", "None", "z", None, 0), ("None", "0", "y", None, 0)]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_one_long_conversation(spark):
    rows = [(1, i, "u", f"message {i % 7}\n> message {(i - 1) % 7}") for i in range(600)]
    found = got(run(spark, rows))
    assert found[1, 599][:3] == (598, True, 599) and found[1, 0][:3] == (None, False, 0)
