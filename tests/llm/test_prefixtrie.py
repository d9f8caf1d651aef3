import hashlib
import random
import zlib

import pytest

from mixloom.llm import prefixtrie
from mixloom.llm.prefixtrie import prefix_trie
from mixloom.llm.queries import ORACLE
from mixloom.llm.scratch import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    below = {}
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in below
            saved[node[:d]] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(below.get(node, [])), leaves[node], saved[node], sha))
    return sorted(out)


def run(spark, rows, schema=SCHEMA):
    scratch = Scratch(spark)
    out = sorted(tuple(r) for r in prefix_trie(spark.createDataFrame(rows, schema), scratch).collect())
    scratch.close()
    return out


def talk(seed, convs=60, most=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.choice([rng.randrange(40), 100 + rng.randrange(8), 200, 1000 + rng.randrange(300), -rng.randrange(250)])
        if any(r[0] == c for r in rows):
            continue
        for turn in range(rng.randrange(1, most)):
            said = rng.choice(["yes", "né", "日本語", "why not?", "", None])
            rows.append((c, turn, rng.choice(["user", "user", "assistant", None]), said))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = talk(seed)
    assert run(spark, rows) == brute(rows)


def test_null_turns_ties_and_repeats(spark):
    rows = talk(4) + [(7, None, "user", "b"), (7, None, "user", "a"), (7, 1, "user", "x"), (7, 1, "user", "x"), (None, 1, "user", "lost")]
    rows += [(8, None, "user", "a"), (8, None, "user", "b"), (8, 1, "user", "x")]
    assert run(spark, rows) == brute(rows)


def test_turnless_conversations(spark):
    lone = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 >= 2]
    rows = [(c, 0, "user", "gone") for c in lone[:5]]
    got = run(spark, rows)
    assert got == brute(rows)
    assert got[0][1:6] == (0, None, 5, 0, 1)


def test_one_conversation_over_many_ranges(spark):
    rng = random.Random(9)
    rows = [(300, i, "user", rng.choice("abc")) for i in range(3000)]
    rows += [(c, i, "user", rows[i][3]) for c in (301, 5300) for i in range(400)]
    rows += [(c, i, "assistant", "same " * (i + 1)) for c in range(400, 460) for i in range(7)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    assert run(spark, rows) == brute_long(rows)


def brute_long(rows):
    """As ``brute``, by prefix numbers instead of whole prefixes."""
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn, role, text))
    own = {c: [t[1:] for t in sorted(v)] for c, v in own.items()}
    step, children, chars, members, path = {}, {0: []}, {0: 0}, {0: []}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        at, path[c] = 0, [0]
        members[0].append(c)
        for turn in own.get(c - c % 100, [])[:h] + own[c][h:]:
            if (at, turn) not in step:
                step[at, turn] = len(chars)
                children[at].append(len(chars))
                chars[len(chars)], children[len(children)], members[len(members)] = len(turn[1]), [], []
            at = step[at, turn]
            members[at].append(c)
            path[c].append(at)
    depth, parent = {0: 0}, {0: None}
    for node in sorted(chars):
        for kid in children[node]:
            depth[kid], parent[kid] = depth[node] + 1, node
    leaves, saved = {}, {}
    for node in sorted(chars, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * chars[node]
    out = []
    for node in chars:
        ends = ",".join(str(c) for c in members[node] if path[c][-1] == node)
        up = None if parent[node] is None else min(members[parent[node]])
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[node]), depth[node], up, len(members[node]), len(children[node]), leaves[node], saved[node], sha))
    return sorted(out)


def test_many_members_end_at_one_node(spark):
    rows = [(100_000 + 100 * i + 1, 0, "user", "hello") for i in range(4000)]
    rows += [(100_000 + 100 * i, 0, "user", "hello") for i in range(0, 4000, 3)]
    assert run(spark, rows) == brute(rows)


def test_clash_of_fingerprints_is_seen(spark, monkeypatch):
    rows = talk(5)
    tried = []

    def weak(seed):
        tried.append(seed)
        return [1, 1, 1, 1] if seed == 0 else good(seed)

    good = prefixtrie._bases
    monkeypatch.setattr(prefixtrie, "_bases", weak)
    rows += [(90_001 + i, turn, "user", said) for i in range(30) for turn, said in enumerate(["ab", "ba"] if i % 2 else ["ba", "ab"])]
    assert run(spark, rows) == brute(rows)
    assert set(tried) == {0, 1}


def test_empty_table_and_other_columns(spark):
    assert run(spark, []) == []
    rows = talk(6)
    wide = [(*r, 1, 2, "k") for r in rows]
    assert run(spark, wide, SCHEMA + ", depth long, x long, conv string") == brute(rows)


def test_sql_states_the_same(spark):
    import duckdb

    rows = talk(7) + [(3, None, "user", "b"), (3, None, None, "a"), (None, 1, "user", "lost")]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(con.execute(ORACLE["op13_conversation_trie"]).fetchall()) == brute(rows)
