"""Secrets: known formats as labels, probabilistic automata inferred from them, and a score for every candidate.

Base spans (assignments, access keys, hexadecimal runs) are labelled credentials. For each kind, the
distinct credentials of a sample form a prefix tree over character classes with counts. States
whose outgoing shares are statistically compatible (Hoeffding bound, also for all their followers)
are merged, breadth first, which leaves a probabilistic automaton of the format. A background chain
of the same classes is fitted to the other candidates. A candidate is a token of at least ``MIN_LENGTH``
characters that mixes letters and digits; it is added when its likelihood ratio per character
exceeds a limit under some automaton and no base span overlaps it.

The sample for fitting is bounded by ``sample`` distinct class strings per kind, taken by hash over the
whole corpus; everything else covers all documents, and texts are read where they are.

Defined cases: a null text is empty; repeated rows are judged alike; an empty table gives no row;
without labelled credentials only base spans are found, i.e. none.
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixloom.llm.scratch import Scratch

KINDS = ("assign", "access", "hex")
MIN_LENGTH = 12
BASE = {
    "assign": re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    # Runs below the least length fail, whether they are matched or not.
    "access": re.compile(r"AKIA[A-Z0-9]{14,}"),
    "hex": re.compile(r"[0-9a-f]{16,}"),
}
LEAST_ASSIGNED = 12
WORDS = ("passw", "secret", "token", "api")
TOKEN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{MIN_LENGTH},}}")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
END = "$"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """start, kind number, end and credential of each base span, sorted."""
    low = text.lower()
    found = []
    if any(w in low for w in WORDS):
        found = [(m.start(), 0, m.end(), m[2]) for m in BASE["assign"].finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    found += [(m.start(), at, m.end(), m[0]) for at, kind in enumerate(KINDS) if at for m in BASE[kind].finditer(text)]
    return sorted(found)


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    """Tokens that may be credentials: long enough, with letters and digits."""
    for m in TOKEN.finditer(text) if DIGIT.search(text) else ():
        token = m[0].strip(".=-")
        if len(token) >= MIN_LENGTH and DIGIT.search(token) and LETTER.search(token):
            start = m.start() + m[0].index(token)
            yield start, start + len(token), token


def classes(token: str) -> str:
    """Character classes: hexadecimal and other lower-case letters, the same in capitals, digits; marks stand for themselves."""
    return token.translate(_CLASSES)


_CLASSES = str.maketrans(
    {c: "d" for c in "0123456789"}
    | {c: "h" for c in "abcdef"}
    | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
    | {c: "H" for c in "ABCDEF"}
    | {c: "L" for c in "GHIJKLMNOPQRSTUVWXYZ"}
)
#: How many characters a class has: a class string stands for that many strings.
_WIDTH = {"d": 10, "h": 6, "l": 20, "H": 6, "L": 20}


class Automaton:
    """Prefix tree with counts whose compatible states are merged."""

    def __init__(self, strings: dict[str, int], alpha: float = 0.01):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[Counter] = [Counter()]
        for string, n in sorted(strings.items()):
            self._insert(string, n)
        self.alpha = alpha
        self._merge_states()

    def _insert(self, string: str, n: int) -> None:
        state = 0
        for c in string:
            self.seen[state][c] += n
            if c not in self.next[state]:
                self.next[state][c] = len(self.next)
                self.next.append({})
                self.seen.append(Counter())
            state = self.next[state][c]
        self.seen[state][END] += n

    def _differ(self, a: int, b: int) -> bool:
        """Whether some outgoing share of the states differs by more than chance."""
        x, y = self.seen[a], self.seen[b]
        n, m = sum(x.values()), sum(y.values())
        limit = math.sqrt(math.log(2 / self.alpha) / 2) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return any(abs(x[c] / n - y[c] / m) > limit for c in x.keys() | y.keys())

    def _compatible(self, a: int, b: int) -> bool:
        """Also for the followers of both; states of a tree below ``b`` are met once."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(a, b):
                return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the automaton at ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.seen[a].update(self.seen[b])
            for c, below in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], below))
                else:
                    self.next[a][c] = below

    def _merge_states(self) -> None:
        """Each state next to a kept one joins the first kept state that it is compatible with, or is kept itself."""
        self.kept, inside = [0], {0}
        while edge := next(((k, c) for k in self.kept for c in sorted(self.next[k]) if self.next[k][c] not in inside), None):
            parent, c = edge
            state = self.next[parent][c]
            if other := next((k + 1 for k in self.kept if self._compatible(k, state)), 0):
                self.next[parent][c] = other - 1
                self._fold(other - 1, state)
            else:
                self.kept.append(state)
                inside.add(state)

    def table(self) -> dict[int, dict[str, tuple[int, float]]]:
        """Per kept state: class to follower and log probability of one of its characters."""
        out = {}
        for s in self.kept:
            total = sum(self.seen[s].values())
            out[s] = {
                c: (self.next[s].get(c, -1), math.log(n / total / _WIDTH.get(c, 1))) for c, n in self.seen[s].items()
            }
        return out


UNSEEN = math.log(1e-4)


def likelihood(table: dict[int, dict[str, tuple[int, float]]], string: str) -> float:
    """Log probability of ``string``; after a step the automaton doesn't know it goes on from its start."""
    state, total = 0, 0.0
    for c in string:
        follower, log = table[state].get(c, (0, UNSEEN))
        total += log
        state = follower
    return total + table[state].get(END, (0, UNSEEN))[1]


class Background:
    """Chain of character classes, smoothed."""

    def __init__(self, strings: dict[str, int]):
        pairs, alphabet = Counter(), {*_WIDTH, *"+/_.=-"}
        for string, n in strings.items():
            for pair in zip(END + string, string + END, strict=True):
                pairs[pair] += n
        totals = Counter()
        for (a, _), n in pairs.items():
            totals[a] += n
        self.log = {
            (a, b): math.log((pairs[a, b] + 1) / (totals[a] + len(alphabet) + 1) / _WIDTH.get(b, 1))
            for a in (*alphabet, END)
            for b in (*alphabet, END)
        }

    def likelihood(self, string: str) -> float:
        return sum(self.log[pair] for pair in zip(END + string, string + END, strict=True))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class strings with their kind, ``other`` for candidates without base span, and counts."""
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            text = text or ""
            spans = base_spans(text)
            taken = _Taken(spans)
            counts.update((KINDS[k], classes(secret)) for _, k, _, secret in spans)
            counts.update(("other", classes(t)) for a, b, t in candidates(text) if taken.is_free(a, b))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in counts], pa.string()),
                pa.array([s for _, s in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["kind", "string", "n"],
        )


class _Taken:
    """Which stretches the base spans (sorted by start) cover."""

    def __init__(self, spans: list):
        self.starts = [a for a, *_ in spans]
        self.reach = list(itertools.accumulate((b for _, _, b, _ in spans), max))

    def is_free(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return not before or self.reach[before - 1] <= start


class Detector:
    """Automata of the kinds and the background."""

    def __init__(self, samples: dict[str, dict[str, int]], limit: float):
        self.tables = {k: Automaton(samples[k]).table() for k in KINDS if samples.get(k)}
        self.background = Background(samples.get("other", {}))
        self.limit = limit

    def kind_of(self, token: str) -> str | None:
        """Kind of the automaton with the best ratio per character, if above the limit."""
        string = classes(token)
        plain = self.background.likelihood(string)
        best = max(((likelihood(t, string) - plain, k) for k, t in self.tables.items()), default=(0.0, None))
        return best[1] if best[0] > self.limit * len(string) else None

    def spans(self, text: str) -> tuple[list, list]:
        base = base_spans(text)
        taken, added = _Taken(base), []
        for start, end, token in candidates(text):
            if taken.is_free(start, end) and (kind := self.kind_of(token)):
                added.append((start, KINDS.index(kind), end))
        return [x[:3] for x in base], added


def fit(docs: DataFrame, scratch: Scratch, sample: int = 2000, longest: int = 256, min_count: int = 20, limit: float = 0.3) -> Detector:
    """Automata from labelled credentials of ``docs``.

    At most ``sample`` distinct class strings per kind, of at most ``longest`` characters, come to
    the driver, chosen by hash. A kind with fewer than ``min_count`` of them gets no automaton.
    """
    counted = docs.select(F.col("text").cast("string")).mapInArrow(_labelled, "kind string, string string, n long")
    counted = scratch.keep(counted.groupBy("kind", "string").agg(F.sum("n").alias("n")).filter(F.length("string") <= longest))
    place = F.xxhash64("string")
    samples: dict[str, dict[str, int]] = {}
    for kind in (*KINDS, "other"):
        rows = counted.filter(F.col("kind") == kind).orderBy(place, "string").limit(sample).collect()
        if len(rows) >= min_count or kind == "other":
            # Copies of one document don't make a format.
            samples[kind] = {r["string"]: 1 for r in rows}
    scratch.drop(counted)
    return Detector(samples, limit)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, detector: Detector) -> DataFrame:
    """Per row of ``docs``: doc_id, ``base`` and ``added`` spans, ``all`` of them by start and kind; no shuffle."""
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def named(spans: list) -> list:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [detector.spans(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([named(b) for b, _ in found], pa.list_(struct)),
                    pa.array([named(a) for _, a in found], pa.list_(struct)),
                    pa.array([named(sorted(b + a)) for b, a in found], pa.list_(struct)),
                ],
                names=["doc_id", "base", "added", "all"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, base {SPANS}, added {SPANS}, all {SPANS}")
