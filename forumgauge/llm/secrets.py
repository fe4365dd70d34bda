"""Secrets in texts: rules, and probabilistic automata learned from what the rules find.

The rules' matches are the labelled credentials.  From a bounded sample of their
distinct values (``SAMPLE`` of each kind, those of lowest hash) a prefix tree is built
for each kind; states whose outgoing frequencies are compatible by Hoeffding's bound
are merged, which leaves a probabilistic automaton of the kind's format.  Another one
is learned from a sample of ordinary strings.  Every candidate string of every text
that no rule has found is scored; it is added if it is as likely, character by
character, as labelled credentials that were not learned from (a third of the sample),
and ``MARGIN`` likelier than as an ordinary string, in natural logarithms.  The ordinary sample may
hold unlabelled credentials, as long as they are less than a tenth of it.

Spans count code points, the end exclusive.  Cases: null and empty texts have no spans;
repeated rows are scanned each; with too few labelled credentials of a kind (``LEAST``)
nothing is added for it; empty tables give no rows.  Texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm.tables import Work, map_batches

KINDS = ("assign", "access", "hex")
SAMPLE = 400
ORDINARY_SAMPLE = 1200
LEAST = 8
ALPHA = 0.05
MARGIN = math.log(10.0)
PLACEHOLDER = "[secret]"

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
_DIGIT = re.compile(r"[0-9]")

SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType()), T.StructField("value", T.StringType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                  ("value", pa.string())]))


def rule_spans(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end and the secret of the rules' matches, by start and then kind."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    if _DIGIT.search(text) or len(text) >= 32:
        found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Strings of 16 and more credential characters with a digit that overlap no span."""
    if not _DIGIT.search(text):
        return []
    return [("", m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)
            if _DIGIT.search(m[0]) and all(m.end() <= s[1] or s[2] <= m.start() for s in taken)]


class Automaton:
    """A probabilistic automaton: for each state its moves, how often each was taken, and how often a string ended."""

    def __init__(self, strings: list[str], alpha: float = ALPHA):
        self.moves: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]
        for string in sorted(strings):
            self._add(string)
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._generalise()
        self.symbols = 64 + 8

    def _add(self, string: str) -> None:
        state = 0
        for c in string:
            self.taken[state][c] = self.taken[state].get(c, 0) + 1
            nearby = self.moves[state].get(c)
            if nearby is None:
                nearby = self.moves[state][c] = len(self.moves)
                self.moves.append({})
                self.taken.append({})
                self.ends.append(0)
            state = nearby
        self.ends[state] += 1

    def _visits(self, state: int) -> int:
        return self.ends[state] + sum(self.taken[state].values())

    def _differ(self, hits: int, visits: int, others: int, visits_of_others: int) -> bool:
        gap = abs(hits / visits - others / visits_of_others)
        return gap >= self._bound * (visits ** -0.5 + visits_of_others ** -0.5)

    def _compatible(self, a: int, b: int) -> bool:
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            n, m = self._visits(a), self._visits(b)
            if not n or not m:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if self._differ(self.taken[a].get(c, 0), n, self.taken[b].get(c, 0), m):
                    return False
                if c in self.moves[a] and c in self.moves[b]:
                    pending.append((self.moves[a][c], self.moves[b][c]))
        return True

    def _fold(self, into: int, state: int) -> None:
        """Add a tree's counts to the states it runs along."""
        pending = [(into, state)]
        while pending:
            into, state = pending.pop()
            self.ends[into] += self.ends[state]
            for c, count in self.taken[state].items():
                self.taken[into][c] = self.taken[into].get(c, 0) + count
                if c in self.moves[into]:
                    pending.append((self.moves[into][c], self.moves[state][c]))
                else:
                    self.moves[into][c] = self.moves[state][c]

    def _generalise(self) -> None:
        settled = [0]
        fringe = [(0, c) for c in sorted(self.moves[0])]
        known = {0}
        while fringe:
            parent, c = fringe.pop(0)
            state = self.moves[parent][c]
            if state in known:
                continue
            target = next((s for s in settled if self._compatible(s, state)), None)
            if target is None:
                settled.append(state)
                known.add(state)
                fringe += [(state, x) for x in sorted(self.moves[state])]
                continue
            self.moves[parent][c] = target
            before = set(self.moves[target])
            self._fold(target, state)
            fringe += [(s, x) for s in settled for x in sorted(self.moves[s])
                       if self.moves[s][x] not in known and (s, x) not in fringe and (s != target or x not in before)]

    def log_likelihood(self, string: str) -> float:
        """Of the string and its end; moves never seen have a small share and stay in the state."""
        state, total = 0, 0.0
        for c in string:
            taken, rest = self.taken[state], self._visits(state) + 0.05 * self.symbols
            total += math.log((taken.get(c, 0) + 0.05) / rest)
            state = self.moves[state].get(c, state)
        return total + math.log((self.ends[state] + 0.05) / (self._visits(state) + 0.05 * self.symbols))


class Formats:
    """The automata of all kinds and of ordinary strings, and each kind's usual likelihood."""

    def __init__(self, credentials: dict[str, list[str]], ordinary: list[str]):
        self.ordinary = Automaton(ordinary)
        self.kinds = {}
        for kind in KINDS:
            values = credentials.get(kind, [])
            if len(values) >= LEAST:
                automaton = Automaton([v for i, v in enumerate(values) if i % 3])
                usual = sorted(automaton.log_likelihood(v) / (len(v) + 1) for v in values[::3])
                self.kinds[kind] = automaton, usual[len(usual) // 50]

    def kind_of(self, string: str) -> str | None:
        best, most = None, MARGIN
        if not self.kinds:
            return None
        plain = self.ordinary.log_likelihood(string)
        for kind, (automaton, usual) in self.kinds.items():
            own = automaton.log_likelihood(string)
            if own - plain > most and own / (len(string) + 1) >= usual:
                best, most = kind, own - plain
        return best


def found(table: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, rules (spans of the rules), others (candidates)."""
    schema = T.StructType([table.schema[key], T.StructField("rules", SPAN), T.StructField("others", SPAN)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rules, others = [], []
            for value in batch.column(1):
                content = value.as_py() or ""
                rules.append(rule_spans(content))
                others.append(candidates(content, rules[-1]))
            columns = [pa.array([[dict(zip(("kind", "start", "end", "value"), s)) for s in row] for row in column],
                                _ARROW_SPAN) for column in (rules, others)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "rules", "others"])

    return map_batches(table.select(key, text), run, schema)


def _sample(spans: DataFrame, size: int) -> list[str]:
    rows = (spans.select("value").distinct()
            .orderBy(F.xxhash64("value"), "value").limit(size).collect())
    return [r["value"] for r in rows]


def learn(scanned: DataFrame) -> Formats:
    """Automata from bounded samples of the labelled credentials and of the candidates."""
    spans = scanned.select(F.explode("rules").alias("span")).select("span.kind", "span.value")
    credentials = {kind: _sample(spans.where(F.col("kind") == kind), SAMPLE) for kind in KINDS}
    ordinary = _sample(scanned.select(F.explode("others").alias("span")).select("span.value"), ORDINARY_SAMPLE)
    return Formats(credentials, ordinary)


def scan(documents: DataFrame, work: Work, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, rules, added: spans of the rules and those that the automata add, one row per row."""
    scanned = work.keep(found(documents, text, key), "found")
    formats = documents.sparkSession.sparkContext.broadcast(learn(scanned))
    schema = T.StructType([scanned.schema[key], T.StructField("rules", SPAN), T.StructField("added", SPAN)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added = []
            for row in batch.column(2).to_pylist():
                kinds = [formats.value.kind_of(span["value"]) for span in row or ()]
                added.append([span | {"kind": kind} for span, kind in zip(row or (), kinds) if kind])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(added, _ARROW_SPAN)],
                                             names=[key, "rules", "added"])

    return map_batches(scanned, run, schema)


def redact(documents: DataFrame, text: str = "text", placeholder: str = PLACEHOLDER, *,
           formats: Formats) -> DataFrame:
    """The documents with every span that rules or automata find replaced; other texts stay as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(formats)
    place = documents.columns.index(text)

    def clean(content: str | None) -> str | None:
        if not content:
            return content
        spans = rule_spans(content)
        spans += [s for s in candidates(content, spans) if shared.value.kind_of(s[3])]
        out, at = [], 0
        for _, start, end, _ in sorted(spans, key=lambda s: s[1]):
            if start >= at:
                out += [content[at:start], placeholder]
            at = max(at, end)
        return "".join([*out, content[at:]]) if spans else content

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([clean(x.as_py()) for x in batch.column(place)], pa.string())
            yield batch.set_column(place, text, texts)

    return map_batches(documents, run, documents.schema)
