"""Removing passages that an earlier document has, by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of one document.  A word is removed if it lies in a window
whose words also start in a document with a smaller key; windows are judged on the input.

Every window has an anchor, the leftmost of its runs of ``GRAM`` words with the least hash.
Windows that follow each other with one anchor form a segment of at most
2 ``WINDOW`` - ``GRAM`` words.  Equal windows have equal anchors, so that only segments of
one anchor can share windows.  Anchors that occur once are dropped.  Equal segments are one
reference with its first document; in all later documents the whole segment goes.

Where an anchor has several different segments, these form the reference shard of the
anchor: its segments are added to a suffix automaton by rising document, and each is
streamed through the automaton of the earlier ones before it is added.  Wherever the
matching statistic reaches ``WINDOW`` words, the window goes.  A shard of more than ``SHARD``
segments, such as the edge of a passage that very many documents hold, is not brought
together: its windows are counted by their 128-bit hash with their first document, which gives the
same windows and splits over all tasks.

Cases: null and empty texts and those shorter than a window lose nothing; rows with a null key
lose nothing and are no reference; of rows with one key none is earlier than the other,
and all lose the same words if their texts agree; a passage repeated inside one document stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.tables import Work, map_batches

WINDOW = 50
GRAM = 16
SHARD = 256
_PLACE_BITS = 24
_SLICE = 1 << 22

SEGMENT = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("content", T.LongType()),
                        T.StructField("doc", T.LongType()), T.StructField("start", T.IntegerType()),
                        T.StructField("windows", T.IntegerType())])
RUN = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("content", T.LongType()),
                    T.StructField("doc", T.LongType()), T.StructField("offset", T.IntegerType()),
                    T.StructField("windows", T.IntegerType())])


def _least_places(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams the place of its least one, the leftmost among equals."""
    if len(grams) < width:
        return np.empty(0, np.int64)
    out = []
    for at in range(0, len(grams) - width + 1, _SLICE):
        part = grams[at:at + _SLICE + width - 1]
        least = (part >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while span < width:
            step = min(span, width - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        out.append((least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + at)
    return np.concatenate(out)


def _segments(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows from ``first``: word hashes, row bounds, and of each segment its
    row, first window (in its row), number of windows, and the place of its anchor."""
    for first, last, data, offsets in words.chunks(column):
        starts, ends, row = words.spans(data, offsets)
        code = words.hashes(data, starts, ends, lower=False)
        bounds = words.row_bounds(row, last - first)
        grams = words.grams(code, GRAM)
        least = _least_places(grams, WINDOW - GRAM + 1)
        inside = np.flatnonzero(row[:len(least)] == row[WINDOW - 1:WINDOW - 1 + len(least)]) if len(least) else least
        anchor, own = least[inside], row[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(inside)))
        yield first, code, bounds, own[at], inside[at], count, grams[anchor[at]] if len(at) else grams[:0]


def segments(documents: DataFrame) -> DataFrame:
    """anchor, content, doc, start, windows of every segment of doc, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            for first, code, bounds, row, begin, count, anchor in _segments(batch.column(1)):
                content = words.range_hashes(code, begin, begin + count + WINDOW - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.astype(np.int64)), pa.array(content.astype(np.int64)),
                     pa.array(docs[first + row].astype(np.int64)), pa.array((begin - bounds[row]).astype(np.int32)),
                     pa.array(count.astype(np.int32))], names=SEGMENT.names)

    return map_batches(documents, run, SEGMENT)


def _with_words(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """anchor, content, doc, codes: the word hashes of the wanted segments."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "content", "start", "windows")).alias("parts"))
    schema = T.StructType([*SEGMENT.fields[:3], T.StructField("codes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, last, data, offsets in words.chunks(batch.column(1)):
                starts, ends, row = words.spans(data, offsets)
                code = words.hashes(data, starts, ends, lower=False)
                bounds = words.row_bounds(row, last - first)
                out = []
                for i in range(first, last):
                    base = bounds[i - first]
                    for p in parts[i]:
                        a = base + p["start"]
                        out.append((p["anchor"], p["content"], docs[i], code[a:a + p["windows"] + WINDOW - 1].tobytes()))
                columns = zip(*out) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=schema.names)

    joined = documents.join(lists, "doc").select("doc", "text", "parts")
    return map_batches(joined, run, schema).dropDuplicates(["anchor", "content"])


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """A state for the strings of q that end at p's and c."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        state, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return state

    def matches(self, sequence: list[int]) -> list[int]:
        """For each place the length of the longest substring known that ends there."""
        state, size, out = 0, 0, []
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                size += 1
            out.append(size)
        return out


def _runs(held: np.ndarray) -> list[tuple[int, int]]:
    """First place and length of each run of places held."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], held, [False]]).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]


def _run_table(runs: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*runs)) if runs else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=RUN.names)


def _matched(shards: DataFrame) -> DataFrame:
    """Runs of a segment's windows that an earlier document's segment of the same anchor has."""

    def shard(anchor: int, segments: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int, int, int, int]]:
        automaton, waiting, out = SuffixAutomaton(), [], []
        for doc, content, codes in segments:
            if waiting and waiting[0][0] != doc:
                for _, earlier in waiting:
                    automaton.add(earlier)
                waiting = []
            sequence = codes.tolist()
            statistic = np.array(automaton.matches(sequence)[WINDOW - 1:])
            out += [(anchor, content, doc, *r) for r in _runs(statistic >= WINDOW)]
            waiting.append((doc, sequence))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, pending = None, []
        for batch in batches:
            out = []
            for a, doc, content, codes in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if a != anchor:
                    out += shard(anchor, pending)
                    anchor, pending = a, []
                pending.append((doc, content, np.frombuffer(codes, np.uint64)))
            yield _run_table(out)
        yield _run_table(shard(anchor, pending))

    rows = shards.select("anchor", "doc", "content", "codes").repartition("anchor")
    return map_batches(rows.sortWithinPartitions("anchor", "doc", "content"), run, RUN)


def _counted(shards: DataFrame) -> DataFrame:
    """The same for shards of any size, window by window."""
    schema = T.StructType([T.StructField("f", T.LongType()), T.StructField("g", T.LongType()), *RUN.fields[:4]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *own, packed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                codes = np.frombuffer(packed, np.uint64)
                at = np.arange(len(codes) - WINDOW + 1)
                prints = [words.range_hashes(x, at, at + WINDOW) for x in (codes, words.mix(codes ^ words.GRAM_BASE))]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.astype(np.int64)) for x in prints), *(pa.array(np.full(len(at), x)) for x in own),
                     pa.array(at.astype(np.int32))], names=schema.names)

    dealt = shards.select("anchor", "content", "doc", "codes").repartition("anchor", "content")
    windows = map_batches(dealt, run, schema)
    first = windows.groupBy("f", "g").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    return windows.join(first, ["f", "g"]).where("doc > first").select(*RUN.names[:4], F.lit(1).cast("int").alias("windows"))


def repeated(documents: DataFrame, work: Work, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc, spans: the word spans [start, end) to remove, one row per document that has any."""
    table = documents.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    every = work.keep(segments(table), "segments")
    # kept first, so that the join below is a plain one, whose large partitions Spark splits
    often = work.keep(every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "often")
    shared = work.keep(every.join(often, "anchor", "left_semi"), "shared")
    work.drop("segments")
    firsts = work.keep(
        shared.groupBy("anchor", "content").agg(F.min(F.struct("doc", "start", "windows")).alias("first"),
                                                F.max("doc").alias("last"))
        .select("anchor", "content", "first.*", "last"), "firsts")
    copied = firsts.where("last > doc").select("anchor", "content", F.col("doc").alias("first"))
    later = shared.join(copied, ["anchor", "content"]).where("doc > first").select("doc", "start", "windows")
    several = work.keep(firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "several")
    shards = work.keep(_with_words(firsts.join(several, "anchor"), table).join(several, "anchor"), "shards")
    partly = _matched(shards.where(F.col("n") <= SHARD)).unionByName(_counted(shards.where(F.col("n") > SHARD)))
    # a segment may occur more than once in its first document
    partly = shared.select("anchor", "content", "doc", "start").join(partly, ["anchor", "content", "doc"]).select(
        "doc", (F.col("start") + F.col("offset")).alias("start"), "windows")
    runs = later.unionByName(partly)
    span = F.struct("start", (F.col("start") + F.col("windows") + WINDOW - 1).alias("end"))
    return runs.groupBy("doc").agg(F.sort_array(F.collect_set(span)).alias("spans"))


def remove(documents: DataFrame, work: Work, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_words, n_removed, kept (the words that stay, joined by a space): one row per row."""
    spans = work.keep(repeated(documents, work, text, key), "spans")
    schema = T.StructType([documents.schema[key], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column(1)):
                counts, removed, kept = [], [], []
                for i, found in enumerate(batch.column(2).slice(first, last - first).to_pylist()):
                    own = data[offsets[i]:offsets[i + 1]].tobytes().split()
                    counts.append(len(own))
                    if found:
                        gone = np.zeros(len(own) + 1, np.int64)
                        np.add.at(gone, [s["start"] for s in found], 1)
                        np.add.at(gone, [s["end"] for s in found], -1)
                        gone = np.cumsum(gone[:-1]) > 0
                        own = [w for w, g in zip(own, gone.tolist()) if not g]
                    removed.append(counts[-1] - len(own))
                    kept.append(b" ".join(own).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(counts, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    narrow = documents.select(key, text)  # other columns are not looked at, whatever their names
    spans = spans.select(F.col("doc").alias("_repeats_doc"), F.col("spans").alias("_repeats_spans"))
    joined = narrow.join(spans, narrow[key].cast("bigint") == spans["_repeats_doc"], "left")
    return map_batches(joined.select(key, text, "_repeats_spans"), run, schema)
