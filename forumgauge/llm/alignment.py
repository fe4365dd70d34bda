"""Alignment of the tokens of two tokenizers, and how often their ids meet.

Tokenizer A is a byte-level BPE file, B a piece model with byte fallback.  Both
encode a text; the byte offsets at which a token of each ends cut the tokens into
groups.  The cuts are found in two steps.  The coarse ones come from the character
spans that both tokenizers report.  (The piece library has them in its offset mapping;
its present release refuses the immutable proto that had them.)  Tokens that end
inside a character are not told apart by spans, so wherever a coarse group holds a
multibyte character or a byte piece it is refined by the ends of the tokens' decoded
bytes.  Where all characters are ASCII, a token's span and its bytes are the same, and the
tokenizers, which spend much of their time on spans, are asked for ids alone.  A text counts only if the decoded bytes of each tokenizer,
joined, are the space and the text.

Words recur, so a text is first cut at spaces that follow other characters than
blanks, where neither tokenizer can join what stands on both sides: A's pattern
splits there, and no piece of B has a space inside.  Pieces of text met lately keep
their alignment, and a text's is put together from those of its pieces; when a task holds too
many, those met most often stay.

All pairs of an A and a B token of one group are links.  A document holds each id
pair with the number of its links; ids that repeat inside a group are multiplied,
not listed.  How many documents hold a pair is a grouped count over the corpus.
Pairs that have at least a hundred-thousandth of all holdings, 100,000 at most,
are then broadcast, the others joined by pair, so that no key has more than that
part of the rows; the highest count of each A id is a table of the vocabulary's
size.

Cases: null and empty texts, and texts whose bytes a tokenizer does not give back
(U+2581 for B), have no tokens: zeros and an empty string; the strings of special
tokens are plain text; repeated rows are documents of their own; a null key stays
null; empty tables give no rows; ties for the highest count all count as best;
texts are encoded whole; columns other than the key and the text are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.bpe import byte_symbols
from forumgauge.llm.tables import Work, map_batches

# Id pairs with at least this part of all holdings are broadcast: as many at most.
COMMON = 100_000
# Pairs of one row of the pair table; a document with more has several rows.
PART = 1 << 16
CHUNK_BYTES = 1 << 19
# What one task keeps of pieces of text met lately, and how many new pieces are encoded as one text.
CACHED_PIECES, CACHED_CHARS, CACHED_PAIRS = 500_000, 1 << 24, 1 << 22
TOGETHER = 20_000
# Links of a group that are listed before its ids are counted.
NARROW = 64

# Of a text with a space before it: the spaces where it is cut, but for one that ends it.
_CUT = re.compile(r"(?<=\S) (?=[\s\S])")
_SPACE_INSIDE = re.compile("[^▁]▁")


class Vocabulary:
    """The bytes of each id, and its decimal digits, as tables with offsets."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = _Strings(tokens)
        self.digits = _Strings([str(i).encode() for i in range(len(tokens))])


class _Strings:
    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _taken(strings: _Strings, ids: np.ndarray) -> np.ndarray:
    return strings.bytes[_runs(strings.starts[ids], strings.sizes[ids])]


class Store:
    """The alignment of pieces of text met lately, by number, as arrays that grow.

    ``sums`` has n_a, n_b, n_groups, n_links of each piece; the linked id pairs of piece
    i are those from ``bounds[i]`` to ``bounds[i + 1]`` of ``codes`` (a * ids of B + b),
    with the number of links in ``times``.  ``met`` says how often texts had the piece.
    """

    def __init__(self):
        self.number: dict[str, int] = {}
        self.listing: list[str | None] = []
        self.sums, self.met = np.zeros((0, 4), np.int64), np.empty(0, np.int64)
        self.bounds, self.codes, self.times = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.chars = 0

    def add(self, pieces: list[str], listing: list[str | None], sums: np.ndarray, held: np.ndarray,
            codes: np.ndarray, times: np.ndarray) -> None:
        for piece in pieces:
            self.number[piece] = len(self.number)
            self.chars += len(piece)
        self.listing += listing
        self.sums, self.met = np.concatenate([self.sums, sums]), np.append(self.met, np.zeros(len(pieces), np.int64))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(held)])
        self.codes, self.times = np.concatenate([self.codes, codes]), np.concatenate([self.times, times])

    def full(self) -> bool:
        return len(self.listing) > CACHED_PIECES or self.chars > CACHED_CHARS or len(self.codes) > CACHED_PAIRS

    def often(self) -> Store:
        """A store of the pieces met most often, more than once, half as full at most; their counts are halved."""
        pieces, held = list(self.number), np.diff(self.bounds)
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        least, kept = 2, np.flatnonzero(self.met >= 2)
        while 2 * len(kept) > CACHED_PIECES or 2 * chars[kept].sum() > CACHED_CHARS or 2 * held[kept].sum() > CACHED_PAIRS:
            least *= 2
            kept = kept[self.met[kept] >= least]
        where, out = _runs(self.bounds[kept], held[kept]), Store()
        out.add([pieces[i] for i in kept.tolist()], [self.listing[i] for i in kept.tolist()], self.sums[kept], held[kept],
                self.codes[where], self.times[where])
        out.met = self.met[kept] // 2
        return out


class Aligned(NamedTuple):
    """The alignment of one text."""

    listing: str
    sums: np.ndarray  # n_a, n_b, n_groups, n_links
    codes: np.ndarray
    times: np.ndarray


class Aligner:
    """Both tokenizers, made from the content of their files, in one task."""

    def __init__(self, a_file: str, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        spec = json.loads(a_file)
        strings = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {symbol: b for b, symbol in enumerate(byte_symbols())}
        tokens = [b""] * (max(strings.values()) + 1)
        for string, i in strings.items():
            tokens[i] = bytes(byte_of[c] for c in string)
        self.a_words = Vocabulary(tokens)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.is_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_words = Vocabulary([bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode()
                                   for p, byte in zip(pieces, self.is_byte)])
        self.width = len(pieces)
        self.codes = len(tokens) * len(pieces)
        kind = spec["pre_tokenizer"] or {}
        apart = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not spec["normalizer"]
        apart = apart and not any(_SPACE_INSIDE.search(p) for p, byte in zip(pieces, self.is_byte) if not byte)
        self.cut = _CUT.split if apart else lambda text: [text]
        self.store = Store()

    def align(self, texts: list[str]) -> Iterator[Aligned | None]:
        """The alignment of each text, put together from its pieces; None without tokens."""
        cut = [self.cut(text) if text else [] for text in texts]
        if self.store.full():
            self.store = self.store.often()
        self._learn([p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in self.store.number])
        store = self.store
        sizes = np.array([len(pieces) for pieces in cut], np.int64)
        numbers = np.fromiter(map(store.number.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        store.met += np.bincount(numbers, minlength=len(store.met))
        ends = np.cumsum(sizes)
        # Pairs of all texts at once, put in order by text and code.
        held = np.diff(store.bounds)[numbers]
        where = _runs(store.bounds[numbers], held)
        codes = np.repeat(np.repeat(np.arange(len(texts)), sizes), held) * self.codes + store.codes[where]
        order = np.argsort(codes)
        codes, times = codes[order], store.times[where][order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[:len(codes)])
        codes, times = codes[first], np.add.reduceat(times, first) if len(first) else times
        bounds = np.searchsorted(codes, np.arange(len(texts) + 1) * self.codes)
        for i, (begin, end) in enumerate(zip(ends - sizes, ends)):
            listing = [store.listing[n] for n in numbers[begin:end].tolist()]
            if not listing or None in listing:
                yield None
            else:
                own = slice(bounds[i], bounds[i + 1])
                yield Aligned(";".join(listing), store.sums[numbers[begin:end]].sum(axis=0),
                              codes[own] - i * self.codes, times[own])

    def _learn(self, pieces: list[str]) -> None:
        """Put pieces that the store lacks into it.

        Those that the cut would find again are encoded as one text, ASCII ones apart from the rest, the others alone.
        """
        together = [p for p in pieces if not p[-1].isspace() and "▁" not in p]
        for alike in ([p for p in together if p.isascii()], [p for p in together if not p.isascii()]):
            for first in range(0, len(alike), TOGETHER):
                self._encode(alike[first:first + TOGETHER])
        for piece in pieces:
            if piece not in self.store.number:
                self._encode([piece])

    def _encode(self, pieces: list[str]) -> None:
        """Encode pieces as one text with a space before each, align it and store what belongs to each piece."""
        text = " " + " ".join(pieces)
        ascii_only = text.isascii()
        if ascii_only:
            a, = self.a.encode_batch_fast([text], add_special_tokens=False)
            b = {"ids": self.b.encode(text[1:], out_type=int)}
        else:
            a, b = self.a.encode(text, add_special_tokens=False), self.b.encode(text[1:], return_type="offset_mapping")
        a_ids, b_ids = np.array(a.ids, np.int64), np.array(b["ids"], np.int64)
        raw = np.frombuffer(text.encode(), np.uint8)
        if not all(np.array_equal(_taken(v.tokens, ids), raw) for v, ids in ((self.a_words, a_ids), (self.b_words, b_ids))):
            return self._apart(pieces)
        a_ends, b_ends = np.cumsum(self.a_words.tokens.sizes[a_ids]), np.cumsum(self.b_words.tokens.sizes[b_ids])
        if ascii_only:
            cuts = np.intersect1d(a_ends, b_ends)
        else:
            cuts = self._cuts(text, raw, a, b, a_ends, b_ends, b_ids)
        piece_ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        last_group = np.searchsorted(cuts, piece_ends)
        if not np.array_equal(cuts[np.minimum(last_group, len(cuts) - 1)], piece_ends):
            return self._apart(pieces)
        # Group of each token, tokens of each group, groups of each piece.
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n_a, n_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        piece = np.searchsorted(piece_ends, cuts)
        sums = np.stack([np.bincount(piece, x, len(pieces)).astype(np.int64) for x in (n_a, n_b, np.ones_like(n_a), n_a * n_b)], axis=1)
        group, codes, times = self._pairs(a_ids, b_ids, n_a, n_b)
        held = np.bincount(piece[group], minlength=len(pieces))
        self.store.add(pieces, self._listing(a_ids, b_ids, a_group, b_group, last_group), sums, held, codes, times)

    def _apart(self, pieces: list[str]) -> None:
        """Pieces whose text a tokenizer does not give back: one by one, and without tokens where it is one."""
        if len(pieces) == 1:
            none = np.empty(0, np.int64)
            self.store.add(pieces, [None], np.zeros((1, 4), np.int64), np.zeros(1, np.int64), none, none)
        for piece in pieces if len(pieces) > 1 else ():
            self._encode([piece])

    def _cuts(self, text: str, raw: np.ndarray, a, b, a_ends: np.ndarray, b_ends: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        """Byte offsets at which a token of each tokenizer ends."""
        spans = np.fromiter(chain.from_iterable(a.offsets), np.int64, 2 * len(a_ends)).reshape(-1, 2)
        b_spans = np.fromiter(map(itemgetter(1), b["offsets"]), np.int64, len(b_ids)) + 1  # the space before
        last = np.append(spans[1:, 0] >= spans[:-1, 1], True)  # no other token ends in the same character
        a_spans = spans[last, 1]
        wide = len(raw) > len(text)
        if wide:
            byte_of = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
            a_spans, b_spans = byte_of[a_spans], byte_of[b_spans]
        ends = np.zeros(len(raw) + 1, np.uint8)
        ends[a_spans] = 1
        ends[b_spans] |= 2
        coarse = np.flatnonzero(ends == 3)
        bytes_left = b_ends[self.is_byte[b_ids]] - 1
        if not wide and not len(bytes_left):
            return coarse
        # Groups that spans leave too wide are refined by the ends of the tokens' own bytes.
        unclear = np.zeros(len(coarse) + 1, bool)
        for where in (np.flatnonzero(raw >= 0x80), bytes_left):
            unclear[np.searchsorted(coarse, where, "right")] = True
        ends[:] = 0
        ends[a_ends] = 1
        ends[b_ends] |= 2
        fine = np.flatnonzero(ends == 3)
        return np.union1d(coarse, fine[unclear[np.searchsorted(coarse, fine)]])

    def _listing(self, a_ids, b_ids, a_group, b_group, last_group) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each piece, whose last groups are given."""
        side = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        a, b = self.a_words.digits, self.b_words.digits
        starts = np.concatenate([a.starts[a_ids], b.starts[b_ids] + len(a.bytes)])[order]
        sizes = np.concatenate([a.sizes[a_ids], b.sizes[b_ids]])[order]
        digits = np.concatenate([a.bytes, b.bytes])[_runs(starts, sizes)]
        # After each id a comma, or what stands between the sides and between groups.
        ends = np.cumsum(sizes + 1)
        out = np.empty(ends[-1], np.uint8)
        out[_runs(ends - sizes - 1, sizes)] = digits
        follows = np.append(side[1:], -1)
        out[ends - 1] = np.where(follows == side, ord(","), np.where(side % 2 == 0, ord("|"), ord(";")))
        group_ends = ends[np.flatnonzero((follows != side) & (side % 2 == 1))]
        text, stops = out.tobytes().decode(), group_ends[last_group].tolist()
        return [text[begin:end - 1] for begin, end in zip([0, *stops], stops)]

    def _pairs(self, a_ids, b_ids, n_a, n_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """group, code and number of links of the linked id pairs, in order of groups."""
        a_at, b_at, links = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b, n_a * n_b
        narrow = np.where(links <= NARROW, links, 0)
        # Groups of few links: all of them by place.
        group = np.repeat(np.arange(len(links)), narrow)
        place = _runs(np.zeros(len(links), np.int64), narrow)
        codes = a_ids[a_at[group] + place // n_b[group]] * self.width + b_ids[b_at[group] + place % n_b[group]]
        times = np.ones(len(codes), np.int64)
        wide = np.flatnonzero(links > NARROW)
        if not len(wide):
            return group, codes, times
        # Groups of many links: each id once, with its number.
        parts = [(group, codes, times)]
        for g in wide.tolist():
            a, many_a = np.unique(a_ids[a_at[g]:a_at[g] + n_a[g]], return_counts=True)
            b, many_b = np.unique(b_ids[b_at[g]:b_at[g] + n_b[g]], return_counts=True)
            product = (a[:, None] * self.width + b).ravel()
            parts.append((np.full(len(product), g), product, (many_a[:, None] * many_b).ravel()))
        group, codes, times = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(group, kind="stable")
        return group[order], codes[order], times[order]


_ALIGNERS: dict[int, Aligner] = {}

STATS = [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]


def aligned(documents: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """row, part, doc, n_a, n_b, n_groups, n_links, groups, codes, times: the alignment of each text.

    ``groups`` is the SHA-256 of the groups' listing, ``codes`` the id pairs and
    ``times`` their links.  ``row`` numbers the rows of ``documents``; a text with many
    pairs has several rows, of which only part 0 has more than row and pairs.  The
    files are read on the driver; they have the size of a vocabulary.
    """
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        content = a_file.read(), b_file.read()
    shared, which = documents.sparkSession.sparkContext.broadcast(content), hash(content)
    pairs = [T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("part", T.LongType()),
                           T.StructField("doc", documents.schema[key].dataType), *STATS,
                           T.StructField("groups", T.StringType()), *pairs])
    longs, nothing = pa.list_(pa.int64()), (np.empty(0, np.int64),) * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if which not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[which] = Aligner(*shared.value)
        aligner = _ALIGNERS[which]
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column(1), CHUNK_BYTES):
                keys = batch.column(0).slice(first, last - first)
                texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
                out: list[tuple] = []
                for i, found in enumerate(aligner.align(texts)):
                    if found is None:
                        out.append((row, 0, i, 0, 0, 0, 0, "", *nothing))
                    else:
                        stats = *found.sums.tolist(), sha256(found.listing.encode()).hexdigest()
                        for part in range(0, len(found.codes), PART):
                            cut = slice(part, part + PART)
                            out.append((row, part // PART, i, *(stats if part == 0 else (None,) * 5), found.codes[cut], found.times[cut]))
                    row += 1
                columns = list(zip(*out))
                bounds = pa.array(np.cumsum([0, *map(len, columns[8])]), pa.int32())
                arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                          keys.take(pa.array(columns[2])), *(pa.array(c, pa.int64()) for c in columns[3:7]),
                          pa.array(columns[7], pa.string()),
                          *(pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(c))).cast(longs) for c in columns[8:])]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_batches(documents.select(key, text), run, schema)


def pair_counts(table: DataFrame, width: int) -> DataFrame:
    """code, n (documents that hold the pair), a (the pair's A id)."""
    counts = table.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n"))
    return counts.withColumn("a", F.expr(f"code div {width}"))


def align(documents: DataFrame, a_path: str, b_path: str, work: Work, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: one row per row."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    table = work.keep(aligned(documents, a_path, b_path, text, key), "aligned")
    counts = work.keep(pair_counts(table, width), "counts")
    # As many rows as A has ids, whatever the documents.
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    held = counts.agg(F.sum("n")).first()[0] or 0
    counts = counts.join(F.broadcast(highest), "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    is_common = F.col("n") * COMMON >= F.lit(held)  # COMMON pairs at most, as each adds its n to held
    common = counts.where(is_common)
    rest = counts.where(~is_common)

    def totals(links: DataFrame) -> DataFrame:
        return links.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    links = table.select("row", F.inline(F.arrays_zip(F.col("codes").alias("code"), "times")))
    links = links.join(F.broadcast(common), "code", "left")
    by_pair = links.where(F.col("n").isNull()).select("code", "row", "times").join(rest, "code")
    sums = totals(links.where(F.col("n").isNotNull())).unionByName(totals(by_pair)).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return table.where("part = 0").drop("codes", "times").join(sums, "row", "left").select(
        F.col("doc").alias(key), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups")
