"""Exact BPE encoding by backtracking over longest token matches, and decoding.

An Aho-Corasick automaton finds the longest vocabulary token at each place of a
pre-token.  The encoder accepts it only if the pair it forms with the token before
it is compatible: merging the two tokens' symbols would give these same two tokens
again.  Where nothing fits it steps back to the next shorter token, which a table
of prefixes names; a position found to be a dead end is never tried again, so the
work is linear in the pre-token.  The sequence in which
all neighbours are compatible is the one that applying the merges gives.

Decoding joins the tokens' strings through a table of their bytes and offsets.

Cases: null and empty texts give no ids and an empty decoded text; repeated rows
are encoded each; special tokens' strings in a text become their ids; texts of
any length are encoded whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.tables import map_batches

END = "</w>"
# A symbol that ends a pre-token is another symbol than the same one inside it.
_LAST = 0x1000
CACHE = 200_000
# str.split() takes these for white space, Unicode does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a
    visible Latin-1 character, else the next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


def _symbols(token: str) -> str:
    return token[:-len(END) - 1] + chr(ord(token[-len(END) - 1]) + _LAST) if token.endswith(END) and len(token) > len(END) else token


class Model:
    """What a tokenizer file says, small enough to go to every task."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.tokens = {_symbols(t): i for t, i in vocabulary.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.pairs, self.parts = {}, {}
        for rank, (left, right) in enumerate(merges):
            pair = vocabulary[left], vocabulary[right]
            self.pairs[pair] = rank
            self.parts[vocabulary[left + right]] = (rank, *pair)
        strings = vocabulary | self.special
        size = max(strings.values()) + 1
        table = [b""] * size
        for string, i in strings.items():
            table[i] = string.encode() + b" "
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.sizes = np.array([len(x) for x in table], np.int32)
        self.offsets = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)


class _Ids(dict):
    """The packed ids of the strings met lately: two generations of up to ``CACHE`` each."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, string: str) -> bytes:
        ids = self.older.pop(string, None)
        if ids is None:
            ids = self.encode(string)
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[string] = ids
        return ids


class Encoder:
    """Encodes texts in one task; remembers pre-tokens and pairs met lately."""

    def __init__(self, model: Model):
        self.model = model
        self.compatible: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        reachable = set(model.tokens.values()) - set(model.parts)
        for token, (_, left, right) in sorted(model.parts.items(), key=lambda x: x[1][0]):
            if left in reachable and right in reachable and self._seam(left, right, own=True):
                reachable.add(token)
        usable = {string: token for string, token in model.tokens.items() if token in reachable}
        self.shorter: dict[int, tuple[int, int]] = {}  # the longest token that begins a token, and its length
        for string, token in usable.items():
            self.automaton.add_word(string, (len(string), token))
            for length in range(len(string) - 1, 0, -1):
                if string[:length] in usable:
                    self.shorter[token] = length, usable[string[:length]]
                    break
        self.automaton.make_automaton()
        self.symbols = byte_symbols()
        self.pieces = regex.compile(model.pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, model.special)) + ")")
        self.of_piece, self.of_run = _Ids(self.piece), _Ids(self._run)

    def _seam(self, left: int, right: int, own: bool = False) -> bool:
        """Whether no merge across the seam of two tokens comes before the merges beside it.

        Undoes the younger of the two merges that face each other at the seam, again
        and again; among equal ranks the one further left came first.  ``own`` leaves
        out the merge of the two tokens themselves.
        """
        pairs, parts, none = self.model.pairs, self.model.parts, (-1, -1, -1)
        before = -1 if own else len(pairs)
        while True:
            across = pairs.get((left, right))
            if across is not None and across < before:
                return False
            (rank_l, _, inner_l), (rank_r, inner_r, _) = parts.get(left, none), parts.get(right, none)
            if rank_l < 0 and rank_r < 0:
                return True
            if rank_l > rank_r:
                before, left = rank_l, inner_l
            else:
                before, right = rank_r + 1, inner_r

    def fits(self, left: int, right: int) -> bool:
        """Whether the symbols of both tokens merge into just these two."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= CACHE:
                self.compatible.clear()
            known = self.compatible[left, right] = self._seam(left, right)
        return known

    def piece(self, piece: str) -> bytes:
        """The ids of one pre-token, packed."""
        text = piece if piece.isascii() and piece.isprintable() else "".join([self.symbols[b] for b in piece.encode()])
        text = text[:-1] + chr(ord(text[-1]) + _LAST)
        size = len(text)
        longest: list[tuple[int, int] | None] = [None] * size
        for last, match in self.automaton.iter(text):
            longest[last - match[0] + 1] = match  # the end rises, so the last one stored is the longest
        shorter, chosen, dead = self.shorter, [], set()
        at, match = 0, longest[0]
        while at < size:
            while match and (at + match[0] in dead or chosen and not self.fits(chosen[-1][1], match[1])):
                match = shorter.get(match[1])
            if match:
                chosen.append(match)
                at += match[0]
                match = longest[at] if at < size else None
            else:
                dead.add(at)
                length, token = chosen.pop()
                at -= length
                match = shorter.get(token)
        return np.array([token for _, token in chosen], "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        return b"".join(map(self.of_piece.__getitem__, self.pieces(run)))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._plain(text)
        parts = self.specials.split(text)
        return b"".join(self.model.special[part].to_bytes(4, "little") if i % 2 else self._plain(part)
                        for i, part in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if _NOT_SPACE.search(text):
            return self._run(text)
        # No pre-token holds white space, so what stands between is looked up whole.
        return b"".join(map(self.of_run.__getitem__, text.split()))


def decode(model: Model, packed: list[bytes]) -> list[str]:
    """The tokens' strings joined by spaces, for each list of packed ids."""
    ids = np.frombuffer(b"".join(packed), "<u4")
    begins, sizes = model.offsets[ids], model.sizes[ids]
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    where = np.ones(ends[-1], np.int32)  # steps of one inside a token, jumps between tokens
    if len(ids):
        where[0] = begins[0]
        where[ends[1:-1]] = begins[1:] - begins[:-1] - sizes[:-1] + 1
        np.cumsum(where, out=where)
    text = model.bytes[where].tobytes()
    cuts = ends[np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])])]
    return [text[a:max(a, b - 1)].decode() for a, b in zip(cuts[:-1], cuts[1:])]


_ENCODERS: dict[str, Encoder] = {}


def encode(table: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids (packed little-endian unsigned 32-bit), decoded: one row per row.

    ``path`` names the tokenizer file, read on the driver; its content goes to the
    tasks as a broadcast of a size fixed by the vocabulary.
    """
    shared = table.sparkSession.sparkContext.broadcast(Model(path))
    schema = T.StructType([table.schema[key], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path)
        if encoder is None:
            encoder = _ENCODERS[path] = Encoder(shared.value)
        for batch in batches:
            for first, last, data, offsets in words.chunks(batch.column(1)):
                packed = [encoder.encode(data[a:b].tobytes().decode()) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first),
                     pa.array([len(x) // 4 for x in packed], pa.int64()),
                     pa.array(packed, pa.binary()), pa.array(decode(encoder.model, packed), pa.string())],
                    names=[key, "n_tokens", "ids", "decoded"])

    return map_batches(table.select(key, text), run, schema)
