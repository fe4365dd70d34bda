"""Operators 11 to 13 against plain loops over the same rows."""

import math
import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from forumgauge.llm import alignment, line_dedup, resampling
from forumgauge.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, tokenizer_path
from forumgauge.llm.tables import Work

CLASHES = "size taken spans kept key doc text2 evidence_low rank part place h g row code line mark _fits _id fits".split()


def clashing(documents):
    return documents.withColumns({name: F.lit("x") for name in CLASHES})


def by_key(table, *columns):
    rows = [tuple(r[c] for c in columns) for r in table.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, repr(r)))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# Resampling -----------------------------------------------------------------

def plain_features(text):
    words = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(crc32(run.encode()) % 10000 for run in runs)


def plain_resample(rows, target, percent=5):
    docs = [(key, *plain_features(text)) for key, text in rows]
    s, t = Counter(), Counter()
    for _, _, counts in docs:
        s.update(counts)
    for text in target:
        t.update(plain_features(text)[1])
    total_s, total_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)]
    out, fit = [], []
    for key, n_words, counts in docs:
        h = int(sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain[b] for b, n in counts.items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, counts.total(), weight, score, None])
        if n_words >= 20:
            fit.append(out[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(fit[:percent * len(fit) // 100], 1):
        row[4] = rank
    return [tuple(r) for r in out]


TARGET = ["the tea pot of black water", None, "", "Tea POT lid, cup milk spoon; table-leaf 12 green"]


def resampled(spark, documents, target=TARGET, **options):
    items = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id bigint, text string")
    return resampling.resample(documents, items, Work(spark, "test"), **options)


@pytest.mark.parametrize("percent", [5, 60])
def test_resampling_equals_a_plain_loop(spark, documents, rows, percent):
    got = by_key(resampled(spark, clashing(documents), percent=percent), "doc_id", "n_features", "weight", "score", "rank")
    assert got == sorted(plain_resample([(r[0], r[1]) for r in rows], TARGET, percent))
    assert any(r[4] for r in got)


def test_resampling_of_long_texts_in_blocks(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice(["tea", "pot", "Über", "x1", "-", "lid,cup", "日本"]) for _ in range(3000))
    whole = Counter(plain_features(text)[1])
    monkeypatch.setattr(resampling, "BLOCK_BYTES", 7)
    parts = list(resampling.features(text.encode()))
    assert len(parts) > 100
    counts = Counter()
    for _, codes in parts:
        counts.update((codes % 10000).tolist())
    assert counts == whole and sum(n for n, _ in parts) == plain_features(text)[0]


def test_resampling_ranks_across_partitions_ties_and_repeats(spark):
    weighed = spark.createDataFrame(
        [(i, 20 + i % 2 * 0 if i % 5 else 19, 1, 0, 100 - i // 7) for i in range(500)] + [(3, 30, 1, 0, 100)] * 2 + [(None, 30, 1, 0, 100)],
        "score_key bigint, n_words bigint, n_features bigint, weight bigint, score bigint").repartition(7)
    got = resampling.draw(weighed, Work(spark, "test"), key="score_key", percent=50).collect()
    fit = sorted((r for r in weighed.collect() if r["n_words"] >= 20), key=lambda r: (-r["score"], r[0] is None, r[0] or 0))
    wanted = {i: r for i, r in enumerate(fit[:len(fit) // 2], 1)}
    found = {r["rank"]: r for r in got if r["rank"]}
    assert len(got) == 503 and found.keys() == wanted.keys()
    assert all((found[i]["score"], found[i]["score_key"]) == (wanted[i]["score"], wanted[i]["score_key"]) for i in wanted)


def test_resampling_of_nothing(spark, nothing, documents):
    assert resampled(spark, nothing).count() == 0
    empty_target = resampled(spark, documents, target=[None])
    assert empty_target.where("rank is not null").count() > 0


# Lines ----------------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"


def plain_lines(rows, least_chars=20, least_documents=3):
    def of(text):
        return (text or "").split("\n")

    def key(line):
        return lower(line.strip(BLANKS))

    held, keeper = Counter(), {}
    for doc, text in rows:
        for k in {key(line) for line in of(text)}:
            held[k] += 1
            keeper[k] = max((x for x in (keeper.get(k), doc) if x is not None), default=None)
    out = []
    for doc, text in rows:
        kept = [line for line in of(text)
                if len(key(line)) < least_chars or held[key(line)] < least_documents or keeper[key(line)] == doc]
        out.append((doc, len(of(text)), len(of(text)) - len(kept), "\n".join(kept)))
    return out


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(11)
    pool = [f"A line of some length, number {i} " + "é" * (i % 3) for i in range(12)] + ["short", "", " \t", "x" * 19, "y" * 20,
                                                                                  "É" * 19 + "a", "É" * 19 + "A"]
    rows = []
    for i in range(120):
        lines = [rng.choice(["", "  ", "\t"]) + (x.upper() if rng.random() < 0.2 and x.isascii() else x) + rng.choice(["", "\r", " "])
                 for x in rng.choices(pool, k=rng.randint(0, 12))]
        lines += [f"only in document {i} and nowhere else"] * rng.randint(0, 2)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n"), (203, "\n\n a \n"), (5, rows[5][1]), (5, rows[6][1]), (5, rows[5][1]),
             (None, rows[7][1]), (None, rows[8][1])]
    rows += [(300, "\n".join(f"line {rng.randrange(4000)} of the very long text" for _ in range(20000)))]
    rows += [(301 + i, f"line {i} of the very long text\nline {i + 1} of the very long text") for i in range(40)]
    rows += [(None, f"held by nobody in particular {i % 2}") for i in range(8)]
    return rows


def test_lines_equal_a_plain_loop(spark, line_rows, monkeypatch):
    documents = spark.createDataFrame(line_rows, "doc_id bigint, text string").repartition(5)
    wanted = sorted(plain_lines(line_rows), key=repr)
    for common in (line_dedup.COMMON, 1, 10**9):
        monkeypatch.setattr(line_dedup, "COMMON", common)
        got = line_dedup.dedup(clashing(documents), Work(spark, "test"))
        assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr) == wanted
    assert sum(r[2] for r in wanted) > 500


def test_lines_with_other_thresholds_and_nothing(spark, line_rows, nothing):
    documents = spark.createDataFrame(line_rows, "doc_id bigint, text string")
    got = line_dedup.dedup(documents, Work(spark, "test"), least_chars=5, least_documents=10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(plain_lines(line_rows, 5, 10), key=repr)
    assert line_dedup.dedup(nothing, Work(spark, "test")).count() == 0


def test_lines_run_without_python(spark, documents):
    plan = line_dedup.dedup(documents, Work(spark, "test"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Alignment ------------------------------------------------------------------

PATHS = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)


@pytest.fixture(scope="module")
def plain_tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    from forumgauge.llm.bpe import byte_symbols

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = {symbol: i for i, symbol in enumerate(byte_symbols())}

    def tokens(text):
        if not text:
            return None
        left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if regex.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (left, right) if b"".join(x[1] for x in left) == raw == b"".join(x[1] for x in right) else None

    return tokens


def plain_alignment(rows, tokens):
    grouped, held = [], Counter()
    for doc, text in rows:
        found, groups = tokens(text), []
        if found:
            ends = [[0], [0]]
            for side, own in zip(found, ends):
                for _, data in side:
                    own.append(own[-1] + len(data))
            cuts = sorted(set(ends[0]) & set(ends[1]))
            for lo, hi in zip(cuts, cuts[1:]):
                groups.append([[t[0] for t, e in zip(side, own[1:]) if lo < e <= hi] for side, own in zip(found, ends)])
            held.update({(x, y) for g in groups for x in g[0] for y in g[1]})
        grouped.append((doc, found, groups))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc, found, groups in grouped:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        listing = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc, len(found[0]) if found else 0, len(found[1]) if found else 0, len(groups), len(links),
                    sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    sha256(listing.encode()).hexdigest() if found else ""))
    return out


COLUMNS = "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"

ODD = ["naïve café £5 日本語 text\x1cwith\x85odd spaces", "🎉🎉 a🎉b 👩‍👩‍👧 ́", "▁ is in B's table", "<|endoftext|> <s></s> <0x41> <unk>", "  two  spaces  ",
       "\n\n\tx\r\n", "\x00\x01", "ﬁ ½ Å ﻿", "ᚠᛇᚻ 𝔘𝔫𝔦 ꙮ", "한국어 텍스트 मानक हिन्दी العربية", "a" * 3000, "日" * 2000, "é" * 999, "🦊" * 500 + "x", "=" * 777 + "-" * 333]


def test_alignment_equals_a_plain_loop(spark, documents, rows, plain_tokens, monkeypatch):
    more = [(r[0], r[1]) for r in rows] + [(1000 + i, x) for i, x in enumerate(ODD)] + [(3, rows[3][1]), (3, "a"), (None, "a b c"), (None, None)]
    table = spark.createDataFrame(more, "doc_id bigint, text string").repartition(5)
    wanted = sorted(plain_alignment(more, plain_tokens), key=repr)
    for common, part in ((alignment.COMMON, alignment.PART), (20, 50)):
        monkeypatch.setattr(alignment, "COMMON", common)
        got = alignment.align(clashing(table), *PATHS, Work(spark, "test"))
        assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == wanted
    assert sum(r[1] == 0 for r in wanted) >= 4 and sum(r[3] < r[1] for r in wanted) >= 5


def test_alignment_of_texts_with_random_characters(spark, plain_tokens):
    rng = random.Random(2)
    ranges = [(32, 126), (0x80, 0x24F), (0x370, 0x52F), (0x900, 0x9FF), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x1F300, 0x1FAFF)]
    texts = ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    rows = list(enumerate(texts))
    got = alignment.align(spark.createDataFrame(rows, "doc_id bigint, text string"), *PATHS, Work(spark, "test"))
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == sorted(plain_alignment(rows, plain_tokens), key=repr)


@pytest.fixture(scope="module")
def aligner():
    with open(PATHS[0], encoding="utf-8") as a, open(PATHS[1], "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def test_wide_groups_are_multiplied(aligner):
    a_ids, b_ids = [1, 2, 1, 3, 5] * 9 + [7], [4, 4, 6] * 5 + [8]
    group, codes, times = aligner._pairs(np.array(a_ids), np.array(b_ids), np.array([45, 1]), np.array([15, 1]))
    wanted = Counter((0, x, y) for x in a_ids[:45] for y in b_ids[:15]) + Counter([(1, 7, 8)])
    assert {(g, *divmod(c, 32000)): n for g, c, n in zip(group.tolist(), codes.tolist(), times.tolist())} == wanted


def test_pieces_are_forgotten_and_learned_again(aligner, plain_tokens, monkeypatch):
    rng = random.Random(4)
    syllables = ["an", "the", "wh", "é", "日", "x", "...", "\n", "\t", " ", "  ", "▁", "Zw\u200b"]
    texts = ["".join(rng.choice(syllables) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    monkeypatch.setattr(alignment, "CACHED_PIECES", 50)
    monkeypatch.setattr(alignment, "TOGETHER", 7)
    aligner.store = alignment.Store()
    got = [found for first in range(0, 300, 20) for found in aligner.align(texts[first:first + 20])]
    assert len(aligner.store.listing) < 1500
    for text, found, row in zip(texts, got, plain_alignment(list(enumerate(texts)), plain_tokens)):
        if found is None:
            assert row[1:5] == (0, 0, 0, 0)
        else:
            assert tuple(found.sums.tolist()) == row[1:5]
            assert sha256(found.listing.encode()).hexdigest() == row[7]
            assert len(set(found.codes.tolist())) == len(found.codes) and found.times.sum() == row[4]
    assert sum(found is None for found in got) < 290


def test_frequent_pieces_stay_when_the_store_is_full(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_PIECES", 50)
    monkeypatch.setattr(aligner, "store", alignment.Store())
    texts = ["tea and tea", "green tea and café", *("x" * i + "y tea and café" for i in range(120))]
    for i in range(0, len(texts), 2):
        list(aligner.align(texts[i:i + 2]))
    assert len(aligner.store.listing) <= 60
    learned, encode = [], aligner._encode
    monkeypatch.setattr(aligner, "_encode", lambda pieces: (learned.extend(pieces), encode(pieces)))
    aligner.store = aligner.store.often()
    found, = aligner.align(["tea and café"])
    assert learned == []
    aligner.store = alignment.Store()
    again, = aligner.align(["tea and café"])
    assert found.listing == again.listing and found.codes.tolist() == again.codes.tolist()


def test_ascii_pieces_are_cut_as_by_spans(aligner, monkeypatch):
    text = "<|endoftext|> tabs\there, \x00 \x7f 1234567 https://a.b/c?d=e  two\n\nlines <s> </s> ~~~ don't"
    monkeypatch.setattr(aligner, "store", alignment.Store())
    plain, = aligner.align([text])
    monkeypatch.setattr(aligner, "store", alignment.Store())
    asked, encode = [], aligner.b.encode
    monkeypatch.setattr(aligner.b, "encode", lambda *args, **how: (asked.append(how), encode(*args, **how))[1])
    aligner._learn(["é", *aligner.cut(text)])
    assert any("out_type" in how for how in asked) and any("return_type" in how for how in asked)
    raw = " " + text
    a, b = aligner.a.encode(raw, add_special_tokens=False), encode(text, return_type="offset_mapping")
    cuts = {end for _, end in a.offsets} & {end + 1 for _, end in b["offsets"]}
    assert plain.sums.tolist()[:3] == [len(a.ids), len(b["ids"]), len(cuts)]


def test_alignment_of_nothing(spark, nothing):
    assert alignment.align(nothing, *PATHS, Work(spark, "test")).count() == 0
