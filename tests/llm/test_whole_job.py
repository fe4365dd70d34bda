"""What the operators once left out: each test fails on the code before."""

import random
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from forumgauge.llm import class_model, main_text, near_duplicates
from forumgauge.llm.tables import Work
from tests.llm.conftest import SCHEMA, prose


# --- language model -----------------------------------------------------------------

@pytest.fixture(scope="module")
def long_rows():
    rng = random.Random(11)
    texts = [prose(rng, 400) for _ in range(150)]
    for i in range(12):  # 5 to 16 times in more than 60,000 tokens
        for at in rng.sample(range(150), 5 + i):
            texts[at] += f" seldom{i} tea"
    return [(i, t + f" once{i}", None, "a", None) for i, t in enumerate(texts)]


def test_every_word_above_an_absolute_count_is_a_unit(spark, long_rows):
    documents = spark.createDataFrame(long_rows, SCHEMA).repartition(4)
    model, _ = class_model.train(documents, Work(spark, "u"), classes=6, passes=1)
    seen = Counter(w for r in long_rows for w in r[1].lower().split())
    assert sum(seen.values()) > 60_000 and seen["seldom0"] == 5
    alone = model.units.table.where(f"unit >= {class_model.WORDS}")
    assert alone.count() == sum(n >= 5 for n in seen.values())
    assert alone.where("types <> 1").count() == 0


@pytest.mark.parametrize("size", [10 ** 6, 800, 0])  # all words travel to the tasks, the frequent ones, none
def test_scores_of_words_that_tasks_know_or_not(spark, long_rows, monkeypatch, size):
    monkeypatch.setattr(class_model, "LEXICON", size)
    documents = spark.createDataFrame(long_rows + [(900, "never seldom1 zzq zzq seldom1 never", None, None, None)], SCHEMA)
    model, counts = class_model.train(documents.where("doc_id < 900"), Work(spark, "scores"), classes=6, passes=1)
    assert model.units.complete == (size > 0) and (model.rare.count() > 0) == (size < 1000)
    of = {r.word: (r.c, r.own) for x in (model.units.known, model.units.rare) for r in model._valued(x).collect()}
    got = {r.doc_id: r for r in class_model.score(documents, model, counts).collect()}
    assert (got[900].n_tokens, got[900].n_known) == (7, 3)
    for key, text, *_ in [*long_rows[:5], (900, "never seldom1 zzq zzq seldom1 never")]:
        (_, _, code, ending, _), = class_model.tokens(pa.array([text]))
        found = [of.get(w, (model.unseen[0][e], model.unseen[1][e])) for w, e in zip(code.tolist(), ending.tolist())]
        before = [of[class_model.END], *found[:-1]]
        assert got[key].score == pytest.approx(sum(model.step[a[0], b[0]] + b[1] for a, b in zip(before, found)), rel=1e-9)


def test_classes_reach_the_bigrams_by_either_join(spark, long_rows, monkeypatch):
    monkeypatch.setattr(class_model, "LEXICON", 100)
    documents, work = spark.createDataFrame(long_rows, SCHEMA).select("text"), Work(spark, "b")
    units = class_model.Units(work.keep(class_model.word_counts(documents), "counts"), work)
    bigrams = work.keep(class_model.unit_bigrams(documents, units, work), "bigrams")
    assert bigrams.agg({"n": "sum"}).first()[0] == units.total
    assigned = work.keep(class_model._start(units, 6), "assigned")
    rows = class_model._classed(bigrams, assigned, units.complete).collect()
    of = {r.unit: r.c for r in assigned.collect()}
    assert not units.complete and rows and all((r.cu, r.cv) == (of[r.u], of[r.v]) for r in rows)


def test_units_travel_beyond_the_words_that_may_be_rare(spark, long_rows, monkeypatch):
    monkeypatch.setattr(class_model, "RARER", 100, raising=False)
    documents, work = spark.createDataFrame(long_rows, SCHEMA).select("text"), Work(spark, "t")
    units = class_model.Units(work.keep(class_model.word_counts(documents), "counts"), work)
    assert units.complete and units.rare.count() > 0
    assert units.rare.where(f"n >= {class_model.LEAST}").count() == 0


def test_classes_from_packed_neighbours_equal_those_of_the_joins(spark, long_rows, monkeypatch):
    for name, value in (("HEAVY", 60), ("PART", 4096), ("ROW", 256), ("HELD", 10_000)):
        monkeypatch.setattr(class_model, name, value)
    rows = long_rows + [(1000, "tea tea tea tea seldom1 seldom1", None, None, None), (1001, None, None, None, None)]
    documents, work = spark.createDataFrame(rows, SCHEMA).select("text").repartition(3), Work(spark, "p")
    units = class_model.Units(work.keep(class_model.word_counts(documents), "counts"), work)
    assert units.table.where(f"n * 60 > {units.total}").count() > 1
    packed, grid = class_model.cluster_packed(documents, units, 6, 3, work)
    joined, expected = class_model.cluster(
        work.keep(class_model.unit_bigrams(documents, units, work), "bigrams"), units, 6, 3, work)
    assert grid.tolist() == expected.tolist() and grid.sum() == units.total
    assert sorted(packed.collect()) == sorted(joined.select("unit", "c").collect())


# --- pipeline -------------------------------------------------------------------------

def shingles(text, size):
    own = text.split()
    return {tuple(own[p:p + size]) for p in range(len(own) - size + 1)}


def test_near_stage_compares_sets_of_five_words(spark):
    words = [f"w{i}" for i in range(200)]
    changed = lambda name, count: " ".join(
        f"{name}{w}" if i % 40 == 20 and i < 40 * count else name[0] + w for i, w in enumerate(words))
    texts = [changed("a", 0), changed("ax", 5), changed("b", 0), changed("bx", 4)]
    likeness = lambda a, b, n: len(shingles(a, n) & shingles(b, n)) / len(shingles(a, n) | shingles(b, n))
    assert likeness(*texts[:2], 5) < 0.8 < likeness(*texts[:2], 4) and likeness(*texts[2:], 5) >= 0.8
    docs = spark.createDataFrame([(i, t, None, "a", None) for i, t in enumerate(texts)], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect()) == [0, 1, 2]


# --- near-duplicates ------------------------------------------------------------------

def test_template_pages_make_few_links(spark):
    rng = random.Random(17)
    page = [f"t{i}" for i in range(120)]
    texts = [" ".join(page + [f"o{rng.randrange(10 ** 9)}" for _ in range(40)]) for _ in range(200)]
    texts += [texts[i] + " end" for i in (150, 199, 40)]
    work = Work(spark, "family")
    docs = spark.createDataFrame([(i, t, None, "a", None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.component_id for r in near_duplicates.groups(docs, work).collect()}
    sets = [shingles(t, 4) for t in texts]
    assert 0.5 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.64
    assert got == {i: i for i in range(200)} | {200: 150, 201: 199, 202: 40}
    likely = spark.read.parquet(f"{work.path}/likely").count()
    assert likely < 40 * len(texts)  # not a large share of all pairs in each bucket


# --- main text ------------------------------------------------------------------------

BODY = [f"Paragraph {i} of the story goes on for a good many words, as stories do." for i in range(4)]


def test_cards_do_not_replace_the_story():
    cards = "".join(f"<article><h3>Other {i}</h3><p>A short teaser, no more.</p></article>" for i in range(3))
    page = "<div class=story><h1>Title</h1>" + "".join(f"<p>{x}</p>" for x in BODY) + f"</div><section>{cards}</section>"
    lines = main_text.extract(page).split("\n")
    assert lines[:5] == ["Title", *BODY]
    # an article that holds the largest surge is the story, as before
    page = "<div><p>Something short beside it all.</p></div><article>" + "".join(f"<p>{x}</p>" for x in BODY) + "</article>"
    assert main_text.extract(page).split("\n") == BODY


def test_text_begins_at_the_window_before_the_surge():
    page = "<div><h1>Title</h1><p>By me</p><p>Monday</p><p>Rome</p>" + "".join(f"<p>{x}</p>" for x in BODY) + "</div>"
    assert main_text.extract(page).split("\n") == ["Title", "By me", "Monday", "Rome", *BODY]
