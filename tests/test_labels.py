"""Keyword labels against a keyword-by-keyword search in Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from forumgauge.functions.labels import LABEL_COLUMNS, found_keywords, with_implied
from forumgauge.functions.lexicon import DEFAULT_LEXICON, KINDS, Lexicon
from forumgauge.operators import table_tagging, tagging
from forumgauge.operators.enrich import keep_labelled

WORDS = DEFAULT_LEXICON.keywords(*KINDS)


def random_texts(n=400, seed=3):
    rng = random.Random(seed)
    glue = [" ", "", "-", ". ", " the ", "s", "é", "\n"]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 8)):
            word = rng.choice(WORDS)
            parts += [rng.choice([word, word.upper(), word[:-1], word.title()]), rng.choice(glue)]
        texts.append("".join(parts))
    return texts


def present(text, match):
    lowered = text.lower()
    if match == "substring":
        return {w for w in WORDS if w in lowered}
    return {w for w in WORDS if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", lowered)}


@pytest.mark.parametrize("match", ["substring", "word"])
def test_every_keyword_present_is_found(spark, match):
    texts = random_texts() + WORDS
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = found_keywords(F.lower("t"), WORDS, match)
    rows = df.select("i", with_implied(found, WORDS, match).alias("h")).collect()
    for row in rows:
        assert set(row.h) == present(texts[row.i], match), texts[row.i]
        assert len(row.h) == len(set(row.h))


def test_large_lexicon_takes_several_patterns(spark, monkeypatch):
    texts = random_texts(100, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in df.select("i", with_implied(found_keywords(F.lower("t"), WORDS), WORDS).alias("h")).collect():
        assert set(row.h) == present(texts[row.i], "substring")


def expected(text, kind):
    lowered = (text or "").lower()
    cats = DEFAULT_LEXICON.categories(kind)
    found = [c for c, kws in cats.items() if any(k in lowered for k in kws)]
    if kind == "sentiment":
        pos, neg = (sum(k in lowered for k in cats[p]) for p in ("Positive", "Negative"))
        return "Positive" if pos > neg else "Negative" if neg > pos else "Neutral"
    if kind == "experience":
        return found[0] if found else "Not Specified"
    if kind == "topic":
        return found or ["General"]
    if kind == "industry":
        return (found or ["General/Unspecified"]) if text else []
    return found


@pytest.mark.parametrize("kind", KINDS)
def test_labels(spark, kind):
    texts = random_texts(150, 11) + WORDS + ["", None, "nothing here", "Senior Engineer", "5 years", "5+ years"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, full_text string")
    for row in tagging.tag(df, [kind]).collect():
        assert row[LABEL_COLUMNS[kind]] == expected(texts[row.i], kind), (kind, texts[row.i])


def test_all_kinds_in_one_pass_give_the_same_labels(spark):
    texts = random_texts(100, 13)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, full_text string")
    for row in tagging.tag(df).collect():
        for kind in KINDS:
            assert row[LABEL_COLUMNS[kind]] == expected(texts[row.i], kind)


@pytest.mark.parametrize("text, level", [
    ("senior engineer", "No Experience"), ("5 years", "3-5 Years"), ("5+ years", "5+ Years"),
    ("new grad", "New Grad"), ("2 years", "1-2 Years"), ("hello", "Not Specified")])
def test_experience_takes_the_first_class(spark, text, level):
    df = spark.createDataFrame([(text,)], "full_text string")
    assert tagging.tag_experience(df).first().experience_level == level


def test_word_match_does_not_look_inside_words(spark):
    df = spark.createDataFrame([("time to go, said the goat",)], "full_text string")
    assert "Hardware/Semiconductor" in tagging.tag_industries(df).first().industries
    assert tagging.tag_industries(df, match="word").first().industries == ["E-commerce/Retail"]
    assert tagging.tag_skills(df, match="word").first().mentioned_skills == ["go"]
    with pytest.raises(ValueError):
        tagging.tag_skills(df, match="fuzzy")


def test_own_lexicon(spark):
    lexicon = DEFAULT_LEXICON.replace("topic", {"Pets": ("cat", "dog")})
    df = spark.createDataFrame([("a dog",), ("a bird",)], "full_text string")
    assert [r.topics for r in tagging.tag_topics(df, lexicon=lexicon).collect()] == [["Pets"], ["General"]]
    table = Lexicon({"topic": {"Pets": ("cat", "dog")}}).to_df(spark)
    assert [tuple(r) for r in table.orderBy("keyword").collect()] == [
        ("topic", 0, "Pets", "cat"), ("topic", 0, "Pets", "dog")]


def test_lexicon_sizes():
    sizes = {k: sum(len(v) for v in DEFAULT_LEXICON.categories(k).values()) for k in KINDS}
    assert sizes == {"industry": 244, "topic": 73, "advice": 103, "company": 29, "skill": 33,
                     "sentiment": 86, "experience": 30}


def test_filter_on_labels_reads_the_text_once(spark):
    df = spark.createDataFrame([("java and go",)], "full_text string").repartition(2)
    plan = keep_labelled(tagging.tag_industries(df), "industries")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    plan = keep_labelled(tagging.tag_skills(df), "mentioned_skills")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def _posts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id bigint, full_text string")


ODD_TEXTS = [
    None, "", "c++", "I know C++, c# and c", "c++x", "xc++", "(c++)", "c+++", "+c++ ", "go", "golang", "go-go", "node.js", "_go_", "go_",
    "y combinator and y  combinator", "ernst & young!", "ernst&young", "5+ years", "15+ years", "5+ years!", "high-school senior",
    "ts/sci clearance", "23andme", "Über uber", "rejected, ghosted; offer offered", "entry level\tjob", "...", " \n ", "a.i. ai a_i",
    "co-op coop co op", "what should i do", "日本 go 日本", "go日本", "new grad, new-grad newgrad",
]


def test_labels_from_a_table_equal_whole_word_labels(spark):
    posts = _posts(spark, ODD_TEXTS)
    wanted = tagging.tag(posts, KINDS, match="word").select("id", *LABEL_COLUMNS.values())
    got = table_tagging.tag_by_table(posts, DEFAULT_LEXICON.to_df(spark))
    assert got.columns == wanted.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_a_lexicon_of_many_keywords_is_joined(spark):
    table = spark.range(100_000).select(
        F.lit("skill").alias("kind"), F.col("id").cast("int").alias("priority"), F.concat(F.lit("s"), "id").alias("category"),
        F.concat(F.lit("tool "), F.col("id").cast("string"), F.when(F.col("id") % 2 == 0, "+").otherwise("")).alias("keyword"))
    texts = ["tool 7 and tool 8+ but tool 9x", "tool 8", "no tool", "tool 99999, tool 0+"]
    got = {r.id: r.mentioned_skills for r in table_tagging.tag_by_table(_posts(spark, texts), table, ["skill"]).collect()}
    assert got == {0: ["s7", "s8"], 1: [], 2: [], 3: ["s0", "s99999"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = table_tagging.tag_by_table(_posts(spark, texts), table, ["skill"])
        assert {r.id: r.mentioned_skills for r in shuffled.collect()} == got
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(Exception, match="keyword without a word"):
        table_tagging.found_rows(_posts(spark, texts), table.limit(1).withColumn("keyword", F.lit("++")))


def test_runs_have_the_shapes_of_keywords(spark):
    """One search of the text, and no run that no keyword could equal."""
    table = Lexicon({"skill": {"C++": ("c++",), "Go": ("go",), "Data": ("data science",)}}).to_df(spark)
    shapes = table_tagging.keyword_shapes(table)
    assert shapes == [(1, 0, 0), (1, 0, 2), (2, 0, 0)]
    posts = _posts(spark, ["Go, c++ data-science  go", "(c++)", "", None])
    runs = table_tagging.word_runs(posts, "full_text", shapes)
    assert [sorted(r["_runs"]) for r in runs.orderBy("id").collect()] == [
        ["c", "c++", "c++ data", "data", "data-science", "go", "go, c", "science", "science  go"], ["c", "c++"], [], []]
    plan = runs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    starts = table_tagging.keyword_starts(table)
    assert starts == ["c++", "dat", "go"]
    runs = table_tagging.word_runs(posts, "full_text", shapes, starts)
    assert [sorted(r["_runs"]) for r in runs.orderBy("id").collect()] == [
        ["c", "c++", "c++ data", "data", "data-science", "go", "go, c"], ["c", "c++"], [], []]
    signs = Lexicon({"skill": {"Net": (".net",), "Plus": ("++x+",)}}).to_df(spark)
    assert table_tagging.keyword_shapes(signs) == [(1, 1, 0), (1, 2, 1)]
    texts = [".net ++x+", "a.net", "a ++x+y", "a+++x++ .net.", "++x+"]
    got = table_tagging.tag_by_table(_posts(spark, texts), signs, ["skill"]).orderBy("id").collect()
    assert [r.mentioned_skills for r in got] == [["Net", "Plus"], [], [], ["Net", "Plus"], ["Plus"]]


def test_few_keywords_are_looked_for_one_by_one(spark):
    df = spark.createDataFrame([("Meta and metamask at google", ), ("none",), (None,)], "full_text string").repartition(2)
    tagged = tagging.tag_companies(df)
    assert "regexp" not in tagged._jdf.queryExecution().optimizedPlan().toString()
    few = tagged.withColumn("found", found_keywords(F.lower("full_text"), ["meta", "metam", "x"])).collect()
    assert sorted(map(sorted, (r.found for r in few))) == [[], [], ["meta", "metam"]]
    assert sorted(len(r.mentioned_companies) for r in few) == [0, 0, 2]
