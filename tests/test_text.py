"""Text, time and categorical columns against plain Python."""

import random
import re

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from forumgauge.functions import text as X
from forumgauge.functions.stopwords import STOP_WORDS
from forumgauge.operators import enrich

PIECES = ["http://a.b/c", "https://x", "http", "htt", " ", "  ", "\n", "\t", "a", "Bc", "é", "9", "$", ".",
          "hello", "World", "shttp://q r", "", "-", "ü", "the", "of", "intern"]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def clean(text):
    text = re.sub(r"http[^ \t\n\x0b\f\r]+", "", text)
    text = re.sub(r"[^a-zA-Z \t\n\x0b\f\r]", " ", text)
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text).lower()


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", expression.alias("v")).orderBy("i").select("v").collect()]


def test_cleaned_text_equals_the_three_documented_steps(spark):
    texts = random_texts(400)
    assert column(spark, texts, X.cleaned_text(F.col("t"))) == [clean(t) for t in texts]


def test_length_filter_equals_the_length_of_the_cleaned_text(spark):
    texts = random_texts(600) + ["a" * 10, "a" * 11, "http " + "a" * 11, "x" * 9 + " http://y z"]
    got = column(spark, texts, X.is_long_enough(F.col("t")))
    assert got == [len(clean(t)) > 10 for t in texts]
    assert {True, False} <= set(got)


def test_length_filter_drops_null(spark, posts_of):
    kept = enrich.keep_text_posts(posts_of({"title": None, "selftext": None}, {"title": "x" * 11}))
    assert [r.id for r in kept.collect()] == ["1"]


def test_filter_is_the_same_before_and_after_collapsing(posts_of):
    rows = [{"title": t, "selftext": b} for t, b in zip(random_texts(200, 1), random_texts(200, 2))]
    posts = enrich.add_full_text(posts_of(*rows))
    before = {r.id for r in enrich.keep_text_posts(posts).collect()}
    after = {r.id for r in posts.filter(F.length(X.cleaned_text(F.col("full_text"))) > 10).collect()}
    assert before == after


def test_tokens_and_stop_words_equal_spark_ml(spark):
    texts = [clean(t) for t in random_texts(300)] + ["", " ", " a", "a ", "the cat of the hat"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    ml = StopWordsRemover(inputCol="w", outputCol="f").transform(Tokenizer(inputCol="c", outputCol="w").transform(df))
    both = ml.select("w", X.tokens(F.col("c")).alias("w2"), "f", X.without_stop_words(F.col("w")).alias("f2"))
    for row in both.collect():
        assert row.w == row.w2 and row.f == row.f2


def test_stop_words_are_the_default_list(spark):
    assert list(STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_full_text(posts_of):
    rows = [("T  t", None), ("T  t", ""), ("T  t", "b\n\n c"), ("T", "   "), (None, "b")]
    posts = enrich.add_full_text(posts_of(*({"title": t, "selftext": b} for t, b in rows)))
    assert [r.full_text for r in posts.orderBy("id").collect()] == ["T  t", "T  t", "T t b c", "T ", None]


def test_time_columns_cut_the_fraction_and_use_utc(posts_of):
    row = enrich.enrich(posts_of({"created_utc": 1704067199.9})).first()
    assert str(row.created_datetime) == "2023-12-31 23:59:59"
    assert (row.year, row.month, row.day, row.hour, row.year_month) == (2023, 12, 31, 23, "2023-12")


def test_engagement_and_media(posts_of):
    posts = enrich.enrich(posts_of(*({"num_comments": n} for n in (0, 1, 2, 3, 10, 11))))
    assert [r.engagement_level.split()[0] for r in posts.orderBy("id").collect()] == [
        "No", "Low", "Low", "Medium", "Medium", "High"]
    urls = ["https://i.redd.it/1.png", "http://imgur.com/a", "https://www.reddit.com/r/x/1", "https://e.org", None]
    media = enrich.enrich(posts_of(*({"url": u} for u in urls)))
    assert [r.has_media for r in media.orderBy("id").collect()] == [
        "Image", "Image", "Text Post", "External Link", "External Link"]


def test_explode_words_keeps_repeats(posts_of):
    posts = enrich.add_measures_time(posts_of({"title": "apple apple banana the pear"}))
    words = enrich.explode_words(enrich.prepare_words(posts))
    assert sorted(r.word for r in words.collect()) == ["apple", "apple", "banana", "pear"]
