"""Derived post columns, text preparation and row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumgauge.functions import text as X
from forumgauge.operators.once import compute_once


def add_created_datetime(posts: DataFrame) -> DataFrame:
    return posts.withColumn("created_datetime", X.created_datetime())


def add_date_parts(posts: DataFrame) -> DataFrame:
    t = F.col("created_datetime")
    return posts.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)})


def add_year_month(posts: DataFrame) -> DataFrame:
    return posts.withColumn("year_month", X.year_month())


def add_full_text(posts: DataFrame) -> DataFrame:
    return posts.withColumn("full_text", X.full_text())


def add_text_length(posts: DataFrame) -> DataFrame:
    return posts.withColumn("text_length", F.length("full_text"))


def add_engagement_level(posts: DataFrame) -> DataFrame:
    return posts.withColumn("engagement_level", X.engagement_level())


def add_has_media(posts: DataFrame) -> DataFrame:
    return posts.withColumn("has_media", X.has_media())


def add_cleaned_text(posts: DataFrame) -> DataFrame:
    return posts.withColumn("cleaned_text", X.cleaned_text(F.col("full_text")))


def add_words(posts: DataFrame) -> DataFrame:
    return posts.withColumn("words", X.tokens(F.col("cleaned_text")))


def add_filtered_words(posts: DataFrame) -> DataFrame:
    return posts.withColumn("filtered_words", X.without_stop_words(F.col("words")))


def add_measures_time(posts: DataFrame) -> DataFrame:
    """Every time key derived from the creation instant."""
    return add_year_month(add_date_parts(add_created_datetime(posts)))


def enrich(posts: DataFrame) -> DataFrame:
    """All derived columns of a raw post; unused ones are pruned by Spark."""
    for step in (add_measures_time, add_full_text, add_text_length,
                 add_engagement_level, add_has_media):
        posts = step(posts)
    return posts


def keep_text_posts(posts: DataFrame) -> DataFrame:
    """Drop posts whose cleaned text is too short, or NULL, to analyse.

    Cleaning gives the same text with and without collapsed whitespace, so the
    filter starts from title and body.  Spark moves it below the other columns,
    and collapsing there would mean doing it twice.
    """
    return posts.filter(X.is_long_enough(X.joined_text()))


def prepare_words(posts: DataFrame) -> DataFrame:
    """The text posts with their tokens, stop words dropped."""
    cleaned = compute_once(keep_text_posts(posts), "cleaned_text", X.cleaned_text(X.joined_text()))
    return add_filtered_words(add_words(cleaned))


def explode_words(posts: DataFrame) -> DataFrame:
    """One row per word, with the fields of its post."""
    return posts.select("id", "title", "score", "num_comments", "created_datetime",
                        F.explode_outer("filtered_words").alias("word")).filter(F.col("word").isNotNull())


def keep_labelled(posts: DataFrame, labels: str) -> DataFrame:
    """Posts with at least one label in the given array column."""
    return posts.filter(F.size(labels) > 0)
