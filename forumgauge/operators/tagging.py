"""Text labels and pay mentions added to posts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumgauge.functions.labels import LABEL_COLUMNS, found_keywords, label_column, with_implied
from forumgauge.functions.lexicon import DEFAULT_LEXICON, KINDS, Lexicon
from forumgauge.functions.salary import HOURS_PER_YEAR, annual_pays, salary_mentions
from forumgauge.operators.once import compute_once


def tag(posts: DataFrame, kinds: Iterable[str] = KINDS, text_col: str = "full_text",
        lexicon: Lexicon = DEFAULT_LEXICON, match: str = "substring") -> DataFrame:
    """Add the label columns of the given kinds, reading each text once."""
    kinds = tuple(kinds)
    text = F.col(text_col)
    keywords = lexicon.keywords(*kinds)
    found = posts.withColumn("_lowered", F.lower(text))
    found = compute_once(found, "_found", found_keywords(F.col("_lowered"), keywords, match))
    found = compute_once(found, "_hits", with_implied(F.col("_found"), keywords, match))
    return (found
            .withColumns({LABEL_COLUMNS[k]: label_column(k, "_hits", text, lexicon) for k in kinds})
            .drop("_lowered", "_found", "_hits"))


def tag_industries(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["industry"], **options)


def tag_topics(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["topic"], **options)


def tag_companies(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["company"], **options)


def tag_skills(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["skill"], **options)


def tag_advice(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["advice"], **options)


def tag_sentiment(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["sentiment"], **options)


def tag_experience(posts: DataFrame, **options) -> DataFrame:
    return tag(posts, ["experience"], **options)


def tag_salaries(posts: DataFrame, text_col: str = "full_text",
                 hours_per_year: float = HOURS_PER_YEAR) -> DataFrame:
    """Add ``salary_mentions`` (raw) and ``salaries`` (yearly pay, non-NULL)."""
    return (compute_once(posts, "salary_mentions", salary_mentions(F.col(text_col)))
            .withColumn("salaries", annual_pays(F.col("salary_mentions"), hours_per_year)))


def explode_salaries(posts: DataFrame) -> DataFrame:
    """One row per industry and pay mention of a post."""
    return (posts
            .select("id", "score", "num_comments", "salaries",
                    F.explode_outer("industries").alias("industry"))
            .select("id", "industry", "score", "num_comments",
                    F.explode_outer("salaries").alias("norm_salary"))
            .filter(F.col("industry").isNotNull() & F.col("norm_salary").isNotNull()))
