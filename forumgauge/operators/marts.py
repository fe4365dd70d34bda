"""Per-run aggregate tables.

Every function takes tagged posts and groups by its own keys plus the optional
``by`` columns, so the tables of all dates come out of one job with
``by=("date",)``.  Label arrays are exploded with ``explode_outer`` and the NULL
label dropped afterwards: a plain ``explode`` makes the optimizer add a size
filter below the projection that computes the labels, which would read every
text twice.  Aggregation is partial before each shuffle, so a label carried by a
third of all posts costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumgauge.functions.lexicon import DEFAULT_SKILL

By = Sequence[str]


def _count(name: str = "post_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def _stats(count: str = "post_count", score: str = "avg_score",
           comments: str = "avg_comments") -> list[Column]:
    return [_count(count), F.avg("score").alias(score), F.avg("num_comments").alias(comments)]


def explode_label(posts: DataFrame, labels: str, name: str) -> DataFrame:
    """One row per label of a post; posts without labels disappear."""
    exploded = posts.select(*[c for c in posts.columns if c != labels],
                            F.explode_outer(labels).alias(name))
    return exploded.filter(F.col(name).isNotNull())


def _pairs(posts: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """One row per combination of two kinds of labels of the same post."""
    return explode_label(explode_label(posts, *first), *second)


INDUSTRY = ("industries", "industry")
TOPIC = ("topics", "topic")
ADVICE = ("advice_categories", "advice_category")
COMPANY = ("mentioned_companies", "company")
SKILL = ("mentioned_skills", "skill")


# --- Words -------------------------------------------------------------------

def word_freq(posts: DataFrame, min_length: int = 3) -> DataFrame:
    """word (longer than ``min_length``) -> frequency, from tokenised posts."""
    words = posts.select(F.explode_outer("filtered_words").alias("word"))
    return words.filter(F.length("word") > min_length).groupBy("word").agg(_count("frequency"))


# --- Topics and industries ----------------------------------------------------

def topic_analysis(posts: DataFrame, by: By = ()) -> DataFrame:
    return explode_label(posts, *TOPIC).groupBy(*by, "topic").agg(*_stats())


def industry_distribution(posts: DataFrame, by: By = ()) -> DataFrame:
    return explode_label(posts, *INDUSTRY).groupBy(*by, "industry").agg(*_stats())


def posts_by_industry(posts: DataFrame, by: By = ()) -> DataFrame:
    return industry_distribution(posts, by).withColumnsRenamed(
        {"avg_score": "avg_engagement_score", "avg_comments": "avg_comments_count"})


def topic_by_industry(posts: DataFrame, by: By = ()) -> DataFrame:
    return (_pairs(posts, TOPIC, INDUSTRY).groupBy(*by, "industry", "topic")
            .agg(_count(), F.avg("score").alias("avg_score")))


def _engagement(stats: DataFrame, key: str) -> DataFrame:
    return (stats.select(key, F.col("avg_score").alias("avg_upvotes"), "avg_comments",
                         F.col("post_count").alias("total_posts"))
            .orderBy(F.desc("avg_comments"), key))


def engagement_by_topic(posts: DataFrame) -> DataFrame:
    return _engagement(topic_analysis(posts), "topic")


def engagement_by_industry(posts: DataFrame) -> DataFrame:
    return _engagement(industry_distribution(posts), "industry")


def engagement_by_hour(posts: DataFrame) -> DataFrame:
    """All 24 hours; hours without posts count 0.  Over all cleaned posts."""
    measured = posts.groupBy("hour").agg(*_stats())
    hours = posts.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    # At most 24 rows on the right, one per hour.
    return (hours.join(F.broadcast(measured), "hour", "left")
            .fillna(0, ["post_count", "avg_score", "avg_comments"]).orderBy("hour"))


# --- Companies and advice -------------------------------------------------------

def company_mentions(posts: DataFrame, by: By = ()) -> DataFrame:
    return (explode_label(posts, *COMPANY).groupBy(*by, "company")
            .agg(*_stats("mention_count", comments="avg_engagement")))


def advice_share(posts: DataFrame) -> DataFrame:
    """One row: posts with advice, all posts, percentage (0 without posts)."""
    with_advice = F.count_if(F.size("advice_categories") > 0)
    total = F.count(F.lit(1))
    return posts.agg(
        with_advice.alias("advice_posts"), total.alias("total_posts"),
        F.when(total > 0, with_advice * 100.0 / total).otherwise(0.0).alias("advice_percentage"))


def advice_distribution(posts: DataFrame) -> DataFrame:
    return (explode_label(posts, *ADVICE).groupBy("advice_category")
            .agg(*_stats(comments="avg_engagement")))


def advice_by_industry(posts: DataFrame) -> DataFrame:
    return (_pairs(posts, ADVICE, INDUSTRY).groupBy("industry", "advice_category")
            .agg(_count(), F.avg("score").alias("avg_score")))


def advice_timeline(posts: DataFrame) -> DataFrame:
    return explode_label(posts, *ADVICE).groupBy("year_month", "advice_category").agg(_count())


# --- Sentiment --------------------------------------------------------------------

def sentiment_dist(posts: DataFrame) -> DataFrame:
    return posts.groupBy("sentiment").agg(*_stats("count"))


def sentiment_by_industry(posts: DataFrame) -> DataFrame:
    return explode_label(posts, *INDUSTRY).groupBy("industry", "sentiment").agg(_count("count"))


def sentiment_by_topic(posts: DataFrame, by: By = ()) -> DataFrame:
    return explode_label(posts, *TOPIC).groupBy(*by, "topic", "sentiment").agg(_count("count"))


# --- Time -------------------------------------------------------------------------

def posts_over_time(posts: DataFrame) -> DataFrame:
    """Daily volume and engagement.  Over all cleaned posts."""
    return posts.groupBy("year", "month", "day").agg(*_stats())


def industry_trends(posts: DataFrame) -> DataFrame:
    return explode_label(posts, *INDUSTRY).groupBy("year", "month", "industry").agg(_count())


def temporal_trends(posts: DataFrame, by: By = ()) -> DataFrame:
    return posts.groupBy(*by, "year_month", "sentiment").agg(*_stats())


# --- Experience, skills, totals ----------------------------------------------------

def experience_distribution(posts: DataFrame, by: By = ()) -> DataFrame:
    return posts.groupBy(*by, "experience_level").agg(_count())


def skill_counts(posts: DataFrame, by: By = ()) -> DataFrame:
    return explode_label(posts, *SKILL).groupBy(*by, "skill").agg(_count("skill_count"))


def skills_summary(posts: DataFrame, by: By = ()) -> DataFrame:
    """Posts per skill, or one default row where no skill was found at all.

    Posts without a skill are counted under a NULL skill, so the default row can
    be decided on the small aggregate instead of by a second pass over posts.
    """
    counts = (posts.select(*by, F.explode_outer("mentioned_skills").alias("skill"))
              .groupBy(*by, "skill").agg(_count("skill_count")))
    # One slot per group: its real skills, or a NULL to be replaced.
    rows = F.collect_list(F.when(F.col("skill").isNotNull(), F.struct("skill", "skill_count")))
    default = F.array(F.struct(F.lit(DEFAULT_SKILL).alias("skill"),
                               F.lit(1).cast("bigint").alias("skill_count")))
    # The list holds at most one entry per skill of the lexicon.
    return (counts.groupBy(*by).agg(rows.alias("found"))
            .select(*by, F.inline(F.when(F.size("found") > 0, F.col("found")).otherwise(default))))


def skills_by_industry(posts: DataFrame, by: By = ()) -> DataFrame:
    return (_pairs(posts, SKILL, INDUSTRY).groupBy(*by, "industry", "skill")
            .agg(_count("skill_count")))


def network_metrics(posts: DataFrame, by: By = ()) -> DataFrame:
    """Four metric rows from one aggregation.  Over all cleaned posts."""
    def number(value: Column) -> Column:
        return F.coalesce(value.cast("double"), F.lit(0.0))

    totals = posts.groupBy(*by).agg(
        number(F.count(F.lit(1))).alias("Total Posts"),
        number(F.sum("num_comments")).alias("Total Comments"),
        number(F.avg("score")).alias("Avg Score"),
        number(F.avg("num_comments")).alias("Avg Comments"))
    metrics = [c for c in totals.columns if c not in by]
    return totals.unpivot(list(by), metrics, "metric", "value")
