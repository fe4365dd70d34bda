"""Dashboard answers over the rolled-up tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumgauge.functions.lexicon import SENTIMENTS


def metric_value(metrics: DataFrame, name: str) -> DataFrame:
    """One metric as a whole number, 0 if it is absent."""
    wanted = F.max(F.when(F.col("metric") == name, F.col("value")))
    return metrics.agg(F.coalesce(wanted.cast("long"), F.lit(0).cast("long")).alias("value"))


def kpi_salary_posts(salary: DataFrame) -> DataFrame:
    total = F.sum("salary_mention_posts").cast("long")
    return salary.agg(F.coalesce(total, F.lit(0).cast("long")).alias("salary_posts"))


def dominant_sentiment(sentiment_by_topic: DataFrame) -> DataFrame:
    """The sentiment with the largest total; N/A for an empty table.

    Ties go to the earlier of Positive, Negative, Neutral.
    """
    totals = [F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("count"))), F.lit(0)) for s in SENTIMENTS]
    best = F.greatest(*totals)
    first = F.coalesce(*[F.when(t == best, F.lit(s)) for s, t in zip(SENTIMENTS, totals)])
    return sentiment_by_topic.agg(
        F.when(F.count(F.lit(1)) == 0, "N/A").otherwise(first).alias("dominant_sentiment"))


def filter_options(table: DataFrame, key: str) -> DataFrame:
    """Sorted distinct values a filter widget offers."""
    return table.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key)


def _keep(table: DataFrame, key: str, wanted: Iterable[str]) -> DataFrame:
    return table.filter(F.col(key).isin(*wanted))


def filter_by_topics(table: DataFrame, topics: Iterable[str]) -> DataFrame:
    return _keep(table, "topic", topics)


def filter_by_industries(table: DataFrame, industries: Iterable[str]) -> DataFrame:
    return _keep(table, "industry", industries)


def monthly_avg_score(temporal: DataFrame) -> DataFrame:
    """Month -> mean of its sentiments' averages; NULLs are skipped."""
    return temporal.groupBy("year_month").agg(F.avg("avg_score").alias("avg_score"))


def salary_ranges(salary: DataFrame) -> DataFrame:
    """Average pay with the distance to the extremes, never below 0."""
    pay = F.col("avg_annual_tc")
    known = salary.filter(pay.isNotNull())
    if not {"min_salary", "max_salary"} <= set(salary.columns):
        return known

    def at_least_zero(value):
        # greatest() skips NULL, which must stay NULL here.
        return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))

    return known.withColumns({"err_plus": at_least_zero(F.col("max_salary") - pay),
                              "err_minus": at_least_zero(pay - F.col("min_salary"))})


# --- Fixed values: display names of the salary report -------------------------
SALARY_DISPLAY = {
    "industry": "Industry",
    "salary_mention_posts": "Posts w/ Salary",
    "avg_annual_tc": "Average Salary ($)",
    "min_salary": "Min ($)",
    "max_salary": "Max ($)",
    "avg_engagement_score": "Avg Score",
    "avg_comments": "Avg Comments",
}
# --- End of fixed values -------------------------------------------------------


def salary_display(salary: DataFrame) -> DataFrame:
    """The available columns under their display names, most mentions first."""
    shown = [F.col(c).alias(name) for c, name in SALARY_DISPLAY.items() if c in salary.columns]
    return salary.orderBy(F.desc("salary_mention_posts"), "industry").select(*shown)
