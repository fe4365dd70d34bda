"""Top-k reports over aggregated tables.  Ties are broken by the key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top(table: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest measure."""
    return table.orderBy(F.desc(measure), *ties).limit(n)


def top_per_group(table: DataFrame, n: int, group: str, measure: str, *ties: str) -> DataFrame:
    """The ``n`` largest rows of each group of an aggregated table.

    The input is an aggregate with one row per (group, label), so a group is
    never larger than the lexicon.
    """
    ranked = Window.partitionBy(group).orderBy(F.desc(measure), *ties)
    return (table.withColumn("_rank", F.row_number().over(ranked))
            .filter(F.col("_rank") <= n).drop("_rank"))


def top_advice_per_industry(advice_by_industry: DataFrame) -> DataFrame:
    return top_per_group(advice_by_industry, 1, "industry", "post_count", "advice_category")


def top_keywords(word_freq: DataFrame, n: int = 20) -> DataFrame:
    return top(word_freq, n, "frequency", "word")


def recent_trends(temporal: DataFrame, n: int = 12) -> DataFrame:
    """The latest month rows; within a month the larger sentiment first."""
    return temporal.orderBy(F.desc("year_month"), F.desc("post_count"), "sentiment").limit(n)


# How the run summary orders each table and how many rows it shows.
SUMMARY = {
    "topic_analysis": (10, [F.desc, "post_count"], ["topic"]),
    "sentiment_by_topic": (10, [F.asc, "topic"], ["count", "sentiment"]),
    "posts_by_industry": (10, [F.desc, "post_count"], ["industry"]),
    "salary_stats": (10, [F.desc, "salary_mention_posts"], ["industry"]),
    "experience_distribution": (10, [F.desc, "post_count"], ["experience_level"]),
    "skills_summary": (20, [F.desc, "skill_count"], ["skill"]),
    "network_metrics": (10, [F.asc, "metric"], []),
}


def summary(name: str, table: DataFrame) -> DataFrame:
    """The rows of one published table that the run summary shows."""
    if name == "temporal_trends":
        return recent_trends(table)
    n, (direction, column), ties = SUMMARY[name]
    order = [direction(column)] + [F.desc(t) if t == "count" else F.asc(t) for t in ties]
    return table.orderBy(*order).limit(n)


def top_skills(skills: DataFrame, n: int = 15) -> DataFrame:
    return top(skills, n, "skill_count", "skill")


def top_skills_in_industry(skills_by_industry: DataFrame, industry: str, n: int = 15) -> DataFrame:
    return top(skills_by_industry.filter(F.col("industry") == industry), n, "skill_count", "skill")


def top_skills_per_industry(skills_by_industry: DataFrame, n: int = 15) -> DataFrame:
    """The same report for every industry at once."""
    return top_per_group(skills_by_industry, n, "industry", "skill_count", "skill")


def top_companies(companies: DataFrame, n: int = 15) -> DataFrame:
    return top(companies, n, "mention_count", "company")


def presentation_order(table: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Ascending by the measure, for display of an already small result."""
    return table.orderBy(F.asc(measure), *ties)


def by_columns(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.orderBy(*columns)
