"""Published tables rolled up over all dates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumgauge.functions.lexicon import SENTIMENTS
from forumgauge.operators.salary import upper_median

# Output column -> (input column, aggregate).
Aggregates = dict[str, tuple[str, str]]

MEAN_OF_MEANS = "mean_of_means"
WEIGHTED = "weighted"


def _aggregate(source: str, how: str, weight: str | None) -> Column:
    if how == "mean" and weight is not None:
        known = F.when(F.col(source).isNotNull(), F.col(weight))
        return F.sum(F.col(source) * known) / F.sum(known)
    return {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}[how](source)


def rollup_mart(table: DataFrame, keys: Sequence[str], aggregates: Aggregates,
                avg_mode: str = MEAN_OF_MEANS, weight: str | None = None) -> DataFrame:
    """Group a table of all dates by its keys; rows with a NULL key are dropped.

    ``avg_mode="mean_of_means"`` averages the per-date averages without weights.
    ``"weighted"`` weights each by the ``weight`` column, which gives the average
    over all posts.
    """
    if avg_mode not in (MEAN_OF_MEANS, WEIGHTED):
        raise ValueError(f"unknown avg_mode {avg_mode!r}")
    used = weight if avg_mode == WEIGHTED else None
    for key in keys:
        table = table.filter(F.col(key).isNotNull())
    return table.groupBy(*keys).agg(*[
        _aggregate(source, how, used).alias(name) for name, (source, how) in aggregates.items()])


# Output column -> the columns it may be made from, best first, and how; none there, no output.
Outputs = dict[str, tuple[tuple[str, ...], str]]


@dataclass(frozen=True)
class Rollup:
    """What a published table is grouped by over its dates, and what is worked out."""

    keys: tuple[str, ...]
    outputs: Outputs
    weight: str | None = None

    def aggregates(self, columns: Iterable[str]) -> Aggregates:
        """Each output with the first of its source columns that a table has."""
        columns = set(columns)
        sources = {name: [c for c in wanted if c in columns] for name, (wanted, _) in self.outputs.items()}
        return {name: (found[0], self.outputs[name][1]) for name, found in sources.items() if found}

    def __call__(self, table: DataFrame, avg_mode: str = MEAN_OF_MEANS) -> DataFrame:
        return rollup_mart(table, self.keys, self.aggregates(table.columns), avg_mode, self.weight)


def _same(how: str, *columns: str) -> Outputs:
    return {c: ((c,), how) for c in columns}


rollup_topic = Rollup(("topic",), _same("sum", "post_count") | _same("mean", "avg_score", "avg_comments"), "post_count")
rollup_sentiment_topic = Rollup(("topic", "sentiment"), _same("sum", "count"))
rollup_industry = Rollup(
    ("industry",), _same("sum", "post_count") | _same("mean", "avg_engagement_score", "avg_comments_count"), "post_count")
rollup_experience = Rollup(("experience_level",), _same("sum", "post_count"))
rollup_skills = Rollup(("skill",), _same("sum", "skill_count"))
rollup_temporal = Rollup(
    ("year_month", "sentiment"), _same("sum", "post_count") | _same("mean", "avg_score", "avg_comments"), "post_count")
rollup_company = Rollup(
    ("company",), _same("sum", "mention_count") | _same("mean", "avg_score", "avg_engagement"), "mention_count")
rollup_topic_industry = Rollup(("industry", "topic"), _same("sum", "post_count") | _same("mean", "avg_score"), "post_count")
rollup_skills_industry = Rollup(("industry", "skill"), _same("sum", "skill_count"))
# Tables written without some of these columns are accepted.
rollup_salary = Rollup(("industry",), {
    **_same("sum", "salary_mention_posts"), **_same("mean", "avg_engagement_score", "avg_comments"),
    "avg_annual_tc": (("avg_annual_tc", "median_salary"), "mean"),
    **_same("min", "min_salary"), **_same("max", "max_salary")}, "salary_mention_posts")

TOTALS, AVERAGES = ("Total Posts", "Total Comments"), ("Avg Score", "Avg Comments")


@dataclass(frozen=True)
class MetricRollup(Rollup):
    """Totals added up and averages averaged, by metric name; other metrics are left out."""

    def __call__(self, table: DataFrame, avg_mode: str = MEAN_OF_MEANS) -> DataFrame:
        return self.chosen(super().__call__(table, avg_mode))

    @staticmethod
    def chosen(both: DataFrame) -> DataFrame:
        metric = F.col("metric")
        value = F.when(metric.isin(*TOTALS), F.col("total")).when(metric.isin(*AVERAGES), F.col("mean"))
        return both.filter(metric.isin(*TOTALS, *AVERAGES)).select("metric", value.alias("value"))


rollup_metrics = MetricRollup(("metric",), {"total": (("value",), "sum"), "mean": (("value",), "mean")})


def densify_temporal(temporal: DataFrame) -> DataFrame:
    """Every month with every sentiment; absent counts 0, absent averages NULL.

    One aggregate per month holds its sentiments side by side, so that the table is read once.
    """
    measures = ("post_count", "avg_score", "avg_comments")
    sides = [F.any_value(F.when(F.col("sentiment") == s, F.struct(*measures)), F.lit(True)).alias(s) for s in SENTIMENTS]
    rows = [F.struct(F.lit(s).alias("sentiment"), F.coalesce(F.col(s)["post_count"], F.lit(0)).alias("post_count"),
                     *(F.col(s)[m].alias(m) for m in measures[1:])) for s in SENTIMENTS]
    return temporal.groupBy("year_month").agg(*sides).select("year_month", F.inline(F.array(*rows)))


def rollup_salary_median(histogram: DataFrame) -> DataFrame:
    """industry, median_salary, mentions: the exact upper median over all dates of a pay histogram.

    Histograms of dates are added up; a mean of the dates' medians is not the median.
    """
    known = histogram.filter(F.col("industry").isNotNull())
    mentions = known.groupBy("industry").agg(F.sum("mentions").alias("mentions"))
    return mentions.join(upper_median(known, ["industry"]), "industry")


ROLLUPS: dict[str, Rollup] = {
    "topic_analysis": rollup_topic,
    "sentiment_by_topic": rollup_sentiment_topic,
    "posts_by_industry": rollup_industry,
    "salary_stats": rollup_salary,
    "experience_distribution": rollup_experience,
    "skills_summary": rollup_skills,
    "temporal_trends": rollup_temporal,
    "network_metrics": rollup_metrics,
    "company_mentions": rollup_company,
    "topic_by_industry": rollup_topic_industry,
    "skills_by_industry": rollup_skills_industry,
}
