"""From raw posts to published tables and back to dashboard tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge import schemas
from forumgauge.functions.labels import LABEL_COLUMNS
from forumgauge.functions.lexicon import DEFAULT_LEXICON, KINDS, Lexicon
from forumgauge.functions.salary import HOURS_PER_YEAR
from forumgauge.functions.text import is_long_enough, joined_text
from forumgauge.operators import enrich, marts, rollups, salary, tagging
from forumgauge.sources import marts as mart_files
from forumgauge.sources.paths import stored

# Published table -> how it is computed from the label table.
TEXT_MARTS: dict[str, Callable[..., DataFrame]] = {
    "topic_analysis": marts.topic_analysis,
    "sentiment_by_topic": marts.sentiment_by_topic,
    "posts_by_industry": marts.posts_by_industry,
    "salary_stats": salary.salary_table,
    "experience_distribution": marts.experience_distribution,
    "skills_summary": marts.skills_summary,
    "temporal_trends": marts.temporal_trends,
    "company_mentions": marts.company_mentions,
    "topic_by_industry": marts.topic_by_industry,
    "skills_by_industry": marts.skills_by_industry,
}
# These cover posts with short texts too.
WHOLE_MARTS: dict[str, Callable[..., DataFrame]] = {"network_metrics": marts.network_metrics}

RUN_TOGETHER = 8

LABEL_TABLE = ("id", "subreddit", "score", "num_comments", "created_datetime", "year", "month", "day",
               "hour", "year_month", *LABEL_COLUMNS.values(), "salary_mentions", "salaries", "is_text_post")


def text_labels(posts: DataFrame, kinds: Iterable[str] = KINDS, salaries: bool = False,
                lexicon: Lexicon = DEFAULT_LEXICON, match: str = "substring") -> DataFrame:
    """Text posts with the labels asked for, and without their text."""
    found = enrich.keep_text_posts(enrich.add_full_text(posts))
    kinds = tuple(kinds)
    if kinds:
        found = tagging.tag(found, kinds, lexicon=lexicon, match=match)
    if salaries:
        found = tagging.tag_salaries(found)
    return found.drop("full_text", "title", "selftext")


def label_posts(posts: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, match: str = "substring",
                hours_per_year: float = HOURS_PER_YEAR, measures: DataFrame | None = None) -> DataFrame:
    """All labels of all posts, without text: what every table is made from.

    Texts are the bulk of the data and are read once, here.  Posts too short to
    analyse stay in, marked by ``is_text_post``, because some tables count them.
    Where score, comments and time are in a table of their own, ``measures`` with the
    same ids, they are joined with the labels, so that no text moves for the join.
    """
    found = enrich.add_full_text(posts).withColumn("is_text_post", is_long_enough(joined_text()))
    found = tagging.tag_salaries(tagging.tag(found, KINDS, lexicon=lexicon, match=match),
                                 hours_per_year=hours_per_year)
    found = found.drop("full_text", "title", "selftext", "url")
    if measures is not None:
        found = found.join(measures, "id")
    return enrich.add_measures_time(found).select(*LABEL_TABLE, *(c for c in ("date",) if c in found.columns))


def compute_mart(name: str, labels: DataFrame, by: Iterable[str] = ("date",)) -> DataFrame:
    """One published table from the label table."""
    by = tuple(by)
    if name in WHOLE_MARTS:
        return WHOLE_MARTS[name](labels, by)
    return TEXT_MARTS[name](labels.filter("is_text_post"), by)


# A failure of one of these tables does not keep the others from being published.
ISOLATED = ("salary_stats", "salary_histogram")

SIDE_TABLES: dict[str, Callable[..., DataFrame]] = {"salary_histogram": salary.histogram}


def compute_side(name: str, labels: DataFrame, by: Iterable[str] = ("date",)) -> DataFrame:
    return SIDE_TABLES[name](labels.filter("is_text_post"), tuple(by))


def publish_all(posts: DataFrame, path: str, date: str | None = None, fmt: str = "csv",
                labels_path: str | None = None, isolated: Iterable[str] = ISOLATED, side: bool = False,
                measures: DataFrame | None = None) -> dict[str, bool | Exception]:
    """Compute and write all published tables for the dates of ``posts``.

    The label table is written once, to ``labels_path`` or the shared folder;
    each published table then reads only its own few columns of it.

    Pass ``date`` for posts of a single run; otherwise ``posts`` must have a
    ``date`` column and every date is published by the same jobs.  All tables are
    written before any is visible; then one small file per date shows all of them.
    The result says of each table whether it had rows, or why it failed.  Where a
    table outside ``isolated`` fails, nothing is shown and every date keeps what it
    had; a failed table of ``isolated`` keeps its own earlier state only.  ``side``
    adds the tables that exact roll-ups are made from.  ``measures`` as for
    :func:`label_posts`.
    """
    if date is not None:
        posts = posts.withColumn("date", F.lit(date))
    labels = stored(label_posts(posts, measures=measures), "labels", labels_path)

    def stage(name: str) -> mart_files.Staged | Exception:
        try:
            table = compute_side(name, labels) if name in SIDE_TABLES else compute_mart(name, labels)
            return mart_files.stage_mart(table, name, path, fmt=fmt)
        except Exception as error:  # noqa: BLE001 - reported, and decided on below
            return error

    names = [*schemas.MARTS, *(SIDE_TABLES if side else ())]
    # The tables are small jobs over the same input; run together they fill the
    # cores that each of them leaves idle while it finishes.
    with ThreadPoolExecutor(RUN_TOGETHER) as pool:
        outcome = dict(zip(names, pool.map(stage, names)))
    failed = {name for name, result in outcome.items() if isinstance(result, Exception)}
    if failed <= set(isolated):
        mart_files.commit_marts(posts.sparkSession, path, [r for n, r in outcome.items() if n not in failed])
    return {name: result if name in failed else bool(result.dates) for name, result in outcome.items()}


def load_published(spark: SparkSession, path: str, fmt: str = "csv", names: Iterable[str] = tuple(schemas.MARTS)
                   ) -> dict[str, DataFrame]:
    """Every published table over all dates, by name, as one state of the commits has them."""
    commits = mart_files.committed(spark, path)
    return {name: mart_files.load_mart_all_dates(spark, name, path, fmt, commits) for name in names}


def published_rows(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """dataset, date, row count of everything published."""
    parts = [table.groupBy("date").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("dataset"), "date", "row_count")
             for name, table in load_published(spark, path, fmt).items()]
    return reduce(DataFrame.unionByName, parts)


def mart_health(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per published table, whether it has rows, and the overall state.

    Columns dataset, loaded, datasets_loaded, total_datasets, status.
    """
    parts = [table.limit(1).agg((F.count(F.lit(1)) > 0).alias("loaded"))
             .select(F.lit(name).alias("dataset"), "loaded") for name, table in tables.items()]
    checks = reduce(DataFrame.unionByName, parts)
    # One row per table, so both lists are as long as the list of tables.
    loaded = F.col("datasets_loaded")
    return (checks.agg(F.collect_list(F.struct("dataset", "loaded")).alias("checks"),
                       F.count_if("loaded").alias("datasets_loaded"),
                       F.count(F.lit(1)).alias("total_datasets"))
            .select(F.inline("checks"), "datasets_loaded", "total_datasets",
                    F.when(loaded == F.col("total_datasets"), "Healthy")
                    .when(loaded > 0, "Degraded").otherwise("Critical").alias("status")))


def dashboard_tables(spark: SparkSession, path: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Every published table rolled up over all dates, months made dense."""
    tables = {name: rollups.ROLLUPS[name](table)
              for name, table in load_published(spark, path, fmt).items()}
    tables["temporal_trends"] = rollups.densify_temporal(tables["temporal_trends"])
    return tables
