"""Raw posts: landing pages, dated JSON batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge import schemas

CORRUPT = "_corrupt_record"
ARRAY_POSTS = 1000


def _records(spark: SparkSession, path: str, date: str | None, layout: str) -> DataFrame:
    if layout not in ("lines", "array"):
        raise ValueError(f"unknown layout {layout!r}")
    raw = (spark.read.schema(f"{schemas.POST}, date string, {CORRUPT} string")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .option("multiLine", layout == "array").json(path))
    return raw if date is None else raw.filter(F.col("date") == date)


def read_posts(spark: SparkSession, path: str, date: str | None = None, layout: str = "lines") -> DataFrame:
    """Posts of one date, or of all, from ``<path>/date=*/``.

    ``layout="lines"`` reads one post, or one array of posts, per line; such
    files are split between tasks.  ``layout="array"`` reads files that hold a
    single JSON array over several lines, each of them by one task.
    What is no post is returned by :func:`read_rejects`.
    """
    return _records(spark, path, date, layout).filter(F.col("id").isNotNull()).select(*schemas.POST_COLUMNS, "date")


def read_rejects(spark: SparkSession, path: str, date: str | None = None, layout: str = "lines") -> DataFrame:
    """record, date of everything under ``path`` that :func:`read_posts` leaves out.

    ``record`` is the text that could not be parsed, or the fields of a post without id.
    """
    rest = _records(spark, path, date, layout).filter(F.col("id").isNull())
    return rest.select(F.coalesce(CORRUPT, F.to_json(F.struct(*schemas.POST_COLUMNS))).alias("record"), "date")


def write_posts(posts: DataFrame, path: str, parts: Sequence[str] = ("date",), layout: str = "lines",
                per_array: int = ARRAY_POSTS) -> None:
    """Write dated posts as JSON, one folder per date.

    Replaces the folders that occur in ``posts`` and no others.  The posts of a date
    are gathered into as many files as their size asks for: a small date gets one, a
    date with most posts many.  ``layout="array"`` writes files of one JSON array
    each, with ``per_array`` posts at most.
    """
    if layout == "lines":
        (posts.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).json(path))
        return
    group = F.floor(F.monotonically_increasing_id() / per_array)
    post = F.to_json(F.struct(*[c for c in posts.columns if c not in parts]), {"ignoreNullFields": "false"})
    arrays = posts.select(*parts, group.alias("_group"), post.alias("_post")).groupBy(*parts, "_group").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("_post"), ",\n"), F.lit("]")).alias("value"))
    (arrays.drop("_group").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", 1).partitionBy(*parts).text(path))


def parse_listings(pages: DataFrame, payload: str = "payload", keep: bool = False) -> DataFrame:
    """Listing pages with the JSON payload replaced by the parsed ``data``, NULL where it is no listing.

    ``keep`` leaves the payload beside it, for the pages that are rejected.
    """
    parsed = pages.withColumn("data", F.from_json(payload, schemas.LISTING)["data"])
    return parsed if keep else parsed.drop(payload)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All posts that collection runs have written, with when they were fetched, date and run."""
    return spark.read.schema(f"{schemas.POST}, fetched_at timestamp, date string, run bigint").json(path)


def read_run(spark: SparkSession, path: str, run: int) -> DataFrame:
    """The posts one collection run has written."""
    return read_runs(spark, path).filter(F.col("run") == run)


def write_run(table: DataFrame, path: str, run: int) -> None:
    """Write what one run adds to a table, replacing an earlier attempt of it."""
    (table.withColumn("run", F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path))
