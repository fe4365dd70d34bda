"""Pay statistics per industry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumgauge.functions.salary import HIGHEST, LOWEST, bounded_pay
from forumgauge.sources.paths import stored

BUCKETS = 1000


def pay_counts(posts: DataFrame, by: Sequence[str] = (), lowest: float = LOWEST,
               highest: float = HIGHEST) -> DataFrame:
    """Mentions pre-aggregated per industry and yearly pay (NULL out of range).

    Each post's first mention carries ``posts`` = 1, so summing it counts posts
    without a distinct aggregate.
    """
    mentions = (posts
                .select(*by, "score", "num_comments", "industries", F.posexplode_outer("salaries").alias("nth", "pay"))
                .filter(F.col("pay").isNotNull())
                .select(*by, "score", "num_comments", "nth", "pay",
                        F.explode_outer("industries").alias("industry"))
                .filter(F.col("industry").isNotNull()))
    return (mentions.withColumn("pay", bounded_pay(F.col("pay"), lowest, highest))
            .groupBy(*by, "industry", "pay")
            .agg(F.count(F.lit(1)).alias("mentions"),
                 F.count_if(F.col("nth") == 0).alias("posts"),
                 F.sum("score").alias("score"),
                 F.sum("num_comments").alias("num_comments")))


def histogram(posts: DataFrame, by: Sequence[str] = (), lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    """industry, pay, mentions of pay in range: what medians over several dates are merged from."""
    counts = pay_counts(posts, by, lowest, highest)
    return counts.filter(F.col("pay").isNotNull()).select(*by, "industry", "pay", "mentions")


def _mention_stats(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    # Decimal money makes the sum exact, whatever the order of addition.
    money = F.col("pay").cast("decimal(12,2)") * F.col("mentions").cast("decimal(20,0)")
    in_range = F.sum(F.when(F.col("pay").isNotNull(), F.col("mentions")))
    total = F.sum("mentions")
    return counts.groupBy(*by, "industry").agg(
        total.alias("salary_mention_posts"),
        F.sum("posts").alias("salary_distinct_posts"),
        (F.sum("score") / total).alias("avg_engagement_score"),
        (F.sum("num_comments") / total).alias("avg_comments"),
        (F.sum(money).cast("double") / in_range).alias("avg_annual_tc"),
        F.min("pay").alias("min_salary"),
        F.max("pay").alias("max_salary"))


def salary_stats(posts: DataFrame, by: Sequence[str] = (), lowest: float = LOWEST,
                 highest: float = HIGHEST) -> DataFrame:
    """Mention counts, engagement and average pay per industry."""
    stats = _mention_stats(pay_counts(posts, by, lowest, highest), by)
    return stats.drop("min_salary", "max_salary")


def upper_median(counts: DataFrame, keys: Sequence[str], value: str = "pay", held: str = "mentions",
                 out: str = "median_salary") -> DataFrame:
    """The exact upper median of a value per key, from rows of (value, how often).

    No task ever sorts all values of a key.  Counting in ``BUCKETS`` equal parts of
    the key's own range tells which part holds the middle and how far into it; only
    the distinct values of that one part are then put in order.
    """
    keys = list(keys)
    values = counts.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(held).alias("_held"))
    ranges = values.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"),
                                       (F.floor(F.sum("_held") / 2) + 1).alias("_middle"))
    part = F.when(F.col("_high") == F.col("_low"), 0).otherwise(
        F.least(F.floor((F.col(value) - F.col("_low")) / (F.col("_high") - F.col("_low")) * BUCKETS), F.lit(BUCKETS - 1)))
    values = values.join(ranges, keys).withColumn("_part", part.cast("int"))

    upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    parts = (values.groupBy(*keys, "_middle", "_part").agg(F.sum("_held").alias("_in"))
             .withColumn("_before", F.sum("_in").over(upto) - F.col("_in")))
    chosen = parts.filter(F.col("_middle").between(F.col("_before") + 1, F.col("_before") + F.col("_in"))).select(
        *keys, "_part", (F.col("_middle") - F.col("_before")).alias("_offset"))

    by_value = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    last = F.sum("_held").over(by_value)
    return (values.join(chosen, [*keys, "_part"]).withColumn("_upto", last)
            .filter((F.col("_upto") >= F.col("_offset")) & (F.col("_upto") - F.col("_held") < F.col("_offset")))
            .select(*keys, F.col(value).alias(out)))


def salary_order_stats(posts: DataFrame, by: Sequence[str] = (), lowest: float = LOWEST,
                       highest: float = HIGHEST) -> DataFrame:
    """Upper median, minimum and maximum pay per industry, NULL if none in range."""
    stats = salary_table(posts, by, lowest, highest)
    return stats.select(*by, "industry", "median_salary", "min_salary", "max_salary")


def salary_table(posts: DataFrame, by: Sequence[str] = (), lowest: float = LOWEST,
                 highest: float = HIGHEST) -> DataFrame:
    """The published table: mention statistics and order statistics together.

    The counts are used three times.  They are few, so they are written once to
    the shared folder rather than worked out from the posts three times.
    """
    counts = stored(pay_counts(posts, by, lowest, highest), "pay")
    keys = [*by, "industry"]
    joined = _mention_stats(counts, by).join(upper_median(counts, keys), keys, "left")
    return joined.select(
        *keys, "salary_mention_posts", "salary_distinct_posts", "avg_engagement_score",
        "avg_comments", "avg_annual_tc", "median_salary", "min_salary", "max_salary")
