"""Running totals that no single task has to add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(table: DataFrame, group: list[str], bucket: str, order: list[Column], value: str,
                  out: str = "before", place: str = "place") -> DataFrame:
    """Add to each row the sum of ``value`` over the rows of its group before it.

    Rows are ordered by ``bucket`` and, inside a bucket, by ``order``.  A task adds
    up one bucket; what came before a bucket is worked out from one row per bucket.
    ``place`` numbers the rows of a bucket from 1.
    """
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = (table.groupBy(*group, bucket).agg(F.sum(value).alias("_total"))
              .select(*group, bucket, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base")))
    return (table.join(totals, [*group, bucket])
            .withColumn(place, F.row_number().over(inside))
            .withColumn(out, F.col("_base") + F.coalesce(
                F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .drop("_base"))
