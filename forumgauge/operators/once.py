"""Keeping a costly expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(table: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is evaluated once per row.

    A filter on a plain projected column moves below the projection and takes a
    copy of the expression with it, one per use, so a filter on a label would
    read the text again and again.  A filter on a generated column stays above
    the generator, which here yields exactly one value per row.
    """
    return table.select("*", F.explode(F.array(value)).alias(name))
