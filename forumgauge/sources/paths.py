"""Where jobs keep tables that must outlive an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder shared by all executors: ``spark.checkpoint.dir``, or the warehouse if that is unset."""
    return (spark.conf.get(CHECKPOINT_SETTING, None) or spark.conf.get(WAREHOUSE_SETTING)).rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for one job below the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/forumgauge/{purpose}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(table: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """The table written as Parquet and read back.

    Cuts the lineage with files every executor can read, so what was computed
    survives the loss of any of them.  Without ``path`` the files go with the
    application.
    """
    path = path or work_folder(table.sparkSession, purpose)
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
