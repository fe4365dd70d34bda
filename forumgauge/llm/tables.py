"""Tables that outlive an executor, and reading the supplied ones."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import forumgauge
from forumgauge.sources.paths import shared_folder

BATCH_ROWS = 1000


class Work:
    """A folder of intermediate tables for one run of an operator.

    Each table is written as Parquet and read back, which cuts its lineage with
    files that every executor can read.  The folder goes when the application ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/llm/{purpose}-{uuid.uuid4().hex[:12]}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)

    def keep(self, table: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        table.write.parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _shipped(application: str) -> bool:
    """Give the package's code to the executors, once for each application."""
    package = Path(forumgauge.__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='forumgauge-')}/forumgauge", "zip", package.parent, package.name)
    SparkSession.active().sparkContext.addPyFile(archive)
    return True


def map_batches(table: DataFrame, run: Callable, schema: StructType) -> DataFrame:
    """``mapInArrow`` with functions of this package, in batches that stay small where texts are long."""
    table.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _shipped(table.sparkSession.sparkContext.applicationId)
    return table.mapInArrow(run, schema)
