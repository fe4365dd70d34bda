"""Incremental collection: pages land as files, each micro-batch is one run.

``start_collection`` looks every batch's ids up in the registry.  ``start_deduplication``
keeps the ids met lately in the state of the stream instead, so a batch is joined with
nothing; it is for listings that show a post for a known time only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forumgauge.operators import ingest
from forumgauge.plans.collection import LANDED_PAGE, Collection, run_collection
from forumgauge.sources import raw
from forumgauge.sources.registry import Registry


def start_collection(spark: SparkSession, landing_path: str, collection: Collection,
                     checkpoint_path: str, keep_running: str | None = None) -> StreamingQuery:
    """Collect every page that has landed, then stop.

    Pass an interval such as ``"10 minutes"`` as ``keep_running`` to go on
    watching the landing folder.  Spark may repeat a batch after a failure under
    the same number; the run of that number is then replaced, not added to.
    """
    pages = spark.readStream.schema(LANDED_PAGE).json(landing_path)
    trigger = {"processingTime": keep_running} if keep_running else {"availableNow": True}
    return (pages.writeStream
            .foreachBatch(lambda batch, number: run_collection(batch, collection, number))
            .option("checkpointLocation", checkpoint_path)
            .trigger(**trigger).start())


def first_sightings(pages: DataFrame, within: str) -> DataFrame:
    """The posts of a stream of landed pages, each id once as long as it is met within ``within`` of before.

    Ids are state, dealt out by id and kept until the watermark, the latest
    ``fetched_at`` less ``within``, has passed their time plus ``within``.  Pages older
    than the watermark are late and left out; Spark counts them in the progress of the
    query.  Of sightings in one batch any one is taken.
    """
    posts = ingest.flatten_listing(raw.parse_listings(pages))
    return posts.withWatermark("fetched_at", within).dropDuplicatesWithinWatermark(["id"])


def start_deduplication(spark: SparkSession, landing_path: str, collection: Collection, checkpoint_path: str,
                        within: str = "7 days", files_per_batch: int = 1000,
                        keep_running: str | None = None) -> StreamingQuery:
    """Collect every page that has landed by :func:`first_sightings`, then stop, or go on every ``keep_running``.

    Posts and ids of a batch go to folders of its number, which a repeated batch replaces.
    """
    pages = spark.readStream.schema(LANDED_PAGE).option("maxFilesPerTrigger", files_per_batch).json(landing_path)

    def write(batch: DataFrame, number: int) -> None:
        dated = batch.withColumns({"date": F.date_format("fetched_at", "yyyy-MM-dd"), "run": F.lit(number)})
        raw.write_posts(dated.drop("page", "position", "listing"), collection.raw_path, parts=("date", "run"))
        written = raw.read_run(batch.sparkSession, collection.raw_path, number)
        raw.write_run(ingest.collection_audit(written, collection.sources, collection.listings, F.col("fetched_at")),
                      collection.audit_path, number)
        Registry(batch.sparkSession, collection.registry_path).add(written.select("id"), number)

    trigger = {"processingTime": keep_running} if keep_running else {"availableNow": True}
    return (first_sightings(pages, within).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint_path).trigger(**trigger).start())
