"""One collection run: listing pages in, new posts and ids out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumgauge.operators import ingest
from forumgauge.sources import raw
from forumgauge.sources.registry import Registry

# Landed pages: the payload as fetched, and what it is the answer to.
LANDED_PAGE = "payload string, subreddit string, listing string, page int, fetched_at timestamp"


@dataclass(frozen=True)
class Collection:
    """Where a collection keeps its tables and what it asks for."""

    raw_path: str
    registry_path: str
    audit_path: str
    sources: Sequence[str]
    listings: Sequence[str] = ("new", "top")


def new_posts(pages: DataFrame, registry: DataFrame, sources: Sequence[str],
              listings: Sequence[str]) -> DataFrame:
    """Posts not collected before, each once, dated by when it was fetched."""
    ranked = ingest.rank_pages(raw.parse_listings(pages), sources, listings)
    posts = ingest.flatten_listing(ranked).withColumn("date", F.date_format("fetched_at", "yyyy-MM-dd"))
    return ingest.first_of_new(posts, registry)


def run_collection(pages: DataFrame, collection: Collection, run: int) -> None:
    """Collect one run of landed pages.

    Everything a run writes is in folders of its own, and it does not look at
    its own ids, so running it again after a failure replaces what the first
    attempt left.  Ids are recorded last, once the posts are safe.
    """
    spark = pages.sparkSession
    registry = Registry(spark, collection.registry_path)
    found = new_posts(pages, registry.read(before_run=run), collection.sources, collection.listings)
    raw.write_posts(found.drop("source_rank", "listing_rank", "page", "position", "listing")
                    .withColumn("run", F.lit(run)), collection.raw_path, parts=("date", "run"))
    written = raw.read_run(spark, collection.raw_path, run)
    raw.write_run(ingest.collection_audit(written, collection.sources, collection.listings, F.col("fetched_at")),
                  collection.audit_path, run)
    registry.add(written.select("id"), run)
