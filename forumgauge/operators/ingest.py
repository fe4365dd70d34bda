"""Collection steps: flatten listing pages, de-duplicate, keep the registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumgauge.schemas import POST_COLUMNS
from forumgauge.sources.paths import stored

# Points to no page; a token of the API is never written like this.
LOST = "\x00"


def flatten_listing(pages: DataFrame) -> DataFrame:
    """One row per post of a nested listing page, plus its position.

    Needs ``data`` (the parsed page) and ``subreddit``; other columns of the
    page, such as source and listing ranks, are passed through.
    """
    passed = [c for c in pages.columns if c not in ("data", "subreddit")]
    posts = pages.select(*passed, "subreddit", F.posexplode("data.children").alias("position", "child"))
    return (posts.select(*passed, "position", "subreddit", "child.data.*")
            .withColumn("selftext", F.coalesce("selftext", F.lit("")))
            .select(*passed, "position", *POST_COLUMNS))


def number_pages(pages: DataFrame, chain: Sequence[str] = ("subreddit", "listing"), asked: str = "asked_after",
                 after: str = "after") -> DataFrame:
    """Add ``page``, from 0, to landed pages that only say what they follow.

    ``asked`` is the token a page was asked for with, null for the first page of its
    ``chain``; ``after`` is the token of the page that follows it.  Each page points to
    the page before it; in each round it takes over what the page it points to points
    to, so a chain of n pages takes log2(n) rounds and no task walks along one.
    Pages whose chain has no first page, for one before was not landed or because
    tokens form a ring, get null.  Pages asked for with one token share its number.
    """
    of, token = F.to_json(F.struct(*chain)), F.coalesce(asked, F.lit(""))  # a null source is a source of its own
    links = pages.select(of.alias("_of"), token.alias("_token"), F.col(after).alias("_next"))
    before = links.filter(F.col("_next").isNotNull()).groupBy("_of", F.col("_next").alias("_token")).agg(
        F.min("_token").alias("_before"))
    state = links.select("_of", "_token").distinct().join(before, ["_of", "_token"], "left")
    # _to: the page pointed to, null at the first page; _steps: how far it is.
    first = F.col("_token") == ""
    state = stored(state.select(
        "_of", "_token", F.when(~first, F.coalesce("_before", F.lit(LOST))).alias("_to"),
        F.when(first, 0).otherwise(1).cast("bigint").alias("_steps")), "page-chains")
    for _ in range(max(1, state.count()).bit_length()):
        if state.filter(F.col("_to") != LOST).isEmpty():
            break
        there = state.select("_of", F.col("_token").alias("_to"), F.col("_to").alias("_then"),
                             F.col("_steps").alias("_more"), F.lit(True).alias("_met"))
        then = F.when(F.col("_met"), F.col("_then")).otherwise(F.lit(LOST))
        state = stored(state.join(there, ["_of", "_to"], "left").select(
            "_of", "_token", F.when(F.col("_to").isNotNull(), then).alias("_to"),
            (F.col("_steps") + F.coalesce("_more", F.lit(0))).alias("_steps")), "page-chains")
    numbered = state.select("_of", "_token", F.when(F.col("_to").isNull(), F.col("_steps")).alias("page"))
    return (pages.withColumns({"_of": of, "_token": token}).join(numbered, ["_of", "_token"], "left")
            .select(*pages.columns, "page"))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """The pages whose payload was no listing, with all columns but the parsed one.

    Together with :func:`flatten_listing` every page is accounted for.
    """
    return pages.filter(F.col("data").isNull() | F.col("data.children").isNull()).drop("data")


def packed(order: Mapping[str, int]) -> Column:
    """Whole numbers from 0 as one long that orders as they do, the first one most, nulls first.

    ``order`` names the columns and the bits that each may take, 62 in all; a value
    that does not fit ends the query with an error.
    """
    if sum(order.values()) > 62:
        raise ValueError(f"more than 62 bits: {dict(order)}")
    out = F.lit(0).cast("bigint")
    for name, bits in order.items():
        value = F.col(name).cast("bigint")
        place = F.when(value.isNull(), 0).when(value.between(0, (1 << bits) - 2), value + 1).otherwise(
            F.raise_error(F.concat_ws(" ", F.lit(f"{name} does not fit {bits} bits:"), value)).cast("bigint"))
        out = F.shiftleft(out, bits) + place
    return out


def winners(rows: DataFrame, key: str, order: Mapping[str, int], where: str = "_order") -> DataFrame:
    """key and the packed order of its first row: a hash aggregate of two narrow columns.

    The minimum is taken on each input partition before the shuffle, so a key with a
    third of all copies sends one row per partition.
    """
    return rows.select(key, packed(order).alias(where)).groupBy(key).agg(F.min(where).alias(where))


def rows_of(rows: DataFrame, chosen: DataFrame, key: str, order: Mapping[str, int], where: str = "_order") -> DataFrame:
    """The whole rows of chosen keys and orders, one per key.

    Only keys and orders are looked at until here; a row's other columns move once,
    or not at all where Spark finds the chosen ones few enough to send them to the
    rows.  Rows that are equal in the order are told apart by the hash of all columns.
    """
    written = F.to_json(F.struct(key))  # a null key is a key of its own
    known = chosen.select(written.alias("_known"), F.col(where).alias("_first"))
    met = rows.withColumns({where: packed(order), "_key": written})
    met = met.join(known, (met["_key"] == known["_known"]) & (met[where] == known["_first"]), "left_semi")
    # A key has one order by now; as the join, by both, so that rows stay where it put them.
    same = Window.partitionBy("_key", where).orderBy(F.xxhash64(*rows.columns))
    return met.withColumn("_nth", F.row_number().over(same)).filter("_nth = 1").select(*rows.columns)


def first_occurrence(rows: DataFrame, key: str, order: Mapping[str, int]) -> DataFrame:
    """One row per key: the first in the given order."""
    return rows_of(rows, winners(rows, key, order), key, order)


# The order in which posts are met, and the bits of each part.
MEETING_ORDER = {"source_rank": 10, "listing_rank": 6, "page": 30, "position": 16}


def dedup_first_listing(posts: DataFrame, order: Mapping[str, int] = MEETING_ORDER) -> DataFrame:
    """Each post id once, as first met in source, listing and page order."""
    return first_occurrence(posts, "id", order)


def dedup_new_posts(posts: DataFrame, registry: DataFrame) -> DataFrame:
    """Posts whose id is not in the registry."""
    return posts.join(registry.select("id"), "id", "left_anti")


def first_of_new(posts: DataFrame, registry: DataFrame, order: Mapping[str, int] = MEETING_ORDER) -> DataFrame:
    """Posts not in the registry, each once: the two steps above, with whole posts moved only for new ids."""
    return rows_of(posts, dedup_new_posts(winners(posts, "id", order), registry), "id", order)


def new_ids(posts: DataFrame, registry: DataFrame) -> DataFrame:
    """Ids to append to the registry: in the posts and not yet in it."""
    return posts.select("id").distinct().join(registry.select("id"), "id", "left_anti")


def update_registry(registry: DataFrame, posts: DataFrame) -> DataFrame:
    """The registry after a run: old and new ids, each once.

    The registry holds each id once, so only the new ids need checking against
    it.  A running collection appends :func:`new_ids` and rewrites nothing.
    """
    return registry.select("id").unionByName(new_ids(posts, registry))


def rank_pages(pages: DataFrame, sources: Sequence[str], listings: Sequence[str]) -> DataFrame:
    """Add the positions of a page's source and listing in the configured order; others rank last."""
    def rank(column: str, order: Sequence[str]) -> Column:
        place = F.array_position(F.array(*map(F.lit, order)), F.col(column))
        return F.when(place > 0, place).otherwise(F.lit(len(order) + 1).cast("bigint"))

    return pages.withColumns({"source_rank": rank("subreddit", sources),
                              "listing_rank": rank("listing", listings)})


def registry_size(registry: DataFrame) -> DataFrame:
    return registry.agg(F.count(F.lit(1)).alias("tracked_ids"))


def collection_audit(posts: DataFrame, sources: Sequence[str], listings: Sequence[str],
                     collected_at: datetime | Column) -> DataFrame:
    """One row per collection date: what was asked for, how many posts came, when.

    Needs a ``date`` column.  A run without new posts leaves no row.
    """
    moment = collected_at if isinstance(collected_at, Column) else F.lit(collected_at)
    return posts.groupBy(F.col("date").alias("collection_date")).agg(
        F.array(*map(F.lit, sources)).alias("subreddits"),
        F.array(*map(F.lit, listings)).alias("listings"),
        F.count(F.lit(1)).alias("total_posts"),
        F.max(moment).alias("collected_at_utc"))
