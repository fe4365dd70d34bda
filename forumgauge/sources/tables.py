"""Posts assembled from the supplied tables.

Every document is a post with its whole text as body.  Posts without a body are
further rows: one link post with an empty body for each of ``pages``, with that page's address,
and one with a null body for each item of ``benchmark``; ``number`` keeps the three apart.
Titles come from a fixed phrase list.  All ``events`` count: those of one document are
the ones whose id leaves its number as remainder by the number of documents.  Text
and measures are separate relations: a caller labels the text first and joins only the
narrow result, so no body crosses the network for the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumgauge.schemas import LISTING, POST_COLUMNS

# --- Fixed values: titles by doc_id % 20 -----------------------------------------
TITLES = (
    "Got an internship offer at Google paying $45/hr",
    "Rejected again after the final interview, feeling hopeless",
    "New grad salary $120,000 or $135,500 at a YC startup",
    "Is 150k total comp fair after 3 years of Python and AWS",
    "Moving to consulting at Deloitte, any resume advice?",
    "Palantir clearance job: is $52.50 per hour low?",
    "Nvidia hardware team burnout, 2,000 applications later",
    "Stripe or Databricks: system design mock interview tips",
    "Biotech data science, staff role, $185k base",
    "Walmart retail to game dev, career change via bootcamp",
    "ok",
    "Entry level C++ at Oracle, degree from a small college",
    "Sophomore at a state school, new to networking on LinkedIn",
    "Job search is slow, amazon and meta ghosted me, was 60/hr",
    "How to negotiate offer: $95,000 vs $110k at Goldman Sachs",
    "Learn open source, check Glassdoor before joining Uber",
    "Contract at $2,500 per hour, or 1,000/hr, or 1000.50/hr?",
    "After a 100km run with a 120kb file: $120.5k or 85.5k base?",
    "Is 120,0000 a typo, and does 401k match count next to $401k?",
    "Volunteering pays 0/hr, then 95,000.50 and $95000.50 a year",
)
# --- End of fixed values ----------------------------------------------------------

MONTH_SECONDS = 2_592_000
PAGE_POSTS, ITEM_POSTS = 10 ** 12, 2 * 10 ** 12  # where their post numbers begin
PER_PAGE = 10
# Posts that one task labels, and the fewest tasks among which documents are dealt out.
PER_TASK, FEWEST_TASKS = 5000, 12


SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _bodyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, selftext, subreddit of the posts without a body."""
    pages = _read(spark, sf_dir, "pages").select(
        (F.col("page_id") + PAGE_POSTS).alias("doc_id"), F.lit("").alias("selftext"), F.lit("links").alias("subreddit"))
    items = _read(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + ITEM_POSTS).alias("doc_id"), F.lit(None).cast("string").alias("selftext"),
        F.lit("titles").alias("subreddit"))
    return pages.unionByName(items)


def post_texts(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """doc_id, id, title, selftext, subreddit: one row per post.

    The supplied documents may be one row group, which one task would read and label
    alone, so their texts are dealt out once, at every size.  Labelling a text takes far longer than moving it,
    so tasks are made by the number of posts: by bytes they would be so few and large that cores wait for the last.
    Not ``dealt``, texts stay where they are read, for callers that move them anyway.
    """
    documents = _read(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("selftext"), F.col("source").alias("subreddit"))
    if dealt:
        tasks = max(FEWEST_TASKS, -(-documents.count() // PER_TASK))  # counted from the files' footers
        documents = documents.repartition(tasks, "doc_id")
    doc = F.col("doc_id")
    titles = F.split(F.lit("\n".join(TITLES)), "\n")
    return documents.unionByName(_bodyless(spark, sf_dir)).select(
        "doc_id", doc.cast("string").alias("id"),
        F.element_at(titles, (doc % len(TITLES) + 1).cast("int")).alias("title"), "selftext", "subreddit")


def post_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, id of every post, for tables that read no text."""
    documents = _read(spark, sf_dir, "documents").select("doc_id")
    return documents.unionByName(_bodyless(spark, sf_dir).select("doc_id")).select(
        "doc_id", F.col("doc_id").cast("string").alias("id"))


def add_measures(posts: DataFrame, sf_dir: str) -> DataFrame:
    """Add score, num_comments and created_utc, from all events of a post.

    A post without an event counts 0 and dates from the epoch, so each post has one row
    whichever columns a query reads.
    """
    zero = F.lit(0).cast("bigint")
    documents = max(1, _read(posts.sparkSession, sf_dir, "documents").count())  # from the files' footers
    events = _read(posts.sparkSession, sf_dir, "events").groupBy((F.col("event_id") % documents).alias("doc_id")).agg(
        F.sum(F.floor("value").cast("bigint")).alias("_score"),
        F.sum(F.regexp_extract("props", r"[0-9]+", 0).try_cast("bigint")).alias("_comments"),
        F.min(F.unix_seconds(F.col("ts").cast("timestamp"))).alias("_second"))
    return posts.join(events, "doc_id", "left").withColumns({
        "score": F.coalesce("_score", zero),
        "num_comments": F.coalesce("_comments", zero),
        "created_utc": (F.coalesce("_second", zero) + F.col("doc_id") % 6 * MONTH_SECONDS).cast("double"),
    }).drop("_score", "_comments", "_second")


def add_urls(posts: DataFrame, sf_dir: str) -> DataFrame:
    """Add url: a page's address, a generated one, or NULL.  Needs subreddit."""
    pages = _read(posts.sparkSession, sf_dir, "pages").select(
        (F.col("page_id") + PAGE_POSTS).alias("doc_id"), F.col("url").alias("_page_url"))
    doc, number = F.col("doc_id"), F.col("doc_id").cast("string")
    url = (F.when(doc >= PAGE_POSTS, F.col("_page_url"))
           .when(doc % 4 == 1, F.concat(F.lit("https://i.redd.it/"), number, F.lit(".png")))
           .when(doc % 4 == 2, F.concat(F.lit("https://www.reddit.com/r/"), "subreddit", F.lit("/"), number)))
    return posts.join(pages, "doc_id", "left").withColumn("url", url).drop("_page_url")


def posts(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """Whole raw posts, for the readers and writers of raw data."""
    texts = post_texts(spark, sf_dir, dealt)
    return add_urls(add_measures(texts, sf_dir), sf_dir).select(*POST_COLUMNS)


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subreddit, page, payload: nested API pages over the posts, up to ``PER_PAGE`` posts of a source each.

    A page holds the posts whose numbers share all but the last digit, so a group is
    never larger.  A missing body is left out of the payload, as the API may do.
    """
    child = F.struct(F.struct("id", "title", "selftext", "score", "created_utc",
                              "num_comments", "url").alias("data"))
    number = F.col("id").cast("bigint")
    pages = posts(spark, sf_dir, dealt=False).groupBy("subreddit", F.expr(f"bigint(id) % {PAGE_POSTS} div {PER_PAGE}").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(number.alias("number"), child.alias("child")))).alias("found"))
    page = F.struct(F.struct(F.transform("found", lambda x: x["child"]).alias("children"),
                             F.concat(F.lit("t3_"), F.element_at("found", -1)["number"]).alias("after")).alias("data"))
    return pages.select("subreddit", "page", F.to_json(page).alias("payload"))


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payload, subreddit, listing, page: every page in the listing ``new``, those of even number also in ``top``.

    A post has one vote more by the time that it is in ``top``.
    """
    voted = F.to_json(_voted(F.from_json("payload", LISTING)))
    new, top = (F.struct(payload.alias("payload"), F.lit(listing).alias("listing"))
                for payload, listing in ((F.col("payload"), "new"), (voted, "top")))
    # Both from one row, so that the pages are put together once.
    listings = F.when(F.expr("page % 2 = 0"), F.array(new, top)).otherwise(F.array(new))
    landed = listing_pages(spark, sf_dir).select("subreddit", F.col("page").cast("int").alias("page"), F.explode(listings).alias("landed"))
    return landed.select("landed.payload", "subreddit", "landed.listing", "page")


def _voted(page: Column) -> Column:
    """A parsed page whose posts have one vote more."""
    def more(child: Column) -> Column:
        return child.withField("data", child["data"].withField("score", child["data"]["score"] + 1))

    data = page["data"]
    return F.struct(data.withField("children", F.transform(data["children"], more)).alias("data"))


def chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payload, subreddit, listing, asked_after: the pages of a source, each asked for with the token of the one before."""
    after = F.get_json_object("payload", "$.data.after")
    in_order = Window.partitionBy("subreddit").orderBy("page")
    asked = listing_pages(spark, sf_dir).withColumn("asked_after", F.lag(after).over(in_order))
    return asked.select("payload", "subreddit", F.lit("new").alias("listing"), "asked_after")


def page_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of all pages, which are neither posts nor listings."""
    return _read(spark, sf_dir, "pages").select("url")


def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry: the labelled documents."""
    return _read(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))


def repeated_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as repeated sightings of one id."""
    return _read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("id"),
        F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).otherwise(2).alias("source_rank"),
        F.col("turn").alias("listing_rank"), "role", F.col("text").alias("title"))
