"""Every operator as a query over the supplied tables.

Array columns are joined to strings and timestamps formatted, so that results
compare by value.  Averages of averages depend on the order of addition in the
last bit and are rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge import schemas
from forumgauge.functions.labels import LABEL_COLUMNS
from forumgauge.functions.salary import bounded_pay
from forumgauge.functions.lexicon import DEFAULT_LEXICON
from forumgauge.operators import enrich, features, ingest, marts, ranking, rollups, salary, serving, table_tagging
from forumgauge.plans import pipeline, stored_rollups
from forumgauge.plans.collection import Collection, run_collection
from forumgauge.sources import marts as mart_files
from forumgauge.sources import raw, tables
from forumgauge.sources.paths import stored, work_folder
from forumgauge.sources.registry import Registry

Query = Callable[[SparkSession, str], DataFrame]

DATE, NEXT_DATE = "2024-01-01", "2024-01-02"
SOURCES = tuple(f"src{i}" for i in range(20))
LISTINGS = ("new", "top")
COLLECTED_AT = datetime(2024, 6, 30, 12, 0, 0)
TOPICS = ("Interview Prep", "Compensation", "General")
INDUSTRIES = ("FAANG/Big Tech", "FinTech/Finance", "General/Unspecified")
CHOSEN_INDUSTRY = "FAANG/Big Tech"
MOMENT = "yyyy-MM-dd HH:mm:ss"

# Which labels each published table needs.
MART_KINDS = {
    "topic_analysis": ("topic",),
    "sentiment_by_topic": ("topic", "sentiment"),
    "posts_by_industry": ("industry",),
    "salary_stats": ("industry",),
    "experience_distribution": ("experience",),
    "skills_summary": ("skill",),
    "temporal_trends": ("sentiment",),
    "company_mentions": ("company",),
    "topic_by_industry": ("industry", "topic"),
    "skills_by_industry": ("industry", "skill"),
}


# --- Inputs ---------------------------------------------------------------------

def _cleaned(s: SparkSession, d: str) -> DataFrame:
    """All cleaned posts with measures and time keys, without text."""
    return enrich.add_measures_time(tables.add_measures(tables.post_ids(s, d), d))


def _labelled(s: SparkSession, d: str, kinds: Iterable[str] = (), salaries: bool = False) -> DataFrame:
    """Text posts with labels; the text is gone before measures are joined."""
    return pipeline.text_labels(tables.post_texts(s, d), kinds, salaries)


def _tagged(s: SparkSession, d: str, kinds: Iterable[str] = (), salaries: bool = False) -> DataFrame:
    return enrich.add_measures_time(tables.add_measures(_labelled(s, d, kinds, salaries), d))


def _dated(posts: DataFrame) -> DataFrame:
    return posts.withColumn("date", F.date_format("created_datetime", "yyyy-MM-dd"))


def _daily(s: SparkSession, d: str, name: str) -> DataFrame:
    """One published table for every date."""
    if name in pipeline.WHOLE_MARTS:
        return pipeline.WHOLE_MARTS[name](_dated(_cleaned(s, d)), ["date"])
    tagged = _tagged(s, d, MART_KINDS[name], salaries=name == "salary_stats")
    return pipeline.TEXT_MARTS[name](_dated(tagged), ["date"])


def _rolled(s: SparkSession, d: str, name: str) -> DataFrame:
    return rollups.ROLLUPS[name](_daily(s, d, name))


def _dated_raw(s: SparkSession, d: str) -> DataFrame:
    posts = tables.posts(s, d)
    return posts.withColumn("date", F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd"))


def _words(s: SparkSession, d: str) -> DataFrame:
    posts = enrich.prepare_words(tables.post_texts(s, d))
    return posts.select("doc_id", "id", "title", "filtered_words")


# --- Outputs --------------------------------------------------------------------

def _joined(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({c: F.array_join(c, "|") for c in columns})


def _rounded(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({c: F.round(c, 6) for c in columns})


def _formatted(table: DataFrame, column: str) -> DataFrame:
    return table.withColumn(column, F.date_format(column, MOMENT))


# --- Sources, sinks, ingest --------------------------------------------------------

def read_posts(s, d):
    path = work_folder(s, "raw")
    raw.write_posts(_dated_raw(s, d), path)
    return raw.read_posts(s, path)


def read_posts_of_date(s, d):
    path = work_folder(s, "raw")
    raw.write_posts(_dated_raw(s, d), path)
    return raw.read_posts(s, path, date=DATE)


def flatten_listing(s, d):
    """Every page has the posts of one source whose numbers share all but the last digit."""
    return ingest.flatten_listing(raw.parse_listings(tables.listing_pages(s, d)))


def read_posts_rejects(s, d):
    """Page addresses among the posts of a date are no posts."""
    path = work_folder(s, "raw")
    raw.write_posts(_dated_raw(s, d), path)
    lines = tables.page_addresses(s, d).select(F.col("url").alias("value"), F.lit(DATE).alias("date"))
    lines.write.mode("append").partitionBy("date").text(path)
    return raw.read_rejects(s, path)


def flatten_listing_rejects(s, d):
    addresses = tables.page_addresses(s, d).select(
        F.lit("links").alias("subreddit"), F.lit(None).cast("bigint").alias("page"), F.col("url").alias("payload"))
    pages = tables.listing_pages(s, d).unionByName(addresses)
    return ingest.rejected_pages(raw.parse_listings(pages, keep=True))


def dedup_new_posts(s, d):
    new = ingest.dedup_new_posts(tables.post_texts(s, d), tables.known_ids(s, d))
    return new.select("id", "title", "subreddit")


def read_posts_array(s, d):
    """Files of one JSON array each."""
    path = work_folder(s, "raw")
    raw.write_posts(_dated_raw(s, d), path, layout="array")
    return raw.read_posts(s, path, layout="array")


def dedup_first_listing(s, d):
    return ingest.dedup_first_listing(tables.repeated_posts(s, d), {"source_rank": 10, "listing_rank": 32})


def _collected(s, d) -> Collection:
    """Two runs over the landed pages: first those whose number 3 divides, then all of them, a day later."""
    folder = work_folder(s, "collection")
    conf = Collection(*(f"{folder}/{name}" for name in ("raw", "registry", "audit")), sources=SOURCES, listings=LISTINGS)
    pages = stored(tables.landed_pages(s, d), "pages")
    for run, (day, fetched) in enumerate(((DATE, pages.filter("page % 3 = 0")), (NEXT_DATE, pages)), 1):
        run_collection(fetched.withColumn("fetched_at", F.lit(f"{day} 08:00:00").cast("timestamp")), conf, run)
    return conf


def collection_run(s, d):
    return raw.read_runs(s, _collected(s, d).raw_path).select("id", "title", "score", "subreddit", "date", "run")


def page_chains(s, d):
    """Posts in the order in which following each page's token meets them."""
    pages = raw.parse_listings(stored(tables.chained_pages(s, d), "pages")).withColumn("after", F.col("data.after"))
    posts = ingest.flatten_listing(ingest.number_pages(pages))
    return posts.select("id", "subreddit", F.col("page").alias("page_number"), "position")


def collection_registry(s, d):
    return Registry(s, _collected(s, d).registry_path).read()


def collection_run_audit(s, d):
    audit = s.read.parquet(_collected(s, d).audit_path)
    return audit.select("collection_date", "total_posts", F.col("run").cast("bigint").alias("run"))


def update_registry(s, d):
    return ingest.update_registry(tables.known_ids(s, d), tables.post_ids(s, d))


def registry_size(s, d):
    return ingest.registry_size(update_registry(s, d))


def collection_audit(s, d):
    posts = tables.post_ids(s, d).withColumn("date", F.lit(DATE))
    audit = ingest.collection_audit(posts, SOURCES, LISTINGS, COLLECTED_AT)
    return _formatted(_joined(audit, "subreddits", "listings"), "collected_at_utc")


def _written(s, d, *names, fmt="csv"):
    path = work_folder(s, "marts")
    for name in names:
        mart_files.write_mart(_daily(s, d, name), name, path, fmt=fmt)
    return path


def write_mart(s, d):
    return mart_files.load_mart_all_dates(s, "topic_analysis", _written(s, d, "topic_analysis"))


def write_salary_mart(s, d):
    return mart_files.load_mart_all_dates(s, "salary_stats", _written(s, d, "salary_stats"))


def _published(s, d):
    path = work_folder(s, "marts")
    measures = tables.add_measures(tables.post_ids(s, d), d).withColumn(
        "date", F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd"))
    outcome = pipeline.publish_all(tables.post_texts(s, d), path, measures=measures.drop("doc_id"))
    failed = {n: r for n, r in outcome.items() if isinstance(r, Exception)}
    if failed:
        raise RuntimeError(f"tables not published: {failed}")
    return path


def publish_all(s, d):
    return pipeline.published_rows(s, _published(s, d))


def mart_health(s, d):
    path = _published(s, d)
    return pipeline.mart_health({name: mart_files.load_mart_all_dates(s, name, path) for name in schemas.MARTS})


def publish_one_date(s, d):
    """The posts of one day published by themselves, after all other days."""
    path = work_folder(s, "marts")
    posts = stored(_dated_raw(s, d), "posts")
    pipeline.publish_all(posts.filter(F.col("date") != DATE), path)
    pipeline.publish_all(posts.filter(F.col("date") == DATE).drop("date"), path, date=DATE)
    return pipeline.published_rows(s, path)


def write_empty_mart(s, d):
    """An empty table is not written and leaves what is there; ``written`` is what the writer answers."""
    path = _written(s, d, "experience_distribution")
    written = mart_files.write_mart(_daily(s, d, "experience_distribution").limit(0), "experience_distribution", path)
    return mart_files.load_mart_all_dates(s, "experience_distribution", path).withColumn("written", F.lit(written))


def load_mart_mixed_columns(s, d):
    """One date lacks a column and has the others in another order."""
    path = work_folder(s, "marts")
    daily = stored(_daily(s, d, "salary_stats"), "daily")
    mart_files.write_mart(daily.filter(F.col("date") != DATE), "salary_stats", path)
    older = daily.filter(F.col("date") == DATE).select(*[c for c in reversed(daily.columns) if c != "min_salary"])
    mart_files.write_mart(older, "salary_stats", path)
    return mart_files.load_mart_all_dates(s, "salary_stats", path)


def list_dates(s, d):
    return mart_files.list_dates(s, _written(s, d, "network_metrics", "experience_distribution"))


def load_mart(s, d):
    return mart_files.load_mart(s, "sentiment_by_topic", DATE, _written(s, d, "sentiment_by_topic"))


def load_mart_all_dates(s, d):
    path = _written(s, d, "company_mentions", fmt="parquet")
    return mart_files.load_mart_all_dates(s, "company_mentions", path, fmt="parquet")


def empty_salary(s, d):
    """The salary table of the posts that mention no pay."""
    silent = _tagged(s, d, ["industry"], True).filter(F.size("salary_mentions") == 0)
    return salary.salary_table(silent)


def skills_default(s, d):
    """The skill table of the posts that mention no skill."""
    return marts.skills_summary(_tagged(s, d, ["skill"]).filter(F.size("mentioned_skills") == 0))


# --- Projections and filters ---------------------------------------------------------

def _full(s, d):
    return enrich.add_full_text(tables.post_texts(s, d))


def created_datetime(s, d):
    return _formatted(_cleaned(s, d).select("id", "created_datetime"), "created_datetime")


def date_parts(s, d):
    return _cleaned(s, d).select("id", "year", "month", "day", "hour")


def full_text(s, d):
    return _full(s, d).select("id", "full_text")


def text_length(s, d):
    return enrich.add_text_length(_full(s, d)).select("id", "text_length")


def engagement_level(s, d):
    return enrich.add_engagement_level(_cleaned(s, d)).select("id", "engagement_level")


def has_media(s, d):
    urls = tables.add_urls(tables.post_texts(s, d).select("doc_id", "id", "subreddit"), d)
    return enrich.add_has_media(urls).select("id", "has_media")


def cleaned_text(s, d):
    return enrich.add_cleaned_text(_full(s, d)).select("id", "cleaned_text")


def tokenize(s, d):
    return _joined(enrich.add_words(enrich.add_cleaned_text(_full(s, d))).select("id", "words"), "words")


def remove_stopwords(s, d):
    words = enrich.add_filtered_words(enrich.add_words(enrich.add_cleaned_text(_full(s, d))))
    return _joined(words.select("id", "filtered_words"), "filtered_words")


def short_post_filter(s, d):
    return enrich.keep_text_posts(tables.post_texts(s, d)).select("id", "title")


def year_month(s, d):
    return _cleaned(s, d).select("id", "year_month")


def explode_words(s, d):
    posts = enrich.add_measures_time(tables.add_measures(_words(s, d), d))
    return _formatted(enrich.explode_words(posts), "created_datetime")


def nonempty_label_filter(s, d):
    posts = _labelled(s, d, ["company"]).select("id", "mentioned_companies")
    return _joined(enrich.keep_labelled(posts, "mentioned_companies"), "mentioned_companies")


# --- Tagging --------------------------------------------------------------------------

def _tag_query(kind: str) -> Query:
    column = LABEL_COLUMNS[kind]

    def query(s, d):
        found = _labelled(s, d, [kind]).select("id", column)
        return found if kind in ("sentiment", "experience") else _joined(found, column)
    return query


def extract_salaries(s, d):
    return _joined(_labelled(s, d, salaries=True).select("id", "salary_mentions"), "salary_mentions")


def normalize_salary(s, d):
    return _labelled(s, d, salaries=True).select("id", F.explode_outer("salaries").alias("norm_salary")).filter(
        F.col("norm_salary").isNotNull())


def bounded_salary(s, d):
    return normalize_salary(s, d).select("id", bounded_pay(F.col("norm_salary")).alias("bounded_salary"))


def explode_salaries(s, d):
    from forumgauge.operators.tagging import explode_salaries as explode
    return explode(_tagged(s, d, ["industry"], True))


# --- Aggregations -------------------------------------------------------------------

def _mart(function, *kinds: str, salaries: bool = False) -> Query:
    return lambda s, d: function(_tagged(s, d, kinds, salaries))


def _whole(function) -> Query:
    return lambda s, d: function(_cleaned(s, d))


def word_freq(s, d):
    return marts.word_freq(_words(s, d))


# --- Features -------------------------------------------------------------------------

def term_vectors(s, d):
    return features.term_counts(_words(s, d))


def tfidf(s, d):
    return _rounded(features.tfidf_weights(_words(s, d)), "weight")


def vocabulary(s, d):
    return features.vocabulary(_words(s, d))


# --- Rankings --------------------------------------------------------------------------

def _summary(name: str) -> Query:
    def query(s, d):
        if name in pipeline.WHOLE_MARTS:
            table = pipeline.WHOLE_MARTS[name](_cleaned(s, d))
        else:
            tagged = _tagged(s, d, MART_KINDS[name], salaries=name == "salary_stats")
            table = pipeline.TEXT_MARTS[name](tagged)
        return ranking.summary(name, table)
    return query


def top_advice_per_industry(s, d):
    return ranking.top_advice_per_industry(marts.advice_by_industry(_tagged(s, d, ["advice", "industry"])))


def top_keywords(s, d):
    return ranking.top_keywords(word_freq(s, d))


def recent_trends(s, d):
    return ranking.recent_trends(marts.temporal_trends(_tagged(s, d, ["sentiment"])))


def top_skills(s, d):
    return ranking.top_skills(_rolled(s, d, "skills_summary"))


def top_skills_in_industry(s, d):
    return ranking.top_skills_in_industry(_rolled(s, d, "skills_by_industry"), CHOSEN_INDUSTRY)


def top_skills_per_industry(s, d):
    return ranking.top_skills_per_industry(_rolled(s, d, "skills_by_industry"))


def top_companies(s, d):
    return _rounded(ranking.top_companies(_rolled(s, d, "company_mentions")), "avg_score", "avg_engagement")


def presentation_order(s, d):
    return ranking.presentation_order(top_skills(s, d), "skill_count", "skill")


# --- Roll-ups and serving ------------------------------------------------------------

def _rollup(name: str, *rounded: str) -> Query:
    return lambda s, d: _rounded(_rolled(s, d, name), *rounded) if rounded else _rolled(s, d, name)


def _stored_rollup(name: str, *rounded: str, avg_mode: str = rollups.MEAN_OF_MEANS) -> Query:
    """The roll-up from its stored state, made of all dates but one and then brought up to date by that one."""
    def query(s, d):
        path = work_folder(s, "marts")
        daily = stored(_daily(s, d, name), "daily")
        mart_files.write_mart(daily.filter(F.col("date") != DATE), name, path)
        stored_rollups.update(s, path, name)
        mart_files.write_mart(daily.filter(F.col("date") == DATE), name, path)
        return _rounded(stored_rollups.stored_rollup(s, path, name, avg_mode=avg_mode), *rounded)
    return query


def rollup_salary_median(s, d):
    """The exact median over all dates, merged from the published pay histograms of the dates."""
    path = work_folder(s, "marts")
    histogram = salary.histogram(_dated(_tagged(s, d, ["industry"], True)), ["date"])
    mart_files.write_mart(histogram, "salary_histogram", path, fmt="parquet")
    return rollups.rollup_salary_median(mart_files.load_mart_all_dates(s, "salary_histogram", path, fmt="parquet"))


def rollup_topic_weighted(s, d):
    return _rounded(rollups.rollup_topic(_daily(s, d, "topic_analysis"), rollups.WEIGHTED),
                    "avg_score", "avg_comments")


def rollup_mart(s, d):
    """The generic roll-up with every kind of aggregate."""
    table = rollups.rollup_mart(_daily(s, d, "topic_analysis"), ["topic"], {
        "posts": ("post_count", "sum"), "mean_score": ("avg_score", "mean"),
        "lowest": ("avg_comments", "min"), "highest": ("avg_comments", "max")})
    return _rounded(table, "mean_score")


def rollup_salary_fallback(s, d):
    """Average pay from the medians, for tables that have no average."""
    table = _daily(s, d, "salary_stats").drop("avg_annual_tc", "min_salary")
    return _rounded(rollups.rollup_salary(table), "avg_engagement_score", "avg_comments", "avg_annual_tc")


def densify_temporal(s, d):
    return _rounded(rollups.densify_temporal(_rolled(s, d, "temporal_trends")), "avg_score", "avg_comments")


def metric_value(s, d):
    return serving.metric_value(_rolled(s, d, "network_metrics"), "Total Comments")


def kpi_salary_posts(s, d):
    return serving.kpi_salary_posts(_rolled(s, d, "salary_stats"))


def dominant_sentiment(s, d):
    return serving.dominant_sentiment(_rolled(s, d, "sentiment_by_topic"))


def filter_options(s, d):
    return serving.filter_options(_rolled(s, d, "topic_analysis"), "topic")


def filter_options_industries(s, d):
    return serving.filter_options(_rolled(s, d, "posts_by_industry"), "industry")


def filter_options_skill_industries(s, d):
    return serving.filter_options(_rolled(s, d, "skills_by_industry"), "industry")


def filter_by_topics(s, d):
    return serving.filter_by_topics(_rolled(s, d, "sentiment_by_topic"), TOPICS)


def filter_topic_mart(s, d):
    return _rounded(serving.filter_by_topics(_rolled(s, d, "topic_analysis"), TOPICS), "avg_score", "avg_comments")


def filter_industry_mart(s, d):
    kept = serving.filter_by_industries(_rolled(s, d, "posts_by_industry"), INDUSTRIES)
    return _rounded(kept, "avg_engagement_score", "avg_comments_count")


def filter_salary_mart(s, d):
    kept = serving.filter_by_industries(_rolled(s, d, "salary_stats"), INDUSTRIES)
    return _rounded(kept, "avg_engagement_score", "avg_comments", "avg_annual_tc")


def order_industries(s, d):
    rolled = _rounded(_rolled(s, d, "posts_by_industry"), "avg_engagement_score", "avg_comments_count")
    return ranking.presentation_order(rolled, "post_count", "industry")


def order_companies(s, d):
    rolled = _rounded(_rolled(s, d, "company_mentions"), "avg_score", "avg_engagement")
    return ranking.presentation_order(rolled, "mention_count", "company")


def order_pay(s, d):
    rolled = _rounded(_rolled(s, d, "salary_stats"), "avg_engagement_score", "avg_comments", "avg_annual_tc")
    return ranking.presentation_order(rolled, "avg_annual_tc", "industry")


def order_months(s, d):
    return ranking.by_columns(monthly_avg_score(s, d), ["year_month"])


def tag_topics_word(s, d):
    labels = pipeline.text_labels(tables.post_texts(s, d), ["topic"], match="word")
    return _joined(labels.select("id", "topics"), "topics")


def _table_query(kind: str) -> Query:
    """Whole-word labels from the lexicon as a table."""
    column = LABEL_COLUMNS[kind]

    def query(s, d):
        posts = enrich.keep_text_posts(enrich.add_full_text(tables.post_texts(s, d)))
        found = table_tagging.tag_by_table(posts, DEFAULT_LEXICON.to_df(s), [kind])
        return _joined(found, column)
    return query


def tag_industries_word(s, d):
    labels = pipeline.text_labels(tables.post_texts(s, d), ["industry"], match="word")
    return _joined(labels.select("id", "industries"), "industries")


def filter_by_industries(s, d):
    rolled = serving.filter_by_industries(_rolled(s, d, "topic_by_industry"), INDUSTRIES)
    return _rounded(rolled, "avg_score")


def monthly_avg_score(s, d):
    dense = rollups.densify_temporal(_rolled(s, d, "temporal_trends"))
    return _rounded(serving.monthly_avg_score(dense), "avg_score")


PAY = ("avg_engagement_score", "avg_comments", "avg_annual_tc")


def salary_ranges(s, d):
    return _rounded(serving.salary_ranges(_rolled(s, d, "salary_stats")), *PAY, "err_plus", "err_minus")


def salary_table(s, d):
    shown = serving.salary_display(_rolled(s, d, "salary_stats"))
    return _rounded(shown, "Average Salary ($)", "Avg Score", "Avg Comments")


QUERIES: dict[str, Query] = {
    # Sources, sinks, ingest
    "read_posts": read_posts,
    "read_posts_of_date": read_posts_of_date,
    "read_posts_array": read_posts_array,
    "page_chains": page_chains,
    "collection_run": collection_run,
    "collection_registry": collection_registry,
    "collection_run_audit": collection_run_audit,
    "flatten_listing": flatten_listing,
    "read_posts_rejects": read_posts_rejects,
    "flatten_listing_rejects": flatten_listing_rejects,
    "dedup_new_posts": dedup_new_posts,
    "dedup_first_listing": dedup_first_listing,
    "update_registry": update_registry,
    "registry_size": registry_size,
    "collection_audit": collection_audit,
    "write_mart": write_mart,
    "write_salary_mart": write_salary_mart,
    "publish_all": publish_all,
    "publish_one_date": publish_one_date,
    "write_empty_mart": write_empty_mart,
    "load_mart_mixed_columns": load_mart_mixed_columns,
    "list_dates": list_dates,
    "load_mart": load_mart,
    "load_mart_all_dates": load_mart_all_dates,
    "empty_salary": empty_salary,
    "skills_default": skills_default,
    "mart_health": mart_health,
    # Projections and filters
    "created_datetime": created_datetime,
    "date_parts": date_parts,
    "full_text": full_text,
    "text_length": text_length,
    "engagement_level": engagement_level,
    "has_media": has_media,
    "cleaned_text": cleaned_text,
    "tokenize": tokenize,
    "remove_stopwords": remove_stopwords,
    "short_post_filter": short_post_filter,
    "year_month": year_month,
    "explode_words": explode_words,
    "nonempty_label_filter": nonempty_label_filter,
    # Tagging and extraction
    "tag_industries": _tag_query("industry"),
    "tag_topics": _tag_query("topic"),
    "tag_companies": _tag_query("company"),
    "tag_skills": _tag_query("skill"),
    "tag_advice": _tag_query("advice"),
    "sentiment": _tag_query("sentiment"),
    "experience_level": _tag_query("experience"),
    "extract_salaries": extract_salaries,
    "normalize_salary": normalize_salary,
    "bounded_salary": bounded_salary,
    "explode_salaries": explode_salaries,
    # Aggregations
    "word_freq": word_freq,
    "topic_analysis": _mart(marts.topic_analysis, "topic"),
    "industry_distribution": _mart(marts.industry_distribution, "industry"),
    "posts_by_industry": _mart(marts.posts_by_industry, "industry"),
    "topic_by_industry": _mart(marts.topic_by_industry, "topic", "industry"),
    "engagement_by_topic": _mart(marts.engagement_by_topic, "topic"),
    "engagement_by_industry": _mart(marts.engagement_by_industry, "industry"),
    "engagement_by_hour": _whole(marts.engagement_by_hour),
    "company_mentions": _mart(marts.company_mentions, "company"),
    "advice_share": _mart(marts.advice_share, "advice"),
    "advice_distribution": _mart(marts.advice_distribution, "advice"),
    "advice_by_industry": _mart(marts.advice_by_industry, "advice", "industry"),
    "advice_timeline": _mart(marts.advice_timeline, "advice"),
    "sentiment_dist": _mart(marts.sentiment_dist, "sentiment"),
    "sentiment_by_industry": _mart(marts.sentiment_by_industry, "sentiment", "industry"),
    "sentiment_by_topic": _mart(marts.sentiment_by_topic, "sentiment", "topic"),
    "posts_over_time": _whole(marts.posts_over_time),
    "industry_trends": _mart(marts.industry_trends, "industry"),
    "temporal_trends": _mart(marts.temporal_trends, "sentiment"),
    "salary_stats": _mart(salary.salary_stats, "industry", salaries=True),
    "salary_order_stats": _mart(salary.salary_order_stats, "industry", salaries=True),
    "experience_distribution": _mart(marts.experience_distribution, "experience"),
    "skills_summary": _mart(marts.skills_summary, "skill"),
    "skills_by_industry": _mart(marts.skills_by_industry, "skill", "industry"),
    "network_metrics": _whole(marts.network_metrics),
    # Features
    "term_vectors": term_vectors,
    "tfidf": tfidf,
    "vocabulary": vocabulary,
    # Rankings
    "top_advice_per_industry": top_advice_per_industry,
    "top_keywords": top_keywords,
    "recent_trends": recent_trends,
    **{f"summary_top10_{name}": _summary(name) for name in ranking.SUMMARY},
    "top_skills": top_skills,
    "top_skills_in_industry": top_skills_in_industry,
    "top_skills_per_industry": top_skills_per_industry,
    "top_companies": top_companies,
    "presentation_order": presentation_order,
    # Roll-ups and serving
    "rollup_mart": rollup_mart,
    "rollup_topic": _rollup("topic_analysis", "avg_score", "avg_comments"),
    "rollup_topic_weighted": rollup_topic_weighted,
    "rollup_sentiment_topic": _rollup("sentiment_by_topic"),
    "rollup_industry": _rollup("posts_by_industry", "avg_engagement_score", "avg_comments_count"),
    "rollup_experience": _rollup("experience_distribution"),
    "rollup_skills": _rollup("skills_summary"),
    "rollup_temporal": _rollup("temporal_trends", "avg_score", "avg_comments"),
    "densify_temporal": densify_temporal,
    "rollup_company": _rollup("company_mentions", "avg_score", "avg_engagement"),
    "rollup_topic_industry": _rollup("topic_by_industry", "avg_score"),
    "rollup_skills_industry": _rollup("skills_by_industry"),
    "rollup_salary": _rollup("salary_stats", *PAY),
    "rollup_salary_fallback": rollup_salary_fallback,
    "rollup_salary_median": rollup_salary_median,
    "stored_rollup_topic": _stored_rollup("topic_analysis", "avg_score", "avg_comments"),
    "stored_rollup_topic_weighted": _stored_rollup("topic_analysis", "avg_score", "avg_comments", avg_mode=rollups.WEIGHTED),
    "stored_rollup_salary": _stored_rollup("salary_stats", *PAY),
    "stored_rollup_metrics": _stored_rollup("network_metrics", "value"),
    "rollup_metrics": _rollup("network_metrics", "value"),
    "metric_value": metric_value,
    "kpi_salary_posts": kpi_salary_posts,
    "dominant_sentiment": dominant_sentiment,
    "filter_options": filter_options,
    "filter_options_industries": filter_options_industries,
    "filter_options_skill_industries": filter_options_skill_industries,
    "filter_by_topics": filter_by_topics,
    "filter_by_industries": filter_by_industries,
    "filter_topic_mart": filter_topic_mart,
    "filter_industry_mart": filter_industry_mart,
    "filter_salary_mart": filter_salary_mart,
    "order_industries": order_industries,
    "order_companies": order_companies,
    "order_pay": order_pay,
    "order_months": order_months,
    "tag_topics_word": tag_topics_word,
    "tag_topics_table": _table_query("topic"),
    "tag_industries_table": _table_query("industry"),
    "tag_skills_table": _table_query("skill"),
    "tag_industries_word": tag_industries_word,
    "monthly_avg_score": monthly_avg_score,
    "salary_ranges": salary_ranges,
    "salary_table": salary_table,
}
