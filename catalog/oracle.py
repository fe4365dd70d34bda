"""The registered queries once more, as plain SQL over the same tables.

Written the direct way, one `contains` per keyword and one row per mention, so
that it shares no method with the Spark jobs it is compared with.
"""

from __future__ import annotations

from catalog import queries as Q
from forumgauge import schemas
from forumgauge.functions.lexicon import DEFAULT_LEXICON
from forumgauge.functions.stopwords import STOP_WORDS
from forumgauge.sources.tables import ITEM_POSTS, MONTH_SECONDS, PAGE_POSTS, PER_PAGE, TITLES

LEX = DEFAULT_LEXICON
SPACE = r"[ \t\n\x0B\f\r]"
NOT_SPACE = r"[^ \t\n\x0B\f\r]"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(lit(v) for v in values)


# --- Common table expressions: name -> (names needed, SQL) -------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql)


def chain(select: str, *names: str) -> str:
    """The select with every table it needs defined before it."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in CTES[name][0]:
            add(need)
        ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + select


titles = " ".join(f"WHEN {i} THEN {lit(t)}" for i, t in enumerate(TITLES))
cte("posts", (), f"""
SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS id, CASE d.doc_id % {len(TITLES)} {titles} END AS title, d.selftext,
  coalesce(e.score, 0) AS score, coalesce(e.comments, 0) AS num_comments,
  CAST(coalesce(e.second, 0) + (d.doc_id % 6) * {MONTH_SECONDS} AS DOUBLE) AS created_utc,
  CASE WHEN d.page_url IS NOT NULL THEN d.page_url WHEN d.doc_id >= {PAGE_POSTS} THEN NULL
    WHEN d.doc_id % 4 = 1 THEN 'https://i.redd.it/' || CAST(d.doc_id AS VARCHAR) || '.png'
    WHEN d.doc_id % 4 = 2 THEN 'https://www.reddit.com/r/' || d.subreddit || '/' || CAST(d.doc_id AS VARCHAR) END AS url,
  d.subreddit
FROM (SELECT doc_id, text AS selftext, source AS subreddit, NULL AS page_url FROM documents
  UNION ALL SELECT page_id + {PAGE_POSTS}, '', 'links', url FROM pages
  UNION ALL SELECT item_id + {ITEM_POSTS}, NULL, 'titles', NULL FROM benchmark) d
LEFT JOIN (SELECT event_id % (SELECT count(*) FROM documents) AS doc_id,
    CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS score,
    CAST(sum(TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT)) AS BIGINT) AS comments,
    min(CAST(floor(epoch(ts)) AS BIGINT)) AS second FROM events GROUP BY 1) e ON e.doc_id = d.doc_id""")

cte("paged", ("posts",), f"""
SELECT *, CAST(row_number() OVER (PARTITION BY subreddit, page ORDER BY doc_id) - 1 AS INTEGER) AS position FROM (
  SELECT *, doc_id % {PAGE_POSTS} // {PER_PAGE} AS page FROM posts)""")

# Each sighting of a post, and of a post's sightings the first run's first one.
cte("sightings", ("paged",), """
SELECT *, 1 AS listing_rank FROM paged
UNION ALL SELECT * REPLACE (score + 1 AS score), 2 FROM paged WHERE page % 2 = 0""")
cte("collected", ("sightings",), f"""
SELECT *, CAST(nth AS BIGINT) AS run, CASE nth WHEN 1 THEN {lit(Q.DATE)} ELSE {lit(Q.NEXT_DATE)} END AS date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY nth, listing_rank) AS met FROM (
    SELECT *, 1 AS nth FROM sightings WHERE page % 3 = 0 UNION ALL SELECT *, 2 FROM sightings))
WHERE met = 1""")

cte("cleaned", ("posts",), rf"""
SELECT *, CASE WHEN selftext IS NULL OR selftext = '' THEN title
    ELSE regexp_replace(title || ' ' || selftext, '{SPACE}+', ' ', 'g') END AS full_text,
  make_timestamp(CAST(created_utc AS BIGINT) * 1000000) AS moment
FROM posts""")

cte("timed", ("cleaned",), """
SELECT *, CAST(year(moment) AS INTEGER) AS year, CAST(month(moment) AS INTEGER) AS month,
  CAST(day(moment) AS INTEGER) AS day, CAST(hour(moment) AS INTEGER) AS hour,
  strftime(moment, '%Y-%m') AS year_month, strftime(moment, '%Y-%m-%d') AS date
FROM cleaned""")

cte("texts", ("timed",), rf"""
SELECT *, lower(regexp_replace(regexp_replace(regexp_replace(full_text, 'http{NOT_SPACE}+', '', 'g'),
  '[^a-zA-Z \t\n\x0B\f\r]', ' ', 'g'), '{SPACE}+', ' ', 'g')) AS cleaned_text, lower(full_text) AS lowered
FROM timed""")

cte("text_posts", ("texts",), "SELECT * FROM texts WHERE length(cleaned_text) > 10")


def contains_any(keywords) -> str:
    return "(" + " OR ".join(f"contains(lowered, {lit(k)})" for k in keywords) + ")"


def labels_sql(kind: str) -> str:
    cases = ", ".join(f"CASE WHEN {contains_any(kws)} THEN {lit(name)} END"
                      for name, kws in LEX.categories(kind).items())
    return f"concat_ws('|', {cases})"


def count_sql(keywords) -> str:
    return "(" + " + ".join(f"CAST(contains(lowered, {lit(k)}) AS INTEGER)" for k in keywords) + ")"


def with_default(sql: str, default: str) -> str:
    return f"CASE WHEN {sql} = '' THEN {lit(default)} ELSE {sql} END"


LABEL_SQL = {
    "industry": ("industries", with_default(labels_sql("industry"), "General/Unspecified")),
    "topic": ("topics", with_default(labels_sql("topic"), "General")),
    "advice": ("advice_categories", labels_sql("advice")),
    "company": ("mentioned_companies", labels_sql("company")),
    "skill": ("mentioned_skills", labels_sql("skill")),
}
for kind, (column, sql) in LABEL_SQL.items():
    cte(f"tag_{kind}", ("text_posts",), f"SELECT id, {sql} AS {column} FROM text_posts")

cte("tag_sentiment", ("text_posts",), f"""
SELECT id, CASE WHEN pos > neg THEN 'Positive' WHEN neg > pos THEN 'Negative' ELSE 'Neutral' END AS sentiment
FROM (SELECT id, {count_sql(LEX.categories("sentiment")["Positive"])} AS pos,
  {count_sql(LEX.categories("sentiment")["Negative"])} AS neg FROM text_posts)""")

levels = " ".join(f"WHEN {contains_any(kws)} THEN {lit(level)}"
                  for level, kws in LEX.categories("experience").items())
cte("tag_experience", ("text_posts",), f"""
SELECT id, CASE {levels} ELSE 'Not Specified' END AS experience_level FROM text_posts""")

# One row per label of a post, with the post's fields.
EXPLODED = {"industry": "industry", "topic": "topic", "advice": "advice_category",
            "company": "company", "skill": "skill"}
for kind, name in EXPLODED.items():
    column = LABEL_SQL[kind][0]
    cte(f"by_{kind}", ("text_posts", f"tag_{kind}"), f"""
SELECT t.id, t.score, t.num_comments, t.year, t.month, t.year_month, t.date, l.{name}
FROM text_posts t JOIN (SELECT id, unnest(string_split({column}, '|')) AS {name} FROM tag_{kind}) l USING (id)
WHERE l.{name} <> ''""")

# Yearly pay is read token by token: a token is a run of letters, digits and . , $ without the
# punctuation at its end, and counts if the whole of it is an amount.
AMOUNT = r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d{1,2})?"
HOURLY = rf"(?i)(?:^|[^\pL\pN_.,])({AMOUNT})\s*(?:/hr|/hour|per hour|an hour|/h\b)"
ANNUAL = r"(?i)\$?(?:\d+(?:\.\d+)?k|\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?)|\$\d{4,}(?:\.\d{1,2})?"
NUMBER = "CAST(replace(replace(rtrim(lower(m), 'hk'), ',', ''), '$', '') AS DOUBLE)"
cte("raw_mentions", ("text_posts",), rf"""
SELECT id, 0 AS kind, unnest(regexp_extract_all(full_text, '{HOURLY}', 1)) || 'h' AS m,
  generate_subscripts(regexp_extract_all(full_text, '{HOURLY}', 1), 1) AS nth FROM text_posts
UNION ALL
SELECT id, 1, x, nth FROM (
  SELECT id, rtrim(unnest(tokens), '.,') AS x, generate_subscripts(tokens, 1) AS nth FROM (
    SELECT id, regexp_extract_all(regexp_replace(full_text, '{HOURLY}', ' ', 'g'), '[\pL\pN_.,$]+') AS tokens
    FROM text_posts))
WHERE regexp_full_match(x, '{ANNUAL}') AND lower(x) NOT IN ('401k', '403b')""")
cte("kept_mentions", ("raw_mentions",), f"""
SELECT id, kind, nth, ltrim(m, '$') AS m FROM raw_mentions
WHERE kind = 0 OR m LIKE '$%' OR lower(m) LIKE '%k' OR {NUMBER} > 1000""")
cte("pays", ("kept_mentions",), f"""
SELECT id, kind, nth, pay, CASE WHEN pay BETWEEN 30000 AND 1000000 THEN pay END AS bounded FROM (
  SELECT *, CASE WHEN lower(m) LIKE '%h' THEN CASE WHEN {NUMBER} > 0 THEN {NUMBER} * 2080 END WHEN lower(m) LIKE '%k' THEN {NUMBER} * 1000
    WHEN {NUMBER} > 1000 THEN {NUMBER} END AS pay FROM kept_mentions)
WHERE pay IS NOT NULL""")
cte("pay_rows", ("by_industry", "pays"), """
SELECT i.id, i.industry, i.date, i.score, i.num_comments, p.pay, p.bounded FROM by_industry i JOIN pays p USING (id)""")

cte("words", ("text_posts",), f"""
SELECT id, title, score, num_comments, moment, word FROM (
  SELECT id, title, score, num_comments, moment,
    unnest(string_split(regexp_replace(cleaned_text, ' +$', ''), ' ')) AS word FROM text_posts)
WHERE word NOT IN ({listed(STOP_WORDS)})""")
cte("vocab", ("words",), """
SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, word) - 1 AS INTEGER) AS index, word AS term,
  count(*) AS frequency FROM words GROUP BY word ORDER BY frequency DESC, word LIMIT 500""")
cte("tf", ("words", "vocab"), """
SELECT w.id, v.index, v.term, count(*) AS tf FROM words w JOIN vocab v ON v.term = w.word GROUP BY ALL""")

# --- Aggregates, optionally per date ------------------------------------------------

COUNT = "count(*) AS post_count"
STATS = "count(*) AS post_count, avg(score) AS avg_score, avg(num_comments) AS avg_comments"


def agg(table: str, keys: list[str], measures: str, by: bool = False) -> str:
    names = ", ".join((["date"] if by else []) + keys)
    return f"SELECT {names}, {measures} FROM {table} GROUP BY {names}"


def label_join(left: str, right: str, columns: str) -> str:
    return f"(SELECT a.*, {columns} FROM {left} a JOIN {right} b USING (id))"


def salary_sql(by: bool) -> str:
    keys = "date, industry" if by else "industry"
    same = " AND ".join(f"o.{k} = s.{k}" for k in keys.split(", "))
    return f"""
SELECT {", ".join(f"s.{k}" for k in keys.split(", "))}, s.salary_mention_posts, s.salary_distinct_posts,
  s.avg_engagement_score, s.avg_comments, s.avg_annual_tc, o.median_salary, s.min_salary, s.max_salary
FROM (SELECT {keys}, count(*) AS salary_mention_posts, count(DISTINCT id) AS salary_distinct_posts,
    avg(score) AS avg_engagement_score, avg(num_comments) AS avg_comments,
    CAST(sum(CAST(bounded AS DECIMAL(12, 2))) AS DOUBLE) / count(bounded) AS avg_annual_tc,
    min(bounded) AS min_salary, max(bounded) AS max_salary FROM pay_rows GROUP BY {keys}) s
LEFT JOIN (SELECT {keys}, bounded AS median_salary FROM (
    SELECT {keys}, bounded, row_number() OVER (PARTITION BY {keys} ORDER BY bounded) AS rn,
      count(*) OVER (PARTITION BY {keys}) AS n FROM pay_rows WHERE bounded IS NOT NULL)
  WHERE rn = n // 2 + 1) o ON {same}"""


def metrics_sql(by: bool) -> str:
    key = "date, " if by else ""
    group = "GROUP BY date" if by else ""
    parts = (("Total Posts", "count(*)"), ("Total Comments", "coalesce(sum(num_comments), 0)"),
             ("Avg Score", "coalesce(avg(score), 0)"), ("Avg Comments", "coalesce(avg(num_comments), 0)"))
    return " UNION ALL ".join(
        f"SELECT {key}{lit(m)} AS metric, CAST({v} AS DOUBLE) AS value FROM timed {group}" for m, v in parts)


def skills_sql(by: bool) -> str:
    counted = agg("by_skill", ["skill"], "count(*) AS skill_count", by)
    if not by:
        return (f"{counted} UNION ALL SELECT 'General Programming', 1 "
                "WHERE NOT EXISTS (SELECT 1 FROM by_skill)")
    return (f"{counted} UNION ALL SELECT DISTINCT date, 'General Programming', 1 FROM text_posts "
            "WHERE date NOT IN (SELECT date FROM by_skill)")


def mart_sql(name: str, by: bool) -> tuple[str, tuple[str, ...]]:
    """One published table and the tables it reads."""
    industry_topic = label_join("by_industry", "by_topic", "b.topic")
    industry_skill = label_join("by_industry", "by_skill", "b.skill")
    topic_sentiment = label_join("by_topic", "tag_sentiment", "b.sentiment")
    post_sentiment = label_join("text_posts", "tag_sentiment", "b.sentiment")
    post_experience = label_join("text_posts", "tag_experience", "b.experience_level")
    return {
        "topic_analysis": (agg("by_topic", ["topic"], STATS, by), ("by_topic",)),
        "sentiment_by_topic": (agg(topic_sentiment, ["topic", "sentiment"], "count(*) AS count", by),
                               ("by_topic", "tag_sentiment")),
        "posts_by_industry": (agg(
            "by_industry", ["industry"], "count(*) AS post_count, avg(score) AS avg_engagement_score, "
            "avg(num_comments) AS avg_comments_count", by), ("by_industry",)),
        "salary_stats": (salary_sql(by), ("pay_rows",)),
        "experience_distribution": (agg(post_experience, ["experience_level"], COUNT, by),
                                    ("text_posts", "tag_experience")),
        "skills_summary": (skills_sql(by), ("by_skill", "text_posts")),
        "temporal_trends": (agg(post_sentiment, ["year_month", "sentiment"], STATS, by),
                            ("text_posts", "tag_sentiment")),
        "network_metrics": (metrics_sql(by), ("timed",)),
        "company_mentions": (agg(
            "by_company", ["company"], "count(*) AS mention_count, avg(score) AS avg_score, "
            "avg(num_comments) AS avg_engagement", by), ("by_company",)),
        "topic_by_industry": (agg(industry_topic, ["industry", "topic"],
                                  "count(*) AS post_count, avg(score) AS avg_score", by),
                              ("by_industry", "by_topic")),
        "skills_by_industry": (agg(industry_skill, ["industry", "skill"], "count(*) AS skill_count", by),
                               ("by_industry", "by_skill")),
    }[name]


for mart in schemas.MARTS:
    for by, prefix in ((False, "whole"), (True, "daily")):
        sql, needs = mart_sql(mart, by)
        cte(f"{prefix}_{mart}", needs, sql)

cte("advice_industry", ("by_industry", "by_advice"), agg(
    label_join("by_industry", "by_advice", "b.advice_category"), ["industry", "advice_category"],
    "count(*) AS post_count, avg(score) AS avg_score"))

# --- Roll-ups over dates -----------------------------------------------------------


def total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT) AS {column}"


def mean(column: str) -> str:
    return f"avg({column}) AS {column}"


def rolled(name: str, keys: str, *measures: str) -> None:
    cte(f"rolled_{name}", (f"daily_{name}",),
        f"SELECT {keys}, {', '.join(measures)} FROM daily_{name} GROUP BY {keys}")


rolled("topic_analysis", "topic", total("post_count"), mean("avg_score"), mean("avg_comments"))
rolled("sentiment_by_topic", "topic, sentiment", total("count"))
rolled("posts_by_industry", "industry", total("post_count"), mean("avg_engagement_score"), mean("avg_comments_count"))
rolled("experience_distribution", "experience_level", total("post_count"))
rolled("skills_summary", "skill", total("skill_count"))
rolled("temporal_trends", "year_month, sentiment", total("post_count"), mean("avg_score"), mean("avg_comments"))
rolled("company_mentions", "company", total("mention_count"), mean("avg_score"), mean("avg_engagement"))
rolled("topic_by_industry", "industry, topic", total("post_count"), mean("avg_score"))
rolled("skills_by_industry", "industry, skill", total("skill_count"))
rolled("salary_stats", "industry", total("salary_mention_posts"), mean("avg_engagement_score"),
       mean("avg_comments"), mean("avg_annual_tc"), "min(min_salary) AS min_salary", "max(max_salary) AS max_salary")
cte("rolled_network_metrics", ("daily_network_metrics",), """
SELECT metric, sum(value) AS value FROM daily_network_metrics
  WHERE metric IN ('Total Posts', 'Total Comments') GROUP BY metric
UNION ALL SELECT metric, avg(value) FROM daily_network_metrics
  WHERE metric IN ('Avg Score', 'Avg Comments') GROUP BY metric""")
cte("dense", ("rolled_temporal_trends",), """
SELECT m.year_month, s.sentiment, coalesce(t.post_count, 0) AS post_count, t.avg_score, t.avg_comments
FROM (SELECT DISTINCT year_month FROM rolled_temporal_trends) m
CROSS JOIN (VALUES ('Positive'), ('Negative'), ('Neutral')) s(sentiment)
LEFT JOIN rolled_temporal_trends t ON t.year_month = m.year_month AND t.sentiment = s.sentiment""")


def rounded(table: str, *columns: str) -> str:
    if not columns:
        return f"SELECT * FROM {table}"
    changed = ", ".join(f'round("{c}", 6) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({changed}) FROM {table}"


def rollup(name: str, *columns: str) -> str:
    return chain(rounded(f"rolled_{name}", *columns), f"rolled_{name}")


def summary(name: str, order: str, n: int = 10) -> str:
    return chain(f"SELECT * FROM whole_{name} ORDER BY {order} LIMIT {n}", f"whole_{name}")


MOMENT = "strftime(moment, '%Y-%m-%d %H:%M:%S')"
POST_FIELDS = ", ".join(schemas.POST_COLUMNS)
PAY = ("avg_engagement_score", "avg_comments", "avg_annual_tc")


def health_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT {lit(m)} AS dataset, (SELECT count(*) FROM daily_{m}) > 0 AS loaded" for m in schemas.MARTS)
    return chain(f"""
SELECT dataset, loaded, n AS datasets_loaded, t AS total_datasets,
  CASE WHEN n = t THEN 'Healthy' WHEN n > 0 THEN 'Degraded' ELSE 'Critical' END AS status
FROM ({parts}) CROSS JOIN (SELECT count(*) FILTER (loaded) AS n, count(*) AS t FROM ({parts}))""",
                 *[f"daily_{m}" for m in schemas.MARTS])


def published_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT {lit(m)} AS dataset, date, count(*) AS row_count FROM daily_{m} GROUP BY date"
        for m in schemas.MARTS)
    return chain(parts, *[f"daily_{m}" for m in schemas.MARTS])


ids = "SELECT CAST(doc_id AS VARCHAR) AS id FROM"
ORACLE: dict[str, str] = {
    # Sources, sinks, ingest
    "read_posts": chain(f"SELECT {POST_FIELDS}, date FROM timed", "timed"),
    "read_posts_of_date": chain(
        f"SELECT {POST_FIELDS}, date FROM timed WHERE date = {lit(Q.DATE)}", "timed"),
    "flatten_listing": chain(
        "SELECT * EXCLUDE (doc_id) REPLACE (coalesce(selftext, '') AS selftext) FROM paged", "paged"),
    "read_posts_array": chain(f"SELECT {POST_FIELDS}, date FROM timed", "timed"),
    "page_chains": chain(
        "SELECT id, subreddit, dense_rank() OVER (PARTITION BY subreddit ORDER BY page) - 1 AS page_number, position FROM paged",
        "paged"),
    "collection_run": chain("SELECT id, title, score, subreddit, date, run FROM collected", "collected"),
    "collection_registry": chain("SELECT id FROM posts", "posts"),
    "collection_run_audit": chain(
        "SELECT date AS collection_date, count(*) AS total_posts, run FROM collected GROUP BY ALL", "collected"),
    "publish_one_date": published_sql(),
    "write_empty_mart": chain("SELECT *, FALSE AS written FROM daily_experience_distribution", "daily_experience_distribution"),
    "load_mart_mixed_columns": chain(
        f"SELECT * REPLACE (CASE WHEN date <> {lit(Q.DATE)} THEN min_salary END AS min_salary) FROM daily_salary_stats",
        "daily_salary_stats"),
    "dedup_new_posts": chain(
        "SELECT id, title, subreddit FROM posts WHERE doc_id NOT IN (SELECT doc_id FROM labels)", "posts"),
    "dedup_first_listing": """
SELECT id, source_rank, listing_rank, role, title FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_rank, listing_rank) AS rn FROM (
    SELECT CAST(conv_id AS VARCHAR) AS id,
      CAST(CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 ELSE 2 END AS INTEGER) AS source_rank,
      turn AS listing_rank, role, text AS title FROM conversations))
WHERE rn = 1""",
    "update_registry": chain(f"{ids} labels UNION SELECT id FROM posts", "posts"),
    "registry_size": chain(f"SELECT count(*) AS tracked_ids FROM ({ids} labels UNION SELECT id FROM posts)", "posts"),
    "collection_audit": chain(f"""
SELECT {lit(Q.DATE)} AS collection_date, {lit("|".join(Q.SOURCES))} AS subreddits,
  {lit("|".join(Q.LISTINGS))} AS listings, count(*) AS total_posts,
  {lit(Q.COLLECTED_AT.strftime("%Y-%m-%d %H:%M:%S"))} AS collected_at_utc FROM posts""", "posts"),
    "write_mart": chain("SELECT * FROM daily_topic_analysis", "daily_topic_analysis"),
    "write_salary_mart": chain("SELECT * FROM daily_salary_stats", "daily_salary_stats"),
    "publish_all": published_sql(),
    "list_dates": chain("SELECT DISTINCT date FROM timed", "timed"),
    "load_mart": chain(
        f"SELECT * FROM daily_sentiment_by_topic WHERE date = {lit(Q.DATE)}", "daily_sentiment_by_topic"),
    "load_mart_all_dates": chain("SELECT * FROM daily_company_mentions", "daily_company_mentions"),
    "empty_salary": chain(
        "SELECT * FROM whole_salary_stats WHERE industry NOT IN (SELECT industry FROM pay_rows)",
        "whole_salary_stats"),
    "skills_default": chain("""
SELECT 'General Programming' AS skill, CAST(1 AS BIGINT) AS skill_count
WHERE NOT EXISTS (SELECT 1 FROM by_skill WHERE id IN (SELECT id FROM tag_skill WHERE mentioned_skills = ''))""",
                            "by_skill"),
    "mart_health": health_sql(),
    # Projections and filters
    "created_datetime": chain(f"SELECT id, {MOMENT} AS created_datetime FROM cleaned", "cleaned"),
    "date_parts": chain("SELECT id, year, month, day, hour FROM timed", "timed"),
    "full_text": chain("SELECT id, full_text FROM cleaned", "cleaned"),
    "text_length": chain("SELECT id, CAST(length(full_text) AS INTEGER) AS text_length FROM cleaned", "cleaned"),
    "engagement_level": chain("""
SELECT id, CASE WHEN num_comments = 0 THEN 'No Engagement' WHEN num_comments <= 2 THEN 'Low Engagement'
  WHEN num_comments <= 10 THEN 'Medium Engagement' ELSE 'High Engagement' END AS engagement_level FROM posts""",
                              "posts"),
    "has_media": chain("""
SELECT id, CASE WHEN contains(url, 'i.redd.it') OR contains(url, 'imgur') THEN 'Image'
  WHEN contains(url, 'reddit.com/r/') THEN 'Text Post' ELSE 'External Link' END AS has_media FROM posts""", "posts"),
    "cleaned_text": chain("SELECT id, cleaned_text FROM texts", "texts"),
    "tokenize": chain("""
SELECT id, array_to_string(string_split(regexp_replace(cleaned_text, ' +$', ''), ' '), '|') AS words
FROM texts""", "texts"),
    "remove_stopwords": chain(f"""
SELECT id, array_to_string([w for w in string_split(regexp_replace(cleaned_text, ' +$', ''), ' ')
  if w NOT IN ({listed(STOP_WORDS)})], '|') AS filtered_words FROM texts""", "texts"),
    "short_post_filter": chain("SELECT id, title FROM text_posts", "text_posts"),
    "year_month": chain("SELECT id, year_month FROM timed", "timed"),
    "explode_words": chain(
        f"SELECT id, title, score, num_comments, {MOMENT} AS created_datetime, word FROM words", "words"),
    "nonempty_label_filter": chain("SELECT * FROM tag_company WHERE mentioned_companies <> ''", "tag_company"),
    # Tagging and extraction
    "tag_industries": chain("SELECT * FROM tag_industry", "tag_industry"),
    "tag_topics": chain("SELECT * FROM tag_topic", "tag_topic"),
    "tag_companies": chain("SELECT * FROM tag_company", "tag_company"),
    "tag_skills": chain("SELECT * FROM tag_skill", "tag_skill"),
    "tag_advice": chain("SELECT * FROM tag_advice", "tag_advice"),
    "sentiment": chain("SELECT * FROM tag_sentiment", "tag_sentiment"),
    "experience_level": chain("SELECT * FROM tag_experience", "tag_experience"),
    "extract_salaries": chain("""
SELECT t.id, coalesce(string_agg(k.m, '|' ORDER BY k.kind, k.nth), '') AS salary_mentions
FROM text_posts t LEFT JOIN kept_mentions k USING (id) GROUP BY t.id""", "text_posts", "kept_mentions"),
    "normalize_salary": chain("SELECT id, pay AS norm_salary FROM pays", "pays"),
    "bounded_salary": chain("SELECT id, bounded AS bounded_salary FROM pays", "pays"),
    "explode_salaries": chain(
        "SELECT id, industry, score, num_comments, pay AS norm_salary FROM pay_rows", "pay_rows"),
    # Aggregations
    "word_freq": chain(
        "SELECT word, count(*) AS frequency FROM words WHERE length(word) > 3 GROUP BY word", "words"),
    "topic_analysis": chain("SELECT * FROM whole_topic_analysis", "whole_topic_analysis"),
    "industry_distribution": chain(agg("by_industry", ["industry"], STATS), "by_industry"),
    "posts_by_industry": chain("SELECT * FROM whole_posts_by_industry", "whole_posts_by_industry"),
    "topic_by_industry": chain("SELECT * FROM whole_topic_by_industry", "whole_topic_by_industry"),
    "engagement_by_topic": chain("""
SELECT topic, avg_score AS avg_upvotes, avg_comments, post_count AS total_posts FROM whole_topic_analysis""",
                                 "whole_topic_analysis"),
    "engagement_by_industry": chain("""
SELECT industry, avg_engagement_score AS avg_upvotes, avg_comments_count AS avg_comments,
  post_count AS total_posts FROM whole_posts_by_industry""", "whole_posts_by_industry"),
    "engagement_by_hour": chain(f"""
SELECT CAST(h.hour AS INTEGER) AS hour, coalesce(post_count, 0) AS post_count,
  coalesce(avg_score, 0) AS avg_score, coalesce(avg_comments, 0) AS avg_comments
FROM range(24) h(hour) LEFT JOIN ({agg("timed", ["hour"], STATS)}) t ON t.hour = h.hour""", "timed"),
    "company_mentions": chain("SELECT * FROM whole_company_mentions", "whole_company_mentions"),
    "advice_share": chain("""
SELECT count(*) FILTER (advice_categories <> '') AS advice_posts, count(*) AS total_posts,
  CASE WHEN count(*) > 0 THEN count(*) FILTER (advice_categories <> '') * 100.0::DOUBLE / count(*)
    ELSE 0 END AS advice_percentage FROM tag_advice""", "tag_advice"),
    "advice_distribution": chain(
        "SELECT advice_category, count(*) AS post_count, avg(score) AS avg_score, "
        "avg(num_comments) AS avg_engagement FROM by_advice GROUP BY advice_category", "by_advice"),
    "advice_by_industry": chain("SELECT * FROM advice_industry", "advice_industry"),
    "advice_timeline": chain(agg("by_advice", ["year_month", "advice_category"], COUNT), "by_advice"),
    "sentiment_dist": chain(
        "SELECT sentiment, count(*) AS count, avg(score) AS avg_score, avg(num_comments) AS avg_comments "
        "FROM text_posts JOIN tag_sentiment USING (id) GROUP BY sentiment", "text_posts", "tag_sentiment"),
    "sentiment_by_industry": chain(
        "SELECT industry, sentiment, count(*) AS count FROM by_industry JOIN tag_sentiment USING (id) "
        "GROUP BY ALL", "by_industry", "tag_sentiment"),
    "sentiment_by_topic": chain("SELECT * FROM whole_sentiment_by_topic", "whole_sentiment_by_topic"),
    "posts_over_time": chain(agg("timed", ["year", "month", "day"], STATS), "timed"),
    "industry_trends": chain(agg("by_industry", ["year", "month", "industry"], COUNT), "by_industry"),
    "temporal_trends": chain("SELECT * FROM whole_temporal_trends", "whole_temporal_trends"),
    "salary_stats": chain(
        "SELECT * EXCLUDE (median_salary, min_salary, max_salary) FROM whole_salary_stats", "whole_salary_stats"),
    "salary_order_stats": chain(
        "SELECT industry, median_salary, min_salary, max_salary FROM whole_salary_stats", "whole_salary_stats"),
    "experience_distribution": chain(
        "SELECT * FROM whole_experience_distribution", "whole_experience_distribution"),
    "skills_summary": chain("SELECT * FROM whole_skills_summary", "whole_skills_summary"),
    "skills_by_industry": chain("SELECT * FROM whole_skills_by_industry", "whole_skills_by_industry"),
    "network_metrics": chain("SELECT * FROM whole_network_metrics", "whole_network_metrics"),
    # Features
    "term_vectors": chain("SELECT id, index, term, tf FROM tf", "tf"),
    "tfidf": chain("""
SELECT t.id, t.index, t.term, round(t.tf * ln((m.m + 1) / (d.df + 1)), 6) AS weight
FROM tf t JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term) d USING (term)
CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS m FROM text_posts) m""", "tf", "text_posts"),
    "vocabulary": chain("SELECT * FROM vocab", "vocab"),
    # Rankings
    "top_advice_per_industry": chain("""
SELECT industry, advice_category, post_count, avg_score FROM (
  SELECT *, row_number() OVER (PARTITION BY industry ORDER BY post_count DESC, advice_category) AS rn
  FROM advice_industry) WHERE rn = 1""", "advice_industry"),
    "top_keywords": chain("""
SELECT word, count(*) AS frequency FROM words WHERE length(word) > 3 GROUP BY word
ORDER BY frequency DESC, word LIMIT 20""", "words"),
    "recent_trends": summary("temporal_trends", "year_month DESC, post_count DESC, sentiment", 12),
    "summary_top10_topic_analysis": summary("topic_analysis", "post_count DESC, topic"),
    "summary_top10_sentiment_by_topic": summary("sentiment_by_topic", "topic, count DESC, sentiment"),
    "summary_top10_posts_by_industry": summary("posts_by_industry", "post_count DESC, industry"),
    "summary_top10_salary_stats": summary("salary_stats", "salary_mention_posts DESC, industry"),
    "summary_top10_experience_distribution": summary("experience_distribution", "post_count DESC, experience_level"),
    "summary_top10_skills_summary": summary("skills_summary", "skill_count DESC, skill", 20),
    "summary_top10_network_metrics": summary("network_metrics", "metric"),
    "top_skills": chain(
        "SELECT * FROM rolled_skills_summary ORDER BY skill_count DESC, skill LIMIT 15", "rolled_skills_summary"),
    "top_skills_in_industry": chain(f"""
SELECT * FROM rolled_skills_by_industry WHERE industry = {lit(Q.CHOSEN_INDUSTRY)}
ORDER BY skill_count DESC, skill LIMIT 15""", "rolled_skills_by_industry"),
    "top_skills_per_industry": chain("""
SELECT industry, skill, skill_count FROM (
  SELECT *, row_number() OVER (PARTITION BY industry ORDER BY skill_count DESC, skill) AS rn
  FROM rolled_skills_by_industry) WHERE rn <= 15""", "rolled_skills_by_industry"),
    "top_companies": chain(rounded(
        "(SELECT * FROM rolled_company_mentions ORDER BY mention_count DESC, company LIMIT 15)",
        "avg_score", "avg_engagement"), "rolled_company_mentions"),
    # Roll-ups and serving
    "rollup_mart": chain("""
SELECT topic, CAST(sum(post_count) AS BIGINT) AS posts, round(avg(avg_score), 6) AS mean_score,
  min(avg_comments) AS lowest, max(avg_comments) AS highest FROM daily_topic_analysis GROUP BY topic""",
                         "daily_topic_analysis"),
    "rollup_topic": rollup("topic_analysis", "avg_score", "avg_comments"),
    "rollup_topic_weighted": chain(rounded("whole_topic_analysis", "avg_score", "avg_comments"),
                                   "whole_topic_analysis"),
    "rollup_sentiment_topic": rollup("sentiment_by_topic"),
    "rollup_industry": rollup("posts_by_industry", "avg_engagement_score", "avg_comments_count"),
    "rollup_experience": rollup("experience_distribution"),
    "rollup_skills": rollup("skills_summary"),
    "rollup_temporal": rollup("temporal_trends", "avg_score", "avg_comments"),
    "densify_temporal": chain(rounded("dense", "avg_score", "avg_comments"), "dense"),
    "rollup_company": rollup("company_mentions", "avg_score", "avg_engagement"),
    "rollup_topic_industry": rollup("topic_by_industry", "avg_score"),
    "rollup_skills_industry": rollup("skills_by_industry"),
    "rollup_salary": rollup("salary_stats", *PAY),
    "rollup_salary_fallback": chain("""
SELECT industry, CAST(sum(salary_mention_posts) AS BIGINT) AS salary_mention_posts,
  round(avg(avg_engagement_score), 6) AS avg_engagement_score, round(avg(avg_comments), 6) AS avg_comments,
  round(avg(median_salary), 6) AS avg_annual_tc, max(max_salary) AS max_salary
FROM daily_salary_stats GROUP BY industry""", "daily_salary_stats"),
    "rollup_metrics": rollup("network_metrics", "value"),
    "rollup_salary_median": chain("""
SELECT industry, bounded AS median_salary, n AS mentions FROM (
  SELECT industry, bounded, row_number() OVER (PARTITION BY industry ORDER BY bounded) AS rn,
    count(*) OVER (PARTITION BY industry) AS n FROM pay_rows WHERE bounded IS NOT NULL)
WHERE rn = n // 2 + 1""", "pay_rows"),
    "stored_rollup_topic": rollup("topic_analysis", "avg_score", "avg_comments"),
    "stored_rollup_topic_weighted": chain(rounded("whole_topic_analysis", "avg_score", "avg_comments"), "whole_topic_analysis"),
    "stored_rollup_salary": rollup("salary_stats", *PAY),
    "stored_rollup_metrics": rollup("network_metrics", "value"),
    "metric_value": chain(
        "SELECT coalesce(max(CAST(trunc(value) AS BIGINT)), 0) AS value FROM rolled_network_metrics "
        "WHERE metric = 'Total Comments'", "rolled_network_metrics"),
    "kpi_salary_posts": chain(
        "SELECT coalesce(CAST(sum(salary_mention_posts) AS BIGINT), 0) AS salary_posts FROM rolled_salary_stats",
        "rolled_salary_stats"),
    "dominant_sentiment": chain("""
SELECT sentiment AS dominant_sentiment FROM (SELECT sentiment, sum(count) AS n,
  CASE sentiment WHEN 'Positive' THEN 0 WHEN 'Negative' THEN 1 ELSE 2 END AS priority
  FROM rolled_sentiment_by_topic GROUP BY sentiment) ORDER BY n DESC, priority LIMIT 1""",
                                "rolled_sentiment_by_topic"),
    "filter_options": chain("SELECT DISTINCT topic FROM by_topic", "by_topic"),
    "filter_options_industries": chain("SELECT DISTINCT industry FROM by_industry", "by_industry"),
    "filter_options_skill_industries": chain(
        "SELECT DISTINCT industry FROM daily_skills_by_industry", "daily_skills_by_industry"),
    "filter_by_topics": chain(
        f"SELECT * FROM rolled_sentiment_by_topic WHERE topic IN ({listed(Q.TOPICS)})", "rolled_sentiment_by_topic"),
    "filter_by_industries": chain(rounded(
        f"(SELECT * FROM rolled_topic_by_industry WHERE industry IN ({listed(Q.INDUSTRIES)}))", "avg_score"),
        "rolled_topic_by_industry"),
    "monthly_avg_score": chain(
        "SELECT year_month, round(avg(avg_score), 6) AS avg_score FROM dense GROUP BY year_month", "dense"),
    "salary_ranges": chain(rounded("""(
SELECT *, CASE WHEN max_salary IS NOT NULL THEN greatest(max_salary - avg_annual_tc, 0) END AS err_plus,
  CASE WHEN min_salary IS NOT NULL THEN greatest(avg_annual_tc - min_salary, 0) END AS err_minus
FROM rolled_salary_stats WHERE avg_annual_tc IS NOT NULL)""", *PAY, "err_plus", "err_minus"), "rolled_salary_stats"),
    "salary_table": chain("""
SELECT industry AS "Industry", salary_mention_posts AS "Posts w/ Salary", round(avg_annual_tc, 6) AS "Average Salary ($)",
  min_salary AS "Min ($)", max_salary AS "Max ($)", round(avg_engagement_score, 6) AS "Avg Score",
  round(avg_comments, 6) AS "Avg Comments" FROM rolled_salary_stats""", "rolled_salary_stats"),
}
ORACLE["presentation_order"] = ORACLE["top_skills"]

AVERAGES = {"topic_analysis": ("avg_score", "avg_comments"), "salary_stats": PAY,
            "posts_by_industry": ("avg_engagement_score", "avg_comments_count"),
            "company_mentions": ("avg_score", "avg_engagement")}


def filtered(mart: str, where: str = "true") -> str:
    return chain(rounded(f"(SELECT * FROM rolled_{mart} WHERE {where})", *AVERAGES[mart]), f"rolled_{mart}")


def word_labels(kind: str, default: str | None) -> str:
    """Labels by whole words, one search per keyword."""
    column = LABEL_SQL[kind][0]

    def found(keyword: str) -> str:
        literal = "".join(c if c.isalnum() or c == " " else "\\" + c for c in keyword)
        return f"regexp_matches(lowered, {lit(rf'(^|[^\pL\pN_]){literal}([^\pL\pN_]|$)')})"

    cases = ", ".join(f"CASE WHEN {' OR '.join(map(found, kws))} THEN {lit(name)} END"
                      for name, kws in LEX.categories(kind).items())
    return chain(f"SELECT id, CASE WHEN l = '' THEN {lit(default or '')} ELSE l END AS {column} "
                 f"FROM (SELECT id, concat_ws('|', {cases}) AS l FROM text_posts)", "text_posts")


ORACLE |= {
    "read_posts_rejects": f"SELECT url AS record, {lit(Q.DATE)} AS date FROM pages",
    "flatten_listing_rejects": "SELECT 'links' AS subreddit, CAST(NULL AS BIGINT) AS page, url AS payload FROM pages",
    "filter_topic_mart": filtered("topic_analysis", f"topic IN ({listed(Q.TOPICS)})"),
    "filter_industry_mart": filtered("posts_by_industry", f"industry IN ({listed(Q.INDUSTRIES)})"),
    "filter_salary_mart": filtered("salary_stats", f"industry IN ({listed(Q.INDUSTRIES)})"),
    "order_industries": filtered("posts_by_industry"),
    "order_companies": filtered("company_mentions"),
    "order_pay": filtered("salary_stats"),
    "order_months": ORACLE["monthly_avg_score"],
    "tag_topics_word": word_labels("topic", "General"),
    "tag_industries_word": word_labels("industry", "General/Unspecified"),
    "tag_topics_table": word_labels("topic", "General"),
    "tag_industries_table": word_labels("industry", "General/Unspecified"),
    "tag_skills_table": word_labels("skill", None),
}
