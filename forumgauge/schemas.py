"""Explicit schemas of every input and output table."""

from __future__ import annotations

POST = ("id string, title string, selftext string, score bigint, created_utc double, "
        "num_comments bigint, url string, subreddit string")

POST_COLUMNS = tuple(part.split()[0] for part in POST.split(", "))

# One page of the collection API.  The source name is not part of the payload,
# it belongs to the request, so the landing table carries it next to the page.
LISTING_POST = ("id: string, title: string, selftext: string, score: bigint, "
                "created_utc: double, num_comments: bigint, url: string")
LISTING = f"data struct<children: array<struct<data: struct<{LISTING_POST}>>>, after: string>"

REGISTRY = "id string"

AUDIT = ("collection_date string, subreddits array<string>, listings array<string>, "
         "total_posts bigint, collected_at_utc timestamp")

# Published tables, without the `date` partition column.
MARTS = {
    "topic_analysis":
        "topic string, post_count bigint, avg_score double, avg_comments double",
    "sentiment_by_topic":
        "topic string, sentiment string, count bigint",
    "posts_by_industry":
        "industry string, post_count bigint, avg_engagement_score double, avg_comments_count double",
    "salary_stats":
        "industry string, salary_mention_posts bigint, salary_distinct_posts bigint, "
        "avg_engagement_score double, avg_comments double, avg_annual_tc double, "
        "median_salary double, min_salary double, max_salary double",
    "experience_distribution":
        "experience_level string, post_count bigint",
    "skills_summary":
        "skill string, skill_count bigint",
    "temporal_trends":
        "year_month string, sentiment string, post_count bigint, avg_score double, avg_comments double",
    "network_metrics":
        "metric string, value double",
    "company_mentions":
        "company string, mention_count bigint, avg_score double, avg_engagement double",
    "topic_by_industry":
        "industry string, topic string, post_count bigint, avg_score double",
    "skills_by_industry":
        "industry string, skill string, skill_count bigint",
}

# Tables that are written with the published ones for roll-ups; the dashboard does not show them.
SIDE_MARTS = {
    "salary_histogram": "industry string, pay double, mentions bigint",
}


def fields_of(name: str) -> str:
    """The columns of a published or side table, as DDL."""
    return (MARTS | SIDE_MARTS)[name]


def fields(ddl: str) -> dict[str, str]:
    """A flat DDL string as an ordered ``name -> type`` mapping."""
    return dict(part.strip().split(" ", 1) for part in ddl.split(", "))
