"""Text, time and small categorical expressions over a post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumgauge.functions.stopwords import STOP_WORDS

MIN_CLEANED_LENGTH = 10
MIN_WORD_LENGTH = 3

# --- Fixed values: class names and what decides them --------------------------
# The least and the most comments of each class, in the order in which they are tried, and the class of the rest.
ENGAGEMENT_RANGES = ((0, 0, "No Engagement"), (None, 2, "Low Engagement"), (None, 10, "Medium Engagement"))
ENGAGEMENT_ABOVE = "High Engagement"
# Parts of an address, in the order in which they are looked for.
MEDIA_PARTS = (("i.redd.it", "Image"), ("imgur", "Image"), ("reddit.com/r/", "Text Post"))
MEDIA_OTHER = "External Link"
# --- End of fixed values --------------------------------------------------------


def created_datetime(created_utc: str = "created_utc") -> Column:
    """Epoch seconds to a timestamp; any fraction of a second is cut off."""
    return F.timestamp_seconds(F.col(created_utc).cast("long"))


def joined_text(title: str = "title", body: str = "selftext") -> Column:
    """Title, space and body; the title alone when there is no body."""
    t, b = F.col(title), F.col(body)
    return F.when(b.isNull() | (b == ""), t).otherwise(F.concat(t, F.lit(" "), b))


def full_text(title: str = "title", body: str = "selftext") -> Column:
    """Title and body with single spaces; a title alone stays as it is."""
    t, b = F.col(title), F.col(body)
    return (F.when(b.isNull() | (b == ""), t)
            .otherwise(F.regexp_replace(F.concat(t, F.lit(" "), b), r"\s+", " ")))


def cleaned_text(text: Column) -> Column:
    """Lower-case letters separated by single spaces, URLs removed, not trimmed.

    A run of non-letters becomes one space in a single pass, which is the same
    as blanking every non-letter and then collapsing the whitespace.
    """
    no_urls = F.regexp_replace(text, r"http\S+", "")
    return F.lower(F.regexp_replace(no_urls, r"[^a-zA-Z]+", " "))


def is_long_enough(text: Column, min_length: int = MIN_CLEANED_LENGTH) -> Column:
    """Whether the cleaned text has more than ``min_length`` characters.

    Letters in front of the first URL all survive cleaning, so having more than
    ``min_length`` of them settles the question without cleaning the text.  Only
    posts that this test cannot settle are cleaned in full, so the answer is
    always the one the cleaned text gives.
    """
    surely = text.rlike(rf"^(?:[^a-zA-Z]*+(?!http)[a-zA-Z]){{{min_length + 1}}}")
    return F.when(surely, F.lit(True)).otherwise(F.length(cleaned_text(text)) > min_length)


def tokens(cleaned: Column) -> Column:
    """The words of a cleaned text, which are separated by single spaces.

    A leading space gives an empty first token, a trailing one gives nothing.
    A text of one space has no tokens, the empty text has one empty token.
    """
    words = F.split(F.rtrim(cleaned), " ")
    return F.when(cleaned == " ", F.array().cast("array<string>")).otherwise(words)


def without_stop_words(words: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Drop stop words; order and repeated words are kept."""
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def _first_label(choices: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first condition that holds."""
    return F.coalesce(*(F.when(condition, label) for condition, label in choices), F.lit(otherwise))


def engagement_level(num_comments: str = "num_comments") -> Column:
    n = F.col(num_comments)
    return _first_label([((n <= most) if least is None else n.between(least, most), label)
                         for least, most, label in ENGAGEMENT_RANGES], ENGAGEMENT_ABOVE)


def has_media(url: str = "url") -> Column:
    u = F.col(url)
    return _first_label([(u.contains(part), label) for part, label in MEDIA_PARTS], MEDIA_OTHER)


def year_month(moment: str = "created_datetime") -> Column:
    return F.date_format(F.col(moment), "yyyy-MM")
