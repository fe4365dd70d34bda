"""Labels from a lexicon held as a table, whatever its size.

A keyword is found as a whole word where the characters beside it are no letters,
digits or underscores.  So it is found exactly where it equals one of the text's runs
of words, written with what stands between them, or such a run with some of the
signs before or after it (``c++``).  Runs that begin as some keyword does and have the
shape of one are listed inside each row, each once, and joined with the keywords by equality; whether keywords or runs move is decided
by Spark from their sizes.  Only keys, runs and labels leave the row, no text does.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumgauge.functions.labels import DEFAULTS, LABEL_COLUMNS, tree_pattern
from forumgauge.functions.lexicon import DEFAULT_EXPERIENCE, KINDS, NEUTRAL
from forumgauge.operators.once import compute_once

WORD = r"[\p{L}\p{N}_]"
SIGN = r"[^\p{L}\p{N}_]"
# Signs before or after a keyword's outer words that still belong to it, at most.
MOST_SIGNS = 4


# Keywords begin in one of so many ways, at most; up to so many characters tell these apart.
MOST_STARTS, START_LENGTH = 1000, 3


def _place_pattern(words: int, before: int, after: int, starts: list[str] | None) -> str:
    """A place where a keyword may begin, as group 1: its words and signs, and enough behind them to see where they end."""
    start = f"(?={tree_pattern(starts)})" if starts else ""
    ends = rf"(?:{SIGN}{{{after + 1}}}|{SIGN}{{0,{after}}}+{WORD}?)"
    return rf"(?<!{WORD}){start}(?=({SIGN}{{{before}}}{WORD}++(?:{SIGN}++{WORD}++){{0,{words - 1}}}{ends}))"


def _run_pattern(words: int, before: int, after: int) -> str:
    """The run of that many words, with that many signs before and after it, at the beginning of a place.

    Signs at an outer end are no blanks, and no word stands beside them.
    """
    lead = rf"(?!\s){SIGN}{{{before}}}" if before else ""
    tail = rf"{SIGN}{{{after}}}(?<!\s)" if after else ""
    return f"^({lead}{WORD}++(?:{SIGN}++{WORD}++){{{words - 1}}}{tail})(?!{WORD})"


def word_runs(posts: DataFrame, text_col: str, shapes: Iterable[tuple[int, int, int]], starts: list[str] | None = None,
              out: str = "_runs") -> DataFrame:
    """Add the distinct runs of words of the lower-cased text that have one of the shapes: words, signs before and after.

    With ``starts`` only runs that begin with one of them are listed.  A text is searched once, and
    once more for each number of signs before a word.
    """
    lowered = F.lower(F.coalesce(text_col, F.lit("")))
    runs = [F.array().cast("array<string>")]
    for before, alike in groupby(sorted(shapes, key=lambda s: s[1]), key=lambda s: s[1]):
        alike = list(alike)
        pattern = _place_pattern(max(s[0] for s in alike), before, max(s[2] for s in alike), starts)
        places = F.array_distinct(F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1)))
        runs.append(F.flatten(F.transform(places, lambda p: F.array(*(F.regexp_extract(p, _run_pattern(*s), 1) for s in alike)))))  # noqa: B023
    return compute_once(posts, out, F.array_remove(F.array_distinct(F.concat(*runs)), ""))


def keyword_words(keyword: Column) -> Column:
    """How many words a keyword has."""
    return F.size(F.regexp_extract_all(keyword, F.lit(f"{WORD}+"), F.lit(0)))


def keyword_shapes(lexicon: DataFrame) -> list[tuple[int, int, int]]:
    """How many words, signs before and signs after them the keywords have, each combination once.

    Keywords with more than ``MOST_SIGNS`` signs at a side are left out, as no text is searched for
    them; those without a word are an error.
    """
    keyword = F.col("keyword")
    words = keyword_words(keyword)
    checked = F.when(words > 0, words).otherwise(F.raise_error(F.concat(F.lit("keyword without a word: "), "keyword")).cast("int"))
    before, after = (F.length(F.regexp_extract(keyword, p, 0)) for p in (f"^{SIGN}*", f"{SIGN}*$"))
    shapes = lexicon.select(checked.alias("words"), before.alias("before"), after.alias("after")).distinct()
    return sorted(tuple(row) for row in shapes.collect() if max(row["before"], row["after"]) <= MOST_SIGNS)


def keyword_starts(lexicon: DataFrame) -> list[str] | None:
    """The first characters of the keywords, as many as leave ``MOST_STARTS`` ways to begin, None if one is too many."""
    for length in range(START_LENGTH, 0, -1):
        found = lexicon.select(F.substring("keyword", 1, length)).distinct().limit(MOST_STARTS + 1).collect()
        if len(found) <= MOST_STARTS:
            return sorted(row[0] for row in found)
    return None


def found_rows(posts: DataFrame, lexicon: DataFrame, text_col: str = "full_text", key: str = "id") -> DataFrame:
    """key and the row of ``lexicon`` (kind, priority, category, keyword) for each keyword in a text.

    Keywords without a word are an error.  The shapes of the keywords and the ways in which they
    begin, few whatever the number of keywords, go to the driver.
    """
    runs = word_runs(posts.select(key, text_col), text_col, keyword_shapes(lexicon), keyword_starts(lexicon))
    runs = runs.select(key, F.explode("_runs").alias("keyword"))
    return runs.join(lexicon, "keyword").select(key, "kind", "priority", "category", "keyword")


def tag_by_table(posts: DataFrame, lexicon: DataFrame, kinds: Iterable[str] = KINDS, text_col: str = "full_text",
                 key: str = "id") -> DataFrame:
    """key and the label columns of the given kinds, one row per post, as whole-word tagging gives them.

    ``lexicon`` has kind, priority, category and keyword, as :meth:`Lexicon.to_df` makes it.
    """
    kinds = list(kinds)
    found = found_rows(posts, lexicon.filter(F.col("kind").isin(kinds)), text_col, key)
    labels = found.groupBy(key, "kind", "priority", "category").agg(F.count_distinct("keyword").alias("n"))
    per_post = labels.groupBy(key).agg(*(
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("priority", "category", "n")))).alias(f"_{kind}")
        for kind in kinds))
    empty = F.col(text_col).isNull() | (F.col(text_col) == "")
    joined = posts.select(F.col(key), empty.alias("_empty")).join(per_post, key, "left")
    return joined.select(key, *(_label(kind).alias(LABEL_COLUMNS[kind]) for kind in kinds))


def _label(kind: str) -> Column:
    """One kind of label from the categories found, by priority."""
    found = F.coalesce(F.col(f"_{kind}"), F.array().cast("array<struct<priority:int,category:string,n:bigint>>"))
    names = F.transform(found, lambda x: x["category"])
    if kind == "sentiment":
        def count(name: str) -> Column:
            return F.aggregate(F.filter(found, lambda x: x["category"] == name), F.lit(0).cast("bigint"), lambda n, x: n + x["n"])

        difference = count("Positive") - count("Negative")
        return F.when(difference > 0, "Positive").when(difference < 0, "Negative").otherwise(NEUTRAL)
    if kind == "experience":
        return F.coalesce(F.get(names, F.lit(0)), F.lit(DEFAULT_EXPERIENCE))
    if kind in DEFAULTS:
        labelled = F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(DEFAULTS[kind])))
        return F.when(F.col("_empty"), F.array().cast("array<string>")).otherwise(labelled) if kind == "industry" else labelled
    return names
