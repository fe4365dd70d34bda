"""Keyword labels as native column expressions.

Testing every keyword with its own ``contains`` reads the text once per keyword,
several hundred times for the whole lexicon.  More than a few keywords go into one
prefix-tree pattern instead, tried at each position, so that the text is read once
whatever the number of labels.  The labels are then worked out on the short array of
keywords found.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from math import ceil, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumgauge.functions.lexicon import (
    DEFAULT_EXPERIENCE, DEFAULT_INDUSTRY, DEFAULT_LEXICON, DEFAULT_TOPIC, NEUTRAL, Lexicon)

# Output column of each kind of label.
LABEL_COLUMNS = {
    "industry": "industries",
    "topic": "topics",
    "advice": "advice_categories",
    "company": "mentioned_companies",
    "skill": "mentioned_skills",
    "sentiment": "sentiment",
    "experience": "experience_level",
}

# Label of a text in which no keyword of the kind was found.
DEFAULTS = {"industry": DEFAULT_INDUSTRY, "topic": DEFAULT_TOPIC}

# Up to this many branches are simply tried one after the other.
LINEAR_BRANCHES = 8

# Up to this many keywords are looked for one by one: each costs about a sixtieth of the pattern's search.
FEW_KEYWORDS = 32

MATCH_MODES = ("substring", "word")

_WORD_CHAR = r"[\p{L}\p{N}_]"
_NO_STRINGS = "array<string>"
_SEPARATOR = "\x1f"


def _quote(char: str) -> str:
    return char if char.isalnum() or char in " _" else "\\" + char


def _one_of(chars: Iterable[str]) -> str:
    """A test that the next character is one of these, taking nothing."""
    return f"(?=[{''.join(map(_quote, chars))}])"


def tree_pattern(words: Iterable[str]) -> str:
    """A pattern matching the longest of the words that starts at a position.

    Most positions match nothing, so what counts is how few tests it takes to
    find that out.  Where many branches meet they are tested in groups by first
    character, and a branch is entered only if its second character can follow.
    """
    by_first: dict[str, list[str]] = {}
    ends_here = False
    for word in words:
        if word:
            by_first.setdefault(word[0], []).append(word[1:])
        else:
            ends_here = True
    firsts = sorted(by_first)
    branches = []
    for char in firsts:
        seconds = sorted({rest[:1] for rest in by_first[char]})
        peek = _one_of(seconds) if len(seconds) > 2 and "" not in seconds else ""
        branches.append(_quote(char) + peek + tree_pattern(by_first[char]))
    if not branches:
        return ""
    if len(branches) == 1 and not ends_here:
        return branches[0]
    if len(branches) > LINEAR_BRANCHES:
        size = ceil(sqrt(len(branches)))
        branches = [f"{_one_of(firsts[i:i + size])}(?:{'|'.join(branches[i:i + size])})"
                    for i in range(0, len(branches), size)]
    return f"(?:{'|'.join(branches)})" + ("?" if ends_here else "")


def _strings(values: Iterable[str]) -> Column:
    """A constant array, as one literal to split instead of one per value."""
    return F.split(F.lit(_SEPARATOR.join(values)), _SEPARATOR)


def _implied(keywords: list[str], match: str) -> dict[str, list[str]]:
    """For each keyword, the shorter keywords found wherever it is found first.

    The pattern reports the longest keyword at a position.  Its prefixes start
    at the same position, so they are present too; for whole-word matching only
    if the prefix ends at a word boundary inside the longer keyword.
    """
    known = set(keywords)
    implied = {}
    for kw in keywords:
        shorter = [kw[:n] for n in range(1, len(kw)) if kw[:n] in known
                   and (match == "substring" or not re.match(r"\w", kw[n]))]
        if shorter:
            implied[kw] = shorter
    return implied


def found_keywords(lowered: Column, keywords: Iterable[str], match: str = "substring") -> Column:
    """Distinct keywords in a lower-cased text, at least the longest at each position.

    ``match="substring"`` finds a keyword anywhere, also inside other words;
    ``match="word"`` only where it is not part of a longer word.  This is the
    only step that reads the text; keep its result in a column of its own and
    complete it with :func:`with_implied`.
    """
    if match not in MATCH_MODES:
        raise ValueError(f"unknown match mode {match!r}")
    ordered = sorted(set(keywords))
    if match == "substring" and len(ordered) <= FEW_KEYWORDS:
        there = F.array_compact(F.array(*(F.when(lowered.contains(kw), F.lit(kw)) for kw in ordered)))
        return there.cast(_NO_STRINGS)
    hits = F.array_distinct(F.regexp_extract_all(lowered, F.lit(_pattern(ordered, match)), F.lit(1)))
    return F.coalesce(hits, F.array().cast(_NO_STRINGS))


def _pattern(keywords: list[str], match: str) -> str:
    tree = tree_pattern(keywords)
    if match == "word":
        return f"(?<!{_WORD_CHAR})(?=({tree})(?!{_WORD_CHAR}))"
    return f"(?=({tree}))"


def with_implied(found: Column, keywords: Iterable[str], match: str = "substring") -> Column:
    """All keywords present, given at least the longest ones at each position."""
    implied = _implied(sorted(set(keywords)), match)
    if not implied:
        return found
    shorter = F.create_map(*[part for kw, words in implied.items()
                             for part in (F.lit(kw), _strings(words))])
    extra = F.flatten(F.transform(
        found, lambda kw: F.coalesce(F.try_element_at(shorter, kw), F.array().cast(_NO_STRINGS))))
    return F.array_union(found, extra)


def _sql_strings(values: Iterable[str]) -> str:
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return ", ".join(f"'{v}'" for v in quoted)


def _any_of(hits: str, keywords: Iterable[str]) -> Column:
    """Whether one of the keywords was found.

    Goes over the few keywords found and looks each up in a prepared set, which
    costs nothing for the many that were not found.
    """
    return F.expr(f"exists({hits}, k -> k IN ({_sql_strings(keywords)}))")


def _number_of(hits: str, keywords: Iterable[str]) -> Column:
    return F.expr(f"size(filter({hits}, k -> k IN ({_sql_strings(keywords)})))")


def _by_category(hits: str, categories: dict[str, tuple[str, ...]], default: str | None) -> Column:
    """Names of the categories with a keyword present, else the default."""
    names = [F.when(_any_of(hits, kws), F.lit(name)) for name, kws in categories.items()]
    if default is not None:
        every = [kw for kws in categories.values() for kw in kws]
        names.append(F.when(~_any_of(hits, every), F.lit(default)))
    return F.array_compact(F.array(*names))


def _by_keyword(hits: str, categories: dict[str, tuple[str, ...]]) -> Column:
    """The same for categories of one keyword each, where one pass will do."""
    keywords = [kws[0] for kws in categories.values()]
    found = F.array_intersect(_strings(keywords), F.col(hits))
    if keywords == list(categories):
        return found
    return F.transform(found, lambda kw: F.element_at(
        _strings(categories), F.array_position(_strings(keywords), kw).cast("int")))


def label_column(kind: str, hits: str, text: Column, lexicon: Lexicon = DEFAULT_LEXICON) -> Column:
    """One kind of label from the column of keywords found in a text.

    Multi-label kinds list their categories in lexicon order.
    """
    categories = lexicon.categories(kind)
    if kind == "sentiment":
        positive, negative = (_number_of(hits, categories[p]) for p in ("Positive", "Negative"))
        return (F.when(positive > negative, "Positive")
                .when(negative > positive, "Negative").otherwise(NEUTRAL))
    if kind == "experience":
        return F.coalesce(*[F.when(_any_of(hits, kws), F.lit(level))
                            for level, kws in categories.items()], F.lit(DEFAULT_EXPERIENCE))
    default = DEFAULTS.get(kind)
    if default is None and all(len(kws) == 1 for kws in categories.values()):
        return _by_keyword(hits, categories)
    labels = _by_category(hits, categories, default)
    if kind == "industry":
        no_text = text.isNull() | (text == "")
        return F.when(no_text, F.array().cast(_NO_STRINGS)).otherwise(labels)
    return labels
