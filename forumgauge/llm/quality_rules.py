"""Document quality rules: one table of thresholds compiled into Spark expressions.

Words are runs of characters other than the space and 0x09-0x0D.  The measures of a
text are worked out by built-in functions only; the arrays that several of them
share pass through one-row generators, so that none is worked out twice.  A rule
bounds a ratio of two measures; the verdict is the conjunction of all rules, in one
projection.

Cases: null and empty texts have no words, fail the word minimum and are not kept;
repeated rows are judged each; a ratio with a zero denominator counts as zero; a
null key stays null; other columns are not looked at.  Texts are measured whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by this are or an "
    "de la le et les des en un une du que est pour dans qui "
    "der die und das ist von zu den mit nicht ein eine sich auf "
    "el los las y por con una para es se del al"
).split()


@dataclass(frozen=True)
class Rule:
    """A bound on ``measure / per``; ``per`` None bounds the measure itself."""

    name: str
    measure: str
    per: str | None = None
    least: float | None = None
    most: float | None = None


BASE_RULES = (
    Rule("too_few_words", "n_words", least=50),
    Rule("repeated_windows", "n_repeat_words", "n_words", most=0.5),
)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2, most=20),
    Rule("symbol_ratio", "n_symbols", "n_words", most=0.2),
    Rule("stop_word_ratio", "n_stop_words", "n_words", least=0.02),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("loud_lines", "n_loud_lines", "n_lines", most=0.5),
)


def _one(table: DataFrame, **columns: Column) -> DataFrame:
    """Add columns worked out once per row, however often they are used."""
    made = F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))
    return table.select("*", made)


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _stop_codes() -> list[Column]:
    forms = dict.fromkeys(f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper()))
    return [F.xxhash64(F.lit(f)) for f in forms]


def measures(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key and the measures that the rules use, one row per row.

    Windows are found by sorting longs that hold a hash's upper bits over the
    window's place.  Neighbours with equal upper bits are then compared by the
    whole 64-bit hash.
    """
    zero = F.lit(0).cast("bigint")
    table = documents.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    table = _one(table, words=F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""),
                 lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    table = _one(
        table, n_words=F.size("words").cast("bigint"), codes=F.transform("words", lambda w: F.xxhash64(w)),
        n_lines=F.size("lines").cast("bigint"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        n_loud_lines=F.size(F.filter("lines", lambda x: x.contains("!!"))).cast("bigint"))

    def window(i: Column) -> Column:
        return F.xxhash64(F.get("codes", i), F.get("codes", i + 1), F.get("codes", i + 2))

    # mask: the bits that a place takes
    table = _one(table, mask=F.expr("shiftleft(1L, length(bin(n_words))) - 1"))
    table = _one(table, packed=F.when(F.col("n_words") >= 3, F.sort_array(F.transform(
        F.sequence(zero, F.col("n_words") - 3),
        lambda i: window(i.cast("int")).bitwiseAND(F.bitwise_not("mask")).bitwiseOR(i))))
        .otherwise(F.array().cast("array<bigint>")))
    def beside(array: str, place: Column, same) -> Column:
        return same(F.get(array, place - 1)) | same(F.get(array, place + 1))

    table = _one(table, near=F.transform(
        F.filter("packed", lambda x, j: beside("packed", j, lambda y: x.bitwiseXOR(y).between(F.lit(0), F.col("mask")))),
        lambda x: x.bitwiseAND(F.col("mask"))))
    table = _one(table, windows=F.sort_array(F.transform(
        "near", lambda i: F.struct(window(i.cast("int")).alias("h"), i.alias("i")))))
    table = _one(table, places=F.sort_array(F.transform(
        F.filter("windows", lambda w, j: beside("windows", j, lambda v: v["h"] == w["h"])), lambda w: w["i"])))
    fewer = F.greatest(F.size("places") - 1, F.lit(0))
    steps = F.zip_with(F.slice("places", 2, fewer), F.slice("places", 1, fewer), lambda b, a: F.least(b - a, F.lit(3)))
    covered = F.when(F.size("places") > 0, F.aggregate(steps, F.lit(3).cast("bigint"), lambda s, x: s + x))
    return table.select(
        F.col("key").alias(key), "n_words",
        F.length(F.translate("text", SPACE, "")).cast("bigint").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("bigint").alias("n_symbols"),
        "n_dup_lines", F.coalesce(covered, zero).alias("n_repeat_words"),
        F.size(F.filter("codes", lambda c: c.isin(_stop_codes()))).cast("bigint").alias("n_stop_words"),
        "n_lines", "n_loud_lines")


def broken(rule: Rule) -> Column:
    """Whether a row breaks a rule, compared without division."""
    value = F.col(rule.measure).cast("double")
    scale = F.col(rule.per).cast("double") if rule.per else F.lit(1.0)
    parts = ([value < scale * rule.least] if rule.least is not None else []) + (
        [value > scale * rule.most] if rule.most is not None else [])
    return parts[0] if len(parts) == 1 else parts[0] | parts[1]


def any_broken(rules: tuple[Rule, ...]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | broken(rule)
    return out


def judge(documents: DataFrame, text: str = "text", key: str = "doc_id",
          base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, base_failed, the names of the broken rules, and kept."""
    return measures(documents, text, key).select(
        "*", any_broken(base).alias("base_failed"),
        F.array_compact(F.array(*(F.when(broken(r), r.name) for r in base + rules))).alias("broken"),
        (~any_broken(base + rules)).alias("kept"))
