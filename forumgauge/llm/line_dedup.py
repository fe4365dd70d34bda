"""Line de-duplication across documents, in built-in expressions only.

A text is split at line feeds.  The key of a line is the line without blanks at
both ends, with A-Z in lower case; keys of ``least_chars`` code points and more are
exploded, hashed to 128 bits and counted by document.  Where ``least_documents`` and
more hold a key, its lines go from every document but the one with the largest key
column; the others' lines stay and are joined again in their order.

The hashes of a document's lines meet the repeated ones in two ways.  A key that
has at least a thousandth of all counted lines is one of a thousand at most, and
these are broadcast; the rest is joined by hash, where no key has more than that.
A document then gets one array of the places of its lost lines, and what lies
between these places is cut out in runs, so that a text of many lines takes linear
work.

Cases: a null text is an empty one, which is one empty line; a text that ends with
a line feed ends with an empty line; rows are documents, so one row repeated three
times holds its lines three times, but rows with the largest key column keep them
all; null keys count as smaller than any other and as equal to each other; short
lines, empty ones too, never go; an empty table gives no rows; columns other than
the key and the text are not looked at, whatever their names.  Texts are split
whole.  Two keys with the same 128-bit hash would count as one.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumgauge.llm.tables import Work

BLANKS = " \t\n\x0b\x0c\r"
LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
# Keys with at least this part of all counted lines are broadcast: as many at most.
COMMON = 1000


def _lower(text: Column) -> Column:
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_keys(text: Column) -> Column:
    """The key of each line of a text."""
    return F.transform(F.split(_lower(text), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))


def _hashes(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g")]


def _rows(documents: DataFrame, text: str, key: str) -> DataFrame:
    """doc, text and its hash: rows with the same three have the same lines."""
    return documents.select(F.col(key).alias("doc"), F.coalesce(text, F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text"))


def repeated(rows: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """h, g, n, keeper: hashes of keys that enough documents hold, and the largest document key."""
    own = F.filter(F.array_distinct(line_keys(F.col("text"))), lambda line: F.length(line) >= least_chars)
    return (rows.select("doc", F.explode(own).alias("line")).select("doc", *_hashes("line"))
            .groupBy("h", "g").agg(F.count("*").alias("n"), F.max("doc").alias("keeper"))
            .where(F.col("n") >= least_documents))


def lost_places(rows: DataFrame, work: Work, least_chars: int = LEAST_CHARS,
                least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """doc, mark, places: where the lines that go are, from 0, ascending; documents that lose none are left out."""
    keys = work.keep(repeated(rows, least_chars, least_documents), "repeated")
    keys = keys.select(F.col("h").alias("rh"), F.col("g").alias("rg"), "n", F.struct("keeper").alias("kept"))
    # Each key adds its n to this sum, so at most COMMON keys are common.
    lines_held = keys.agg(F.sum("n")).first()[0] or 0
    is_common = F.col("n") * COMMON >= F.lit(lines_held)
    common, rest = keys.where(is_common).drop("n"), keys.where(~is_common).drop("n")
    lines = (rows.select("doc", "mark", F.posexplode(line_keys(F.col("text"))).alias("place", "line"))
             .where(F.length("line") >= least_chars).select("doc", "mark", "place", *_hashes("line")))

    def add(table: DataFrame, some: DataFrame, name: str) -> DataFrame:
        some = some.withColumnRenamed("kept", name)
        return table.join(some, (F.col("h") == F.col("rh")) & (F.col("g") == F.col("rg")), "left").drop("rh", "rg")

    marked = add(lines, F.broadcast(common), "common")
    # Lines of common keys are dealt out evenly: without g they meet no key.
    met = F.col("common").isNotNull()
    marked = marked.withColumns({"h": F.when(met, F.xxhash64("mark", "place")).otherwise(F.col("h")),
                                 "g": F.when(~met, F.col("g"))})
    found = F.coalesce("common", "kept")
    lost = add(marked, rest, "kept").where(found.isNotNull() & ~F.col("doc").eqNullSafe(found["keeper"]))
    return lost.groupBy("doc", "mark").agg(F.sort_array(F.collect_set("place")).alias("places"))


def dedup(documents: DataFrame, work: Work, text: str = "text", key: str = "doc_id", least_chars: int = LEAST_CHARS,
          least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """key, n_lines, n_dropped, kept (the text left): one row per row."""
    rows = _rows(documents, text, key)
    lost = lost_places(rows, work, least_chars, least_documents).withColumnsRenamed({"doc": "of", "mark": "of_mark"})
    zero = F.array().cast("array<int>")
    joined = rows.join(lost, rows["doc"].eqNullSafe(lost["of"]) & (rows["mark"] == lost["of_mark"]), "left").select(
        "doc", "text", F.coalesce("places", zero).alias("places"))
    # One-row generators: the lines and the cuts are worked out once, however often they are used.
    split = joined.select("doc", "text", "places", F.explode(F.array(F.split("text", "\n"))).alias("lines"))
    cuts = split.select(
        "doc", "text", "places", "lines",
        F.explode(F.array(F.arrays_zip(
            F.concat(F.array(F.lit(0)), F.transform("places", lambda p: p + 1)).alias("start"),
            F.concat("places", F.array(F.size("lines"))).alias("end")))).alias("runs"))
    kept = F.array_join(F.flatten(F.transform(
        "runs", lambda r: F.slice("lines", r["start"] + 1, r["end"] - r["start"]))), "\n")
    return cuts.select(
        F.col("doc").alias(key), F.size("lines").cast("bigint").alias("n_lines"),
        F.size("places").cast("bigint").alias("n_dropped"),
        F.when(F.size("places") == 0, F.col("text")).otherwise(kept).alias("kept"))
