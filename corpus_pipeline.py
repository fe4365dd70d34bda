"""The corpus pipeline over ``documents``: its stages, each reading what the one before it kept.

1. quality: documents that the classifier rejects, as low in quality or toxic, go.
2. near_duplicates: of each group of near-duplicates, by sets of five words, the document with the smallest id stays.
3. secrets: every secret found is replaced by a placeholder; no document goes.
4. mixing: sources are mixed to their targets; a document has a row for each time that the
   mix takes it, the last one cut to the words taken.
5. encode: the token ids of every text of the mix.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge.llm import bpe, classifier, mixing, near_duplicates, secrets
from forumgauge.llm.queries import tokenizer_path
from forumgauge.llm.tables import Work, read

# Words of a shingle in the near_duplicates stage; op6's query has its own, the operator's default.
SHINGLE = 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps."""
    return classifier.filtered(docs, read(spark, sf_dir, "labels"), Work(spark, "pipeline-quality"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows that repeat it whole count as one."""
    found = near_duplicates.groups(docs, Work(spark, "pipeline-near"), size=SHINGLE)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced."""
    formats = secrets.learn(Work(spark, "pipeline-secrets").keep(secrets.found(docs), "found"))
    return secrets.redact(docs, formats=formats)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.mix(docs, Work(spark, "pipeline-mixing"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left."""
    return bpe.encode(docs, tokenizer_path()).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near),
    ("secrets", scan),
    ("mixing", mix),
    ("encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written as Parquet and read by the next."""
    work = Work(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = work.keep(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
