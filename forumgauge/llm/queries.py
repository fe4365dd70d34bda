"""The operators as queries over the supplied tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge.llm import (
    alignment, bpe, class_model, classifier, grid_join, line_dedup, main_text, mixing, near_duplicates, quality_rules, repeats,
    resampling, secrets,
)
from forumgauge.llm.sql import LLM_ORACLE
from forumgauge.llm.tables import Work, read

__all__ = ["LLM_ORACLE", "LLM_QUERIES", "tokenizer_path"]

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    held_out = class_model.held_out(F.col("doc_id"))
    model, counts = class_model.train(documents.where(~held_out), Work(spark, "classes"))
    return class_model.score(documents, model, counts).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.units.total).cast("bigint").alias("train_tokens"), "base_score", "score")


def _joined(spans) -> object:
    kinds = F.array(*(F.lit(k) for k in secrets.KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"].cast("int")), s["start"], s["end"])), ",")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.scan(read(spark, sf_dir, "documents"), Work(spark, "secrets"))
    kinds = F.transform("rules", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("bigint").alias(f"n_{kind}")  # noqa: B023
              for kind in secrets.KINDS]
    return spans.select("doc_id", *counts, F.sha2(_joined(F.col("rules")), 256).alias("base_sha256"),
                        _joined(F.concat("rules", "added")).alias("spans"),
                        F.size("added").cast("bigint").alias("n_added"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.plan(read(spark, sf_dir, "documents"), Work(spark, "mixing"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove(read(spark, sf_dir, "documents"), Work(spark, "repeats"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read(spark, sf_dir, "documents"), tokenizer_path())
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.groups(read(spark, sf_dir, "documents"), Work(spark, "near"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_stop_words", "n_lines", "n_loud_lines")


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), Work(spark, "classifier"))
    return judged.select("doc_id", "source", "lang", "posterior_low", "posterior_toxic",
                         (1 - F.greatest("posterior_low", "posterior_toxic")).alias("score"), "kept")


def op9_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.join(read(spark, sf_dir, "embeddings"), Work(spark, "vectors"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = main_text.main_text(read(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), Work(spark, "resampling"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = alignment.align(read(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER),
                             Work(spark, "alignment"))
    return groups.withColumnRenamed("groups", "groups_sha256")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup(read(spark, sf_dir, "documents"), Work(spark, "lines"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


LLM_QUERIES = {
    "op1_class_model": op1_class_model,
    "op2_secrets": op2_secrets,
    "op3_mixing": op3_mixing,
    "op4_repeats": op4_repeats,
    "op5_bpe": op5_bpe,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_quality_rules": op7_quality_rules,
    "op8_classifier": op8_classifier,
    "op9_grid_join": op9_grid_join,
    "op10_main_text": op10_main_text,
    "op11_resampling": op11_resampling,
    "op12_alignment": op12_alignment,
    "op13_line_dedup": op13_line_dedup,
}
