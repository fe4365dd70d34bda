"""Term counts, vocabulary and tf-idf weights of tokenised posts."""

from __future__ import annotations

from pyspark.ml.feature import IDF, CountVectorizerModel, IDFModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumgauge.sources.paths import stored

VOCABULARY_SIZE = 500


def vocabulary(posts: DataFrame, size: int = VOCABULARY_SIZE, words: str = "filtered_words") -> DataFrame:
    """The most frequent terms with their rank; ties in term order.

    Columns ``index`` (0 is the most frequent), ``term``, ``frequency``.
    """
    terms = posts.select(F.explode_outer(words).alias("term")).filter(F.col("term").isNotNull())
    return _ranked(terms.groupBy("term").agg(F.count(F.lit(1)).alias("frequency")), size)


def _ranked(counts: DataFrame, size: int) -> DataFrame:
    largest = counts.orderBy(F.desc("frequency"), "term").limit(size)
    # Only `size` rows reach the ranking.
    ranked = Window.partitionBy(F.lit(0)).orderBy(F.desc("frequency"), "term")
    return largest.select((F.row_number().over(ranked) - 1).alias("index"), "term", "frequency")


def fit_count_model(posts: DataFrame, size: int = VOCABULARY_SIZE,
                    words: str = "filtered_words") -> CountVectorizerModel:
    """Spark ML's count vectorizer over :func:`vocabulary`.

    The driver receives the ``size`` terms and nothing else.
    """
    terms = [row.term for row in vocabulary(posts, size, words).orderBy("index").select("term").collect()]
    return CountVectorizerModel.from_vocabulary(
        terms or [""], inputCol=words, outputCol="raw_features")


def term_vectors(posts: DataFrame, size: int = VOCABULARY_SIZE) -> tuple[DataFrame, CountVectorizerModel]:
    """Posts with sparse term counts in ``raw_features``, and the model.

    Counting happens inside each row; nothing is shuffled.
    """
    model = fit_count_model(posts, size)
    return model.transform(posts), model


def tfidf_vectors(counted: DataFrame) -> tuple[DataFrame, IDFModel]:
    """Term counts weighted by ln((m + 1) / (df + 1)) in ``features``."""
    model = IDF(inputCol="raw_features", outputCol="features").fit(counted)
    return model.transform(counted), model


def entries(vectors: DataFrame, column: str, value: str, key: str = "id") -> DataFrame:
    """The stored entries of a sparse vector column: key, index, value."""
    raw = F.unwrap_udt(column)
    pairs = F.arrays_zip(raw["indices"].alias("index"), raw["values"].alias(value))
    return vectors.select(key, F.inline(pairs)).toDF(key, "index", value)


def term_bags(posts: DataFrame, words: str = "filtered_words", key: str = "id") -> DataFrame:
    """key, terms, counts: the distinct terms of each post in order, and how often each occurs.

    Worked out inside each row, from the sorted words and the places where they change;
    nothing is shuffled.
    """
    sorted_words = F.sort_array(F.coalesce(F.col(words), F.array().cast("array<string>")))
    held = posts.select(key, F.explode(F.array(sorted_words)).alias("_w"))
    begins = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)))
    begins = F.when(F.size("_w") > 0, begins).otherwise(F.array().cast("array<int>"))
    held = held.select(key, "_w", F.explode(F.array(begins)).alias("_b"))
    ends = F.concat(F.slice("_b", 2, F.greatest(F.size("_b") - 1, F.lit(0))), F.array(F.size("_w")))
    return held.select(
        key, F.transform("_b", lambda i: F.get("_w", i)).alias("terms"),
        F.zip_with("_b", F.when(F.size("_b") > 0, ends).otherwise(F.array().cast("array<int>")),
                   lambda begin, end: (end - begin).cast("bigint")).alias("counts"))


def _bag_entries(bags: DataFrame, key: str = "id") -> DataFrame:
    return bags.select(key, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf"))))


def bag_vocabulary(bags: DataFrame, size: int = VOCABULARY_SIZE, key: str = "id") -> DataFrame:
    """:func:`vocabulary` of posts whose bags are at hand."""
    return _ranked(_bag_entries(bags, key).groupBy("term").agg(F.sum("tf").alias("frequency")), size)


def _vocabulary_entries(bags: DataFrame, size: int) -> DataFrame:
    """id, index, term, tf of the vocabulary's terms; the side that is broadcast has ``size`` rows."""
    known = F.broadcast(bag_vocabulary(bags, size).select("term", "index"))
    return _bag_entries(bags).join(known, "term").select("id", "index", "term", "tf")


def term_counts(posts: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """id, index, term, tf for every vocabulary term of a post.

    Which terms count is known only when all texts have been read.  So each text is
    tokenised once, into a stored bag, and vocabulary and counts come from the bags.
    """
    return _vocabulary_entries(stored(term_bags(posts), "term-bags"), size)


def tfidf_weights(posts: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """id, index, term, weight: tf * ln((m + 1) / (df + 1)) over the m posts; texts are tokenised once, as above."""
    bags = stored(term_bags(posts), "term-bags")
    entries = _vocabulary_entries(bags, size)
    m = bags.count()  # from the files' footers
    # One row per vocabulary term.
    held = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.col("tf") * F.log(F.lit(m + 1.0) / (F.col("df") + 1))
    return entries.join(F.broadcast(held), "term").select("id", "index", "term", weight.alias("weight"))
