"""Importance resampling towards a target distribution by hashed n-grams.

A 256-byte table lower-cases A-Z and turns every separator into a space in the
UTF-8 bytes; ``bytes.split`` then gives the words.  The crc32 of a run of words is
the crc32 of the space and the last word, seeded with the crc32 of the run before
it, so each longer feature costs one call.  Counters add up the buckets of a task,
a grouped sum those of all tasks.  The gain of a bucket is the logarithm of its
smoothed share in the target texts over that in the documents; a document's weight
is the sum of its features' gains, and Gumbel noise drawn from the hash of its key
turns the weights into a sample without replacement.

Ranks come from one range exchange of keys and scores: each range is numbered in
itself, and the sizes of the ranges, one row per partition, are added up.

Cases: null and empty texts have no words, no features and weight 0, and are never
drawn, as they have fewer than ``least_words`` words; a null key draws the noise of
an empty key and ranks after other keys of its score; each repeated row counts, is
weighed and may be drawn by itself, with ranks that follow each other; empty tables
on either side give counts of 0; texts are taken whole, in blocks; columns other
than the key and the text are not looked at, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.tables import Work, map_batches

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42

# Digits, a-z and all bytes above 0x7F stand for themselves, A-Z for a-z, the rest for a space.
TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
BLOCK_BYTES = 1 << 20


def blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    text = text.translate(TABLE)
    first = 0
    while len(text) - first > BLOCK_BYTES:
        last = text.find(b" ", first + BLOCK_BYTES)
        if last < 0:
            break
        yield text[first:last].split()
        first = last
    yield text[first:].split()


def features(text: bytes, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray]]:
    """The number of words of each block of a text and the crc32 of the runs that end in it."""
    seeds: list[list[int]] = [[] for _ in range(longest - 1)]  # of each length, the run that ends the block before
    for block in blocks(text):
        if not block:
            continue
        spaced = [b" " + word for word in block]
        runs = [list(map(crc32, block))]
        for n in range(1, longest):
            # The run that a word extends ends in the word before it.
            before = seeds[n - 1] + runs[-1][:-1] if seeds[n - 1] else runs[-1][:-1]
            runs.append(list(map(crc32, spaced[len(spaced) - len(before):], before)))
        seeds = [run[-1:] or seed for run, seed in zip(runs, seeds)]
        yield len(block), np.fromiter(chain.from_iterable(runs), np.uint32, sum(map(len, runs)))


def _rows(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    for first, last, data, offsets in words.chunks(column):
        yield first, last, [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]


def bucket_counts(table: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """bucket, n: how often the features of all texts fall in each bucket; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for _, _, texts in _rows(batch.column(0)):
                chunk = np.zeros(buckets, np.int64)
                for one in texts:
                    for _, codes in features(one, longest):
                        chunk += np.bincount(codes % buckets, minlength=buckets)
                held = np.flatnonzero(chunk)
                counts.update(dict(zip(held.tolist(), chunk[held].tolist())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], names=["bucket", "n"])

    schema = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("n", T.LongType())])
    return map_batches(table.select(text), run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: list[int], target: list[int]) -> list[int]:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the raw texts."""
    size, s_all, t_all = len(raw), sum(raw), sum(target)
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + size) / ((s + 1.0) * (t_all + size))))
            for s, t in zip(raw, target)]


def noise(seed: int, key: object) -> int:
    """Thousandths of a Gumbel draw that the seed and the key fix."""
    h = int(sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _all_buckets(counts: DataFrame, buckets: int) -> list[int]:
    """One number per bucket; the driver holds ``buckets`` of them, however large the table is."""
    out = [0] * buckets
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def weigh(documents: DataFrame, gain: list[int], text: str = "text", key: str = "doc_id",
          seed: int = SEED, longest: int = LONGEST) -> DataFrame:
    """key, n_words, n_features, weight and score: one row per row."""
    buckets = len(gain)
    shared = documents.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))
    schema = T.StructType([documents.schema[key]] + [
        T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            keys = batch.column(0)
            for first, last, texts in _rows(batch.column(1)):
                held = keys.slice(first, last - first)
                n_words, n_features, weight = [], [], []
                for one in texts:
                    parts = [(n, len(codes), int(table[codes % buckets].sum())) for n, codes in features(one, longest)]
                    for out, part in zip((n_words, n_features, weight), zip(*parts) if parts else ((0,),) * 3):
                        out.append(sum(part))
                score = [w + noise(seed, k) for w, k in zip(weight, held.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [held, *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight, score))],
                    names=[key, "n_words", "n_features", "weight", "score"])

    return map_batches(documents.select(key, text), run, schema)


def draw(weighed: DataFrame, work: Work, key: str = "doc_id", percent: int = PERCENT,
         least_words: int = LEAST_WORDS) -> DataFrame:
    """Add ``rank`` to weighed rows: 1 for the highest score, ties to the smaller key, null where not drawn.

    ``floor(percent / 100 * rows with least_words words)`` rows are drawn.
    """
    # The low 33 bits of the id are the place in the partition, the high ones the partition.
    order = [F.col("_fits").desc(), F.col("score").desc(), F.col(key).asc_nulls_last()]
    ordered = (weighed.withColumn("_fits", F.col("n_words") >= least_words)
               .repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("_id", F.monotonically_increasing_id()))
    ordered = work.keep(ordered, "ordered").withColumn("_part", F.shiftright("_id", 33))
    sizes = ordered.groupBy("_part").agg(F.count_if("_fits").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"),
        F.floor(F.lit(percent) * F.sum("n").over(Window.partitionBy()) / 100).alias("_drawn"))
    place = F.col("_base") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    # One row per partition of the exchange.
    return ordered.join(F.broadcast(sizes), F.col("_part") == F.col("_of")).select(
        key, "n_words", "n_features", "weight", "score",
        F.when(F.col("_fits") & (place <= F.col("_drawn")), place).alias("rank"))


def resample(documents: DataFrame, target: DataFrame, work: Work, text: str = "text", key: str = "doc_id",
             target_text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED,
             percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """key, n_words, n_features, weight, score, rank of every document."""
    raw = _all_buckets(bucket_counts(documents, text, buckets, longest), buckets)
    wanted = _all_buckets(bucket_counts(target, target_text, buckets, longest), buckets)
    # Kept, as a range exchange reads its input twice.
    weighed = work.keep(weigh(documents, gains(raw, wanted), text, key, seed, longest), "weighed")
    return draw(weighed, work, key, percent, least_words)
