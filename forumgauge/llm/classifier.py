"""Quality classifier: document evidence combined with hierarchical site posteriors.

Two judgements are learned from labelled documents, low quality and toxic.  A document's
features are its distinct words, their beginnings of ``PREFIXES`` bytes, hashed to
``FEATURES`` numbers each, and the bins of some ratios.  From a bounded sample of labelled documents (``SAMPLE``, those whose ids have
the lowest hashes) come each feature's counts by class; the ``TOP`` features furthest from
chance enter a logistic regression on the sample.

Sites form two levels, host and path.  The expected number of bad documents of every
site is summed over all documents; a host's rate is shrunk toward the global one and a
path's toward its host's.  How strongly is estimated from the spread of the rates
between sites: a site with few documents keeps little of its own rate.  A document's
posterior adds the difference between its site's prior log-odds and the global one to
its evidence.

Cases: a null or empty text has only ratio features; null hosts and paths are sites of
their own; without labels of both classes a judgement is never made, and all documents
are kept; a label for an absent document is not used, of repeated labels the largest
counts; repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.tables import Work, map_batches

BITS = 17
FEATURES = 1 << BITS
PREFIXES = (4, 5)
RATIOS = FEATURES * (1 + len(PREFIXES))
WIDTH = RATIOS + 256
SAMPLE = 20_000
LEAST = 16.0
TOP = 256
PENALTY = 1.0
REJECT = 0.5
HEADS = ("low", "toxic")

_WORD = np.ones(256, dtype=bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1),
       *range(0x80, 0x100)]] = False


def _is(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters]] = True
    return out


_CLASSES = (_is("#*$%&|<>"), _is("!?"), _is("".join(map(chr, range(65, 91)))), _is("0123456789"), _is("\n"))
_STEPS = np.array([0.0, 0.01, 0.03, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0])


def occurrences(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows [first, last): the feature numbers of each word, the rows they
    are in from 0, and the ratio features of each row."""
    for first, last, data, offsets in words.chunks(column):
        rows = last - first
        starts, ends, row = words.spans(data, offsets, _WORD)
        code = words.hashes(data, starts, ends, lower=True)
        bounds = words.row_bounds(row, rows)
        # a word and its beginnings, each kind in its own range of numbers
        buckets = np.column_stack([
            (x >> np.uint64(64 - BITS)).astype(np.int32) + i * FEATURES for i, x in enumerate(
                [code, *(words.hashes(data, starts, np.minimum(ends, starts + n), lower=True) for n in PREFIXES)])])
        triples = words.grams(code, 3)
        counts = np.diff(bounds)
        ratios = [words.sums(c[data], offsets) / np.maximum(counts, 1) for c in _CLASSES]
        ratios.append(np.diff(offsets) / np.maximum(counts, 1) / 20)
        repeats = np.zeros(rows)
        for i in np.flatnonzero(counts > 2):
            own = np.sort(triples[bounds[i]:bounds[i + 1] - 2])
            repeats[i] = np.count_nonzero(own[1:] == own[:-1]) / len(own)
        ratios.append(repeats)
        bins = [RATIOS + 16 * i + np.searchsorted(_STEPS, r) for i, r in enumerate(ratios)]
        bins.append(RATIOS + 16 * len(ratios) + np.frexp(counts)[1])
        yield first, last, buckets, row, np.column_stack(bins)


def distinct(buckets: np.ndarray, row: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and their rows, each pair once."""
    pairs = np.unique(np.repeat(row, buckets.shape[1]) * WIDTH + buckets.ravel())
    rows = np.repeat(np.arange(len(bins)), bins.shape[1])
    return np.concatenate([pairs % WIDTH, bins.ravel()]), np.concatenate([pairs // WIDTH, rows])


@dataclass
class Head:
    """The weights of one judgement: a log-odds for each feature, and one for all texts."""

    weights: np.ndarray
    bias: float


@dataclass
class Model:
    heads: dict[str, Head | None]

    def evidence(self, column: pa.Array) -> dict[str, np.ndarray]:
        """Calibrated log-odds of each row, for each judgement."""
        out = {name: np.full(len(column), -20.0) for name in self.heads}
        heads = {name: head for name, head in self.heads.items() if head}
        used = np.zeros(WIDTH, dtype=bool)
        for head in heads.values():
            used |= head.weights != 0
        for first, last, buckets, row, bins in occurrences(column):
            held = used[buckets].any(axis=1)
            found, rows = distinct(buckets[held], row[held], bins)
            for name, head in heads.items():
                out[name][first:last] = head.bias + np.bincount(rows, head.weights[found], last - first)
        return out


def _regression(x: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights of a penalised logistic regression by Newton's steps; the first column is all ones."""
    beta = np.zeros(x.shape[1])
    beta[0] = np.log((bad.sum() + 0.5) / (len(bad) - bad.sum() + 0.5))
    penalty = np.full(x.shape[1], PENALTY)
    penalty[0] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (bad - p) - penalty * beta
        curve = np.diag(penalty)
        for at in range(0, len(x), 4096):
            part = x[at:at + 4096].astype(float)
            curve += (part * (p * (1 - p))[at:at + 4096, None]).T @ part
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _chosen(present: list[np.ndarray], count: list[float]) -> np.ndarray:
    """The features that tell most about the class, by the likelihood-ratio statistic."""
    gain, total = np.zeros(WIDTH), sum(count)
    for held in (present, [count[k] - present[k] for k in (0, 1)]):
        everyone = held[0] + held[1]
        for k in (0, 1):
            expected = np.maximum(everyone * count[k] / total, 1e-12)
            gain += 2 * held[k] * np.log(np.maximum(held[k], 1e-12) / expected)
    best = np.argsort(-gain, kind="stable")[:TOP]
    return np.sort(best[gain[best] >= LEAST])


def fit(documents: DataFrame, labels: DataFrame, work: Work, text: str = "text", key: str = "doc_id",
        quality: str = "quality", toxic: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn both judgements from at most ``sample`` labelled documents.

    The sample is read by a join with its ids, whose number the parameter bounds.
    What comes to the driver is a table of at most ``WIDTH`` features for each class, and
    the chosen features of each document of the sample.
    """
    chosen = (labels.where(F.col(key).isNotNull())
              .groupBy(F.col(key).alias("key"))
              .agg(F.max((1 - F.col(quality)).cast("int")).alias("low"), F.max(F.col(toxic).cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("key"), "key").limit(sample))
    texts = work.keep(documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
                      .join(F.broadcast(chosen), "key").select("low", "toxic", "text"), "sample")
    counts_schema = T.StructType([T.StructField("head", T.StringType()), T.StructField("bad", T.IntegerType()),
                                  T.StructField("feature", T.IntegerType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = {(h, k): np.zeros(WIDTH, np.int64) for h in HEADS for k in (0, 1)}
        for batch in batches:
            classes = {h: batch.column(i).to_numpy(zero_copy_only=False) for i, h in enumerate(HEADS)}
            for first, last, *parts in occurrences(batch.column(2)):
                found, rows = distinct(*parts)
                for h in HEADS:
                    for k in (0, 1):
                        present[h, k] += np.bincount(found[classes[h][first + rows] == k], minlength=WIDTH)
                        present[h, k][WIDTH - 1] += np.count_nonzero(classes[h][first:last] == k)
        for (h, k), n in present.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([h] * len(at), pa.string()), pa.array([k] * len(at), pa.int32()),
                 pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["head", "bad", "feature", "n"])

    counted = map_batches(texts, count, counts_schema).groupBy("head", "bad", "feature").agg(F.sum("n").alias("n"))
    present = {(h, k): np.zeros(WIDTH) for h in HEADS for k in (0, 1)}
    table = counted.toArrow()
    for h, k in present:
        rows = table.filter((pc.field("head") == h) & (pc.field("bad") == k))
        present[h, k][rows["feature"].to_numpy()] = rows["n"].to_numpy()
    del table
    chosen_of = {}
    for h in HEADS:
        size = [present[h, k][WIDTH - 1] for k in (0, 1)]
        if min(size) >= 1:
            for k in (0, 1):
                present[h, k][WIDTH - 1] = 0.0
            chosen_of[h] = _chosen([present[h, 0], present[h, 1]], size)
    fields = [T.StructField(n, t) for h in HEADS for n, t in ((h, T.IntegerType()), (f"in_{h}", T.ArrayType(T.IntegerType())))]

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {h: np.full(WIDTH, -1, np.int32) for h in chosen_of}
        for h, at in chosen_of.items():
            place[h][at] = np.arange(len(at))
        for batch in batches:
            held = {h: [[] for _ in range(batch.num_rows)] for h in HEADS}
            for first, _, *parts in occurrences(batch.column(2)):
                found, rows = distinct(*parts)
                for h, where in place.items():
                    for i, at in zip(rows[where[found] >= 0], where[found][where[found] >= 0]):
                        held[h][first + i].append(int(at))
            yield pa.RecordBatch.from_arrays(
                [x for i, h in enumerate(HEADS) for x in (batch.column(i), pa.array(held[h], pa.list_(pa.int32())))],
                names=[f.name for f in fields])

    rows = map_batches(texts, hold, T.StructType(fields)).toArrow()
    heads: dict[str, Head | None] = dict.fromkeys(HEADS)
    for h, at in chosen_of.items():
        known = rows.filter(pc.field(h).is_valid())
        held = known[f"in_{h}"].combine_chunks()
        x = np.zeros((len(known), len(at) + 1), np.float32)
        x[:, 0] = 1.0
        x[np.repeat(np.arange(len(known)), held.value_lengths().to_numpy()), held.flatten().to_numpy() + 1] = 1.0
        beta = _regression(x, known[h].to_numpy().astype(float))
        weights = np.zeros(WIDTH)
        weights[at] = beta[1:]
        heads[h] = Head(weights, float(beta[0]))
    return Model(heads)


def with_evidence(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns, and evidence_low and evidence_toxic, the calibrated log-odds of each text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index(text)
    names = [f"evidence_{h}" for h in HEADS]
    schema = T.StructType([*documents.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.evidence(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[h]) for h in HEADS)],
                                             names=[*batch.schema.names, *names])

    return map_batches(documents, run, schema)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(table: DataFrame, bad: str, rows: str, mean: str) -> float:
    """How many documents the upper level's rate is worth, from the spread of the lower level's rates."""
    rate, m = F.col(bad) / F.col(rows), F.col(mean)
    spread, chance = table.agg(F.sum(F.col(rows) * (rate - m) ** 2), F.sum(m * (1 - m))).first()
    spread, chance = spread or 0.0, chance or 0.0
    if spread <= chance or not chance:
        return 1e6
    weight, units, base = table.agg(F.sum(rows), F.count("*"), F.sum(F.col(rows) * m * (1 - m))).first()
    between = (spread - chance) / weight
    return float(min(1e6, max(1.0, base / weight / between)))


def site_priors(scored: DataFrame, work: Work, host: str = "source", path: str = "lang") -> DataFrame:
    """host, path and, for each judgement, prior_: the shrunk log-odds less the global one."""
    expected = [F.sum(1 / (1 + F.exp(-F.col(f"evidence_{h}")))).alias(f"bad_{h}") for h in HEADS]
    paths = work.keep(scored.groupBy(F.col(host).alias("host"), F.col(path).alias("path"))
                      .agg(F.count("*").alias("rows"), *expected), "paths")
    hosts = paths.groupBy("host").agg(F.sum("rows").alias("host_rows"),
                                      *(F.sum(f"bad_{h}").alias(f"host_{h}") for h in HEADS))
    total = hosts.agg(F.sum("host_rows"), *(F.sum(f"host_{h}") for h in HEADS)).first()
    rows = total[0] or 1
    overall = {h: (total[i + 1] or 0.0) / rows for i, h in enumerate(HEADS)}
    for h in HEADS:
        hosts = hosts.withColumn("global", F.lit(overall[h]))
        worth = _strength(hosts, f"host_{h}", "host_rows", "global")
        hosts = hosts.withColumn(f"rate_{h}", (F.col(f"host_{h}") + worth * overall[h]) / (F.col("host_rows") + worth))
    hosts = work.keep(hosts.select("host", *(f"rate_{h}" for h in HEADS)), "hosts")
    both = paths.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    for h in HEADS:
        worth = _strength(both, f"bad_{h}", "rows", f"rate_{h}")
        rate = (F.col(f"bad_{h}") + worth * F.col(f"rate_{h}")) / (F.col("rows") + worth)
        both = both.withColumn(f"prior_{h}", _logit(rate) - _logit(F.lit(overall[h])))
    return work.keep(both.select("host", "path", *(f"prior_{h}" for h in HEADS)), "priors")


def judge(scored: DataFrame, priors: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """All columns of ``scored``, and posterior_low, posterior_toxic and kept."""
    sites = priors.select(F.col("host").alias("_host"), F.col("path").alias("_path"), *(f"prior_{h}" for h in HEADS))
    joined = scored.join(sites, scored[host].eqNullSafe(sites["_host"]) & scored[path].eqNullSafe(sites["_path"]), "left")
    posterior = {h: 1 / (1 + F.exp(-(F.col(f"evidence_{h}") + F.coalesce(f"prior_{h}", F.lit(0.0))))) for h in HEADS}
    kept = F.lit(True)
    for h in HEADS:
        kept = kept & (F.col(f"posterior_{h}") < REJECT)
    return (joined.withColumns({f"posterior_{h}": p for h, p in posterior.items()}).withColumn("kept", kept)
            .drop("_host", "_path", *(f"prior_{h}" for h in HEADS)))


def classify(documents: DataFrame, labels: DataFrame, work: Work, text: str = "text", key: str = "doc_id",
             host: str = "source", path: str = "lang", **settings) -> DataFrame:
    """key, host, path, evidence, posteriors and kept, one row per row."""
    model = fit(documents, labels, work, text, key, **settings)
    narrow = work.keep(with_evidence(documents.select(key, host, path, text), model, text).drop(text), "evidence")
    return judge(narrow, site_priors(narrow, work, host, path), host, path)


def filtered(documents: DataFrame, labels: DataFrame, work: Work, text: str = "text", key: str = "doc_id",
             host: str = "source", path: str = "lang", **settings) -> DataFrame:
    """The documents that are kept, with their own columns, which may have any names.

    Evidence is worked out again beside the whole rows, which costs less than sending
    all texts to where the verdicts are.
    """
    model = fit(documents, labels, work, text, key, **settings)
    narrow = with_evidence(documents.select(host, path, text), model, text).drop(text)
    priors = site_priors(narrow, work, host, path)
    # Numbered names keep the caller's columns apart from those of the judgement.
    safe = {name: f"_column_{i}" for i, name in enumerate(documents.columns)}
    judged = judge(with_evidence(documents.toDF(*safe.values()), model, safe[text]), priors, safe[host], safe[path])
    return judged.where("kept").select(*safe.values()).toDF(*safe)
