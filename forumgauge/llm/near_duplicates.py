"""Near-duplicate documents by SetSketch registers.

A document's set is that of its distinct ``SIZE``-word shingles, of words with A-Z in
lower case.  For each of ``REGISTERS`` hash functions the least hash over the set is
stored on an exponential scale of base ``BASE``, truncated to 16 bits: registers that merge by
their maximum and agree about as often as two sets overlap.  Documents with equal sets
are one class from the start, so that copies cost nothing further.

Classes whose registers agree in one of ``BANDS`` bands meet in a bucket.  A bucket is
taken apart in rounds: its smallest document is compared with all others; those that
are likely similar (``NEAR``) are done, the others stay for the next round.  After
``ROUNDS`` rounds, documents that are left in a bucket and not yet in one cluster are compared
block by block, each two blocks in a task, which returns no more links than it takes to
connect them.  The comparison is the likeliest overlap given how many
registers are greater, equal and smaller and both set sizes.  All pairs of some likeness
(``ALIKE``) join documents to clusters: if two documents are linked, they end up in one
cluster, by the triangle inequality of set distances.

Then likely pairs are confirmed on full sets.  In a cluster whose confirmed links leave more
than one part, the documents outside the largest part are compared with all of the
cluster, block by block.  A pair above the threshold is missed only if no band agrees (4e-8 at
0.8) or if its estimate falls below ``NEAR`` (about five standard errors).

Cases: null and empty texts have empty sets and link with nothing; a text with fewer
words than a shingle has its whole sequence as the only one; repeated rows with one key are one
document as far as links go, and a row each in the result; a null key links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm import words
from forumgauge.llm.components import components
from forumgauge.llm.tables import Work, map_batches

SIZE = 4
PERCENT = 80
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE, RATE = 1.001, 20.0
NEAR, ALIKE = 0.65, 0.40
ROUNDS = 2
BLOCK = 256

_STEPS = words.mix(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * words.GRAM_BASE)
_SALT, _FACTOR = _STEPS[:REGISTERS], _STEPS[REGISTERS:] | np.uint64(1)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows [first, last): the rows' sorted distinct shingle hashes and their bounds."""
    for first, last, data, offsets in words.chunks(column):
        starts, ends, row = words.spans(data, offsets)
        code = words.hashes(data, starts, ends, lower=True)
        bounds = words.row_bounds(row, last - first)
        grams = words.grams(code, size)
        out, cuts = [], np.zeros(last - first + 1, np.int64)
        for i in range(last - first):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= size:
                own = np.unique(grams[a:b - size + 1])
            else:
                own = words.grams(code[a:b], b - a) if b > a else grams[:0]
            out.append(own)
            cuts[i + 1] = cuts[i] + len(own)
        yield first, last, np.concatenate(out) if out else np.empty(0, np.uint64), cuts


def registers(found: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The registers of each set, one row each; rows of empty sets are zero."""
    filled = np.flatnonzero(np.diff(cuts))
    least = np.zeros((len(cuts) - 1, REGISTERS), np.float64)
    if len(filled):
        begins = cuts[filled]
        for i in range(REGISTERS):
            least[filled, i] = np.minimum.reduceat((found ^ _SALT[i]) * _FACTOR[i], begins)
    share = (least + 0.5) / 2.0 ** 64
    scale = np.floor(1 - np.log(-np.log1p(-share) / RATE) / np.log(BASE))
    out = np.clip(scale, 0, 65535).astype(np.uint16)
    out[np.diff(cuts) == 0] = 0
    return out


def overlap(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The likeliest similarity of sets of sizes n and m, from how their registers compare."""
    more, less = (a > b).sum(-1), (a < b).sum(-1)
    equal = a.shape[-1] - more - less
    u, v = n / (n + m), m / (n + m)
    share = lambda x: -np.log1p(-np.clip(x, 1e-9, 1 - 1e-9) * (BASE - 1) / BASE) / np.log(BASE)
    grid = np.linspace(0, 1, 101) * np.minimum(u / v, v / u)[..., None]
    up, down = share(u[..., None] - v[..., None] * grid), share(v[..., None] - u[..., None] * grid)
    same = np.clip(1 - up - down, 1e-9, 1)
    likely = more[..., None] * np.log(up) + less[..., None] * np.log(down) + equal[..., None] * np.log(same)
    return np.take_along_axis(grid, likely.argmax(-1)[..., None], -1)[..., 0]


def _unpack(column: pa.Array, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def sketches(documents: DataFrame, text: str = "text", key: str = "doc_id", size: int = SIZE) -> DataFrame:
    """doc, n_shingles, f, g (a 128-bit hash of the set), registers: one row per row."""
    schema = T.StructType([T.StructField("doc", documents.schema[key].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("f", T.LongType()), T.StructField("g", T.LongType()),
                           T.StructField("registers", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found, cuts in shingle_sets(batch.column(1), size):
                total = np.zeros((2, len(found) + 1), np.uint64)
                np.cumsum(found, out=total[0, 1:])
                np.cumsum(words.mix(found ^ words.GRAM_BASE), out=total[1, 1:])
                prints = (total[:, cuts[1:]] - total[:, cuts[:-1]]).astype(np.int64)
                kept = registers(found, cuts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(cuts)), pa.array(prints[0]),
                     pa.array(prints[1]), pa.array([x.tobytes() for x in kept], pa.binary())], names=schema.names)

    return map_batches(documents.select(key, text), run, schema)


def _bands(classes: DataFrame) -> DataFrame:
    """key, doc: one row for each band of each class."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc", T.LongType())])
    powers = words.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)).reshape(BANDS, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = _matrix(part.column(1)).astype(np.uint64).reshape(-1, BANDS, ROWS)
                keys = words.mix((words.mix(rows + powers) * powers).sum(-1, dtype=np.uint64))
                docs = np.repeat(part.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().astype(np.int64)), pa.array(docs)],
                                                 names=["key", "doc"])

    return map_batches(classes.select("doc", "registers"), run, schema)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b, likeness for pairs of classes."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                           T.StructField("likeness", T.DoubleType())])
    sides = [classes.select(F.col("doc").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                            F.col("registers").alias(f"r_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, m = (part.column(i).to_numpy().astype(float) for i in (2, 4))
                likeness = overlap(_matrix(part.column(3)), _matrix(part.column(5)), n, m)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(likeness)], names=schema.names)

    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "r_a", "n_b", "r_b")
    return map_batches(joined, run, schema)


def _sets(documents: DataFrame, chosen: DataFrame, text: str, key: str, size: int) -> DataFrame:
    """doc, shingles (sorted 64-bit hashes) of the chosen documents."""
    schema = T.StructType([T.StructField("doc", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found, cuts in shingle_sets(batch.column(1), size):
                packed = [found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(packed, pa.binary())],
                                                 names=schema.names)

    texts = documents.select(F.col(key).alias("doc"), F.col(text).alias("text")).join(chosen, "doc")
    return map_batches(texts, run, schema).dropDuplicates(["doc"])


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose full sets are similar enough."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                good = [_linked(x, y, percent) for x, y in zip(*(_unpack(part.column(i), np.uint64) for i in (2, 3)))]
                yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    sides = [sets.select(F.col("doc").alias(x), F.col("shingles").alias(f"s_{x}")) for x in "ab"]
    joined = pairs.join(sides[1], "b").join(sides[0], "a").select("a", "b", "s_a", "s_b")
    return map_batches(joined, run, schema)


def _dealt(parts: DataFrame, work: Work, name: str) -> DataFrame | None:
    """cluster, row, column, side, doc, part: the blocks to compare in clusters of several parts; None if there are none.

    ``parts`` has doc, cluster and part.  Documents outside the largest part of a cluster
    are dealt to columns, all documents to rows of blocks.
    """
    sizes = parts.groupBy("cluster", "part").agg(F.count("*").alias("n"))
    mixed = (sizes.groupBy("cluster").agg(F.sum("n").alias("all"), F.count("*").alias("parts"),
                                          F.max(F.struct("n", (-F.col("part")).alias("p"))).alias("top"))
             .where("parts > 1")
             .select("cluster", (-F.col("top.p")).alias("main"),
                     F.ceil(F.col("all") / BLOCK).alias("rows"),
                     F.ceil((F.col("all") - F.col("top.n")) / BLOCK).alias("columns")))
    rows = work.keep(parts.join(mixed, "cluster"), name)
    if rows.isEmpty():
        return None
    place = F.xxhash64("doc")
    wide = [F.col("doc"), F.col("part"), F.col("cluster")]
    as_row = rows.select(*wide, F.pmod(place, "rows").alias("row"),
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("columns") - 1)).alias("column"),
                         F.lit(0).alias("side"))
    as_column = rows.where("part != main").select(
        *wide, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1)).alias("row"),
        F.pmod(place, "columns").alias("column"), F.lit(1).alias("side"))
    return as_row.unionByName(as_column)


def _spanned(group: pa.Table, least: float, confirm) -> list[tuple[int, int, float]]:
    """a, b, likeness: likely links from a block's columns to its rows, one for each two parts that they connect."""
    side = group.column("side").to_numpy()
    doc, part, n = (group.column(c).to_numpy() for c in ("doc", "part", "n_shingles"))
    own = _matrix(group.column("registers").combine_chunks())
    label = {int(p): int(p) for p in part}

    def root(p: int) -> int:
        while label[p] != p:
            label[p] = label[label[p]]
            p = label[p]
        return p

    links, rows_of = [], np.flatnonzero(side == 0)
    for c in np.flatnonzero(side == 1):
        other = rows_of[part[rows_of] != part[c]]
        if not len(other):
            continue
        near = overlap(own[other], own[c], n[other].astype(float), np.float64(n[c]))
        order = np.argsort(-near)
        for x, likeness in zip(other[order], near[order][: int((near >= least).sum())]):
            p, q = root(int(part[x])), root(int(part[c]))
            if p != q and confirm(x, c):
                label[p] = q
                links.append((int(doc[x]), int(doc[c]), float(likeness)))
    return links


def _left(rest: DataFrame, stars: DataFrame, classes: DataFrame, work: Work) -> DataFrame:
    """a, b, likeness: links between documents that the rounds left in one bucket, but in no common cluster."""
    joined = components(stars, work, "joined").select(F.col("node").alias("doc"), "component")
    parts = rest.join(joined, "doc", "left").select(
        "doc", F.col("key").alias("cluster"), F.coalesce("component", "doc").alias("part"))
    dealt = _dealt(parts, work, "left")
    if dealt is None:
        return stars.limit(0)
    dealt = dealt.join(classes, "doc")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                           T.StructField("likeness", T.DoubleType())])

    def compare(group: pa.Table) -> pa.Table:
        links = _spanned(group, ALIKE, lambda x, c: True)
        return pa.table([pa.array([link[i] for link in links], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                        names=schema.names)

    return dealt.groupBy("cluster", "row", "column").applyInArrow(compare, schema)


def _across(parts: DataFrame, classes: DataFrame, sets: DataFrame, work: Work, percent: int) -> DataFrame | None:
    """Links between parts of one cluster, confirmed on full sets; None where each cluster is one part."""
    dealt = _dealt(parts, work, "mixed")
    if dealt is None:
        return None
    full = classes.join(sets, "doc").select("doc", "n_shingles", "registers", "shingles")
    dealt = dealt.join(full, "doc")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def compare(group: pa.Table) -> pa.Table:
        found = _unpack(group.column("shingles").combine_chunks(), np.uint64)
        links = _spanned(group, NEAR, lambda x, c: _linked(found[x], found[c], percent))
        return pa.table([pa.array([link[i] for link in links], pa.int64()) for i in (0, 1)], names=schema.names)

    return dealt.groupBy("cluster", "row", "column").applyInArrow(compare, schema)


def groups(documents: DataFrame, work: Work, text: str = "text", key: str = "doc_id", size: int = SIZE,
           percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id (the smallest key of the group), kept: one row per row."""
    long_key = documents.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    drawn = work.keep(sketches(long_key, "text", "doc", size), "sketches")
    filled = drawn.where("n_shingles > 0 and doc is not null")
    same = work.keep(filled.groupBy("f", "g", "n_shingles").agg(F.min("doc").alias("head")), "same")
    classes = work.keep(filled.join(same.select(F.col("head").alias("doc")), "doc", "left_semi")
                        .select("doc", "n_shingles", "registers").dropDuplicates(["doc"]), "classes")

    bands = _bands(classes)
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    rest = work.keep(bands.join(shared, "key", "left_semi"), "members")
    edges = []
    for number in range(ROUNDS):
        centres = rest.groupBy("key").agg(F.min("doc").alias("a"))
        stars = rest.join(centres, "key").where("doc != a").select("key", "a", F.col("doc").alias("b"))
        near = work.keep(_estimated(stars.select("a", "b").distinct(), classes), f"near-{number}")
        edges.append(near.where(F.col("likeness") >= ALIKE))
        rest = work.keep(stars.join(near.where(F.col("likeness") < NEAR), ["a", "b"])
                         .select("key", F.col("b").alias("doc")), f"rest-{number}")
    stars = edges[0]
    for more in edges[1:]:
        stars = stars.unionByName(more)
    if not rest.isEmpty():
        stars = stars.unionByName(_left(rest, stars, classes, work))
    likely = work.keep(stars, "likely")

    clusters = work.keep(components(likely, work, "clusters"), "clusters")
    sets = work.keep(_sets(long_key, clusters.select(F.col("node").alias("doc")), "text", "doc", size), "sets")
    close = likely.where(F.col("likeness") >= NEAR).select("a", "b").distinct()
    links = work.keep(_confirmed(close, sets, percent), "links")
    first = components(links, work, "parts")
    parts = work.keep(
        clusters.select(F.col("node").alias("doc"), F.col("component").alias("cluster"))
        .join(first.select(F.col("node").alias("doc"), "component"), "doc", "left")
        .select("doc", "cluster", F.coalesce("component", "doc").alias("part")), "parts")
    whole = parts.select(F.col("doc").alias("node"), F.col("part").alias("component"))
    more = _across(parts, classes, sets, work, percent)
    if more is not None:
        # Parts are connected already; only links between them are left to follow.
        sides = [whole.select(F.col("node").alias(x), F.col("component").alias(f"part_{x}")) for x in "ab"]
        between = work.keep(more, "more").join(sides[0], "a").join(sides[1], "b")
        joined = components(between, work, "whole", "part_a", "part_b").select(
            F.col("node").alias("component"), F.col("component").alias("first"))
        whole = work.keep(whole.join(joined, "component", "left").select(
            "node", F.coalesce("first", "component").alias("component")), "whole")

    heads = same.join(whole.select(F.col("node").alias("head"), "component"), "head", "left").select(
        "f", "g", "n_shingles", F.coalesce("component", "head").alias("component"))
    heads = heads.select("f", "g", F.col("n_shingles").alias("n"), "component")
    joined = drawn.select("doc", "n_shingles", "f", "g").join(
        heads, (drawn["f"] == heads["f"]) & (drawn["g"] == heads["g"]) & (drawn["n_shingles"] == heads["n"])
        & drawn["doc"].isNotNull(), "left")
    component = F.coalesce("component", "doc")
    return joined.select(F.col("doc").alias(key), "n_shingles", component.alias("component_id"),
                         (F.col("doc").isNull() | (F.col("doc") == component)).alias("kept"))
