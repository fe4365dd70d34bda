"""Similarity join of vectors by epsilon grid order.

Vectors of one label are compared by cosine.  Scaled to length one, those with a cosine
of at least ``COSINE`` lie within epsilon = sqrt(2 - 2 COSINE) of each other, also along
any axis.  The vectors are projected on the ``LEADING`` directions of greatest variance
(from the moments of all vectors) and cut into cells of side epsilon; the grid order is that
of label and cell.  A cell is a sequence interval; one with more than ``BLOCK``
vectors is split into blocks by a hash.  Intervals are joined level by level: cells meet
where the first coordinates differ by one at most, then the second ones, and so on, so that blocks
which are provably further apart than epsilon never meet.

Equal vectors of one label are one class with a weight.  A pair of blocks is compared by
one matrix product in double precision; what leaves the task are, for each class, the
weight of its partners and a spanning set of links, not the pairs.

Cases: null, empty and zero vectors, vectors with a null or non-finite component and
vectors without label link with nothing; vectors of different lengths link with nothing;
repeated rows with one id are vectors each in counts and one node in groups; a null id
gets a row and a null component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumgauge.llm.components import components
from forumgauge.llm.tables import Work, map_batches

COSINE = 0.98
LEADING = 4
BLOCK = 512


def _usable(table: DataFrame, vector: str, label: str) -> DataFrame:
    """Adds v, the vector in double precision, or null where it links with nothing."""
    v = F.col(vector).cast("array<double>")
    good = (F.col(label).isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
            & F.exists(v, lambda x: x != 0))
    return table.withColumn("v", F.when(good, v))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _directions(classes: DataFrame, leading: int) -> dict[int, np.ndarray]:
    """The leading principal directions for each vector length, from sums over all classes."""
    schema = T.StructType([T.StructField("size", T.IntegerType()), T.StructField("i", T.IntegerType()),
                           T.StructField("row", T.ArrayType(T.DoubleType()))])

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy()
            for size in np.unique(sizes):
                rows = _unit(_matrix(batch.column(0).filter(pa.array(sizes == size))))
                rows = np.hstack([rows, np.ones((len(rows), 1))])
                sums[size] = sums.get(size, 0) + rows.T @ rows
        out = [(int(size), i, row.tolist()) for size, total in sums.items() for i, row in enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
             pa.array([o[2] for o in out], pa.list_(pa.float64()))], names=schema.names)

    added = (map_batches(classes.select("v"), moments, schema)
             .select("size", "i", F.posexplode("row").alias("j", "x")).groupBy("size", "i", "j").agg(F.sum("x").alias("x")))
    table, out = added.toArrow().to_pydict(), {}
    for size in set(table["size"]):
        total = np.zeros((size + 1, size + 1))
        for s, i, j, x in zip(table["size"], table["i"], table["j"], table["x"]):
            if s == size:
                total[i, j] = x
        mean = total[size, :size] / total[size, size]
        _, directions = np.linalg.eigh(total[:size, :size] / total[size, size] - np.outer(mean, mean))
        out[size] = directions[:, ::-1][:, :leading]
    return out


def _cells(classes: DataFrame, epsilon: float, leading: int) -> DataFrame:
    """Adds cell: the grid coordinates of each class on the leading directions."""
    directions = _directions(classes, leading)
    schema = T.StructType([*classes.schema.fields, T.StructField("cell", T.ArrayType(T.IntegerType()))])
    place = classes.columns.index("v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(place).value_lengths().to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                own = np.floor(_unit(_matrix(part.column(place))) @ directions[int(size)] / epsilon).astype(np.int32)
                own = np.hstack([own, np.zeros((len(own), leading - own.shape[1]), np.int32)])
                cells = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * leading),
                                                 pa.array(own.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, cells], names=[*batch.schema.names, "cell"])

    return map_batches(classes, run, schema)


def _meetings(cells: DataFrame, leading: int) -> DataFrame:
    """label, size, a, b: cells that may hold partners, once for each two, a cell with itself included.

    Level by level: each level keeps the pairs of intervals whose next coordinates are neighbours.
    """
    pairs = None
    for depth in range(1, leading + 1):
        level = cells.select("label", "size", F.slice("cell", 1, depth).alias("own")).distinct()
        if pairs is None:
            left = level.select("label", "size", F.col("own").alias("a"),
                                F.explode(F.array(*(F.element_at("own", 1) + d for d in (-1, 0, 1)))).alias("next"))
            right = level.select("label", "size", F.col("own").alias("b"), F.element_at("own", 1).alias("next"))
            pairs = left.join(right, ["label", "size", "next"]).select("label", "size", "a", "b")
        else:
            sides = [level.select("label", "size", F.slice("own", 1, depth - 1).alias(x), F.col("own").alias(f"{x}_own"))
                     for x in "ab"]
            near = sides[0].select("*", F.explode(F.array(*(F.element_at("a_own", depth) + d for d in (-1, 0, 1)))).alias("next"))
            far = sides[1].withColumn("next", F.element_at("b_own", depth))
            pairs = (pairs.join(near, ["label", "size", "a"]).join(far, ["label", "size", "b", "next"])
                     .select("label", "size", F.col("a_own").alias("a"), F.col("b_own").alias("b")))
    return pairs.where("a <= b")


def _compare(group: pa.Table, cosine: float) -> pa.Table:
    """For one pair of blocks: each class's weight of partners, and a spanning set of links."""
    side = group.column("side").to_numpy()
    head, weight = (group.column(c).to_numpy() for c in ("head", "weight"))
    rows = _unit(_matrix(group.column("v")))
    left = np.flatnonzero(side != 1)
    right = left if (side == 2).any() else np.flatnonzero(side == 1)
    out = {"head": [], "links": [], "a": [], "b": []}
    if len(left) and len(right):
        near = rows[left] @ rows[right].T >= cosine
        both = left is not right
        if not both:
            np.fill_diagonal(near, False)
        counts = [(left, near @ weight[right])] + ([(right, weight[left] @ near)] if both else [])
        for members, partners in counts:
            held = partners > 0
            out["head"] += head[members[held]].tolist()
            out["links"] += partners[held].astype(np.int64).tolist()
        # walk the links breadth first; a class enters the walk once
        pending_l, pending_r = np.ones(len(left), bool), np.ones(len(right), bool)
        for start in np.flatnonzero(near.any(axis=1)):
            if not pending_l[start]:
                continue
            pending_l[start] = False
            if not both:
                pending_r[start] = False
            queue = [(0, start)]
            while queue:
                where, i = queue.pop()
                source = left[i] if where == 0 else right[i]
                found = np.flatnonzero((near[i] & pending_r) if where == 0 else (near[:, i] & pending_l))
                targets = right if where == 0 else left
                (pending_r if where == 0 else pending_l)[found] = False
                if not both:
                    pending_l[found] = pending_r[found] = False
                out["a"] += [int(head[source])] * len(found)
                out["b"] += head[targets[found]].tolist()
                queue += [((1 - where) if both else 0, int(x)) for x in found]
    size = len(out["head"]) + len(out["a"])
    pad = [None] * (size - len(out["head"]))
    none = [None] * (size - len(out["a"]))
    return pa.table([pa.array(out["head"] + pad, pa.int64()), pa.array(out["links"] + pad, pa.int64()),
                     pa.array(none + out["a"], pa.int64()), pa.array(none + out["b"], pa.int64())],
                    names=["head", "links", "a", "b"])


def join(vectors: DataFrame, work: Work, vector: str = "embedding", label: str = "label", key: str = "vec_id",
         cosine: float = COSINE, leading: int = LEADING, block: int = BLOCK) -> DataFrame:
    """key, n_links, component_id, kept: one row per row."""
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-12
    rows = _usable(vectors.select(F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"),
                                  F.col(vector).alias("vector")), "vector", "label").drop("vector")
    rows = work.keep(rows.withColumns({"f": F.xxhash64("v"), "g": F.xxhash64(F.lit("v"), "v")}), "rows")
    classes = (rows.where("v is not null and key is not null").groupBy("label", "f", "g")
               .agg(F.min("key").alias("head"), F.count("*").alias("weight"), F.min("v").alias("v"))
               .withColumn("size", F.size("v")))
    classes = work.keep(_cells(work.keep(classes, "classes"), epsilon, leading), "cells")
    blocks = work.keep(classes.groupBy("label", "size", "cell").agg(F.count("*").alias("n"))
                       .withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "blocks")
    sizes = blocks.select("label", "size", "cell", "blocks")
    met = _meetings(blocks, leading)
    met = (met.join(sizes.select("label", "size", F.col("cell").alias("a"), F.col("blocks").alias("n_a")), ["label", "size", "a"])
           .join(sizes.select("label", "size", F.col("cell").alias("b"), F.col("blocks").alias("n_b")), ["label", "size", "b"]))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("i"))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("j")).where("a < b or i <= j")
    met = met.withColumn("meeting", F.xxhash64("label", "size", "a", "b", "i", "j"))
    met = work.keep(met.select("meeting", "label", "size", "a", "b", "i", "j"), "met")
    same = (F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))
    sides = (met.select("meeting", "label", "size", F.col("a").alias("cell"), F.col("i").alias("block"),
                        F.when(same, 2).otherwise(0).alias("side"))
             .unionByName(met.where(~same).select("meeting", "label", "size", F.col("b").alias("cell"),
                                                  F.col("j").alias("block"), F.lit(1).alias("side"))))
    placed = classes.join(sizes, ["label", "size", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("head", F.lit("block")), F.col("blocks")).cast("int"))
    dealt = placed.join(sides, ["label", "size", "cell", "block"]).select("meeting", "side", "head", "weight", "v")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("head", "links", "a", "b")])
    found = work.keep(dealt.groupBy("meeting").applyInArrow(lambda t: _compare(t, cosine), schema), "found")
    partners = found.where("head is not null").groupBy("head").agg(F.sum("links").alias("links"))
    groups = components(found.where("a is not null").select("a", "b"), work, "groups")
    heads = (classes.select("label", "f", "g", "head", "weight").join(partners, "head", "left")
             .join(groups.select(F.col("node").alias("head"), "component"), "head", "left")
             .select(F.col("label").alias("l"), F.col("f").alias("hf"), F.col("g").alias("hg"),
                     (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
                     F.coalesce("component", "head").alias("component")))
    usable = rows["v"].isNotNull() & rows["key"].isNotNull()
    joined = rows.join(heads, usable & (rows["label"] == heads["l"]) & (rows["f"] == heads["hf"])
                       & (rows["g"] == heads["hg"]), "left")
    component = F.coalesce("component", "key")
    return joined.select(F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                         component.alias("component_id"),
                         (F.col("key").isNull() | (F.col("key") == component)).alias("kept"))
