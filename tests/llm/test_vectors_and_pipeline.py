"""The vector join against brute force, components, and the pipeline."""

import random

import numpy as np

import corpus_pipeline
from forumgauge.llm import grid_join
from forumgauge.llm.components import components
from forumgauge.llm.tables import Work


def smallest(links, nodes):
    group = {n: n for n in nodes}
    for a, b in links:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        group = {k: new if v == old else v for k, v in group.items()}
    return group


def test_components(spark, work):
    rng = random.Random(4)
    links = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    links += [(200, x) for x in range(201, 260)] + [(5, 5)]
    df = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(df, work, "c").collect()}
    group = smallest(links, {n for link in links for n in link})
    assert got == {n: c for n, c in group.items() if any(n in link and link[0] != link[1] for link in links)}


def test_vector_join(spark, work):
    rng = np.random.default_rng(3)
    rows, base = [], rng.normal(size=(40, 8))
    for i in range(240):
        v = base[i % 40] * rng.uniform(0.1, 9) + (0 if i < 80 else 0.11) * rng.normal(size=8)
        rows.append((i, [float(x) for x in v], int(i % 40 % 3)))
    rows += [(300 + i, rows[0][1], 0) for i in range(30)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 8, 0), (403, [1.0, None] * 4, 0), (404, [float("nan")] * 8, 0),
             (405, [float("inf")] * 8, 1), (406, rows[0][1], None), (407, rows[0][1][:5], 0), (408, [1e200] * 8, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: r for r in grid_join.join(df, work, block=16).collect()}
    good = {i: np.array(v) / np.abs(v).max() for i, v, label in rows
            if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {r[0]: r[2] for r in rows}
    links = [(a, b) for a in good for b in good if a < b and label[a] == label[b] and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.98]
    group = smallest(links, [r[0] for r in rows])
    for i, *_ in rows:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (
            sum(i in link for link in links), group[i], group[i] == i)
    assert grid_join.join(df.limit(0), Work(spark, "none")).count() == 0


def test_pipeline(spark, documents, tmp_path):
    path = str(tmp_path)
    documents.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), []
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{path}/{number}")
        docs = spark.read.parquet(f"{path}/{number}")
        kept.append(docs.count())
        assert docs.columns == columns or number == 4
    assert kept[1] < kept[0] == documents.count() and kept[2] == kept[1] and kept[4] == kept[3]
    assert corpus_pipeline.run(spark, path).count() == kept[4]
