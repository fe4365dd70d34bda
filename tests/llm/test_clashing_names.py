"""Columns of the caller that are named like an operator's own change nothing and stay as they are."""

import pytest
from pyspark.sql import functions as F

from forumgauge.llm import bpe, classifier, mixing, near_duplicates, quality_rules, repeats, secrets
from forumgauge.llm.queries import tokenizer_path
from forumgauge.llm.tables import Work

NAMES = "size taken spans kept key doc text2 evidence_low evidence_toxic posterior_low host path n_words rank block skey part a b".split()


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(r[0] % 3 > 0), int(r[0] % 7 == 0)) for r in rows], "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "plan": lambda docs, labels, work: mixing.plan(docs, work)[0],
    "mix": lambda docs, labels, work: mixing.mix(docs, work),
    "remove": lambda docs, labels, work: repeats.remove(docs, work),
    "groups": lambda docs, labels, work: near_duplicates.groups(docs, work),
    "filtered": lambda docs, labels, work: classifier.filtered(docs, labels, work),
    "classify": lambda docs, labels, work: classifier.classify(docs, labels, work),
    "redact": lambda docs, labels, work: secrets.redact(docs, formats=secrets.learn(work.keep(secrets.found(docs), "found"))),
    "encode": lambda docs, labels, work: bpe.encode(docs, tokenizer_path()),
    "judge": lambda docs, labels, work: quality_rules.judge(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_change_nothing(spark, documents, labels, name):
    plain = OPERATORS[name](documents, labels, Work(spark, "plain"))
    named = documents.withColumns({c: F.lit(f"own {c}") for c in NAMES})
    got = OPERATORS[name](named, labels, Work(spark, "named"))
    passed = [c for c in NAMES if c in got.columns and c not in plain.columns]
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    if passed:
        assert passed == NAMES
        assert [tuple(r) for r in got.select(*passed).distinct().collect()] in ([tuple(f"own {c}" for c in NAMES)], [])


def test_one_key_in_two_sources_is_two_documents(spark):
    rows = [(1, "a " * 50, "s"), (1, "b " * 50, "t"), (2, "c " * 30, "s"), (2, "d " * 30, None)] * 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = {(r.doc_id, r.source): r.taken for r in mixing.plan(docs, Work(spark, "plan"))[0].collect()}
    held = {}
    for r in mixing.mix(docs, Work(spark, "mix")).collect():
        held[r.doc_id, r.source] = held.get((r.doc_id, r.source), 0) + len(r.text.split())
    assert held == {k: n for k, n in taken.items() if n}
