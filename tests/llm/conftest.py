import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and to in tea pot lid cup milk spoon table leaf green black water steam kettle".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * (rng.random() < 0.6) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(60)]
    passage = prose(rng, 70)
    long_text = prose(rng, 9000)
    texts += [texts[3], texts[3], texts[3], texts[5].upper(), None, "", " \t\n", "a", "a b", "a b", "a b c d"]
    for i in (10, 11, 12):
        words = texts[i].split()
        for _ in range(4):
            at = rng.randrange(max(1, len(words)))
            texts.append(" ".join(words[:at] + ["edited"] + words[at + 1:]))
    texts += [prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30) for _ in range(5)]
    texts += [long_text, long_text + " end", passage + " " + passage, "naïve café £5 日本語 text\x1cwith\x85odd spaces"]
    sources = [None, "a", "b", "hot", "hot", "hot"]
    out = [(i, t, ("en", None, "fr")[i % 3], sources[i % 6], None) for i, t in enumerate(texts)]
    return out


@pytest.fixture(scope="session")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def work(spark):
    from forumgauge.llm.tables import Work

    return Work(spark, "test")
