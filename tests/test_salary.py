"""Pay mentions and their statistics."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from forumgauge.functions.salary import annual_pays, bounded_pay, salary_mentions
from forumgauge.operators import salary, tagging


def found(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(salary_mentions(F.col("t")).alias("m"))
    row = df.select("m", annual_pays(F.col("m")).alias("p")).select(
        "m", "p", F.filter(F.transform("p", lambda v: bounded_pay(v)), lambda v: v.isNotNull()).alias("b")).first()
    return row.m, row.p, row.b


@pytest.mark.parametrize("text, in_range", [
    ("$120,000", [120000.0]), ("120,000", [120000.0]), ("120k", [120000.0]), ("$120k", [120000.0]),
    ("$120000", [120000.0]), ("120000", []), ("in 2024", []), ("1,000", []), ("2,000 applications", []),
    ("85,000.50", [85000.5]), ("$85,000.50", [85000.5]), ("$45/hr", [93600.0]), ("45 per hour", [93600.0]),
    ("$45.50 an hour", [94640.0]), ("45/h", [93600.0]), ("45/HOUR", [93600.0]), ("45/hundred", []),
    ("1000/hr", []), ("1,000/hr", []), ("1000.50/hr", []), ("$2,500 per hour", []), ("100km run", []),
    ("120kb file", []), ("$120.5k", [120500.0]), ("85.5k", [85500.0]), ("120,0000", []), ("401k match", []),
    ("403b", []), ("$401k", [401000.0]), ("0/hr", []), ("v1.120k", []), ("95,000.", [95000.0]), (None, []), ("", []), ("no digits", []), ("$95,000 vs $110k", [95000.0, 110000.0]),
    ("120K base", [120000.0]), ("2000k", []), ("$1,000,000", [1000000.0]), ("$30,000", [30000.0]),
    ("$29,999", []), ("a120k", []), ("é120k", []), ("US$120k", [120000.0])])
def test_pay_in_range(spark, text, in_range):
    assert found(spark, text)[2] == in_range


@pytest.mark.parametrize("text, mentions, pays", [
    ("$150k, or $60/hr", ["60h", "150k"], [124800.0, 150000.0]),
    ("2,000 applications", ["2,000"], [2000.0]),
    ("1,000 applications", [], []),
    ("$1,000 stipend", ["1,000"], []),
    ("$45/hr", ["45h"], [93600.0]), ("1,000.50/hr", ["1,000.50h"], [2081040.0]), ("0/hr", ["0h"], [])])
def test_raw_mentions_and_pay(spark, text, mentions, pays):
    got = found(spark, text)
    assert (got[0], got[1]) == (mentions, pays)


def test_hours_per_year(spark):
    df = spark.createDataFrame([("$50/hr",)], "full_text string")
    assert tagging.tag_salaries(df, hours_per_year=2000).first().salaries == [100000.0]


def posts(spark, rows):
    return spark.createDataFrame(rows, "id string, date string, score bigint, num_comments bigint, "
                                       "industries array<string>, salaries array<double>")


def brute_force(rows, by_date):
    groups = defaultdict(list)
    for id_, date, score, comments, industries, pays in rows:
        for industry in industries:
            for pay in pays:
                groups[(date, industry) if by_date else (industry,)].append((id_, score, comments, pay))
    result = {}
    for key, found in groups.items():
        kept = sorted(p for *_, p in found if 30000 <= p <= 1000000)
        result[key] = (len(found), len({i for i, *_ in found}), sum(s for _, s, _, _ in found) / len(found),
                       sum(c for _, _, c, _ in found) / len(found),
                       sum(kept) / len(kept) if kept else None, kept[len(kept) // 2] if kept else None,
                       kept[0] if kept else None, kept[-1] if kept else None)
    return result


@pytest.mark.parametrize("by_date", [False, True])
def test_statistics_equal_brute_force(spark, by_date):
    rng = random.Random(5)
    industries = ["A", "B", "C", "D"]
    rows = []
    for i in range(400):
        pays = [float(rng.choice([2000, 29999.99, 30000, 50000, 93600, 120000, 120000.5, 999999, 1000000, 1000001,
                                  rng.randint(30000, 200000)])) for _ in range(rng.randint(0, 3))]
        # One label holds far more posts than the others.
        labels = ["A"] + rng.sample(industries[1:3], rng.randint(0, 2))
        rows.append((str(i), rng.choice(["d1", "d2"]), rng.randint(-5, 50), rng.randint(0, 9), labels, pays))
    rows.append(("low", "d1", 1, 1, ["D"], [2000.0]))
    keys = ["date", "industry"] if by_date else ["industry"]
    table = salary.salary_table(posts(spark, rows), ["date"] if by_date else [])
    got = {tuple(r[k] for k in keys): tuple(r)[len(keys):] for r in table.collect()}
    want = brute_force(rows, by_date)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key]), key


def test_even_group_takes_the_upper_middle(spark):
    rows = [(str(i), "d", 0, 0, ["A"], [p]) for i, p in enumerate([40000.0, 50000.0, 60000.0, 70000.0])]
    assert salary.salary_order_stats(posts(spark, rows)).first().median_salary == 60000.0


def test_no_mentions_gives_a_typed_empty_table(spark):
    table = salary.salary_table(posts(spark, [("1", "d", 0, 0, ["A"], [])]))
    assert table.count() == 0
    assert dict(table.dtypes)["median_salary"] == "double"
