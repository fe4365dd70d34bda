"""Aggregates, published tables, roll-ups and serving on small rows."""

import pytest
from pyspark.sql import functions as F

from forumgauge import schemas
from forumgauge.operators import features, marts, ranking, rollups, serving
from forumgauge.operators.enrich import prepare_words
from forumgauge.plans import pipeline, stored_rollups
from forumgauge.sources import marts as files
from forumgauge.sources.paths import shared_folder, stored

DAY = 86400.0
START = 1704067200.0


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(scope="module")
def sample(posts_of):
    return posts_of(
        {"title": "Internship offer at Google paying $45/hr", "score": 4, "num_comments": 2, "created_utc": START},
        {"title": "Rejected again and feeling hopeless", "score": 1, "num_comments": 0, "created_utc": START + 3600},
        {"title": "Python at Amazon, $120,000 in the office", "score": 10, "num_comments": 7, "created_utc": START + 40 * DAY},
        {"title": "ok", "score": 100, "num_comments": 50, "created_utc": START + 3600},
    ).withColumn("date", F.date_format(F.timestamp_seconds("created_utc"), "yyyy-MM-dd")).cache()


@pytest.fixture(scope="module")
def labels(sample):
    return stored(pipeline.label_posts(sample), "labels")


def test_short_posts_count_only_in_whole_tables(labels):
    metrics = dict(rows_of(marts.network_metrics(labels)))
    assert metrics == {"Total Posts": 4.0, "Total Comments": 59.0, "Avg Score": 28.75, "Avg Comments": 14.75}
    assert pipeline.compute_mart("experience_distribution", labels, ()).agg(F.sum("post_count")).first()[0] == 3


def test_no_posts_give_zero_metrics(labels):
    none = labels.filter("false")
    assert dict(rows_of(marts.network_metrics(none))) == dict.fromkeys(
        ["Total Posts", "Total Comments", "Avg Score", "Avg Comments"], 0.0)
    share = marts.advice_share(none).first()
    assert (share.advice_posts, share.total_posts, share.advice_percentage) == (0, 0, 0.0)


def test_every_hour_is_present(labels):
    hours = rows_of(marts.engagement_by_hour(labels), "hour")
    assert [h[0] for h in hours] == list(range(24))
    assert hours[1] == (1, 2, 50.5, 25.0) and hours[5] == (5, 0, 0.0, 0.0)


def test_sums_agree_between_tables(labels):
    texts = labels.filter("is_text_post")
    total = texts.count()
    assert marts.sentiment_dist(texts).agg(F.sum("count")).first()[0] == total
    assert marts.topic_analysis(texts).agg(F.sum("post_count")).first()[0] >= total
    by_day = marts.topic_analysis(texts, ["date"]).groupBy("topic").agg(F.sum("post_count").alias("post_count"))
    assert rows_of(by_day) == rows_of(marts.topic_analysis(texts).select("topic", "post_count"))


def test_skill_default_only_without_any_skill(labels):
    texts = labels.filter("is_text_post")
    assert ("General Programming", 1) not in rows_of(marts.skills_summary(texts))
    silent = texts.filter(F.size("mentioned_skills") == 0)
    assert rows_of(marts.skills_summary(silent)) == [("General Programming", 1)]
    assert rows_of(marts.skills_summary(labels.filter("false"))) == [("General Programming", 1)]


def test_top_per_group_breaks_ties_by_name(spark):
    table = spark.createDataFrame([("A", "y", 3, 0.0), ("A", "x", 3, 0.0), ("B", "z", 1, 0.0)],
                                  "industry string, advice_category string, post_count bigint, avg_score double")
    assert rows_of(ranking.top_advice_per_industry(table).select("industry", "advice_category")) == [("A", "x"), ("B", "z")]


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_publish_load_and_republish(spark, sample, tmp_path, fmt):
    path = str(tmp_path / "out")
    done = pipeline.publish_all(sample, path, fmt=fmt)
    assert set(done) == set(schemas.MARTS) and all(v is True for v in done.values())
    assert [r.date for r in files.list_dates(spark, path).collect()] == ["2024-01-01", "2024-02-10"]
    for name, ddl in schemas.MARTS.items():
        table = files.load_mart_all_dates(spark, name, path, fmt)
        assert dict(table.dtypes) == {**schemas.fields(ddl), "date": "string"}, name
    before = {n: rows_of(files.load_mart_all_dates(spark, n, path, fmt)) for n in schemas.MARTS}
    pipeline.publish_all(sample.filter("date = '2024-02-10'"), path, fmt=fmt)
    assert {n: rows_of(files.load_mart_all_dates(spark, n, path, fmt)) for n in schemas.MARTS} == before
    assert files.load_mart(spark, "topic_analysis", "1999-01-01", path, fmt).count() == 0
    health = pipeline.mart_health(pipeline.dashboard_tables(spark, path, fmt)).collect()
    assert len(health) == 11 and {r.status for r in health} == {"Healthy"}


def test_publish_of_one_run_takes_the_date_given(spark, sample, tmp_path):
    path = str(tmp_path / "out")
    pipeline.publish_all(sample.drop("date"), path, date="2024-03-03")
    assert [r.date for r in files.list_dates(spark, path).collect()] == ["2024-03-03"]


def state_of(spark, path):
    return {name: rows_of(table) for name, table in pipeline.load_published(spark, path).items()}


def test_a_failing_salary_table_keeps_its_own_state_only(spark, sample, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    pipeline.publish_all(sample, path)
    before = state_of(spark, path)

    def broken(*_):
        raise RuntimeError("no")
    monkeypatch.setitem(pipeline.TEXT_MARTS, "salary_stats", broken)
    more = sample.withColumn("score", F.col("score") + 1)
    done = pipeline.publish_all(more, path)
    assert isinstance(done["salary_stats"], RuntimeError)
    assert all(v is True for n, v in done.items() if n != "salary_stats")
    after = state_of(spark, path)
    assert after["salary_stats"] == before["salary_stats"] and after["network_metrics"] != before["network_metrics"]


def test_another_failing_table_leaves_every_table_as_it_was(spark, sample, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    pipeline.publish_all(sample, path)
    before = state_of(spark, path)

    def broken(labels, by=()):
        # fails in the middle of writing, after some rows
        return marts.topic_analysis(labels, by).withColumn("post_count", F.raise_error(F.lit("no")).cast("bigint"))
    monkeypatch.setitem(pipeline.TEXT_MARTS, "topic_analysis", broken)
    done = pipeline.publish_all(sample.withColumn("score", F.col("score") + 1), path)
    assert isinstance(done["topic_analysis"], Exception) and done["network_metrics"] is True
    assert state_of(spark, path) == before
    monkeypatch.undo()
    assert files.vacuum(spark, path) > 0 and state_of(spark, path) == before
    pipeline.publish_all(sample.withColumn("score", F.col("score") + 1), path)
    assert state_of(spark, path) != before


def test_tables_written_by_other_programs_are_read(spark, tmp_path):
    path = tmp_path / "out"
    for date, text in (("d1", "skill,skill_count\ngo,3\n"), ("d2", "skill_count,skill\n5,rust\n")):
        (path / "skills_summary" / f"date={date}").mkdir(parents=True)
        (path / "skills_summary" / f"date={date}" / "part-0.csv").write_text(text)
    full = spark.createDataFrame([("sql", 1)], "skill string, skill_count bigint")
    files.write_mart(full, "skills_summary", str(path), "d3")
    assert rows_of(files.load_mart_all_dates(spark, "skills_summary", str(path))) == [
        ("go", 3, "d1"), ("rust", 5, "d2"), ("sql", 1, "d3")]
    assert rows_of(files.load_mart(spark, "skills_summary", "d2", str(path)).select("skill", "skill_count")) == [("rust", 5)]
    assert [r.date for r in files.list_dates(spark, str(path)).collect()] == ["d1", "d2", "d3"]
    files.write_mart(full, "skills_summary", str(path), "d1")
    assert rows_of(files.load_mart(spark, "skills_summary", "d1", str(path))) == [("sql", 1, "d1")]


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_empty_table_is_skipped(spark, tmp_path, fmt):
    path = str(tmp_path)
    full = spark.createDataFrame([("a", 1)], "skill string, skill_count bigint")
    assert files.write_mart(full, "skills_summary", path, "2024-01-01", fmt) is True
    assert files.write_mart(full.filter("skill = 'z'"), "skills_summary", path, "2024-01-01", fmt) is False
    assert rows_of(files.load_mart(spark, "skills_summary", "2024-01-01", path, fmt)) == [("a", 1, "2024-01-01")]


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_dates_with_other_columns_are_aligned_by_name(spark, tmp_path, fmt):
    path = str(tmp_path)
    old = spark.createDataFrame([("A", 5, 50000.0)], "industry string, salary_mention_posts bigint, median_salary double")
    new = spark.createDataFrame([(70000.0, "A", 2)], "min_salary double, industry string, salary_mention_posts bigint")
    files.write_mart(old, "salary_stats", path, "d1", fmt)
    files.write_mart(new, "salary_stats", path, "d2", fmt)
    table = files.load_mart_all_dates(spark, "salary_stats", path, fmt)
    got = rows_of(table.select("date", "industry", "salary_mention_posts", "median_salary", "min_salary"))
    assert got == [("d1", "A", 5, 50000.0, None), ("d2", "A", 2, None, 70000.0)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and " text " not in plan
    assert "max_salary" not in table.columns


def test_absent_tables_are_empty_and_critical(spark, tmp_path):
    path = str(tmp_path / "nothing")
    assert files.list_dates(spark, path).count() == 0
    tables = pipeline.dashboard_tables(spark, path)
    assert all(t.count() == 0 for t in tables.values())
    assert {r.status for r in pipeline.mart_health(tables).collect()} == {"Critical"}
    assert serving.dominant_sentiment(tables["sentiment_by_topic"]).first()[0] == "N/A"
    assert serving.metric_value(tables["network_metrics"], "Total Posts").first()[0] == 0
    assert serving.kpi_salary_posts(tables["salary_stats"]).first()[0] == 0


def test_some_tables_missing_is_degraded(spark):
    full, empty = spark.range(1), spark.range(0)
    rows = pipeline.mart_health({"a": full, "b": empty}).collect()
    assert {(r.dataset, r.loaded, r.datasets_loaded, r.total_datasets, r.status) for r in rows} == {
        ("a", True, 1, 2, "Degraded"), ("b", False, 1, 2, "Degraded")}


def test_mean_of_means_and_weighted(spark):
    table = spark.createDataFrame([("t", 1, 10.0, 1.0), ("t", 3, 20.0, None), (None, 9, 1.0, 1.0)],
                                  "topic string, post_count bigint, avg_score double, avg_comments double")
    assert rows_of(rollups.rollup_topic(table)) == [("t", 4, 15.0, 1.0)]
    assert rows_of(rollups.rollup_topic(table, rollups.WEIGHTED)) == [("t", 4, 17.5, 1.0)]
    with pytest.raises(ValueError):
        rollups.rollup_topic(table, "other")


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_stored_rollups_read_only_new_dates(spark, tmp_path, fmt):
    path = str(tmp_path)
    table = spark.createDataFrame(
        [("d1", "A", 5, 1.0, 50000.0, 10.0), ("d1", "B", 1, 4.0, None, 20.0), ("d2", "A", 3, 2.5, 70000.0, 5.0),
         ("d3", None, 9, 9.0, 9.0, 9.0), ("d3", "C", 2, 3.0, 1.0, None)],
        "date string, industry string, salary_mention_posts bigint, avg_comments double, median_salary double, min_salary double")

    def agree(mode=rollups.MEAN_OF_MEANS):
        stored_table = stored_rollups.stored_rollup(spark, path, "salary_stats", fmt, mode)
        whole = rollups.rollup_salary(files.load_mart_all_dates(spark, "salary_stats", path, fmt), mode)
        assert stored_table.columns == whole.columns
        assert rows_of(stored_table) == rows_of(whole)

    read = []
    load = files.load_mart_dates
    stored_rollups.mart_files.load_mart_dates = lambda s, n, dates, *rest: read.append(dates) or load(s, n, dates, *rest)
    try:
        agree()
        files.write_mart(table.filter("date = 'd1'"), "salary_stats", path, fmt=fmt)
        agree()
        files.write_mart(table.filter("date > 'd1'").withColumn("avg_annual_tc", F.lit(1.5)), "salary_stats", path, fmt=fmt)
        agree()
        agree(rollups.WEIGHTED)
        assert read == [[], ["d1"], ["d2", "d3"]]
        files.write_mart(table.filter("date = 'd2'").withColumn("min_salary", F.lit(7.0)), "salary_stats", path, fmt=fmt)
        agree()
        assert read[3:] == [["d1", "d2", "d3"]]
    finally:
        stored_rollups.mart_files.load_mart_dates = load
    with pytest.raises(ValueError):
        stored_rollups.stored_rollup(spark, path, "salary_stats", fmt, "other")


def test_stored_rollup_of_every_table_equals_the_whole_one(spark, sample, tmp_path):
    path = str(tmp_path / "out")
    pipeline.publish_all(sample.filter("date = '2024-01-01'"), path)
    for name in schemas.MARTS:
        stored_rollups.update(spark, path, name)
    pipeline.publish_all(sample.filter("date > '2024-01-01'"), path)
    for name, table in pipeline.load_published(spark, path).items():
        assert rows_of(stored_rollups.stored_rollup(spark, path, name)) == rows_of(rollups.ROLLUPS[name](table)), name


def test_median_over_dates_is_the_median_of_all_mentions(spark, tmp_path):
    import random

    rng = random.Random(3)
    rows = [(f"d{rng.randrange(5)}", "ABC"[i % 3], rng.choice([30000.0, 50000.5, 99999.99, 1e6, float(rng.randrange(30000, 10**6))]),
             rng.randint(1, 4)) for i in range(600)] + [("d1", "one", 5e4, 1), ("d1", "same", 7e4, 2), ("d2", "same", 7e4, 5), ("d2", None, 1e5, 1)]
    table = spark.createDataFrame(rows, "date string, industry string, pay double, mentions bigint")
    files.write_mart(table, "salary_histogram", str(tmp_path), fmt="parquet")
    got = rollups.rollup_salary_median(files.load_mart_all_dates(spark, "salary_histogram", str(tmp_path), "parquet"))
    values = {}
    for _, industry, pay, n in rows:
        values.setdefault(industry, []).extend([pay] * n)
    wanted = [(k, float(len(v)), sorted(v)[len(v) // 2]) for k, v in values.items() if k]
    assert rows_of(got.select("industry", F.col("mentions").cast("double"), "median_salary")) == sorted(wanted)


def test_densify_fills_counts_but_not_averages(spark):
    table = spark.createDataFrame([("2024-01", "Positive", 2, 5.0, 1.0), ("2024-02", "Neutral", 1, 3.0, 0.0)],
                                  "year_month string, sentiment string, post_count bigint, avg_score double, avg_comments double")
    dense = rollups.densify_temporal(table)
    assert dense.count() == 6
    assert rows_of(dense.filter("year_month = '2024-01' and sentiment = 'Negative'")) == [
        ("2024-01", "Negative", 0, None, None)]
    assert rows_of(serving.monthly_avg_score(dense)) == [("2024-01", 5.0), ("2024-02", 3.0)]


def test_dominant_sentiment_prefers_the_earlier_on_ties(spark):
    table = spark.createDataFrame([("Neutral", 4), ("Negative", 4), ("Positive", 1)], "sentiment string, count bigint")
    assert serving.dominant_sentiment(table).first()[0] == "Negative"


def test_salary_ranges_and_display(spark):
    table = spark.createDataFrame(
        [("A", 3, 1.0, 2.0, 100.0, 120.0, 90.0), ("B", 5, 1.0, 2.0, None, 1.0, 2.0), ("C", 1, 1.0, 2.0, 100.0, None, 110.0)],
        "industry string, salary_mention_posts bigint, avg_engagement_score double, avg_comments double, "
        "avg_annual_tc double, min_salary double, max_salary double")
    got = rows_of(serving.salary_ranges(table).select("industry", "err_plus", "err_minus"))
    assert got == [("A", 0.0, 0.0), ("C", 10.0, None)]
    shown = serving.salary_display(table.drop("min_salary"))
    assert shown.columns == ["Industry", "Posts w/ Salary", "Average Salary ($)", "Max ($)", "Avg Score", "Avg Comments"]
    assert [r[0] for r in shown.collect()] == ["B", "A", "C"]


def test_term_counts_agree_with_the_vectors(posts_of):
    posts = prepare_words(posts_of({"title": "apple apple banana tree"}, {"title": "banana bread with seeds"}))
    counted, model = features.term_vectors(posts, 3)
    assert model.vocabulary == ["apple", "banana", "bread"]
    counts = rows_of(features.term_counts(posts, 3), "id", "index")
    assert counts == [("0", 0, "apple", 2), ("0", 1, "banana", 1), ("1", 1, "banana", 1), ("1", 2, "bread", 1)]
    weighted, _ = features.tfidf_vectors(counted)
    dense = {r.id: r.features.toArray() for r in weighted.collect()}
    for row in features.tfidf_weights(posts, 3).collect():
        assert dense[row.id][row["index"]] == pytest.approx(row.weight)


def test_bags_count_each_term_of_a_post(spark):
    posts = spark.createDataFrame([("a", ["x", "b", "x", "", "x"]), ("b", []), ("c", None), ("d", ["q"])], "id string, filtered_words array<string>")
    assert rows_of(features.term_bags(posts), "id") == [
        ("a", ["", "b", "x"], [1, 1, 3]), ("b", [], []), ("c", [], []), ("d", ["q"], [1])]
    assert rows_of(features.bag_vocabulary(features.term_bags(posts), 2)) == rows_of(features.vocabulary(posts, 2))


def test_texts_are_read_once_for_weights(spark, posts_of):
    posts = prepare_words(posts_of({"title": "apple apple banana tree"}, {"title": "banana bread with seeds"}))
    for table in (features.term_counts(posts, 3), features.tfidf_weights(posts, 3)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "title" not in plan and "FileScan" in plan


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
