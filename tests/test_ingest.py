"""Collection steps, the raw layer and the streaming job."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from forumgauge.operators import ingest
from forumgauge.plans import collection as C
from forumgauge.sources import raw
from forumgauge.sources.commits import CommitLog
from forumgauge.sources.registry import Registry
from forumgauge.streaming.collection import start_collection, start_deduplication


def post(id_, title="t", **more):
    return {"data": {"id": id_, "title": title, "score": 1, "created_utc": 1.5, "num_comments": 2,
                     "url": "u", **more}}


def page(*children, after=None):
    return json.dumps({"data": {"children": list(children), "after": after}})


def landed(source, listing, number, payload, day=1):
    return {"payload": payload, "subreddit": source, "listing": listing, "page": number,
            "fetched_at": f"2024-05-{day:02d}T08:00:00Z"}


def test_flatten_fills_missing_bodies_and_keeps_positions(spark):
    pages = spark.createDataFrame([(page(post("a"), post("b", selftext="x")), "s"), (page(), "s")],
                                  "payload string, subreddit string")
    rows = ingest.flatten_listing(raw.parse_listings(pages)).orderBy("position").collect()
    assert [(r.id, r.selftext, r.position, r.subreddit) for r in rows] == [("a", "", 0, "s"), ("b", "x", 1, "s")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_occurrence_with_one_very_frequent_key(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("id"), F.col("id").alias("n"))
    rest = spark.range(50).select(F.col("id").cast("string"), F.col("id").alias("n"))
    first = ingest.first_occurrence(hot.unionByName(rest).repartition(8), "id", {"n": 40})
    got = first.collect()
    assert len(got) == 51 and {r.n for r in got if r.id == "hot"} == {0}
    assert "SortAggregate" not in plan_of(first) and "HashAggregate" in plan_of(first)


def test_dedup_follows_source_then_listing_then_position(spark):
    rows = [("a", 2, 1, 0, 0, "late"), ("a", 1, 2, 0, 5, "listing"), ("a", 1, 1, 1, 0, "page"),
            ("a", 1, 1, 0, 3, "position"), ("a", 1, 1, 0, 2, "first"), (None, 1, 1, 0, 0, "nameless"), (None, 0, 1, None, 0, "second")]
    posts = spark.createDataFrame(rows, "id string, source_rank int, listing_rank int, page int, position int, t string")
    assert sorted(r.t for r in ingest.dedup_first_listing(posts).collect()) == ["first", "second"]


def test_nulls_come_first_and_equal_orders_give_one_row(spark):
    rows = [("a", None, "none"), ("a", 0, "zero"), ("b", 4, "x"), ("b", 4, "y"), ("b", 4, "y"), ("c", 7, "z"), ("c", 7, "z")]
    posts = spark.createDataFrame(rows, "id string, n int, t string").repartition(3)
    got = [{r.id: r.t for r in ingest.first_occurrence(posts, "id", {"n": 4}).collect()} for _ in range(2)]
    assert got[0] == got[1] and got[0]["a"] == "none" and got[0]["c"] == "z" and len(got[0]) == 3


def test_orders_that_do_not_fit_end_the_query(spark):
    posts = spark.createDataFrame([("a", 15)], "id string, n int")
    with pytest.raises(Exception, match="does not fit 4 bits"):
        ingest.first_occurrence(posts, "id", {"n": 4}).collect()
    with pytest.raises(ValueError):
        ingest.packed({"a": 40, "b": 23})


def test_registry(spark):
    posts = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    registry = spark.createDataFrame([("a",), ("z",)], "id string")
    assert [r.id for r in ingest.dedup_new_posts(posts.distinct(), registry).collect()] == ["b"]
    updated = ingest.update_registry(registry, posts)
    assert sorted(r.id for r in updated.collect()) == ["a", "b", "z"]
    assert ingest.registry_size(updated).first().tracked_ids == 3


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)


def exchanges_above(plan, leaf):
    """Exchanges on the way from a leaf of a plan up to the join that reads it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if leaf in line)
    depth, found = lines[at].index(leaf), []
    for line in reversed(lines[:at]):
        name = line.lstrip(" :+-*(0123456789)")
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            depth = here
            if "Join" in name:
                break
            found += [name] if name.startswith(("Exchange", "BroadcastExchange")) else []
    return found


def test_the_registry_store_never_moves(spark, tmp_path):
    store = Registry(spark, str(tmp_path / "store"), buckets=6)
    assert store.read().count() == 0
    store.add(spark.range(0, 300).select(F.col("id").cast("string")), 1)
    store.add(spark.range(300, 500).select(F.col("id").cast("string")), 2)
    posts = spark.range(400, 700).select(F.col("id").cast("string"), F.lit(0).alias("n"))
    no_broadcast(spark)
    try:
        new = ingest.first_of_new(posts, store.read(), {"n": 4})
        found = new.collect()
        plan = plan_of(new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(int(r.id) for r in found) == list(range(500, 700))
    scan = next(line for line in plan.splitlines() if "forumgauge_registry" in line)
    assert "Bucketed: true" in scan or "SelectedBucketsCount" in scan
    assert exchanges_above(plan, "FileScan parquet spark_catalog") == []


def test_runs_are_replaced_compacted_and_read_by_another_session(spark, tmp_path):
    path = str(tmp_path / "store")
    store = Registry(spark, path, buckets=3)

    def ids(lo, hi):
        return spark.range(lo, hi).select(F.col("id").cast("string"))

    def held(registry, **options):
        return sorted(int(r.id) for r in registry.read(**options).collect())

    for run in range(4):
        store.add(ids(run * 10, run * 10 + 10), run)
    store.add(ids(30, 35), 3)
    assert held(store) == list(range(35)) and held(store, before_run=3) == list(range(30))
    store.compact(keep_run=3)
    assert sorted(store.segments().values(), key=str) == ["3", None]
    assert held(store) == list(range(35)) and held(store, before_run=3) == list(range(30))
    store.add(ids(30, 42), 3)
    other = Registry(spark.newSession(), path)
    assert held(other) == list(range(42))
    store.compact()
    assert held(store) == held(other) == list(range(42)) and len(store.segments()) == 1
    folders = [p.name for p in (tmp_path / "store" / "ids").iterdir() if p.name.startswith("segment=")]
    assert folders == [f"segment={name}" for name in store.segments()]


def test_many_runs_are_written_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("forumgauge.sources.registry.MOST_SEGMENTS", 3)
    store = Registry(spark, str(tmp_path / "store"), buckets=2)
    for run in range(5):
        store.add(spark.createDataFrame([(str(run),)], "id string"), run)
    assert len(store.segments()) <= 3 and sorted(r.id for r in store.read().collect()) == list("01234")


def test_a_number_is_given_out_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() is None
    other = CommitLog(spark, str(tmp_path / "log"))
    turns = []

    def slow(before):
        if not turns:
            turns.append(1)
            other.change(lambda b: {"by": ["other"]})
        return {"by": [*(before or {"by": []})["by"], "slow"]}

    assert log.change(slow)["by"] == ["other", "slow"]
    assert log.latest() == {"by": ["other", "slow"], "number": 1}
    for i in range(5):
        log.change(lambda before, i=i: {"by": [i]})
    assert len(log.numbers()) == 2 and log.latest()["by"] == [4]
    assert not log.folder.create(f"{log.numbers()[-1]:012d}.json", "{}")


def test_audit(spark):
    posts = spark.createDataFrame([("a", "2024-05-01"), ("b", "2024-05-01")], "id string, date string")
    row = ingest.collection_audit(posts, ["s1", "s2"], ["new"], datetime(2024, 5, 1, 9)).first()
    assert (row.collection_date, row.subreddits, row.listings, row.total_posts) == ("2024-05-01", ["s1", "s2"], ["new"], 2)


def test_read_posts_of_a_json_array_file(spark, tmp_path):
    folder = tmp_path / "date=2024-05-01"
    folder.mkdir()
    records = [{**post(i)["data"], "selftext": "", "subreddit": "s"} for i in ("a", "b")]
    (folder / "posts.json").write_text(json.dumps(records, indent=1))
    got = raw.read_posts(spark, str(tmp_path), layout="array")
    assert sorted((r.id, r.date) for r in got.collect()) == [("a", "2024-05-01"), ("b", "2024-05-01")]
    with pytest.raises(ValueError):
        raw.read_posts(spark, str(tmp_path), layout="xml")


def test_arrays_hold_as_many_posts_as_asked(spark, posts_of, tmp_path):
    path = str(tmp_path / "raw")
    posts = posts_of(*({"id": str(i), "title": f"t {i}, \n\"quoted\"", "url": None} for i in range(25))).withColumn(
        "date", F.when(F.col("id").cast("int") < 20, "d1").otherwise("d2")).coalesce(1)
    raw.write_posts(posts, path, layout="array", per_array=8)
    files = sorted((tmp_path / "raw").glob("date=*/part-*"))
    assert sorted(len(json.loads(f.read_text())) for f in files) == [1, 4, 4, 8, 8]
    got = raw.read_posts(spark, path, layout="array")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, posts.select(*got.columns).collect()))


def test_a_small_date_is_one_file(spark, posts_of, tmp_path):
    posts = posts_of(*({"id": str(i)} for i in range(40))).withColumn("date", F.lit("d")).repartition(8)
    raw.write_posts(posts, str(tmp_path / "raw"))
    assert len(list((tmp_path / "raw").glob("date=d/part-*"))) == 1


def test_read_posts_of_lines_arrays_and_bad_records(spark, tmp_path):
    folder = tmp_path / "date=2024-05-02"
    folder.mkdir()
    a, b, c = ({**post(i)["data"], "subreddit": "s"} for i in "abc")
    (folder / "posts.json").write_text("\n".join([json.dumps(a), "{broken", json.dumps([b, c])]))
    assert sorted(r.id for r in raw.read_posts(spark, str(tmp_path)).collect()) == ["a", "b", "c"]
    assert raw.read_posts(spark, str(tmp_path), date="2024-05-03").count() == 0


def test_rewriting_a_date_leaves_other_dates(spark, posts_of, tmp_path):
    path = str(tmp_path / "raw")
    raw.write_posts(posts_of({"id": "a"}).withColumn("date", F.lit("d1")), path)
    raw.write_posts(posts_of({"id": "b"}).withColumn("date", F.lit("d2")), path)
    raw.write_posts(posts_of({"id": "c"}).withColumn("date", F.lit("d2")), path)
    assert sorted((r.id, r.date) for r in raw.read_posts(spark, path).collect()) == [("a", "d1"), ("c", "d2")]


@pytest.fixture
def job(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    conf = C.Collection(*(str(tmp_path / n) for n in ("raw", "registry", "audit")), sources=("s1", "s2"))

    def land(name, *rows):
        (landing / name).write_text("\n".join(json.dumps(r) for r in rows))

    def run():
        start_collection(spark, str(landing), conf, str(tmp_path / "checkpoint")).awaitTermination()
    return conf, land, run


def test_streaming_collection(spark, job):
    conf, land, run = job
    land("1.json", landed("s2", "new", 0, page(post("a", "from s2"), post("b"))),
         landed("s1", "top", 0, page(post("a", "from s1"), post("a", "again"), post("c"))))
    run()
    first = {r.id: r.title for r in raw.read_posts(spark, conf.raw_path).collect()}
    assert first == {"a": "from s1", "b": "t", "c": "t"}
    land("2.json", landed("s1", "new", 0, page(post("c", "known"), post("d")), day=2))
    run()
    got = raw.read_posts(spark, conf.raw_path)
    assert sorted((r.id, r.date) for r in got.collect()) == [
        ("a", "2024-05-01"), ("b", "2024-05-01"), ("c", "2024-05-01"), ("d", "2024-05-02")]
    assert sorted(r.id for r in Registry(spark, conf.registry_path).read().collect()) == ["a", "b", "c", "d"]
    audit = spark.read.parquet(conf.audit_path).orderBy("collection_date").collect()
    assert [(r.collection_date, r.total_posts) for r in audit] == [("2024-05-01", 3), ("2024-05-02", 1)]


def test_repeating_a_run_changes_nothing(spark, job):
    conf, _, _ = job
    pages = spark.createDataFrame(
        [(page(post("a"), post("b")), "s1", "new", 0, datetime(2024, 5, 1))], C.LANDED_PAGE)
    for _ in range(2):
        C.run_collection(pages, conf, 7)
        assert sorted(r.id for r in raw.read_posts(spark, conf.raw_path).collect()) == ["a", "b"]
        assert Registry(spark, conf.registry_path).read().count() == 2
        assert spark.read.parquet(conf.audit_path).count() == 1


def test_a_run_without_new_posts_writes_none(spark, job):
    conf, _, _ = job
    pages = spark.createDataFrame([(page(post("a")), "s1", "new", 0, datetime(2024, 5, 1))], C.LANDED_PAGE)
    C.run_collection(pages, conf, 1)
    C.run_collection(pages, conf, 2)
    assert raw.read_posts(spark, conf.raw_path).count() == 1
    assert spark.read.parquet(conf.audit_path).count() == 1


def test_a_first_run_without_posts_leaves_empty_tables(spark, job):
    conf, _, _ = job
    pages = spark.createDataFrame([(page(), "s1", "new", 0, datetime(2024, 5, 1))], C.LANDED_PAGE)
    C.run_collection(pages, conf, 0)
    assert Registry(spark, conf.registry_path).read().count() == 0
    pages = spark.createDataFrame([(page(post("a")), "s1", "new", 0, datetime(2024, 5, 1))], C.LANDED_PAGE)
    C.run_collection(pages, conf, 1)
    assert [r.id for r in raw.read_posts(spark, conf.raw_path).collect()] == ["a"]


def test_deduplicating_stream_with_repeated_and_late_ids(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    conf = C.Collection(*(str(tmp_path / n) for n in ("raw", "registry", "audit")), sources=("s1",))

    def batch(name, *rows):
        (landing / name).write_text("\n".join(json.dumps(r) for r in rows))
        start_deduplication(spark, str(landing), conf, str(tmp_path / "checkpoint"), within="2 days").awaitTermination()
        return sorted((r.id, r.date) for r in raw.read_posts(spark, conf.raw_path).collect())

    first = batch("1.json", landed("s1", "new", 0, page(post("a"), post("b"), post("a")), day=1),
                  landed("s1", "top", 0, page(post("b")), day=1))
    assert first == [("a", "2024-05-01"), ("b", "2024-05-01")]
    second = batch("2.json", landed("s1", "new", 0, page(post("a", "again"), post("c")), day=2))
    assert second == [*first, ("c", "2024-05-02")]
    # Day 9 moves the watermark to day 7: day 1 is late then, and a's state is gone.
    third = batch("3.json", landed("s1", "new", 0, page(post("d")), day=9))
    fourth = batch("4.json", landed("s1", "new", 0, page(post("late")), day=1), landed("s1", "new", 1, page(post("d"), post("e")), day=9))
    assert fourth == [*third, ("e", "2024-05-09")] and ("d", "2024-05-09") in third
    held = Registry(spark, conf.registry_path).read()
    assert sorted(r.id for r in held.collect()) == list("abcde")
    assert sum(r.total_posts for r in spark.read.parquet(conf.audit_path).collect()) == 5


def test_pages_are_numbered_along_their_chain(spark):
    rows = [("s", None, f"t{0}")] + [("s", f"t{i}", f"t{i + 1}") for i in range(9)] + [("s", "t9", None)]
    rows += [(None, None, "x"), (None, "x", "y"), ("u", None, None), ("u", None, None),
             ("lost", "p", "q"), ("lost", "q", "r"), ("ring", "k", "l"), ("ring", "l", "k")]
    pages = spark.createDataFrame(rows, "subreddit string, asked_after string, after string").withColumns(
        {"listing": F.lit("new"), "note": F.lit("kept")})
    got = sorted(((r.subreddit or "", r.asked_after or "", r.page) for r in ingest.number_pages(pages).collect()), key=repr)
    wanted = [("s", "", 0)] + [("s", f"t{i}", i + 1) for i in range(10)] + [
        ("", "", 0), ("", "x", 1), ("u", "", 0), ("u", "", 0), ("lost", "p", None), ("lost", "q", None), ("ring", "k", None), ("ring", "l", None)]
    assert got == sorted(wanted, key=repr)
    assert ingest.number_pages(pages.limit(0)).count() == 0


@pytest.fixture
def supplied(spark, tmp_path):
    """A folder of small supplied tables: 50 documents in one file, two of them with one key, and five pages."""
    from forumgauge.sources import tables

    rows = {
        "documents": [(i % 49, f"text {i}", "en", f"src{i % 2}", 6) for i in range(50)],
        "pages": [(i, f"http://a/{i}", "<p>") for i in range(5)],
        "benchmark": [(1, "item")],
        "events": [],
    }
    for name, found in rows.items():
        spark.createDataFrame(found, tables.SCHEMAS[name]).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_texts_are_dealt_out_by_their_number(spark, supplied, monkeypatch):
    from forumgauge.sources import tables

    monkeypatch.setattr(tables, "PER_TASK", 2)
    texts = tables.post_texts(spark, supplied)
    assert "hashpartitioning(doc_id" in (plan := texts._jdf.queryExecution().executedPlan().toString())
    assert ", 25), REPARTITION_BY_NUM" in plan
    assert texts.count() == 56


def test_pages_of_all_listings_are_put_together_once(spark, supplied):
    from forumgauge.sources import tables

    landed = tables.landed_pages(spark, supplied)
    assert landed._jdf.queryExecution().executedPlan().toString().count("ReadSchema: struct<doc_id:bigint,text:string,") == 1
    new = {(r.subreddit, r.page): r.payload for r in landed.where("listing = 'new'").collect()}
    top = {(r.subreddit, r.page): r.payload for r in landed.where("listing = 'top'").collect()}
    assert set(top) == {key for key in new if key[1] % 2 == 0} and len(new) == 12
    assert all(top[key] == new[key].replace('"score":0', '"score":1') for key in top)


def test_chosen_rows_stay_where_the_join_put_them(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("a", 0, "z"), (None, 3, "n"), (None, 4, "m"), ("b", 2, "w")],
                                 "id string, page int, title string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        first = ingest.first_occurrence(rows, "id", {"page": 30})
        above_join = first._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
        assert "Window" in above_join and "Exchange" not in above_join
        found = {r.id: r.title for r in first.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(found) == {"a", "b", None} and found["a"] in "yz" and (found["b"], found[None]) == ("w", "n")
