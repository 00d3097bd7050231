"""Streams against batch, repeated batches, late data and replay."""

import json
import random
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.operators.compare import difference
from tidemark.operators.events import WATERMARK, dedupe_events
from tidemark.operators.funnel import product_funnel
from tidemark.operators.sessions import session_metrics, user_sessions
from tidemark.operators.users import user_360, user_state
from tidemark.plans import metrics, replay
from tidemark.session import streaming_session, work_path
from tidemark.sources.logs import read_text
from tidemark.sources.tables import read_lake
from tidemark.streaming import jobs, sinks

START = datetime(2024, 1, 1)
DELAY = timedelta(seconds=5)


def line(i, at, kind="page_view", user="U1", session="S1", product="P1", **metadata):
    return json.dumps({
        "event_id": str(i), "event_type": kind, "user_id": user, "session_id": session, "product_id": product,
        "timestamp": at.isoformat(sep=" ", timespec="milliseconds"), "metadata": metadata})


@pytest.fixture(scope="module")
def log(tmp_path_factory):
    """Four files of events in time order, with some garbage."""
    rng = random.Random(11)
    folder = tmp_path_factory.mktemp("log")
    times = sorted(rng.randrange(20 * 3600 * 1000) for _ in range(400))
    lines = [
        line(i, START + timedelta(milliseconds=t), rng.choice(["page_view", "add_to_cart", "purchase", "signup"]),
             f"U{rng.randrange(5)}", f"S{rng.randrange(4)}", rng.choice(["P1", "P2", None]), page=f"/{i}")
        for i, t in enumerate(times)
    ]
    for n in range(4):
        path = folder / f"part-{n}.txt"
        path.write_text("\n".join([*lines[n * 100:(n + 1) * 100], "garbage"]) + "\n")
        time.sleep(0.02)
    return str(folder)


def stream(spark, path):
    return read_text(streaming_session(spark), path, streaming=True, maxFilesPerTrigger="1")


def drain(job, source, root, **options):
    running = job(source, root, f"{root}/checkpoint", trigger=jobs.DRAIN, **options)
    running.awaitTermination()
    return running


def batch_events(spark, path):
    return jobs.window_events(read_text(spark, path))


def closed(df, events, column):
    watermark = events.agg(F.max("event_timestamp")).first()[0] - DELAY
    return df.where(F.col(column) <= F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz"))


def test_streamed_sessions_equal_batch(spark, log, tmp_path):
    root = str(tmp_path)
    drain(jobs.start_sessions, jobs.window_events(stream(spark, log)), root)
    events = batch_events(spark, log)
    expected = closed(session_metrics(events), events, "session_end")
    gold = read_lake(spark, f"{root}/gold/session_metrics", contracts.load("gold.session_metrics"))
    silver = read_lake(spark, f"{root}/silver/user_sessions", contracts.load("silver.user_sessions"))
    assert expected.count() > 50
    assert difference(gold, expected).count() == 0
    assert difference(silver, user_sessions(expected)).count() == 0
    serving = sinks.read_serving(spark, f"{root}/serving/session_metrics", ["session_id"], jobs.SESSION_ORDER)
    best = expected.groupBy("session_id").agg(F.max("session_end").alias("session_end"))
    assert serving.count() == best.count() == serving.join(best, ["session_id", "session_end"]).count()
    assert dict(serving.dtypes)["event_count"] == "int"
    users = jobs.read_user_360(spark, root)
    assert difference(users, user_360(user_state(gold))).count() == 0
    refreshed = spark.read.parquet(replay.refresh_user_360(spark, root))
    assert difference(refreshed, users).count() == 0


def test_streamed_funnel_equals_batch(spark, log, tmp_path):
    root, size = str(tmp_path), timedelta(minutes=10)
    drain(jobs.start_funnel, jobs.window_events(stream(spark, log)), root, size=size)
    events = batch_events(spark, log)
    expected = closed(product_funnel(events, size), events, "window_end")
    gold = read_lake(spark, f"{root}/gold/product_funnel_1m", contracts.load("gold.product_funnel_1m"))
    assert difference(gold, expected).count() == 0
    assert gold.where("product_id is null").count() > 0
    serving = sinks.read_serving(
        spark, f"{root}/serving/product_funnel_1m", ["product_id", "window_start"], ["window_end"])
    assert difference(serving.select(*expected.columns), expected.where("product_id is not null")).count() == 0


def test_a_restarted_query_goes_on(spark, log, tmp_path):
    """Files that arrive later are picked up by the same checkpoint, nothing twice."""
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n in range(4):
        (source / f"{n}.txt").write_text(open(f"{log}/part-{n}.txt").read())
        drain(jobs.start_bronze, stream(spark, str(source)), root)
    bronze = read_lake(spark, f"{root}/bronze/raw_events", contracts.load("bronze.raw_events"))
    assert bronze.count() == bronze.select("event_id").distinct().count() == 400


def test_validated_and_rejected_cover_the_log(spark, log, tmp_path):
    root = str(tmp_path)
    drain(jobs.start_validated, stream(spark, log), root)
    good = read_lake(spark, f"{root}/silver/validated_events", contracts.load("silver.validated_events"))
    bad = spark.read.parquet(f"{root}/silver/rejected_events")
    assert good.count() + bad.count() == 400
    assert {r.event_type for r in bad.select("event_type").distinct().collect()} == {"signup"}
    assert good.where("page_url is null or ingestion_ts is null").count() == 0


def test_late_events_are_dropped(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    batches = [[START], [START + timedelta(hours=1)], [START + timedelta(hours=2)], [START + timedelta(minutes=1)],
               [START + timedelta(hours=3)]]
    for n, times in enumerate(batches):
        (source / f"{n}.txt").write_text("\n".join(line(f"{n}-{i}", t) for i, t in enumerate(times)) + "\n")
        drain(jobs.start_sessions, jobs.window_events(stream(spark, str(source))), root)
    gold = read_lake(spark, f"{root}/gold/session_metrics", contracts.load("gold.session_metrics"))
    first = gold.where(F.col("session_start") < F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")).collect()
    assert [(r.session_start, r.event_count) for r in first] == [(START, 1)]


@pytest.mark.parametrize("spread_by", [None, "position"])
def test_stream_dedupe(spark, tmp_path, spread_by):
    source = tmp_path / "in"
    source.mkdir()
    for name, numbers in {"a": (1, 1, 2, 1, 1), "b": (1, 3, 2)}.items():
        (source / f"{name}.txt").write_text("\n".join(line(i, START) for i in numbers) + "\n")
        time.sleep(0.02)
    # A stand-in for the log offset: a number that differs between copies.
    events = jobs.window_events(stream(spark, str(source))).withColumn("position", F.expr("crc32(uuid())"))
    out = str(tmp_path / "out")
    running = jobs._start(dedupe_events(events, WATERMARK, spread_by, salts=2), f"{out}/c", jobs.DRAIN,
                          lambda b, label: sinks.append_batch(b, f"{out}/t", label))
    running.awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(f"{out}/t").collect()) == ["1", "2", "3"]


def test_all_jobs_side_by_side(spark, log, tmp_path):
    changes, root = tmp_path / "changes", str(tmp_path / "out")
    changes.mkdir()
    (changes / "a.txt").write_text('{"entity_type":"order","order_id":"O1","timestamp":"2024-01-01 00:00:00.000"}\n')
    session = streaming_session(spark)
    running = jobs.start_all(
        lambda: read_text(session, log, streaming=True), lambda: read_text(session, str(changes), streaming=True),
        root, f"{root}/checkpoints", jobs.DRAIN)
    for job in running.values():
        job.awaitTermination()
    assert len(running) == 11
    for table, rows in {"bronze/raw_events": 400, "lake/orders": 1}.items():
        assert spark.read.parquet(f"{root}/{table}").count() == rows
    for table in ("silver/validated_events", "gold/session_metrics", "gold/product_funnel_1m"):
        assert spark.read.parquet(f"{root}/{table}").count() > 0


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    serving, log = str(tmp_path / "serving"), str(tmp_path / "log")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, t int")
    second = spark.createDataFrame([("a", 3), ("a", 2), (None, 9)], "k string, t int")
    one, two = (sinks.batch_label("checkpoint", n) for n in (0, 1))
    other = sinks.batch_label("another checkpoint", 0)
    assert len({one, two, other}) == 3
    for df, label in [(first, one), (second, two), (first, one), (second, two)]:
        sinks.upsert_batch(df, serving, ["k"], ["t"], label)
        sinks.append_batch(df, log, label)
    assert {tuple(r) for r in sinks.read_serving(spark, serving, ["k"], ["t"]).collect()} == {("a", 3), ("b", 1)}
    assert spark.read.parquet(log).count() == 5


def test_upsert_keeps_the_last_version(spark, tmp_path):
    path, compacted = str(tmp_path / "s"), str(tmp_path / "c")
    batches = [[("a", 1, None), ("b", 1, "x")], [("a", 3, "new"), ("a", 2, "mid"), (None, 9, "no key")], [("b", 1, "again")]]
    for n, rows in enumerate(batches * 2):
        df = spark.createDataFrame(rows, "k string, t int, status string")
        sinks.upsert_batch(df, path, ["k"], ["t"], sinks.batch_label("c", n % 3), {"status": "active"})
    current = {tuple(r) for r in sinks.read_serving(spark, path, ["k"], ["t"]).collect()}
    assert current == {("a", 3, "new"), ("b", 1, "again")}
    sinks.compact_serving(spark, path, compacted, ["k"], ["t"])
    assert {tuple(r) for r in sinks.read_serving(spark, compacted, ["k"], ["t"]).collect()} == current
    later = spark.createDataFrame([("b", 1, "later")], "k string, t int, status string")
    sinks.upsert_batch(later, compacted, ["k"], ["t"], sinks.batch_label("c", 9))
    assert {r.status for r in sinks.read_serving(spark, compacted, ["k"], ["t"]).collect()} == {"new", "later"}


def test_changes_fan_out(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    def user(city, day):
        return json.dumps({"entity_type": "user", "timestamp": f"2024-01-0{day} 00:00:00.000", "user_id": "U1",
                           "user_city": city, "registered_date": "2023-01-01"})
    (source / "a.txt").write_text("\n".join([user("Rome", 2), user("Oslo", 1),
        '{"entity_type":"category","timestamp":"2024-01-01 00:00:00.000","category_id":"C1","cat_name":"x"}']) + "\n")
    drain(jobs.start_changes, stream(spark, str(source)), root)
    log = read_lake(spark, f"{root}/lake/users", contracts.load("entities.users"))
    assert log.count() == 2
    serving = sinks.read_serving(spark, f"{root}/serving/users", ["user_id"], ["change_ts"])
    row = serving.first()
    assert (serving.count(), row.city, row.status) == (1, "Rome", "active")
    assert sinks.read_serving(spark, f"{root}/serving/categories", ["category_id"], ["change_ts"]).count() == 1


def test_replay_gives_the_same_tables(spark, log, tmp_path):
    raw = read_text(spark, log)
    at = F.col("event_timestamp")
    first = replay.rebuild(raw, str(tmp_path / "a"), at)
    shuffled = raw.repartition(5, F.rand(1))
    second = replay.rebuild(shuffled, str(tmp_path / "b"), at)
    again = replay.rebuild(shuffled, str(tmp_path / "b"), at)
    assert second == again
    diff = replay.compare_tables(replay.read_tables(spark, first), replay.read_tables(spark, second)).collect()
    assert len(diff) == 6
    assert all(r.only_left == r.only_right == 0 and r.left_rows == r.right_rows > 0 for r in diff)
    assert spark.read.parquet(replay.table_path(str(tmp_path / "a"), "bronze.rejected_text")).count() == 4


def test_statements():
    sql = sinks.merge_statement("t", "s", ["k"], ["k", "v"])
    options = sinks.staging_options("jdbc:x", "product_funnel_1m")
    assert (options["dbtable"], options["batchsize"]) == ("product_funnel_1m_staging", "200")
    assert sql.startswith("MERGE INTO t t USING s s ON t.k = s.k") and "UPDATE SET v = s.v" in sql
    ordered = sinks.merge_statement("t", "s", ["k"], ["k", "v"], ["at"])
    assert "WHEN MATCHED AND (s.at > t.at OR" in ordered
    assert "UPDATE" not in sinks.merge_statement("t", "s", ["k"], ["k"])


def test_work_path_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    one, two = work_path(spark, "x"), work_path(spark, "x")
    assert one != two
    assert not root or one.startswith(root)


def test_later_runs_win(spark, tmp_path):
    labels = [sinks.batch_label(c, n, since) for c, n, since in (("z", 5, 1), ("a", 0, 2), ("m", 0, 3), ("m", 1, 3))]
    assert labels == sorted(labels) and sinks.BASE < labels[0]
    path = str(tmp_path / "t")
    for i, label in enumerate(labels):
        sinks.upsert_batch(spark.createDataFrame([("k", 1, i)], "k string, t int, v int"), path, ["k"], ["t"], label)
    assert [r.v for r in sinks.read_serving(spark, path, ["k"], ["t"]).collect()] == [3]


def test_empty_serving_table_has_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "k string, t int")
    sinks.upsert_batch(df, str(tmp_path / "t"), ["k"], ["t"], sinks.batch_label("c", 0))
    assert sinks.read_serving(spark, str(tmp_path / "t"), ["k"], ["t"], df.schema).collect() == []


def test_stateful_jobs_need_the_stream_settings(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "false")
    events = session.readStream.schema("user_id string").parquet(str(tmp_path))
    with pytest.raises(RuntimeError, match="build_session"):
        jobs.start_sessions(events, str(tmp_path / "out"), str(tmp_path / "c"))


def test_rollups_refuse_what_does_not_nest(spark):
    sessions = spark.createDataFrame(
        [("S", "U", date(2024, 1, 31), 1, 1, 1, 1, 1, False)],
        "session_id string, user_id string, session_date date, event_count bigint, page_views bigint, "
        "add_to_carts bigint, purchases bigint, session_duration_seconds bigint, converted boolean")
    weekly = metrics.pre_aggregate(sessions, "session_metrics", ["session_date"], "week")
    with pytest.raises(ValueError, match="week"):
        metrics.query_rollup(weekly, "session_metrics", ["count"], ["session_date"], grain="month")
    daily = metrics.pre_aggregate(sessions, "session_metrics", ["session_date"], "day")
    assert metrics.query_rollup(daily, "session_metrics", ["count"], ["session_date"], grain="month").count() == 1


def test_jobs_keep_what_they_cannot_read(spark, tmp_path):
    lines = ['{"event_id":"1","event_type":"page_view","user_id":"U","session_id":"S","timestamp":"2024-01-01 00:00:00.000"}',
             '{"event_id":"2","event_type":"page_view","user_id":"U","session_id":"S"}', "not json", '{"entity_type":"vendor"}',
             '{"entity_type":"category","timestamp":"2024-01-01 00:00:00.000","category_id":"c","cat_name":"C"}']
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.txt").write_text("\n".join(lines))

    def log():
        return spark.readStream.format("text").load(str(tmp_path / "log"))

    out = str(tmp_path / "out")
    jobs.start_bronze(log(), out, str(tmp_path / "c1"), jobs.DRAIN).awaitTermination()
    jobs.start_validated(log(), out, str(tmp_path / "c2"), jobs.DRAIN).awaitTermination()
    jobs.start_changes(log(), out, str(tmp_path / "c3"), jobs.DRAIN, ("category",)).awaitTermination()
    assert [r.value for r in spark.read.parquet(f"{out}/bronze/rejected_text").collect()] == ["not json"]
    assert [r.event_id for r in spark.read.parquet(f"{out}/silver/untimed_events").collect()] == ["2"]
    rejected = {(r.value, r.reason) for r in spark.read.parquet(f"{out}/lake/rejected_changes").collect()}
    assert {("not json", "unparseable"), (lines[3], "unknown entity")} <= rejected and len(rejected) == 4
    served = sinks.read_serving(spark, f"{out}/serving/categories", ["category_id"], ["change_ts"])
    assert [r.category_id for r in served.collect()] == ["c"]


def test_requests_a_rollup_does_not_cover_go_to_the_table(spark):
    schema = ("session_id string, user_id string, session_date date, event_count bigint, page_views bigint, "
              "add_to_carts bigint, purchases bigint, session_duration_seconds bigint, converted boolean")
    rows = [(f"S{i}", "U", date(2024, 1, 1 + i), 1, i, 1, 1, 1, i > 1) for i in range(4)]
    sessions = spark.createDataFrame(rows, schema)
    none = metrics.pre_aggregate(sessions, "session_metrics", ["session_date", "converted"], "day").limit(0)

    def count(**request):
        return metrics.answer(sessions, "session_metrics", ["count"], rollups=[none], **request).collect()

    assert count(dimensions=["converted"]) == []  # covered
    assert count(dimensions=["converted"], where="converted") == []
    assert [r["count"] for r in count(where="page_views > 0")] == [3]
    assert [r["count"] for r in count(where="session_date > DATE'2024-01-02'")] == [2]
    assert sum(r["count"] for r in count(dimensions=["session_date"])) == 4  # finer than the rollup
