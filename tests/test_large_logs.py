"""What keeps jobs and rebuilds in proportion to their logs."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import DataFrame, functions as F

from tidemark.operators import changes as entity
from tidemark.plans import replay, suite
from tidemark.session import streaming_session
from tidemark.sources import warehouse as wh
from tidemark.sources.logs import read_text, rejected_changes
from tidemark.streaming import jobs


@pytest.fixture
def tables(spark, tmp_path):
    """Small tables of the given schema, with repeated and null keys."""
    at = datetime(2024, 1, 10, 23, 59, 59, 999999)
    rows = {
        "part": ([(1, "p", "T", "B", 1.5), (1, "p", "T", "B", 1.5), (2, None, "T", "C", 2.0)],
                 "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double"),
        "nation": ([(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "customer": ([(1, "c", 0, -1.0, "S"), (2, None, 0, 1.0, "S")],
                     "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "orders": ([(i, 1 + i % 2, 10.0 * i, "F", date(1998, 1, 1 + i % 5)) for i in range(40)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string, o_orderdate date"),
        "lineitem": ([(i, 1, 1, 2.0, 5.0, date(1998, 1, 1 + i % 5)) for i in range(20)],
                     "l_orderkey long, l_linenumber long, l_partkey long, l_quantity double, l_extendedprice double, l_shipdate date"),
        "events": ([(0, at, 1, "view", 1.0, '{"k": 1}'), (1, datetime(2024, 1, 11), 1, "view", 1.0, '{"k": 1}'),
                    (2, None, 2, "click", None, None), (3, datetime(2024, 1, 25, 1, 2, 3), 2, "purchase", 3.0, '{"k": 2}')],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lake_writes_one_file_per_partition_and_batch(spark, tmp_path):
    rows = [json.dumps({"entity_type": "order", "order_id": f"O{i}", "order_date": f"1998-01-0{1 + i % 3}"}) for i in range(240)]
    spark.createDataFrame([(r,) for r in rows], "value string").repartition(8).write.text(f"{tmp_path}/in")
    source = read_text(streaming_session(spark), f"{tmp_path}/in", streaming=True)
    jobs.start_lake(source, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["order"], jobs.DRAIN).awaitTermination()
    lake = spark.read.parquet(f"{tmp_path}/out/lake/orders")
    assert lake.count() == 240
    assert lake.select(F.input_file_name()).distinct().count() == 3


@pytest.mark.parametrize("kind", list(entity.TABLES))
def test_change_log_of_one_kind(spark, tables, kind):
    whole = wh.change_log(spark, tables).where(F.col("value").contains(f'"entity_type":"{kind}"'))
    assert sorted(whole.collect()) == sorted(wh.change_log(spark, tables, [kind]).collect()) != []


@pytest.mark.parametrize("kind", list(entity.TABLES))
def test_streams_of_one_kind_make_no_other_text(spark, tables, kind, monkeypatch):
    asked, real = [], wh.change_log
    monkeypatch.setattr(wh, "change_log", lambda spark, sf_dir, *kinds: asked.append(kinds) or real(spark, sf_dir, *kinds))
    table = entity.TABLES[kind][0]
    for name in (f"stream_lake_{table}", f"stream_serving_{table}"):
        assert suite.QUERIES[name](spark, tables).count() > 0
    assert asked == [([kind],)] * 2


def test_rejected_changes_parse_once(spark):
    texts = ['{"entity_type":"order","order_id":"1"}', '{"entity_type":"shop"}', '{"order_id":"1"}', "{}", "not json", "", None,
             '{"entity_type":"order","order_id":', '{"entity_type":null}', '[{"entity_type":"shop"}]', '[]', '"order"',
             '{"entity_type":"shop"} x', '{"entity_type":{"a":1}}']
    found = rejected_changes(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, log_offset long"), ["log_offset"])
    assert found.columns == ["log_offset", "value", "reason"]
    reasons = {r.log_offset: r.reason for r in found.collect()}
    assert 0 not in reasons and reasons[1] == reasons[2] == reasons[3] == reasons[8] == "unknown entity"
    assert reasons[4] == reasons[6] == reasons[7] == "unparseable"
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("name, job", [("replay_diff", "rebuild"), ("reprocess_diff", "reprocess")])
def test_rebuilds_read_stored_logs(spark, tables, name, job, monkeypatch):
    """The text of the logs is made once, however many passes read it."""
    logs, real = [], getattr(replay, job)

    def spied(*args, **options):
        logs.extend(a for a in args if isinstance(a, DataFrame))
        return real(*args, **options)

    monkeypatch.setattr(replay, job, spied)
    assert all(r.only_left == r.only_right == 0 for r in suite.QUERIES[name](spark, tables).collect())
    assert logs and not any("to_json" in log._jdf.queryExecution().optimizedPlan().toString() for log in logs)


def test_log_time_is_the_time_in_the_text(spark, tables):
    events = spark.read.parquet(f"{tables}/events.parquet")
    stated = {r[0]: r[1] for r in events.select(F.col("event_id").cast("string"), wh.log_time("ts")).collect()}
    text = wh.click_log(spark, tables)
    assert stated == {r[0]: r[1] for r in text.select(*(F.get_json_object("value", f"$.{c}") for c in ("event_id", "timestamp"))).collect()}
    assert stated["0"] < "2024-01-11" <= stated["1"] and stated["2"] is None


def test_parts_of_the_log_are_cut_before_their_text_is_made(spark, tables, monkeypatch):
    cut, real = [], wh.click_log
    monkeypatch.setattr(wh, "click_log", lambda spark, sf_dir, source=None: cut.append(source) or real(spark, sf_dir, source))
    suite.QUERIES["stream_funnel_from_log"](spark, tables).collect()
    assert [sorted(r.event_id for r in part.collect()) for part in cut] == [[0], [1], [3]]
