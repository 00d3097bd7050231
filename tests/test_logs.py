import json

import pytest
from pyspark.sql import functions as F

from tidemark import contracts
from tidemark.operators.events import bronze_events
from tidemark.sources.logs import (
    broker_options, contract_options, parse_changes, parse_events, read_text, rejected_text,
)
from tidemark.sources.tables import jdbc_options

FULL = {
    "event_id": "e1", "event_type": "page_view", "user_id": "U1", "session_id": "S1", "product_id": "P1",
    "timestamp": "2024-03-15 10:22:31.456", "metadata": {"page": "/p", "referrer": None},
}
LINES = {
    "full": json.dumps(FULL),
    "no json": "garbage",
    "cut": '{"event_id":"e2","user_id":',
    "empty": "",
    "array": "[1,2]",
    "missing fields": '{"event_id":"e3"}',
    "number id": '{"event_id":4,"timestamp":"nope"}',
    "text metadata": '{"event_id":"e5","metadata":"plain"}',
    "empty object": "{}",
}


@pytest.fixture
def raw(spark):
    return spark.createDataFrame([(v,) for v in LINES.values()] + [(None,)], "value string")


def test_every_record_is_parsed_or_rejected(raw):
    good, bad = parse_events(raw), rejected_text(raw)
    assert good.count() + bad.count() == raw.count()
    assert {r.value for r in bad.collect()} == {LINES["no json"], LINES["cut"], LINES["array"], LINES["empty"], None}


def test_fields_are_text_or_null(raw):
    rows = {r.event_id: r for r in parse_events(raw).collect()}
    assert rows["e1"].metadata == '{"page":"/p","referrer":null}'
    assert rows["e3"].user_id is None and rows["e3"].metadata is None
    assert rows["4"].timestamp == "nope"
    assert rows["e5"].metadata == "plain"


def test_bronze_types_the_time_and_keeps_the_rest(raw):
    rows = {r.event_id: r for r in bronze_events(parse_events(raw)).collect()}
    assert str(rows["e1"].event_timestamp) == "2024-03-15 10:22:31.456000"
    assert str(rows["e1"].event_date) == "2024-03-15"
    assert rows["4"].event_timestamp is None and rows["4"].event_date is None
    contract = contracts.load("bronze.raw_events")
    assert bronze_events(parse_events(raw)).dtypes == [(f.name, f.dataType.simpleString()) for f in contract.schema]


def test_each_record_is_parsed_once(raw):
    plan = parse_events(raw).where(F.col("event_type") == "x")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_change_log_keeps_position(spark):
    raw = spark.createDataFrame([('{"entity_type":"user","user_id":"U1"}', 7)], "value string, log_offset bigint")
    row = parse_changes(raw, keep=("log_offset",)).first()
    assert (row.log_offset, row.entity_type, row.user_id, row.price) == (7, "user", "U1", None)


def test_entity_preselection_keeps_escaped_types(spark):
    texts = ['{"entity_type": "order","order_id":"O1"}', '{"entity_type":"\\u006frder","order_id":"O2"}',
             '{"entity_type":"order_item","order_item_id":"I"}', '{"entity_type":"user","user_name":"order"}']
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    kept = parse_changes(raw, entities=["order"])
    assert {r.order_id for r in kept.where("entity_type = 'order'").collect()} == {"O1", "O2"}
    assert kept.count() == 3 and parse_changes(raw).count() == 4


def test_text_log(spark, tmp_path):
    (tmp_path / "a.txt").write_text(LINES["full"] + "\n" + LINES["no json"] + "\n")
    assert parse_events(read_text(spark, str(tmp_path))).count() == 1


def test_reader_options():
    live, replay = (broker_options("b:1", "t", from_beginning=f) for f in (False, True))
    assert (live["startingOffsets"], replay["startingOffsets"]) == ("latest", "earliest")
    contract = contracts.load("bronze.raw_events")
    declared = contract_options(contract, "b:1", from_beginning=True)
    assert declared["subscribe"] == "raw-events" and declared["startingOffsets"] == "earliest"
    assert contract_options(contract, "b:1")["startingOffsets"] == "latest"
    split = jdbc_options("jdbc:x", "users", "id", ("0", "100"), partitions=4)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "users", "id")
