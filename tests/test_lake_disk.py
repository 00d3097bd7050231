"""What the lake streams keep on disk besides their tables."""

import random
import time
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.plans import suite
from tidemark.sources import warehouse as wh


@pytest.fixture
def shop(tmp_path):
    rng = random.Random(7)
    rows = [{"l_orderkey": rng.randrange(900), "l_linenumber": rng.randrange(1, 8), "l_partkey": rng.randrange(200), "l_quantity": float(rng.randrange(1, 51)),
             "l_extendedprice": rng.randrange(10_000, 9_000_000) / 100, "l_shipdate": f"199{rng.randrange(4, 6)}-03-0{rng.randrange(1, 4)} 00:00:00"} for _ in range(3000)]
    rows += rows[:5]
    (tmp_path / "sf/lineitem.parquet").mkdir(parents=True)
    for i in range(20):
        table = pa.Table.from_pylist(rows[i::20])
        pq.write_table(table, tmp_path / f"sf/lineitem.parquet/{i}.parquet")
    return str(tmp_path / "sf")


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_lake_stream_keeps_little_beside_its_table(spark, shop, tmp_path, monkeypatch):
    monkeypatch.setattr(suite, "work_path", lambda spark, name: f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a file to each task
    before = shuffles(spark)
    try:
        rows = suite.QUERIES["stream_lake_order_items"](spark, shop)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for _ in range(40):
        if not (left := shuffles(spark) - before):
            break
        time.sleep(0.25)
    assert not left
    items, log = wh.order_items(spark, shop), wh.change_log(spark, shop, ["order_item"])
    items = items.withColumns({c: items[c].cast("double") for c in ("unit_price", "line_total")})
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, items.select(rows.columns).collect()), key=repr)
    stored = [f for f in Path(tmp_path, "changes").rglob("part-*")]
    assert len(stored) > 16  # more than one batch
    assert sum(f.stat().st_size for f in stored) < sum(len(r["value"]) + 1 for r in log.collect()) / 3
    assert spark.read.text(f"{tmp_path}/changes/*").count() == 3005
