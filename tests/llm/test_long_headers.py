"""Archives whose header lines are long, and archives that lack records."""

import pytest

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string"


def test_long_urls_lose_no_page(spark):
    rows = [(i, "http://h/" + "u" * n, f"page {i}") for i, n in enumerate((10, 70_000, 600_000, 3_000_000, 20))]
    got = warc.archive_pages(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(i, 6) for i in range(5)]


def test_lost_records_raise(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://h", f"page {i}") for i in range(5)], SCHEMA).coalesce(1)
    manifest = warc.write_archives(warc.records(pages), f"file://{tmp_path}/whole")
    index = warc.normalise(manifest, f"file://{tmp_path}/members")
    assert warc.checked(index, manifest) is index
    with pytest.raises(ValueError, match="5 records were written, 4 were found"):
        warc.checked(index.where("record_id <> '<urn:page:2>'"), manifest)
    damaged = index.unionByName(spark.createDataFrame([("p", 0, 0, None, None, "cut")], warc.INDEX))
    with pytest.raises(ValueError, match="1 archives are damaged: cut"):
        warc.checked(damaged, manifest)
