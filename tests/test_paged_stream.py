"""The paged source as a stream that goes on where it broke."""

import json

import pytest

from quillgraph.sources import tables


def page(folder, key, token, titles, after=None):
    body = {"members": [{"title": t, "ns": 0} for t in titles] + [{"title": "talk", "ns": 1}]}
    (folder / f"{key}.{token}.json").write_text(json.dumps(body | ({"continue": after} if after else {})))


def crawl(spark, folder, out, keys="A|B|C", batch=2):
    spark.dataSource.register(tables.PagedSource)
    rows = spark.readStream.format("paged_members").option("pages", str(folder)).option("keys", keys).option("batch", batch).load()
    running = rows.writeStream.format("parquet").option("path", str(out / "rows")).option("checkpointLocation", str(out / "c")).start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()


def rows(spark, out):
    return sorted((r.key, r.title) for r in spark.read.parquet(str(out / "rows")).collect())


def test_a_crawl_goes_on_where_it_broke(spark, tmp_path):
    pages, out = tmp_path / "pages", tmp_path / "out"
    pages.mkdir()
    page(pages, "A", "0", ["a0", "a1"], "t1")
    page(pages, "A", "t1", ["a2"], "t2")
    page(pages, "B", "0", ["b0"])
    page(pages, "C", "0", [], "u")
    page(pages, "C", "u", ["c0"])
    with pytest.raises(Exception):
        crawl(spark, pages, out)  # A's third page isn't there
    before = rows(spark, out)
    assert set(before) <= {("A", "a0"), ("A", "a1"), ("A", "a2"), ("B", "b0"), ("C", "c0")} and ("A", "a0") in before
    # pages that the crawl is through with aren't read any more
    (pages / "A.0.json").write_text("broken")
    (pages / "B.0.json").write_text("broken")
    page(pages, "A", "t2", ["a3"])
    crawl(spark, pages, out)
    whole = [("A", "a0"), ("A", "a1"), ("A", "a2"), ("A", "a3"), ("B", "b0"), ("C", "c0")]
    assert rows(spark, out) == whole
    crawl(spark, pages, out)
    assert rows(spark, out) == whole
    page(pages, "D", "0", ["d0"])
    crawl(spark, pages, out, "A|B|C|D")
    assert rows(spark, out) == [*whole, ("D", "d0")]
