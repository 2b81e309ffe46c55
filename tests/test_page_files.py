"""The two-phase writer of pages."""

import os

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import exports
from quillgraph.sources import page_files


def found(folder):
    return {os.path.relpath(os.path.join(at, f), folder): open(os.path.join(at, f), encoding="utf-8").read() for at, _, files in os.walk(folder) for f in files}


def test_pages_are_written_all_or_none(spark, tmp_path):
    folder, shape = str(tmp_path / "site"), "path string, content string, other int"
    rows = [(f"l{i % 3}/p{i}.html", f"é{i}\r\n", i) for i in range(200)] + [("null.html", None, 0), ("empty.html", "", 0)]
    page_files.write_pages(spark.createDataFrame(rows, shape).repartition(7), folder)
    want = {p: (c or "").replace("\r\n", "\n") for p, c, _ in rows}
    assert found(folder) == want and not os.listdir(os.path.join(folder, ".staged"))
    # a row that fails in any task leaves all as it was, and nothing staged
    for bad in ([("x.html", "1", 0), ("x.html", "2", 0)], [("../x.html", "1", 0)], [("/x.html", "1", 0)], [(None, "1", 0)], [("", "1", 0)], [(".staged/x", "1", 0)], [("a/..", "1", 0)]):
        with pytest.raises(Exception, match=r"FileExistsError|ValueError"):
            page_files.write_pages(spark.createDataFrame([*[(f"new{i}.html", "n", 0) for i in range(50)], *bad], shape), folder)
        assert found(folder) == want and not os.listdir(os.path.join(folder, ".staged"))
    # overwriting replaces pages of the same path only; appending refuses to
    page_files.write_pages(spark.createDataFrame([("l0/p0.html", "new", 0)], shape), folder)
    want["l0/p0.html"] = "new"
    assert found(folder) == want
    with pytest.raises(Exception, match="FileExistsError"):
        page_files.write_pages(spark.createDataFrame([("fresh.html", "f", 0), ("l0/p0.html", "newer", 0)], shape), folder, "append")
    assert found(folder) == want
    page_files.write_pages(spark.createDataFrame([], shape), folder)
    assert found(folder) == want


def test_only_accepted_attempts_are_moved(tmp_path):
    writer = page_files.PageWriter(str(tmp_path), True)
    row = lambda path, content: {"path": path, "content": content}
    writer.write(iter([row("a", "lost")]))  # an attempt whose executor was lost
    kept = writer.write(iter([row("a", "kept"), row("b/c", "also")]))
    writer.commit([kept, None])
    assert found(tmp_path) == {"a": "kept", "b/c": "also"}
    broken = page_files.PageWriter(str(tmp_path), True)
    broken.write(iter([row("a", "never")]))
    assert len(found(tmp_path)) == 3
    page_files.purge(str(tmp_path))
    assert found(tmp_path) == {"a": "kept", "b/c": "also"}
    gone = page_files.PageWriter(str(tmp_path), True)
    message = gone.write(iter([row("a", "x"), row("d", "y")]))
    os.remove(os.path.join(message.attempt, "d"))
    with pytest.raises(RuntimeError):
        gone.commit([message])
    gone.abort([message])
    assert found(tmp_path) == {"a": "kept", "b/c": "also"}


def test_pages_of_nodes(spark, tmp_path):
    nodes = spark.createDataFrame([("one", "A & B", "<x>"), ("two", "C", "d")], "slug string, title string, description string")
    page_files.write_pages(exports.pages(nodes, "https://e.org").select("path", F.col("html").alias("content")), str(tmp_path))
    got = found(tmp_path)
    assert set(got) == {"one.html", "two.html"} and "<title>A &amp; B</title>" in got["one.html"]
