"""Literal frames for the rules that are easy to get wrong."""

import json
import math
import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.operators import board, exports, graph, layout, reach, rules
from quillgraph.sources import tables
from quillgraph.streaming import limits

#: A folder with an edge seed script and a JSON file of the distances published for it.
GOLDEN = os.environ.get("QUILLGRAPH_GOLDEN", "")


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


def test_points(spark):
    p = lambda m, d, h: one(spark, board.points(F.col("m"), F.col("d"), F.col("h")), m=m, d=d, h=h)
    assert (p(5, 5, 0), p(7, 5, 1), p(14, 5, 0)) == (1000, 660, 100)
    assert [board.page_size(x) for x in (None, 0, 7, 99)] == [20, 1, 7, 50]
    b = lambda x: one(spark, board.bounded_int(F.col("x"), 0, 99), x=x)
    assert [b(x) for x in (" 12abc", "-4", "x", "1000")] == [12, 0, 0, 99]


def test_links(spark):
    markup = "A [[foo_bar#x|y]] {{t [[Z]]}} <ref>[[Q]]</ref> [[File:p]]\n== H ==\n[[later]]"
    clean = T.strip_templates(T.strip_markup(F.col("x")))
    assert one(spark, T.link_targets(clean), x=markup) == ["Foo bar", "Later"]
    assert one(spark, T.link_targets(T.lead(clean)), x=markup) == ["Foo bar"]
    assert one(spark, T.strip_templates(F.col("x")), x="a {{b [[C]]") == "a "
    assert one(spark, T.strip_templates(F.col("x")), x="a }} b {{c {{d}} e}} f") == "a }} b  f"


def test_strings(spark):
    slug = lambda t, i: one(spark, T.slug(F.col("t"), F.col("i")), t=t, i=i)
    assert slug("Sąmokslo teorija!", "X1") == "samokslo-teorija-X1" and slug("中", "X1") == "X1"
    assert one(spark, T.snippet(F.col("x")), x="a" * 190) == "a" * 190
    assert one(spark, T.snippet(F.col("x")), x="word " * 60).endswith("word…")
    assert one(spark, T.url_title(F.col("x")), x="https://e.org/wiki/A+b_%C3%A9") == "A+b é"
    assert one(spark, T.search(F.col("x"), "eclair"), x="Un Éclair") is True
    assert one(spark, T.cut_sentence(F.col("x"), 12), x="One. Two. Three four.") == "One. Two."
    assert one(spark, T.year_contexts(F.col("x")), x="1999 and 2001")[0] == "1999 and 2001"


def test_review_and_dates(spark):
    items = spark.createDataFrame([("T1", "theory", None, False), ("T2", "theory", None, True)], "id string, role string, status string, manual boolean")
    mentions = spark.createDataFrame([("T1", "a", None), ("T1", "b", None), ("T2", "a", None), ("T2", "c", None)], "source string, target string, code string")
    reviews = spark.createDataFrame([("T1", "not_theory")], "id string, status string")
    roles = spark.createDataFrame([("T1", "a", "acc")], "source string, target string, code string")
    out, nodes = rules.merge_reviews(mentions, items, reviews, roles)
    assert {(r.source, r.target): r.tier for r in out.collect()} == {("T1", "a"): "core", ("T1", "b"): "extended", ("T2", "a"): "core", ("T2", "c"): "extended"}
    assert {r.id: r.role for r in nodes.collect()} == {"T1": "related", "T2": "theory"}
    dates = spark.createDataFrame([("a", 0, "year"), ("b", 1900, "none"), ("c", 1900, "year"), ("d", 1900, "year")], "id string, y int, p string")
    merged = rules.merge_dates(spark.createDataFrame([("a", None), ("b", ""), ("c", "1800"), ("d", None)], "id string, d string"), dates)
    assert {r.id: r.d for r in merged.collect()} == {"a": None, "b": "", "c": "1800", "d": "1900"}


def test_graph_degrees_are_counted_once(spark):
    path = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "a string, b string")
    assert {(r.a, r.b) for r in graph.game_graph(path, "z").collect()} == {("b", "c")}
    assert {r.node: r.dist for r in graph.distances(path, "a").collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_rate_limit():
    allowed, opened, n = limits.decide([0] * 20 + [60_000, 60_001], None, 0, 60_000, 20)
    assert allowed == [True] * 20 + [False, True] and (opened, n) == (60_001, 1)


def test_rate_limit_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, i, 10 * i) for i in range(5)] + [(2, 9, 0)], "user_id long, event_id long, ms long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = limits.limit_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), 1000, 3)
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = {(r.user_id, r.event_id): r.allowed for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 0): True, (1, 1): True, (1, 2): True, (1, 3): False, (1, 4): False, (2, 9): True}
    assert {(r.user_id, r.event_id): r.allowed for r in limits.limit_batch(rows, 1000, 3).collect()} == got


def test_board_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", 5, 3, 9, 100), (1, "x", 4, 3, 9, 101), (1, "y", 5, 3, 9, 102)], "lvl int, nick string, score int, moves int, secs int, id long")
    rows.write.parquet(str(tmp_path / "in"))
    limits.feed_board(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), str(tmp_path / "board"), str(tmp_path / "c"))
    assert {(r.nick, r.id) for r in spark.read.parquet(str(tmp_path / "board/0")).collect()} == {("x", 100), ("y", 102)}


def test_service_stream(spark, tmp_path):
    levels = spark.createDataFrame([(1, "a", 2, 3)], "lvl int, start string, dist int, budget int")
    edges = spark.createDataFrame([("a", "b"), ("b", "t"), ("b", "c"), ("c", "t")], "a string, b string")
    sent = lambda i, nick, path, allowed=True, lvl="1": (i, json.dumps({"lvl": lvl, "nick": nick, "path": path, "hints": 1}), allowed)
    first = [sent(1, "x", ["a", "b", "t"]), sent(2, "y", ["a", "b", "c", "t"]), sent(3, "", ["a", "t"]), (4, "{", True), sent(5, "x", ["a", "t"], False), sent(6, "x", ["a", "t"])]
    second = [sent(7, "y", ["a", "b", "t"]), sent(8, "x", ["a", "a", "t"]), sent(9, "z", ["a", "b", "t"], lvl="7"), sent(10, "x", ["a", "b", "c", "t"])]
    shape, source = "id long, body string, allowed boolean", str(tmp_path / "in")
    for rows in (first, second):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(source)
        limits.feed_service(spark.readStream.schema(shape).parquet(source), levels, edges, "t", str(tmp_path / "out"), str(tmp_path / "c"))
    got = {r.id: (r.error, r.step, r.score, r.best, r.rank) for i in (0, 1) for r in spark.read.parquet(str(tmp_path / f"out/answers/{i}")).collect()}
    assert got == {
        1: (None, None, 900, 900, 1), 2: (None, None, 780, 780, 2), 3: ("no_nick", None, None, None, None), 4: ("bad_json", None, None, None, None), 5: ("too_many", None, None, None, None),
        6: ("no_such_link", 1, None, None, None), 7: (None, None, 900, 900, 1), 8: ("repeat", 1, None, None, None), 9: ("no_level", None, None, None, None), 10: (None, None, 780, 900, 1),
    }
    assert {(r.nick, r.score, r.path) for r in spark.read.parquet(str(tmp_path / "out/board/1")).collect()} == {("x", 900, "a,b,t"), ("y", 900, "a,b,t")}


def test_sources(spark, tmp_path):
    (tmp_path / "done").mkdir()
    (tmp_path / "done/b1.json").write_text(json.dumps({"k": {"y": 1, "p": "year"}, "l": {"y": 3, "p": "none"}}))
    (tmp_path / "done/b2.json").write_text(json.dumps({"k": {"y": 2, "p": "decade"}}))
    got = {r.key: (r.value.y, r.file) for r in tables.keyed_json(spark, str(tmp_path / "done"), value_schema="struct<y:int,p:string>").collect()}
    assert got == {"k": (2, "b2.json"), "l": (3, "b1.json")}
    (tmp_path / "done_ents").mkdir()
    (tmp_path / "done_ents/a.json").write_text(json.dumps({"k": {"y": 9, "p": "year"}}))
    both = tables.keyed_json(spark, str(tmp_path / "done"), str(tmp_path / "done_ents"), value_schema="struct<y:int,p:string>")
    assert {r.key: r.value.y for r in both.collect()} == {"k": 9, "l": 3}
    (tmp_path / "whole.json").write_text(json.dumps([{"id": "a", "n": 1}, {"id": "b"}]))
    assert [tuple(r) for r in tables.json_array(spark, str(tmp_path / "whole.json"), "id string, n int").collect()] == [("a", 1), ("b", None)]
    assert tables.optional(lambda: spark.read.parquet(str(tmp_path / "none")), spark, "a int").count() == 0
    (tmp_path / "A.0.json").write_text(json.dumps({"members": [{"title": "x", "ns": 0}, {"title": "t", "ns": 1}], "continue": "p2"}))
    (tmp_path / "A.p2.json").write_text(json.dumps({"members": [{"title": "y", "ns": 14}]}))
    spark.dataSource.register(tables.PagedSource)
    assert {r.title for r in spark.read.format("paged_members").option("pages", str(tmp_path)).option("keys", "A").load().collect()} == {"x", "y"}
    waits: list[float] = []
    tries = iter([OSError(), OSError(), "ok"])

    def get():
        x = next(tries)
        if isinstance(x, OSError):
            raise x
        return x

    assert tables.fetch_with_retries(get, sleep=waits.append) == "ok" and waits == [1, 2]

    def answered(**known):
        e = OSError()
        e.__dict__.update(known)
        return e

    tries, waits[:] = iter([answered(status=503), answered(status=429, retry_after=7), answered(status=500), "ok"]), []
    assert tables.fetch_with_retries(get, sleep=waits.append) == "ok" and waits == [5, 7, 20]
    tries = iter([OSError("last")] * 8)
    with pytest.raises(OSError, match="last"):
        tables.fetch_with_retries(get, sleep=waits.append)
    now, slept = [0.0], []
    pace = tables.Pace(1.0, lambda: now[0], slept.append)
    for t in (0.0, 0.25, 5.0):
        now[0] = t
        pace()
    assert slept == [0.75]
    assert tables.Settings.read({"SEED": "5", "INSIDE": "2.5", "other": "x"}) == tables.Settings(seed=5, inside=2.5)


def test_exports_and_layout(spark, tmp_path):
    df = spark.createDataFrame([("a", None, [], 1)], "id string, d string, c array<string>, n int")
    assert [r.json for r in exports.compact_json(df).collect()] == ['{"id":"a","n":1}']
    exports.write_json(df, str(tmp_path / "j"), ["id"])
    edges = spark.createDataFrame([(f"a{i}", "it's") for i in range(7)], "a string, b string")
    rows = "".join(r.sql for r in exports.seed_statements(edges, size=3).collect())
    assert len(re.findall(r"\('a\d','it''s'\)", rows)) == 7
    pages = exports.pages(spark.createDataFrame([("s", "a<b", "x&y")], "slug string, title string, description string"), "https://e.org").first()
    assert pages.path == "s.html" and "a&lt;b" in pages.html and "x&amp;y" in pages.html
    square = spark.createDataFrame([(i, float(i % 10), float(i // 10)) for i in range(100)], "id long, x double, y double")
    placed = layout.normalize(square).collect()
    assert abs(sum(r.x for r in placed)) < 1e-6 and max((r.x**2 + r.y**2) ** 0.5 for r in placed) < 1100


def test_files_are_what_they_should_be(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "id string, n int")
    exports.write_json(df, str(tmp_path / "j"), ["id"])
    assert [json.loads(r.value)["id"] for r in spark.read.text(str(tmp_path / "j")).orderBy("value").collect()] == ["a", "b"]
    exports.write_tables({"t": df}, str(tmp_path / "store"))
    exports.write_tables({"t": df.limit(1)}, str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store/t")).count() == 1
    exports.write_batches(rules.in_batches(df, ["id"], 1), str(tmp_path / "batches"))
    assert sorted(p.name for p in (tmp_path / "batches").iterdir() if p.name.startswith("batch=")) == ["batch=1", "batch=2"]
    edges = spark.createDataFrame([(f"a{i:04}", f"b{i:04}") for i in range(1203)], "a string, b string")
    sizes = {r.batch: r.sql.count("('") for r in exports.seed_statements(edges).collect()}
    assert sizes == {1: 500, 2: 500, 3: 203}


def test_closure_of_a_large_tree_and_of_a_circle(spark):
    n = 120_000
    tree = spark.range(1, n).select(F.col("id").alias("node"), F.floor(F.col("id") / 8).alias("parent"))
    depth, last, want = 1, 7, 0
    for node in range(1, n):
        while node > last:
            depth, last = depth + 1, last * 8 + 7
        want += depth
    assert reach.closure(tree).count() == want > 400_000
    circle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "node string, parent string")
    assert reach.closure(circle).count() == 9


def test_communities_are_of_high_modularity(spark):
    """Two rings of cliques, against each partition that a plain greedy search finds."""
    pairs = [(f"n{c}{i}", f"n{c}{j}", 1.0) for c in range(4) for i in range(5) for j in range(i + 1, 5)] + [(f"n{c}0", f"n{(c + 1) % 4}1", 0.5) for c in range(4)]
    got = {r.node: r.community for r in graph.communities(spark.createDataFrame(pairs, "a string, b string, weight double")).collect()}
    assert len(got) == 20 and {frozenset(n for n in got if got[n] == c) for c in set(got.values())} == {frozenset(f"n{c}{i}" for i in range(5)) for c in range(4)}
    both = [(a, b, w) for a, b, w in pairs] + [(b, a, w) for a, b, w in pairs]
    total = sum(w for *_, w in both)
    strength = {n: sum(w for a, _, w in both if a == n) for n in got}
    brute = sum((sum(w for x, y, w in both if (x, y) == (a, b)) - 1.2 * strength[a] * strength[b] / total) / total for a in got for b in got if got[a] == got[b])
    edges, label = (spark.createDataFrame(x, s) for x, s in ((both, "node string, other string, weight double"), (list(got.items()), "node string, community string")))
    assert graph.modularity(edges, label, 1.2) == pytest.approx(brute)


def test_running_sums(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(2).alias("v")).repartition(7)
    assert all(r.before == 2 * r.k for r in rules.running(df, ["k"], F.col("v")).collect())
    assert layout.nearest_rank(df, "k", 0.98).first()[0] == 980


def test_placement(spark):
    nodes = spark.createDataFrame([(i, 4) for i in range(6)], "id long, n int")
    centres = spark.createDataFrame([(0, 10.0, 20.0), (1, -5.0, 0.0)], "id long, x double, y double")
    at = {r.id: (r.x, r.y) for r in layout.place(nodes, centres, ["id"]).collect()}
    assert len(at) == 6 and abs(at[0][0] - 10) <= 33 and abs(at[0][1] - 20) <= 33
    assert at[2] == (1200.0, 0.0) and at[3] == pytest.approx((1200 * math.cos(2.399963), 1200 * math.sin(2.399963)))
    assert [r.x for r in spark.createDataFrame([(-0.25,), (0.25,)], "x double").select(layout.rounded(F.col("x")).alias("x")).collect()] == [-0.2, 0.3]


def test_settle_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError):
            graph.settle(spark.range(1))


@pytest.mark.skipif(not os.path.isdir(GOLDEN), reason="no golden data")
def test_golden_distances(spark):
    seed = next(x for x in (p.read_text() for p in sorted(Path(GOLDEN).rglob("*.sql"))) if "INTO edges" in x)
    want = next(x for x in (json.loads(p.read_text()) for p in sorted(Path(GOLDEN).rglob("*.json"))) if isinstance(x, dict) and "reach" in x)
    text = seed[seed.index("INTO edges") :]
    edges = {(a.replace("''", "'"), b.replace("''", "'")) for a, b in re.findall(r"\('((?:[^']|'')*)','((?:[^']|'')*)'\)", text)}
    dist = graph.distances(spark.createDataFrame(sorted(edges), "a string, b string"), want["target"]).cache()
    assert {str(r.dist): r.nodes for r in graph.reach(dist).collect()} == want["reach"]
    starts = spark.createDataFrame([(x["lvl"], x["start"], x["budget"] - x["dist"], x["dist"]) for x in want["levels"]], "lvl int, start string, slack int, expected int")
    assert [r.error for r in graph.levels(dist, starts).collect()] == [None] * len(want["levels"])
