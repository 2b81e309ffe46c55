"""The substring index and the rank index, each against a plain version."""

import random
import unicodedata

from pyspark.sql import functions as F

from quillgraph.operators import substrings
from quillgraph.streaming.ranks import RankIndex, feed_ranks

RUN = "id long, lvl int, nick string, score long, moves long, secs long, note string"


def plain(text):
    return "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn").lower()


def test_substrings(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abéÉ \n𝛼") for _ in range(rng.randint(0, 12)))
    docs = [(i, word()) for i in range(300)] + [(300, None), (301, ""), (302, "ab" * 20_000 + "Éa𝛼"), (302, "bb́a"), (None, "abab")]
    needles = [(f"k{i}", word()[: rng.randint(0, 5)]) for i in range(80)] + [("n", None), ("e", ""), ("m", "́"), ("long", "BABABAB"), ("again", "bababab"), ("none", "zzzz")]
    postings, texts = substrings.index(spark.createDataFrame(docs, "id long, text string"))
    got = {(r.key, r.id) for r in substrings.search(postings, texts, spark.createDataFrame(needles, "key string, needle string")).collect()}
    want = {(k, i) for k, n in needles if n and plain(n) for i, t in docs if t and i is not None and plain(n) in plain(t)}
    assert {x for x in got if x[1] is not None} == want and want
    assert postings.groupBy("gram", "id").count().filter("count > 1").isEmpty()
    nothing = substrings.index(spark.createDataFrame([], "id long, text string"))
    assert substrings.search(*nothing, spark.createDataFrame(needles, "key string, needle string")).count() == 0


def test_substrings_of_many_documents(spark):
    """Needles of common grams: what is sent is a row for a segment's gram, not one for each posting or candidate."""
    rng = random.Random(7)
    docs = [(i // 2, " ".join(rng.choice(("the", "then", "these", "ⱥthé", "othe")) for _ in range(30))) for i in range(600)]
    postings, texts = substrings.index(spark.createDataFrame(docs, "id long, text string"))
    assert postings.count() * 4 < postings.select(F.explode("id")).count()
    assert texts.groupBy("id").agg(F.count_distinct("segment").alias("n")).filter("n > 1").isEmpty()
    needles = [(n, n) for n in ("then the", "e o", "these these then", "héth")]
    found = substrings.search(postings, texts, spark.createDataFrame(needles, "key string, needle string"))
    assert sorted((r.key, r.id) for r in found.collect()) == sorted({(k, i) for k, n in needles for i, t in docs if plain(n) in plain(t)})


def plain_board(runs):
    best = {}
    for i, lvl, nick, score, moves, secs, _ in runs:
        if score is not None:
            best[lvl, nick] = min(best.get((lvl, nick), (1e9,)), (-score, moves, secs, i))
    return {(lvl, nick, -b[0], 1 + sum(o[0] < b[0] for (level, _), o in best.items() if level == lvl)) for (lvl, nick), b in best.items()}, {k: b[3] for k, b in best.items()}


def test_ranks_by_batches(spark, tmp_path):
    rng = random.Random(3)
    batches = [[(100 * n + i, rng.choice([1, 2, None]), rng.choice(["x", "y", "z", "w", None]), rng.choice([None, 100, 220, 340, 1000]), rng.randint(1, 3), rng.randint(0, 2), "n") for i in range(rng.choice([0, 1, 12]))] for n in range(7)]
    index, seen = RankIndex(spark, str(tmp_path / "i"), RUN, compact=3, buckets=4), []
    for n, rows in enumerate(batches):
        before, _ = plain_board(seen)
        seen += rows
        for _ in range(2 if n in (2, 3, 4) else 1):  # a batch that runs again, also where a base is written or follows
            index.apply(spark.createDataFrame(rows, RUN), n)
        after, runs = plain_board(seen)
        assert {tuple(r) for r in index.board(n + 1).collect()} == after
        assert {(r.lvl, r.nick): r.id for r in index.best(n + 1).collect()} == runs
        # what is written is what changed, no more
        touched = {(lvl, nick) for _, lvl, nick, *_ in rows}
        changed = {tuple(r) for r in index.changed(n).collect()}
        assert changed <= after and {c[:2] for c in changed} <= touched and {a[:3] for a in after} - {b[:3] for b in before} <= {c[:3] for c in changed}
    assert not (tmp_path / "i/best/0").exists() and (tmp_path / "i/base/5/best").exists() and not (tmp_path / "i/base/2").exists()


def test_ranks_of_a_stream(spark, tmp_path):
    index = RankIndex(spark, str(tmp_path / "i"), RUN, compact=2, buckets=2)
    first, second = [(1, 1, "x", 340, 2, 0, ""), (2, 1, "y", 1000, 2, 0, "")], [(3, 1, "x", 1000, 2, 0, ""), (4, 1, "y", 100, 2, 0, ""), (5, 1, "z", 100, 2, 0, "")]
    for rows in (first, second):
        spark.createDataFrame(rows, RUN).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        feed_ranks(spark.readStream.schema(RUN).parquet(str(tmp_path / "in")), index, str(tmp_path / "c"))
    answers = lambda n: {(r.nick, r.score, r["rank"]) for r in spark.read.parquet(str(tmp_path / f"i/answers/{n}")).collect()}
    assert answers(0) == {("x", 340, 2), ("y", 1000, 1)} and answers(1) == {("x", 1000, 1), ("z", 100, 3)}
    assert index.best(2).filter(F.col("nick") == "y").first()["id"] == 2
