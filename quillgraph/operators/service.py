"""The leaderboard service: ordered validation of submitted runs, acceptance, retention, rank and boards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions.text import sanitize
from quillgraph.operators import board

#: Nodes of a path, characters of a name and of a node.
MOST_NODES, NAME, NODE = 40, 20, 24


def parsed(bodies: DataFrame) -> DataFrame:
    """(id, ok, lvl, nick, path, hints, secs) of submissions (id, body JSON): ok is false where the body is no JSON."""
    schema = "lvl string, nick string, path array<string>, hints string, secs string"
    read = bodies.withColumn("_b", F.from_json("body", schema)).withColumn("ok", F.try_parse_json("body").isNotNull())
    whole = lambda c, low, high: board.bounded_int(F.coalesce(F.col(c), F.lit("")), low, high)
    path = F.transform(F.coalesce("_b.path", F.array().cast("array<string>")), lambda x: sanitize(F.coalesce(x, F.lit("")), NODE))
    lvl = F.regexp_extract(F.coalesce("_b.lvl", F.lit("")), r"^\s*([+-]?\d{1,9})", 1).try_cast("int")
    return read.select("id", "ok", lvl.alias("lvl"), sanitize(F.coalesce("_b.nick", F.lit("")), NAME).alias("nick"), path.alias("path"), whole("_b.hints", 0, 99).alias("hints"), whole("_b.secs", 0, 86_400).alias("secs"))


def validated(runs: DataFrame, levels: DataFrame, canonical: DataFrame, target: str) -> DataFrame:
    """runs with error, step, moves, dist and score: the first reason to reject a run, in the service's order, and the step
    (1-based) at which its path stands still or follows no link.

    runs (id, allowed, ok, lvl, nick, path, hints, secs); levels (lvl, start, dist, budget); canonical (a, b) with a < b.
    """
    known = F.broadcast(levels.select(F.col("lvl").alias("_lvl"), "start", "dist", "budget"))
    joined = runs.join(known, F.col("lvl") == F.col("_lvl"), "left").withColumn("moves", F.size("path") - 1)
    pairs = F.expr("transform(sequence(1, greatest(size(path) - 1, 1)), i -> struct(get(path, i - 1) AS x, get(path, i) AS y, i AS step))")
    joined = joined.withColumn("pairs", F.filter(pairs, lambda p: p["y"].isNotNull())).withColumn("still", F.try_element_at(F.filter("pairs", lambda p: p["x"] == p["y"]), F.lit(1))["step"])
    early = (
        F.when(~F.col("allowed"), "too_many").when(~F.col("ok"), "bad_json").when(F.col("nick") == "", "no_nick").when(~F.coalesce(F.col("lvl").between(1, 99), F.lit(False)), "bad_level")
        .when(~F.size("path").between(2, MOST_NODES), "bad_path").when(F.col("_lvl").isNull(), "no_level").when(F.get("path", F.lit(0)) != F.col("start"), "wrong_start")
        .when(F.try_element_at("path", F.lit(-1)) != target, "not_finished").when(F.col("moves") > F.col("budget"), "over_budget").when(F.col("still").isNotNull(), "repeat")
    )
    judged = joined.withColumn("early", early)
    # only the steps of runs that are right so far are looked up
    steps = judged.filter("early is null").select("id", F.explode("pairs").alias("p")).select("id", "p.step", F.least("p.x", "p.y").alias("a"), F.greatest("p.x", "p.y").alias("b"))
    broken = steps.join(canonical, ["a", "b"], "left_anti").groupBy("id").agg(F.min("step").alias("broken"))
    out = judged.join(broken, "id", "left")
    error = F.coalesce("early", F.when(F.col("broken").isNotNull(), "no_such_link"))
    step = F.when(F.col("early") == "repeat", F.col("still")).otherwise(F.col("broken"))
    score = F.when(error.isNull(), board.points(F.col("moves"), F.col("dist"), F.col("hints")))
    return out.select("id", "lvl", "nick", "path", "hints", "secs", "moves", error.alias("error"), step.alias("step"), "dist", score.alias("score"))


def accepted(judged: DataFrame) -> DataFrame:
    """The rows that the service stores of validated runs."""
    return judged.filter("error is null").select("id", "lvl", "nick", "moves", "hints", "secs", "score", F.concat_ws(",", "path").alias("path"))


def ranked(judged: DataFrame) -> DataFrame:
    """(id, lvl, nick, score, best, rank) that accepted runs are answered with: the best of the run's name on its level, and
    one more than the other names with a better best. Names are counted by best score first, of which a level has at
    most some hundred, so no level's names meet in one task."""
    runs = judged.filter("error is null").select("id", "lvl", "nick", "score")
    best = runs.groupBy("lvl", "nick").agg(F.max("score").alias("best"))
    counts = best.groupBy("lvl", "best").agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.partitionBy("lvl").orderBy(F.desc("best")).rowsBetween(Window.unboundedPreceding, -1))
    places = counts.select("lvl", "best", (F.coalesce(above, F.lit(0)) + 1).alias("rank"))
    return runs.join(best, ["lvl", "nick"]).join(F.broadcast(places), ["lvl", "best"]).select("id", "lvl", "nick", "score", "best", "rank")


def retained(runs: DataFrame) -> DataFrame:
    """What the store keeps: the best run of each name and level."""
    return board.best_runs(runs)


def top(runs: DataFrame, lvl: int | None, asked: int | None = None) -> DataFrame:
    """A page of the board of a level, or of all levels together; at most 50 rows, 20 by default."""
    if lvl is None:
        return board.total_board(runs).orderBy(F.desc("total"), F.desc("levels"), "nick").limit(board.page_size(asked))
    return board.level_board(runs.filter(F.col("lvl") == lvl)).orderBy(F.desc("score"), "moves", "secs", "nick").limit(board.page_size(asked))


def health(levels: DataFrame, canonical: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: counts of the three tables, and whether runs can be accepted."""
    counts = [df.agg(F.count("*").alias(name)) for name, df in (("levels", levels), ("edges", canonical), ("runs", runs))]
    one = counts[0].join(F.broadcast(counts[1])).join(F.broadcast(counts[2]))
    return one.withColumn("ok", (F.col("levels") > 0) & (F.col("edges") > 0))
