"""Leaderboards: points, best runs, boards and placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def points(moves: Column, dist: Column, hints: Column) -> Column:
    return F.greatest(F.lit(100), 1000 - 120 * (moves - dist) - 100 * hints)


def bounded_int(text: Column, low: int, high: int) -> Column:
    """Leading integer of a text, 0 if there is none, within bounds."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(F.expr("1") * F.regexp_extract(text, r"^\s*([+-]?\d{1,9})", 1).try_cast("int"), F.lit(0))))


def page_size(asked: int | None) -> int:
    return min(50, max(1, 20 if asked is None else asked))


def best_runs(runs: DataFrame) -> DataFrame:
    """One run for each (lvl, nick): most points, then fewest moves, seconds, smallest id."""
    order = Window.partitionBy("lvl", "nick").orderBy(F.desc("score"), "moves", "secs", "id")
    return runs.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def level_board(runs: DataFrame) -> DataFrame:
    """Best score, moves and seconds of each nick, each column for itself."""
    return runs.groupBy("lvl", "nick").agg(F.max("score").alias("score"), F.min("moves").alias("moves"), F.min("secs").alias("secs"))


def total_board(runs: DataFrame) -> DataFrame:
    best = runs.groupBy("nick", "lvl").agg(F.max("score").alias("score"))
    return best.groupBy("nick").agg(F.sum("score").alias("total"), F.count("*").alias("levels"))


def placement(runs: DataFrame) -> DataFrame:
    """1 + the nicks with a better best score, by level."""
    best = runs.groupBy("lvl", "nick").agg(F.max("score").alias("score"))
    return best.withColumn("place", F.rank().over(Window.partitionBy("lvl").orderBy(F.desc("score"))))


def run_error(nick: Column, lvl: Column, n_nodes: Column, known: Column, right_start: Column, finished: Column, over: Column, repeated: Column, bad_step: Column) -> Column:
    """The first reason to reject a submitted run, null if it is accepted."""
    return (
        F.when(F.coalesce(nick, F.lit("")) == "", "no_nick").when(~lvl.between(1, 99), "bad_level").when(~n_nodes.between(2, 40), "bad_path").when(~known, "no_level")
        .when(~right_start, "wrong_start").when(~finished, "not_finished").when(over, "over_budget").when(repeated, "repeat").when(bad_step.isNotNull(), "no_such_link")
    )
