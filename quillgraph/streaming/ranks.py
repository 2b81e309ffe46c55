"""Boards fed by micro-batches that write what changes: runs that become a name's best, and by how much that moves the
counts of names by level and best score. A rank is one more than the counts above a score.

A folder holds

* best/<n>: the runs that batch n made their name's best, by bucket of (lvl, nick), each with `was`, the score before;
* counts/<n>: (lvl, score, n) by how much batch n changes the number of names with that best score;
* base/<n>/best and base/<n>/counts: both of all batches up to n, every `compact` batches; older ones go one batch later.

Which of them batch n reads follows from n alone, and it reads none that it writes, so a batch that runs again after a
failure writes the same again. A level's counts have a row for each score, of which the game has some hundred; they and not the
names are what is ranked.

Defined cases: runs without a score are no runs; a null level or name is a level or name like any other; of runs
that are equal in score, moves and seconds the smallest id counts, and of a run that comes twice one; an empty batch changes
nothing; columns beyond id, lvl, nick, score, moves and secs are kept, but for `was` and `bucket`, which are the index's own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quillgraph.operators.board import best_runs
from quillgraph.streaming.limits import _drop

COUNTS = "lvl int, score long, n long"


class RankIndex:
    def __init__(self, spark: SparkSession, folder: str, runs_schema: str, compact: int = 8, buckets: int = 64):
        """runs_schema: DDL of the runs' columns, with id, lvl, nick, score, moves and secs among them."""
        self.spark, self.folder, self.compact, self.buckets = spark, folder, compact, buckets
        self.runs = spark.createDataFrame([], runs_schema).schema
        self.stored = StructType([*self.runs, StructField("was", LongType()), StructField("bucket", IntegerType())])

    def _parts(self, kind: str, before: int) -> list[str]:
        """The folders that together say what was so before a batch."""
        base = before // self.compact * self.compact - 1
        return ([f"{self.folder}/base/{base}/{kind}"] if base >= 0 else []) + [f"{self.folder}/{kind}/{n}" for n in range(base + 1, before)]

    def _read(self, parts: list[str], schema: StructType | str) -> DataFrame:
        read = [self.spark.read.schema(schema).parquet(part) for part in parts]
        return reduce(DataFrame.unionByName, read) if read else self.spark.createDataFrame([], schema)

    def best(self, before: int) -> DataFrame:
        """The best run of each (lvl, nick) of all batches before that number."""
        return best_runs(self._read(self._parts("best", before), self.stored).select(*self.runs.names))

    def counts(self, before: int) -> DataFrame:
        """(lvl, score, n): names by best score."""
        return _summed(self._read(self._parts("counts", before), COUNTS))

    def ranks(self, before: int) -> DataFrame:
        """(lvl, score, rank): one more than the names above each score that some name has."""
        above = F.sum("n").over(Window.partitionBy("lvl").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
        return self.counts(before).select("lvl", "score", (F.coalesce(above, F.lit(0)) + 1).alias("rank"))

    def board(self, before: int) -> DataFrame:
        """(lvl, nick, score, rank) of every name."""
        ranks = self.ranks(before).alias("r")
        at = F.col("b.lvl").eqNullSafe(F.col("r.lvl")) & (F.col("b.score") == F.col("r.score"))
        return self.best(before).alias("b").join(ranks, at).select("b.lvl", "b.nick", F.col("r.score").alias("score"), "r.rank")

    def _bucketed(self, runs: DataFrame) -> DataFrame:
        return runs.withColumn("bucket", F.pmod(F.xxhash64("lvl", "nick"), F.lit(self.buckets)).cast("int"))

    def apply(self, batch: DataFrame, number: int) -> None:
        """Write what batch `number` changes; those before it must have been applied, in order."""
        if number and number % self.compact == 0:
            # the base up to the batch before is whole, so nothing reads any more what it was made of
            first = number - self.compact
            _drop(self.spark, f"{self.folder}/base/{first - 1}", *[f"{self.folder}/{kind}/{n}" for kind in ("best", "counts") for n in range(first, number)])
        runs = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.runs]).filter("score is not null")
        new = self._bucketed(best_runs(runs)).alias("new")
        same = [F.col("old.bucket") == F.col("new.bucket"), *[F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in ("lvl", "nick")]]
        # only names that the batch has are looked at; where it is small, only their buckets' files are read
        old = best_runs(self._read(self._parts("best", number), self.stored).drop("was").alias("old").join(new, same, "left_semi")).alias("old")
        order = lambda t: F.struct((-F.col(f"{t}.score")).alias("s"), f"{t}.moves", f"{t}.secs", f"{t}.id")
        better = new.join(old, same, "left").filter(F.col("old.bucket").isNull() | (order("new") < order("old")))
        columns = [F.col(f"new.`{c}`") for c in self.runs.names]
        better.select(*columns, F.col("old.score").cast("long").alias("was"), "new.bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/best/{number}")
        written = self._read([f"{self.folder}/best/{number}"], self.stored)
        change = lambda score, n: F.struct(F.col(score).cast("long").alias("score"), F.lit(n).cast("long").alias("n"))
        moved = written.select("lvl", F.inline(F.array(change("score", 1), change("was", -1)))).filter("score is not null")
        _summed(moved).write.mode("overwrite").parquet(f"{self.folder}/counts/{number}")
        if number % self.compact == self.compact - 1:
            best = self._read([*self._parts("best", number), f"{self.folder}/best/{number}"], self.stored).select(*self.runs.names)
            base = self._bucketed(best_runs(best)).withColumn("was", F.lit(None).cast("long"))
            base.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/base/{number}/best")
            _summed(self._read([*self._parts("counts", number), f"{self.folder}/counts/{number}"], COUNTS)).write.mode("overwrite").parquet(f"{self.folder}/base/{number}/counts")

    def changed(self, number: int) -> DataFrame:
        """(lvl, nick, score, rank) of the names whose best run batch `number` changed, as ranked after it."""
        ranks = self.ranks(number + 1).alias("r")
        at = F.col("c.lvl").eqNullSafe(F.col("r.lvl")) & (F.col("c.score") == F.col("r.score"))
        return self._read([f"{self.folder}/best/{number}"], self.stored).alias("c").join(ranks, at).select("c.lvl", "c.nick", F.col("r.score").alias("score"), "r.rank")


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lvl", "score").agg(F.sum("n").alias("n")).filter("n != 0")


def feed_ranks(runs: DataFrame, index: RankIndex, checkpoint: str) -> None:
    """Apply a stream of runs; folder/answers/<n> has the names that batch n changed, with their ranks."""

    def serve(batch: DataFrame, number: int) -> None:
        index.apply(batch, number)
        index.changed(number).write.mode("overwrite").parquet(f"{index.folder}/answers/{number}")

    runs.writeStream.foreachBatch(serve).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
