"""Streaming: a rate limiter with a window that a key's first event opens, and a leaderboard fed by micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quillgraph.operators import service
from quillgraph.operators.board import best_runs

WINDOW_MS, MOST = 60_000, 20


def decide(times: list[int], opened: int | None, n: int, window_ms: int, most: int) -> tuple[list[bool], int | None, int]:
    """Whether each event (in order) is allowed; the window's begin and count afterwards. At window_ms exactly it is still open."""
    out = []
    for t in times:
        if opened is None or t - opened > window_ms:
            opened, n = t, 0
        n += 1
        out.append(n <= most)
    return out, opened, n


class RateLimiter(StatefulProcessor):
    def __init__(self, window_ms: int = WINDOW_MS, most: int = MOST, evict: bool = False):
        self.window_ms, self.most, self.evict = window_ms, most, evict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("window", "opened long, n long", 10 * self.window_ms if self.evict else None)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        own = pd.concat(rows).sort_values(["ms", "event_id"])
        opened, n = self.state.get() if self.state.exists() else (None, 0)
        allowed, opened, n = decide(own.ms.tolist(), opened, n, self.window_ms, self.most)
        self.state.update((opened, n))
        yield pd.DataFrame({"user_id": own.user_id, "event_id": own.event_id, "allowed": allowed})

    def close(self) -> None:
        pass


def limit_stream(events: DataFrame, window_ms: int = WINDOW_MS, most: int = MOST, evict: bool = False) -> DataFrame:
    """events (user_id, event_id, ms), a stream -> with allowed; needs the RocksDB state store.

    evict drops the state of keys that are idle for ten windows. It needs processing time, so it is for streams that run
    on; with an availableNow trigger such a query would not end.
    """
    limiter = RateLimiter(window_ms, most, evict)
    return events.groupBy("user_id").transformWithStateInPandas(limiter, "user_id long, event_id long, allowed boolean", "Append", "ProcessingTime" if evict else "none")


def limit_batch(events: DataFrame, window_ms: int = WINDOW_MS, most: int = MOST) -> DataFrame:
    """The same over a table: each key's events stream through a sorted partition, so no key is held in memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, opened, n = None, None, 0
        for batch in batches:
            out: list[bool] = []
            for user, own in batch.groupby((batch.user_id != batch.user_id.shift()).cumsum()):
                if own.user_id.iloc[0] != key:
                    key, opened, n = own.user_id.iloc[0], None, 0
                allowed, opened, n = decide(own.ms.tolist(), opened, n, window_ms, most)
                out += allowed
            yield pd.DataFrame({"user_id": batch.user_id, "event_id": batch.event_id, "allowed": out})

    ordered = events.select("user_id", "event_id", "ms").repartition("user_id").sortWithinPartitions("user_id", "ms", "event_id")
    return ordered.mapInPandas(run, "user_id long, event_id long, allowed boolean")


def feed_board(runs: DataFrame, folder: str, checkpoint: str) -> None:
    """Append each micro-batch's runs and keep the best of each (lvl, nick): generations of a table in folder, the last
    of which is the board. A batch that runs again after a failure writes the same generation again, from the one before,
    so two generations stay and older ones are deleted."""

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number:
            batch = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{folder}/{number - 1}"))
        best_runs(batch).write.mode("overwrite").parquet(f"{folder}/{number}")
        if number > 1:
            _drop(spark, f"{folder}/{number - 2}")

    runs.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def feed_service(bodies: DataFrame, levels: DataFrame, canonical: DataFrame, target: str, folder: str, checkpoint: str) -> None:
    """bodies (id, body, allowed), a stream of submissions: each micro-batch is validated; its answers (folder/answers, one
    folder for each batch) have the error, or the score, best and rank; the runs that are kept are generations in
    folder/board, as those of feed_board. A batch that runs again overwrites what it wrote."""
    spark = bodies.sparkSession
    schema = "id long, lvl int, nick string, moves int, hints int, secs int, score int, path string"

    def serve(batch: DataFrame, number: int) -> None:
        judged = service.validated(service.parsed(batch).join(batch.select("id", "allowed"), "id"), levels, canonical, target)
        judged.write.mode("overwrite").parquet(f"{folder}/judged/{number}")
        judged = spark.read.schema(judged.schema).parquet(f"{folder}/judged/{number}")
        before = spark.read.schema(schema).parquet(f"{folder}/board/{number - 1}") if number else spark.createDataFrame([], schema)
        new = service.accepted(judged).select(*[F.col(c).cast(t) for c, t in before.dtypes])
        best_runs(before.unionByName(new)).write.mode("overwrite").parquet(f"{folder}/board/{number}")
        board = spark.read.schema(schema).parquet(f"{folder}/board/{number}").withColumn("error", F.lit(None).cast("string"))
        places = service.ranked(board).select("lvl", "nick", "best", "rank")
        answers = judged.join(places, ["lvl", "nick"], "left")
        known = F.col("error").isNull()
        answers.select("id", "lvl", "nick", "error", "step", "score", F.when(known, F.col("best")).alias("best"), F.when(known, F.col("rank")).alias("rank")).write.mode("overwrite").parquet(f"{folder}/answers/{number}")
        _drop(spark, f"{folder}/board/{number - 2}", f"{folder}/judged/{number - 1}")

    bodies.writeStream.foreachBatch(serve).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _drop(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def event_stream(spark, sf_dir: str) -> DataFrame:
    """The events table as a stream of new files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
