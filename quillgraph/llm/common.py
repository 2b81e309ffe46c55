"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a local session has a temporary folder; on a cluster,
    whose executors don't share one, it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quillgraph-"))
    return "file://" + _own_dir[0]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/quillgraph/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it again. The table goes when the driver ends."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(df: DataFrame) -> None:
    """Delete a materialized table that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/quillgraph/" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


#: Rows and bytes in a batch for Python workers, far fewer than Spark's defaults: whole texts of any length are in it, or
#: packed rows of many texts, and JVM and worker hold several batches each.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4194304b")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Where the session has Spark's own batch sizes for Python workers, it gets those of BATCHES."""
    for key, (default, own) in BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, own)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_digest(text: str = "text") -> Column:
    """The md5 of a text; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished phases before the next one writes its own.

    The first round drops the driver's Python objects, and the second what only they still held in the JVM.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


#: Running sums are taken modulo this power of two, so that adding two of them stays in a long.
BITS = 61
MASK = (1 << BITS) - 1
#: Most rows of a table that `looked_up` broadcasts: those of keys that over 1 / HEAVY_KEYS of the rows ask for.
HEAVY_KEYS, LEAST_HEAVY = 100_000, 1000


def wrapped(c: Column) -> Column:
    return c.bitwiseAND(F.lit(MASK))


def running(rows: DataFrame, key: str, order: list[str], sums: list[str], keep: list[str]) -> DataFrame:
    """keep, key, n (place within the key, from 1) and the running sums, modulo 2**BITS, of the long columns `sums`.

    Rows are dealt by ranges of (key, order), so a key of any size is spread. The table that is written pins the parts;
    a key that goes on in the next part carries its totals there: one row for each part reaches the driver.
    """
    columns = [*keep, key]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*columns).schema), "_part int", "n long", *(f"{s} long" for s in sums if s not in columns)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, base = TaskContext.get().partitionId(), None, np.zeros(len(sums) + 1, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(key).to_numpy()
            values = np.stack([np.ones(len(own), np.uint64), *(batch.column(s).to_numpy().view(np.uint64) for s in sums)])
            upto = np.cumsum(values, axis=1, dtype=np.uint64)
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            before = upto[:, starts] - values[:, starts]
            if own[0] == held:
                before[:, 0] -= base
            out = upto - np.repeat(before, np.diff([*starts, len(own)]), axis=1)
            held, base = own[-1], out[:, -1].copy()
            named = {c: batch.column(c) for c in columns} | {s: pa.array((v & np.uint64(MASK)).view(np.int64)) for s, v in zip(sums, out[1:], strict=True)}
            named |= {"_part": pa.array(np.full(len(own), part, np.int32)), "n": pa.array(out[0].view(np.int64))}
            yield pa.RecordBatch.from_arrays([named[c] for c in names], names)

    names = [*columns, "_part", "n", *(s for s in sums if s not in columns)]
    ranged = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select(*dict.fromkeys([*columns, *sums]))
    table = materialize(ranged.mapInArrow(run, schema), "running")
    ends = table.groupBy("_part").agg(F.min(key).alias("first"), F.max(F.struct(key, "n", *sums)).alias("last")).orderBy("_part").collect()
    carried, held, base = [], None, [0] * (len(sums) + 1)
    for e in ends:
        goes_on = e["first"] == held
        if goes_on:
            carried.append((e["_part"], held, *base))
        held, base = e["last"][0], [(x + (y if goes_on and e["last"][0] == held else 0)) & MASK for x, y in zip(e["last"][1:], base, strict=True)]
    if not carried:
        return table.drop("_part")
    added = [f"_{c}" for c in ("n", *sums)]
    offsets = table.sparkSession.createDataFrame(carried, ", ".join(["_part int", f"{key} long", *(f"{c} long" for c in added)]))
    joined = table.join(F.broadcast(offsets), ["_part", key], "left")
    return joined.withColumns({c: wrapped(F.col(c) + F.coalesce(f"_{c}", F.lit(0))) for c in ("n", *sums)}).drop("_part", *added)


def looked_up(rows: DataFrame, on: list[str], table: DataFrame, key: list[str]) -> DataFrame:
    """rows with the columns of table (one row for each key; names differ from those of rows), null where there is none.

    Keys that many rows ask for are found first and answered by a broadcast of at most HEAVY_KEYS rows of the table.
    """
    n = rows.count()
    heavy = rows.groupBy(*on).count().filter(F.col("count") > max(LEAST_HEAVY, n // HEAVY_KEYS)).drop("count")
    heavy = materialize(heavy.join(table, [F.col(a) == F.col(b) for a, b in zip(on, key, strict=True)], "inner").drop(*on), "heavy")
    if heavy.isEmpty():
        return rows.join(table, [F.col(a) == F.col(b) for a, b in zip(on, key, strict=True)], "left").drop(*key)
    first = rows.join(F.broadcast(heavy), [F.col(a) == F.col(b) for a, b in zip(on, key, strict=True)], "left")
    others = first.filter(F.col(key[0]).isNull()).select(*rows.columns)
    return first.filter(F.col(key[0]).isNotNull()).unionByName(others.join(table, [F.col(a) == F.col(b) for a, b in zip(on, key, strict=True)], "left")).drop(*key)
