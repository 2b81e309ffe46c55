"""Scans: parquet tables with their bindings, keyed JSON folders, optional files, and a paged Python data source."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, target, in_lead, kind): one row for each link of a document (customer) to an entity (part)."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    name = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
    return joined.select(name("C", "o_custkey").alias("source"), name("P", "l_partkey").alias("target"), (F.col("l_linenumber") == 1).alias("in_lead"), F.col("l_returnflag").alias("kind"))


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A whole-file JSON array with an explicit schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def keyed_json(spark: SparkSession, *folders: str, value_schema: str) -> DataFrame:
    """(key, value, file) of folders of JSON objects; of a key in several files, the last file by name wins, and a file of a
    later folder before any of an earlier one."""
    parts = [spark.read.text(f, wholetext=True).select("value", F.lit(i).alias("rank"), F.col("_metadata.file_name").alias("file")) for i, f in enumerate(folders)]
    raw = reduce(DataFrame.union, parts)
    parsed = raw.select("rank", "file", F.explode(F.from_json("value", f"map<string,{value_schema}>")).alias("key", "value"))
    best = parsed.groupBy("key").agg(F.max_by(F.struct("value", "file"), F.struct("rank", "file")).alias("best"))
    return best.select("key", "best.value", "best.file")


def optional(read: Callable[[], DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    """read(), or an empty table of the schema if there is no such file."""
    try:
        return read()
    except Exception as e:  # Spark reports a missing path by several classes
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


@dataclass
class Keys(InputPartition):
    keys: list[str]


@dataclass(frozen=True)
class Settings:
    """What a run can be told: layout iterations, neighbours kept of a node, hubs of a shared entity at most, seed, weights
    inside and between clusters, and candidates and core mentions of a source."""

    iterations: int = 2000
    neighbours: int = 8
    most_hubs: int = 60
    seed: int = 20260922
    inside: float = 5.0
    between: float = 0.2
    candidates: int = 40
    core: int = 20

    @classmethod
    def read(cls, given: dict[str, str]) -> Settings:
        """Of names to texts, such as the environment; names are in capitals, others are left alone."""
        return cls(**{f.name: type(f.default)(given[f.name.upper()]) for f in fields(cls) if given.get(f.name.upper())})


class Pace:
    """At least `gap` seconds between one call's begin and the next."""

    def __init__(self, gap: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep, self.last = gap, clock, sleep, float("-inf")

    def __call__(self) -> None:
        wait = self.last + self.gap - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.last = self.clock()


def fetch_with_retries(get: Callable[[], str], tries: int = 8, sleep: Callable[[float], None] = time.sleep, pace: Callable[[], None] = lambda: None) -> str:
    """get(), again after an OSError: after its `retry_after` seconds if it has that; else, if it has the `status` of an
    answer, after 5, 10, 20 .. 60 seconds, and after 1, 2, 4 .. 60 otherwise. The last error is raised. get's own time limit
    counts as such an error."""
    for k in range(tries):
        pace()
        try:
            return get()
        except OSError as e:
            if k == tries - 1:
                raise
            first = 5 if getattr(e, "status", None) is not None else 1
            sleep(getattr(e, "retry_after", None) or min(60, first * 2**k))
    raise AssertionError


def captured(folder: str, key: str, page: str, pace: Callable[[], None]) -> tuple[list[tuple], str | None]:
    """The rows of a captured page, and the token of the page after it, null after the last."""
    with open(f"{folder}/{key}.{page}.json", encoding="utf-8") as f:
        body = json.loads(fetch_with_retries(f.read, pace=pace))
    return [(key, r["title"], int(r["ns"])) for r in body["members"] if r["ns"] in (0, 14)], body.get("continue")


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.pages, self.batch = options["pages"], int(options.get("batch", 50))
        self.keys, self.gap = [k for k in options.get("keys", "").split("|") if k], float(options.get("gap", 0))

    def partitions(self) -> list[Keys]:
        return [Keys(self.keys[i : i + self.batch]) for i in range(0, len(self.keys), self.batch)]

    def read(self, partition: Keys) -> Iterator[tuple]:
        pace = Pace(self.gap)
        for key in partition.keys:
            page: str | None = "0"
            while page is not None:
                rows, page = captured(self.pages, key, page, pace)
                yield from rows


@dataclass
class Span(InputPartition):
    key: str
    first: str
    end: str | None


class PagedStreamReader(DataSourceStreamReader):
    """The same pages as a stream whose offset is each key's next page, null once it is through. In a micro-batch up to
    `batch` keys go on by one page, so a crawl that breaks goes on at the page where it stopped, and reads no rows again but
    those of the batch that broke. The driver reads a page for the token of the one after it, executors for its rows."""

    def __init__(self, options: dict):
        self.pages, self.batch, self.gap = options["pages"], int(options.get("batch", 50)), float(options.get("gap", 0))
        self.keys, self.pace, self.at = [k for k in options.get("keys", "").split("|") if k], Pace(self.gap), None

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.keys, "0")

    def latestOffset(self) -> dict:
        # a key that was added since the stream began starts at its first page
        at = self.initialOffset() | (self.at or {})
        for key in [k for k, page in at.items() if page is not None][: self.batch]:
            at[key] = captured(self.pages, key, at[key], self.pace)[1]
        self.at = at
        return at

    def partitions(self, start: dict, end: dict) -> list[Span]:
        # a stream that starts again first plans its last batch, which says where it was
        self.at = end if self.at is None else self.at
        return [Span(k, start.get(k, "0"), page) for k, page in end.items() if start.get(k, "0") != page]

    def read(self, partition: Span) -> Iterator[tuple]:
        page, pace = partition.first, Pace(self.gap)
        while page is not None and page != partition.end:
            rows, page = captured(self.pages, partition.key, page, pace)
            yield from rows

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    """Captured responses `<key>.<page>.json` in a folder, followed through their continuation tokens, as a table or a stream.

    Options: pages (folder), keys (joined by |), batch (keys in a partition or micro-batch), gap (seconds between pages).
    """

    @classmethod
    def name(cls) -> str:
        return "paged_members"

    def schema(self) -> str:
        return "key string, title string, ns int"

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(self.options)
