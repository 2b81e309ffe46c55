"""Mixture-controlled packing: deficit round-robin over source queues fills every window to target proportions.

Each source is a queue of tokens. Windows of SEQUENCE tokens are filled in order; in each, every queue earns its share
of the window, is served whole tokens of what it is owed, and carries the rest, its deficit, to the next window. The
shares are the queues' shares of all tokens, so all queues run dry together and every window keeps the proportions.
Windows come in groups of GROUP tokens. What each queue is owed at the begin of a group has a closed form, so groups,
and thus partitions, are planned independently while deficits carry over exactly. The very last tokens, too few for a
window, fill sequences whose lengths are powers of two, so no sequence needs padding.

Sources with less than a token in a window (SMALL of all tokens) share one queue, so at most 1 / SMALL + 1 queues are
planned, and how many sources there are doesn't matter. In that queue a source's tokens of each chunk, a task's documents,
stand where its share of its tokens is reached; so each such source keeps its proportion too, over stretches of about a
chunk instead of a window. If such sources have less than a token in a window all together, their tokens stand so in the
largest source's queue.

Defined cases: a null text is empty and has only its end id; a null source is a source of its own; an empty table
gives no pieces; documents of null or repeated ids are packed like any other, each in its own pieces; extra columns
are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import materialize
from quillgraph.llm.token_ids import byte_bpe
from quillgraph.operators.rules import running

SEQUENCE, GROUP = 1024, 1 << 20
SMALL = 1 / SEQUENCE
BATCH_ROWS = 1000
#: Numbers of planned groups that a worker keeps.
KEPT_CELLS, STARTS_KEPT = 6_000_000, 5000
#: A table of so many (chunk, source) rows is broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 200_000


class Plan:
    """Where the tokens of each queue go. totals: tokens of each queue."""

    def __init__(self, totals: list[int]):
        self.totals, self.total = totals, sum(totals)
        self.kept: OrderedDict[int, tuple] = OrderedDict()
        self.starts: dict[int, list[int]] = {}

    def served_before(self, group: int) -> list[int]:
        """Tokens of each queue before the group: its exact share rounded down, the rest to the largest remainders."""
        if group not in self.starts:
            if len(self.starts) * len(self.totals) > KEPT_CELLS // 10 or len(self.starts) > STARTS_KEPT:
                self.starts.clear()
            self.starts[group] = self._served_before(group)
        return self.starts[group]

    def _served_before(self, group: int) -> list[int]:
        n = min(group * GROUP, self.total)
        exact = [divmod(n * t, self.total) for t in self.totals]
        served = [whole for whole, _ in exact]
        for s in sorted(range(len(exact)), key=lambda s: (-exact[s][1], s))[: n - sum(served)]:
            served[s] += 1
        return served

    def sizes(self, group: int) -> list[int]:
        left = min(GROUP, self.total - group * GROUP)
        rest = left % SEQUENCE
        return [SEQUENCE] * (left // SEQUENCE) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]

    def group(self, group: int) -> tuple[np.ndarray, np.ndarray]:
        """(bounds, offsets), each windows x queues: queue positions at the begin of each window and after the last; and
        where the queue's tokens begin in the window."""
        if group in self.kept:
            self.kept.move_to_end(group)
            return self.kept[group]
        first, sizes = np.array(self.served_before(group), np.int64), self.sizes(group)
        share, span = np.array(self.served_before(group + 1), np.int64) - first, sum(sizes)
        bounds = np.zeros((len(sizes) + 1, len(share)), np.int64)
        served, owed = np.zeros_like(share), np.zeros_like(share)  # owed: the deficits, in 1 / span tokens
        for w, size in enumerate(sizes):
            owed += share * size
            give = np.minimum(np.maximum(owed // span, 0), share - served)
            while (free := size - int(give.sum())) != 0:
                left = owed - give * span
                able = np.flatnonzero(give < share - served if free > 0 else give > 0)
                chosen = able[np.argsort(-left[able] if free > 0 else left[able], kind="stable")][: abs(free)]
                give[chosen] += 1 if free > 0 else -1
            owed -= give * span
            served += give
            bounds[w + 1] = served
        counts = np.diff(bounds, axis=0)
        out = bounds + first, np.cumsum(counts, axis=1) - counts
        self.kept[group] = out
        while len(self.kept) > 1 and sum(b.size + o.size for b, o in self.kept.values()) > KEPT_CELLS:
            self.kept.popitem(last=False)
        return out

    def borders(self, queue: int, position: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(edges, windows, offsets) of a queue from some window at or before `position` to one past `end`: positions at
        which its windows begin, and after the last; the windows' numbers; and where the queue's tokens begin in them."""
        group = position * self.total // (self.totals[queue] * GROUP)
        while group and self.served_before(group)[queue] > position:
            group -= 1
        edges, windows, offsets = [], [], []
        while True:
            bounds, begins = self.group(group)
            edges.append(bounds[:-1, queue])
            offsets.append(begins[:, queue])
            windows.append(np.arange(len(begins)) + group * (GROUP // SEQUENCE))
            if bounds[-1, queue] >= end:
                return np.append(np.concatenate(edges), bounds[-1, queue]), np.concatenate(windows), np.concatenate(offsets)
            group += 1

    def pieces(self, queue: int, position: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
        """(which, start, length, sequence, offset) of the pieces of runs of `length` tokens of a queue, from `position`."""
        end = position + length
        edges, windows, offsets = self.borders(queue, int(position.min()), int(end.max()))
        first, last = np.searchsorted(edges, position, "right") - 1, np.searchsorted(edges, end, "left")
        n = last - first
        which = np.repeat(np.arange(len(n)), n)
        w = np.arange(len(which)) + np.repeat(first - (np.cumsum(n) - n), n)
        begin, stop = np.maximum(edges[w], position[which]), np.minimum(edges[w + 1], end[which])
        some = stop > begin
        which, w, begin, stop = which[some], w[some], begin[some], stop[some]
        return which, begin - position[which], stop - begin, windows[w], offsets[w] + begin - edges[w]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(chunk, source, doc_id, position, n, ids): a chunk is a task, position counts a source's tokens in it."""
    names = ["chunk", "source", "doc_id", "position", "n", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, bpe, end, at = TaskContext.get().partitionId(), byte_bpe(tokenizer), struct.pack("<H", end_id), {}
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(i, BATCH_ROWS)
                ids = [b + end for b in bpe.ids(batch.column("text").to_pylist())]
                position = []
                for source, b in zip(batch.column("source").to_pylist(), ids, strict=True):
                    position.append(at.get(source, 0))
                    at[source] = position[-1] + len(b) // 2
                columns = [pa.array([chunk] * len(ids), pa.int32()), batch.column("source"), batch.column("doc_id"), pa.array(position, pa.int64()), pa.array([len(b) // 2 for b in ids], pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
        bpe.forget()

    wanted = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(wanted.mapInArrow(run, "chunk int, source string, doc_id long, position long, n long, ids binary"), "packing-ids")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Pieces of docs (doc_id, text, source): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids."""
    ids = tokenize(docs, tokenizer, end_id)
    per_chunk = ids.groupBy("chunk", "source").agg(F.sum("n").alias("n"))
    per_source = per_chunk.groupBy("source").agg(F.sum("n").alias("n")).withColumn("null", F.col("source").isNull())
    total = per_source.agg(F.sum("n")).first()[0] or 0
    # at most 1 / SMALL rows
    large = per_source.filter(F.col("n") >= SMALL * total).orderBy("source").collect()
    totals = [r["n"] for r in large]
    small, rest = total - sum(totals), len(totals)
    if 0 < small < SMALL * total and totals:
        # less than a token in a window together: they stand among the largest source's
        rest = max(range(len(totals)), key=lambda i: totals[i])
        totals[rest] += small
    elif small:
        totals.append(small)
    spark = docs.sparkSession
    queues = spark.createDataFrame([(r["source"], i) for i, r in enumerate(large)], "source string, queue int")
    with_queue = per_chunk.alias("c").join(F.broadcast(queues).alias("q"), F.expr("c.source <=> q.source"), "left").select("c.chunk", "c.source", "c.n", F.coalesce("q.queue", F.lit(rest)).alias("queue"))
    # where in its source a chunk's tokens lie: a row for each chunk
    own = Window.partitionBy("source").orderBy("chunk")
    middle = F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("n") / 2
    spread = with_queue.withColumn("at", middle / F.sum("n").over(Window.partitionBy("source")))
    starts = spark.createDataFrame([(i, sum(totals[:i])) for i in range(len(totals))], "queue int, start long")
    placed = running(spread, ["queue", "at", "chunk", "source"], F.col("n")).join(F.broadcast(starts), "queue")
    bases = materialize(placed.select("chunk", F.col("source").alias("_source"), "queue", (F.col("before") - F.col("start")).alias("base")), "packing-bases")
    if bases.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    placed = ids.join(bases, (ids["chunk"] == bases["chunk"]) & ids["source"].eqNullSafe(bases["_source"])).select("doc_id", "queue", (F.col("base") + F.col("position")).alias("position"), "n", "ids")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(totals)
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                part = whole.slice(i, BATCH_ROWS)
                queue, position, n = (part.column(c).to_numpy() for c in ("queue", "position", "n"))
                found = []
                for q in np.unique(queue).tolist():
                    own = np.flatnonzero(queue == q)
                    which, *rest = plan.pieces(q, position[own], n[own])
                    found.append((own[which], *rest))
                take, start, length, sequence, offset = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.argsort(take, kind="stable")
                take, start, length, sequence, offset = (x[order] for x in (take, start, length, sequence, offset))
                ends = np.cumsum(np.bincount(take, minlength=len(n))).tolist()
                crcs, own = [], []
                a_of, z_of, at = (4 * start).tolist(), (4 * (start + length)).tolist(), 0
                for b, until in zip(part.column("ids").to_pylist(), ends, strict=True):
                    raw = memoryview(np.frombuffer(b, "<u2").astype("<u4").tobytes())
                    cuts = [raw[a:z] for a, z in zip(a_of[at:until], z_of[at:until], strict=True)]
                    crcs += map(zlib.crc32, cuts)
                    own += map(bytes, cuts) if with_ids else ()
                    at = until
                columns = [part.column("doc_id").take(pa.array(take)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64()), pa.array(n[take]), pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(own, pa.binary())] * with_ids], names)

    return placed.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids)
