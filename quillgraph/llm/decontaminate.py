"""Benchmark decontamination: q-gram lemma filtering over diagonal bands, then banded alignment.

Texts are compared as UTF-8 bytes with A-Z in lower case and white space runs as one space. An item is searched by units:
an item of up to UNIT bytes is one unit, a longer one has a unit at each of its positions. A document is contaminated if
a part of it is within `edits` of a unit, a tenth of its length. By the q-gram lemma such a part shares at least
length - Q + 1 - Q * edits q-grams with the unit, on diagonals at most `edits` apart. So shared q-grams are counted in
overlapping bands of diagonals; bands that reach the number in some unit are kept, and units that reach it in their band
are verified by an alignment within the band, those of most q-grams first. Items under SHORTEST bytes leave no room for
edits: they are found where their words stand in the text, unchanged.

The benchmark is a stated query set: it is searched in blocks of at most BLOCK_BYTES, each sent to all executors, while
the documents stay where they are: no text is shuffled. Shared q-grams are listed in slices of at most SLICE pairs, so
texts and items of one repeated period take no more memory than others.

Defined cases: null items and items without a word are not searched; null and empty documents are clean; documents of
any length are scanned whole, in overlapping portions; repeated rows are judged alike; an empty benchmark leaves all
documents clean; extra columns are ignored by `leaks` and kept by `remove_contaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import text_digest

Q, RATE, UNIT, SHORTEST = 8, 0.1, 128, 24
EDITS = int(UNIT * RATE)
#: Diagonals in half a band; bytes of an item indexed together; bytes between texts, which no alignment can pass.
BAND, CHUNK, GAP = EDITS + 1, 2048, 4 * EDITS
BLOCK_BYTES, SCAN, SLICE = 2_000_000, 1_000_000, 4_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def normalized(text: str | None) -> bytes:
    if not text:
        return b""
    x = text.encode().lower().translate(_SPACES)
    return b" ".join(x.split()) if b"  " in x or x[:1] == b" " or x[-1:] == b" " else x


def q_grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each position, as one number."""
    return np.lib.stride_tricks.as_strided(data, (max(0, len(data) - Q + 1), Q), (1, 1)).copy().view(np.uint64).ravel()


class Patterns:
    """One block of items, with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str | None]]):
        chunks: dict[bytes, set[int]] = {}
        self.short: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
        for item_id, text in items:
            x = normalized(text)
            if len(x) >= SHORTEST:
                for s in range(0, max(1, len(x) - UNIT), CHUNK - UNIT):
                    chunks.setdefault(x[s : s + CHUNK], set()).add(item_id)
            elif x:
                words = tuple(x.split())
                self.short.setdefault(len(words), {}).setdefault(words, set()).add(item_id)
        self.text, self.items = list(chunks), list(chunks.values())
        self.unit = np.array([min(len(x), UNIT) for x in self.text], np.int64)
        self.edits = np.minimum((self.unit * RATE).astype(np.int64), (self.unit - Q) // Q)
        self.least = self.unit - Q + 1 - Q * self.edits
        codes = [q_grams(np.frombuffer(x, np.uint8)) for x in self.text]
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.chunk = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])[order] if codes else np.zeros(0, np.int32)
        self.place = np.concatenate([np.arange(len(c), dtype=np.int32) for c in codes])[order] if codes else np.zeros(0, np.int32)
        self.code, self.first, self.count = np.unique(code[order], return_index=True, return_counts=True)
        self.shift = np.uint64(64 - min(26, max(16, (24 * len(self.code)).bit_length())))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), bool)
        self.maybe[(self.code * _ODD) >> self.shift] = True

    def _hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in data, number of its q-gram in the index) of each q-gram that the index has."""
        code = q_grams(data)
        at = np.flatnonzero(self.maybe[(code * _ODD) >> self.shift])
        found = np.minimum(np.searchsorted(self.code, code[at]), len(self.code) - 1)
        real = self.code[found] == code[at]
        return at[real], found[real]

    def bands(self, at: np.ndarray, found: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(text, chunk, first diagonal, distinct places in the chunk) of the bands that share enough q-grams with some unit.

        at: the hits' positions in their texts, ascending in each text; text: the texts' numbers.
        """
        n = self.count[found]
        total = int(n.sum())
        if total > SLICE and at[-1] - at[0] > 8 * UNIT and text[0] == text[-1]:
            # a part within the edits is shorter than twice a unit
            middle = (at[0] + at[-1]) // 2
            for own in (at < middle + 2 * UNIT, at >= middle - 2 * UNIT):
                yield from self.bands(at[own], found[own], text[own])
            return
        if total > SLICE and text[0] != text[-1]:
            border = np.searchsorted(text, text[len(text) // 2])
            border = border if border else np.searchsorted(text, text[0], "right")
            yield from self.bands(at[:border], found[:border], text[:border])
            yield from self.bands(at[border:], found[border:], text[border:])
            return
        entry = np.repeat(self.first[found], n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        chunk, place = self.chunk[entry], self.place[entry]
        diagonal = np.repeat(at, n) - place + CHUNK
        # bands are BAND apart and two of them wide, so any BAND neighbouring diagonals lie in one
        span = (int(at[-1] if text[0] == text[-1] else at.max()) + CHUNK) // BAND + 3
        key = (np.repeat(text, n) * len(self.text) + chunk) * span + diagonal // BAND + 1
        order = np.argsort(key, kind="stable")
        halves, begin, hits = np.unique(key[order], return_index=True, return_counts=True)
        after = np.searchsorted(halves, halves + 1)
        there = halves[np.minimum(after, len(halves) - 1)] == halves + 1
        together = hits + np.where(there, hits[np.minimum(after, len(halves) - 1)], 0)
        # a half whose lower neighbour has hits is only looked at with it
        alone = ~np.isin(halves - 1, halves)
        kept = (together >= self.least[halves // span % len(self.text)]) & (there | alone)
        for h in np.flatnonzero(kept).tolist():
            own = order[begin[h] : begin[h] + hits[h]]
            if there[h]:
                own = np.concatenate([own, order[begin[after[h]] : begin[after[h]] + hits[after[h]]]])
            number, half = divmod(int(halves[h]), span)
            yield *divmod(number, len(self.text)), (half - 1) * BAND - CHUNK, np.unique(place[own])

    def units(self, chunk: int, places: np.ndarray) -> np.ndarray:
        """Begins of the chunk's units that have enough of the places, those of most places first."""
        m = int(self.unit[chunk])
        begin = np.arange(len(self.text[chunk]) - m + 1)
        n = np.searchsorted(places, begin + m - Q, "right") - np.searchsorted(places, begin, "left")
        own = np.flatnonzero(n >= self.least[chunk])
        return own[np.argsort(-n[own], kind="stable")]

    def distances(self, data: np.ndarray, chunk: int, begin: np.ndarray, diagonal: int) -> np.ndarray:
        """Least edits between each unit and a part of data on the diagonals from `diagonal` to 2 * BAND further, widened
        by the edits. A diagonal is a position in data less one in the chunk."""
        m, more = int(self.unit[chunk]), int(self.edits[chunk])
        whole, width = np.frombuffer(self.text[chunk], np.uint8), 2 * BAND + 2 * more
        low = int(begin.min()) + diagonal - more
        high = int(begin.max()) + m + diagonal - more + width
        near = np.full(high - low, 255, np.uint8)
        a, z = max(low, 0), min(high, len(data))
        if a < z:
            near[a - low : z - low] = data[a:z]
        start, ramp = begin + diagonal - more - low, np.arange(width)
        row = np.zeros((len(begin), width), np.int16)
        for j in range(m):
            best = row + (near[start[:, None] + j + ramp] != whole[begin + j][:, None])
            best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
            row = (np.minimum.accumulate(best - ramp, axis=1) + ramp).astype(np.int16)
        return row.min(axis=1)

    def _verified(self, data: np.ndarray, chunk: int, diagonal: int, places: np.ndarray) -> int | None:
        """Edits of the first unit that lies in the band within its edits."""
        begin, at, step = self.units(chunk, places), 0, 1
        while at < len(begin):
            edits = self.distances(data, chunk, begin[at : at + step], diagonal)
            if edits.min() <= self.edits[chunk]:
                return int(edits.min())
            at, step = at + step, min(16 * step, 4096)
        return None

    def search(self, texts: list[str | None], all_items: bool = True) -> list[dict[int, int]]:
        """For each text the items that it contains, with the edits of an alignment; else only one of them."""
        out: list[dict[int, int]] = [{} for _ in texts]
        held: list[tuple[int, bytes]] = []

        def scan() -> None:
            gap = b"\xff" * GAP
            data = np.frombuffer(gap.join(x for _, x in held) + gap, np.uint8)
            starts = np.cumsum([0, *[len(x) + GAP for _, x in held]])
            at, found = self._hits(data)
            if not len(at):
                return
            text = np.searchsorted(starts, at, "right") - 1
            for number, chunk, diagonal, places in self.bands(at - starts[text], found, text):
                own = out[held[number][0]]
                if self.items[chunk] <= own.keys() or own and not all_items:
                    continue
                edits = self._verified(data, chunk, diagonal + int(starts[number]), places)
                if edits is not None:
                    for item in self.items[chunk]:
                        own[item] = min(edits, own.get(item, edits))

        size = 0
        for i, text in enumerate(texts):
            x = normalized(text)
            if self.short:
                words = x.split()
                for n, items in self.short.items():
                    for k in range(len(words) - n + 1):
                        out[i].update(dict.fromkeys(items.get(tuple(words[k : k + n]), ()), 0))
            for base in range(0, max(1, len(x)), SCAN) if self.text else ():
                part = x[base : base + SCAN + 2 * UNIT]
                if len(part) >= Q:
                    held.append((i, part))
                    size += len(part)
                if size >= SCAN:
                    scan()
                    held, size = [], 0
        if held:
            scan()
        return out


def blocks(benchmark: DataFrame, text: str = "text", item: str = "item_id") -> Iterator[Patterns]:
    """The benchmark's items, in blocks of about BLOCK_BYTES."""
    rows = benchmark.filter(F.col(text).isNotNull()).select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for b in range(n):
        yield Patterns(sorted(rows.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_items, least_edits, item_ids) of each contaminated row of docs, whatever blocks its items are in."""
    names, schema = ["doc_id", "digest", "found"], "doc_id long, digest binary, found array<struct<item:long,edits:int>>"
    wanted, out, n = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"), "text"), None, 0
    for patterns in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], patterns: Patterns = patterns) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = patterns.search(batch.column("text").to_pylist())
                own = pa.array([i for i, f in enumerate(found) if f], pa.int64())
                each = pa.array([[{"item": k, "edits": e} for k, e in f.items()] for f in found if f], pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32())])))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(own), batch.column("digest").take(own), each], names)

        one, n = wanted.mapInArrow(run, schema).withColumn("block", F.lit(n)), n + 1
        out = one if out is None else out.union(one)
    if out is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, n_items int, least_edits int, item_ids array<long>")
    if n > 1:
        # rows of the same doc_id and text are told apart by nothing, so each block finds as many of them
        in_block = out.groupBy("doc_id", "digest", "block").agg(F.first("found").alias("found"), F.count("*").alias("rows"))
        whole = in_block.groupBy("doc_id", "digest").agg(F.flatten(F.collect_list("found")).alias("found"), F.max("rows").alias("rows"))
        out = whole.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    items = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item"])))
    return out.select("doc_id", F.size(items).alias("n_items"), F.array_min(F.transform("found", lambda x: x["edits"])).alias("least_edits"), items.alias("item_ids"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The clean rows of docs, with all their columns."""
    for patterns in blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], patterns: Patterns = patterns) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not f for f in patterns.search(batch.column("text").to_pylist(), all_items=False)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
