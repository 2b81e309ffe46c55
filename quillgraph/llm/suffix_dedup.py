"""Suffix-array dedup: remove every byte that a LENGTH-byte string covers which an earlier document also has.

A suffix array over all texts would need one machine to hold them. Here equal strings meet in small pieces instead:

1. Each window of LENGTH bytes has a minimizer, the least hash of its K-byte substrings; equal windows have equal
   ones. The minimizers of all documents, packed into one row for each batch and bucket, are grouped by value; those
   that only one doc_id has can't lie in a repeated window, and go.
2. The windows whose minimizer is shared are cut out as runs, with K + 2 * (LENGTH - K) bytes or so each, and meet in a
   task by their minimizer. The number of buckets grows with the bytes of all texts, so a task's share doesn't.
3. A task joins its distinct runs in portions of about PORTION bytes into one text, sorts its suffixes to depth LENGTH,
   and expands intervals on its Burrows-Wheeler transform: breadth first, every interval of a prefix is extended
   backwards by a character, which yields the longest common prefixes by increasing value; it stops at LENGTH. What is
   then undivided are the strings of LENGTH bytes; each gets the smallest doc_id that has it.
4. The bytes covered by strings of an earlier document return to their documents.

Equal runs of a scanned portion are one row. Of their places, those of a larger doc_id than the smallest there are known to
be covered, and are told at once; only the smallest one's have to meet others. A minimizer of over HOT places forms no
group: its windows meet by their own hash, as rows of that kind too. So a passage that a third of all documents have sends a
place for each portion and window, not for each document.

Defined cases: a null or empty text, or one shorter than LENGTH, loses nothing; a null doc_id counts as larger than all
others, and rows of equal doc_id (also null ones) are never earlier than each other; repeated rows are answered each;
rows of equal doc_id are told apart by a 32-bit hash of their text, rows of null doc_id by 96 bits; texts of any length
are cut into overlapping portions; an empty table gives no rows; extra columns are ignored by `find_spans` and `report`
and kept by `remove_repeats`, but for columns named _did, _dig, _null, _spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import drop_path, materialize, release

LENGTH, K = 50, 16
#: Places of one minimizer beyond which its windows are spread; windows in a run; bytes handled at once by a scan and by
#: a suffix sort; bytes of texts to a bucket; windows and places compared at once.
HOT, RUN, SCAN, PORTION, BUCKET_BYTES, COMPARED, PLACES = 20_000, 64, 1_000_000, 300_000, 8_000_000, 1_000_000, 100_000
#: Owner of what only rows without a doc_id have. A text has less than 2**31 bytes, so the top bit of a place tells them.
NO_ID, NULL = (1 << 63) - 1, np.uint32(1 << 31)
PLACE = np.dtype([("did", "<i8"), ("dig", "<i4"), ("at", "<u4")])
_ODD = np.uint64(0x9E3779B97F4A7C15)


def minimizers(data: np.ndarray) -> np.ndarray:
    """For each window of LENGTH bytes, the least hash of its K-byte substrings. data: uint8, at least LENGTH."""
    n, padded = len(data) - K + 1, np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(np.uint64).ravel()
    h = words[:n] * _ODD
    h ^= h >> np.uint64(29)
    for at in range(8, K, 8):
        h = (h + words[at : at + n]) * _ODD
        h ^= h >> np.uint64(31)
    span, width = 1, LENGTH - K + 1
    while span * 2 <= width:
        h, span = np.minimum(h[:-span], h[span:]), span * 2
    return np.minimum(h[: len(h) - (width - span)], h[width - span :])


def portions(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, text number and position of each run of windows, begin of the run in data, its number of windows), and
    the run's minimizer as last; a run is of equal minimizers in one text. Texts over SCAN are cut with an overlap."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def scan() -> tuple:
        data = np.frombuffer(b"".join(x for _, _, x in held), np.uint8)
        lengths = np.array([len(x) for _, _, x in held])
        ends = np.cumsum(lengths)
        low = minimizers(data)
        piece = np.repeat(np.arange(len(held)), lengths)[: len(low)]
        valid = np.arange(len(low)) + LENGTH <= ends[piece]
        at = np.flatnonzero(valid)
        new = np.concatenate([[True], (low[at[1:]] != low[at[:-1]]) | (at[1:] != at[:-1] + 1)])
        begin = at[new]
        count = np.diff(np.append(np.flatnonzero(new), len(at)))
        own = piece[begin]
        text = np.array([i for i, _, _ in held])[own]
        place = begin - (ends - lengths)[own] + np.array([b for _, b, _ in held])[own]
        return data, text, place, begin, count, low[begin]

    for i, x in enumerate(texts):
        for base in range(0, max(1, len(x) - LENGTH + 1), SCAN):
            part = x[base : base + SCAN + LENGTH - 1]
            if len(part) >= LENGTH:
                held.append((i, base, part))
                size += len(part)
            if size >= SCAN:
                yield scan()
                held, size = [], 0
    if held:
        yield scan()


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _owners(places: np.ndarray) -> np.ndarray:
    """The doc_id of each place."""
    return np.where(places["at"] & NULL, NO_ID, places["did"])


def codes(low: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 40 bits of each minimizer, as one number. Two that share a code only make needless candidates."""
    mixed = low * _ODD
    return ((mixed >> np.uint64(24)) % np.uint64(buckets) << np.uint64(40)) | (mixed & np.uint64((1 << 40) - 1))


def shared_minimizers(docs: DataFrame, buckets: int, hot: int) -> DataFrame:
    """(_did, _null, code) of each minimizer code that at least two doc_ids have; -1 - code if it has over `hot` places.

    A packed row holds a batch's codes of one bucket: the doc_ids, how many codes each has, and 5 bytes a code.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(text, low) for _, text, _, _, _, low in portions(_texts(batch.column("text")))]
            if not found:
                continue
            text, low = (np.concatenate(c) for c in zip(*found, strict=True))
            did, code = batch.column("_did").to_numpy(), codes(low, buckets)
            null = batch.column("_null").to_numpy(zero_copy_only=False).astype("u1")
            bucket = (code >> np.uint64(40)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            present, first = np.unique(bucket[order], return_index=True)
            rows = []
            for b, own in zip(present.tolist(), np.split(order, first[1:]), strict=True):
                used, n = np.unique(text[own], return_counts=True)
                packed = np.ascontiguousarray(code[own].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]
                rows.append((b, did[used].tobytes(), null[used].tobytes(), n.astype("<u4").tobytes(), packed.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 4), strict=True)], ["bucket", "dids", "nulls", "counts", "packed"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(bucket: int, parts: list[tuple]) -> pa.RecordBatch:
            did = np.concatenate([np.repeat(np.frombuffer(d, np.int64), np.frombuffer(n, "<u4")) for d, _, n, _ in parts])
            null = np.concatenate([np.repeat(np.frombuffer(d, "u1"), np.frombuffer(n, "<u4")) for _, d, n, _ in parts]) > 0
            wide = np.zeros((len(did), 8), np.uint8)
            wide[:, :5] = np.concatenate([np.frombuffer(x, np.uint8) for *_, x in parts]).reshape(-1, 5)
            code = wide.view("<u8").ravel()
            order = np.argsort(code)
            did, null, code = did[order], null[order], code[order]
            owner = np.where(null, NO_ID, did)
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            n = np.diff(np.append(first, len(code)))
            shared = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
            keep, own = np.repeat(shared, n), code.astype(np.int64) | (bucket << 40)
            return pa.RecordBatch.from_arrays([pa.array(did[keep]), pa.array(null[keep]), pa.array(np.where(np.repeat(n > hot, n), -1 - own, own)[keep])], ["_did", "_null", "code"])

        held, now = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "dids", "nulls", "counts", "packed")), strict=True):
                if row[0] != now and held:
                    yield close(now, held)
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield close(now, held)

    packed = docs.mapInArrow(pack, "bucket int, dids binary, nulls binary, counts binary, packed binary")
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(group, "_did long, _null boolean, code long")


RUNS = "bucket int, keys binary, lengths binary, strings binary, counts binary, places binary"


def runs(candidates: DataFrame, buckets: int) -> DataFrame:
    """The runs of windows with shared minimizers, packed: a row holds a portion's distinct runs of one bucket, that is their
    keys (uint64), lengths (uint8), strings, numbers of places (uint32) and places (PLACE). A row without keys holds places
    that are known to be covered, with the numbers of their windows as counts."""
    names = ["bucket", "keys", "lengths", "strings", "counts", "places"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 5), strict=True)], names)

    def pack(key: np.ndarray, strings: list[bytes], number: np.ndarray, windows: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        """key and strings of each distinct run; number of its run, and windows, for each place."""
        owner, least = _owners(places), np.full(len(strings), NO_ID)
        np.minimum.at(least, number, owner)
        decided = owner > least[number]
        if decided.any():
            done, n = places[decided], windows[decided].astype(np.int64)
            same = (done["did"][1:] == done["did"][:-1]) & (done["dig"][1:] == done["dig"][:-1]) & (done["at"][1:] == done["at"][:-1] + n[:-1])
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            yield batch_of([(int(done["at"][0]) % buckets, None, None, None, np.add.reduceat(n, first).astype("<u4").tobytes(), done[first].tobytes())])
        rest = np.flatnonzero(~decided)
        rest = rest[np.argsort(number[rest], kind="stable")]
        counts = np.bincount(number[rest], minlength=len(strings))
        begin, bucket = np.cumsum(counts) - counts, (key % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((key, bucket))
        used, first = np.unique(bucket[order], return_index=True)
        rows = []
        for b, own in zip(used.tolist(), np.split(order, first[1:]), strict=True):
            text = [strings[i] for i in own.tolist()]
            rows.append((b, key[own].tobytes(), bytes(map(len, text)), b"".join(text), counts[own].astype("<u4").tobytes(), places[rest[_ranges(begin[own], counts[own])]].tobytes()))
        yield batch_of(rows)

    def numbered(raw: bytes, begin: np.ndarray, length: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        found: dict[bytes, int] = {}
        number = np.array([found.setdefault(raw[b:z], len(found)) for b, z in zip(begin.tolist(), (begin + length).tolist(), strict=True)])
        return list(found), number

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, wanted = _rows(batch), np.unique(batch.column("codes").flatten().to_numpy())
            cool, hot = wanted[wanted >= 0].view(np.uint64), np.unique(-1 - wanted[wanted < 0]).view(np.uint64)
            for data, text, place, begin, count, low in portions(_texts(batch.column("text"))):
                code, raw = codes(low, buckets), data.tobytes()
                own = np.flatnonzero(np.isin(code, cool))
                if len(own):
                    # runs of at most RUN windows
                    parts = -(-count[own] // RUN)
                    run_of = np.repeat(own, parts)
                    inner = (np.arange(len(run_of)) - np.repeat(np.cumsum(parts) - parts, parts)) * RUN
                    n = np.minimum(count[run_of] - inner, RUN)
                    where = rows[text[run_of]]
                    where["at"] += (place[run_of] + inner).astype(np.uint32)
                    strings, number = numbered(raw, begin[run_of] + inner, n + LENGTH - 1)
                    key = np.zeros(len(strings), np.uint64)
                    key[number] = code[run_of]
                    yield from pack(key, strings, number, n, where)
                own = np.flatnonzero(np.isin(code, hot))
                if len(own):
                    n = count[own]
                    where = rows[np.repeat(text[own], n)]
                    where["at"] += _ranges(place[own], n).astype(np.uint32)
                    strings, number = numbered(raw, _ranges(begin[own], n), np.full(int(n.sum()), LENGTH))
                    yield from pack(np.array([xxhash.xxh64_intdigest(x) for x in strings], np.uint64), strings, number, np.ones(len(where), np.int64), where)

    return candidates.mapInArrow(run, RUNS)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    """The place at which each text of a batch begins."""
    out = np.zeros(batch.num_rows, PLACE)
    out["did"], out["dig"] = batch.column("_did").to_numpy(), batch.column("_dig").to_numpy()
    out["at"] = batch.column("_null").to_numpy(zero_copy_only=False).astype(np.uint32) * NULL
    return out


SPANS = "_did long, _null boolean, _dig int, start long, n int"


def _spans(places: np.ndarray, more: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Spans that begin `more` bytes after the places and have n windows."""
    null, at = (places["at"] & NULL) > 0, (places["at"] & ~NULL).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(places["did"])), pa.array(null), pa.array(np.ascontiguousarray(places["dig"])), pa.array(at + more), pa.array((n + LENGTH - 1).astype(np.int32))], ["_did", "_null", "_dig", "start", "n"])


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers of begin .. begin + length - 1, range after range."""
    ends = np.cumsum(length)
    return np.repeat(begin - (ends - length), length) + np.arange(int(length.sum()))


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffix array of data to depth LENGTH: suffixes that agree so far come in any order."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    rank = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)
    depth = 8
    order = None
    while depth < LENGTH:
        step = min(depth, LENGTH - depth)
        if depth == 8:
            first = np.argsort(rank)
            own = rank[first]
            dense = np.empty(len(rank), np.uint64)
            dense[first] = np.cumsum(np.concatenate([[0], own[1:] != own[:-1]])).astype(np.uint64)
            rank = dense
        key = rank * np.uint64(len(rank) + 1)
        key[: len(rank) - step] += rank[step:] + np.uint64(1)
        order = np.argsort(key)
        own = key[order]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], own[1:] != own[:-1]])).astype(np.uint64)
        depth += step
    return order


def long_intervals(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Number of its interval of common prefix `depth`, for each place of the suffix array.

    first[j] is the character of suffix j and step[j] the place of the suffix one character shorter, so that first is
    the transform's character at step[j]: extending each interval of a prefix backwards by each character puts a border
    before j where the character changes or where a border lies between step[j - 1] and step[j]. Level by level, the
    places that get a border have the next larger common prefix; places that have one are done.
    """
    n = len(order)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    step, first = place[np.minimum(order + 1, n - 1)], data[order]
    border = np.concatenate([[True], first[1:] != first[:-1]])
    active = np.flatnonzero(~border)
    for _ in range(1, depth):
        interval = np.cumsum(border, dtype=np.int32)
        new = interval[step[active]] != interval[step[active - 1]]
        if not new.any():
            break
        border[active[new]] = True
        active = active[~new]
    return np.cumsum(border, dtype=np.int64) - 1


def earliest(strings: list[bytes], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, size): for each window of LENGTH bytes of each string, string after string, the smallest owner of a string
    with that window; and the strings' numbers of windows."""
    lengths = np.array([len(s) + 1 for s in strings])
    data = np.frombuffer(b"\0".join(strings) + b"\0" * (LENGTH + 1), np.uint8)
    order = suffix_order(data)
    interval = long_intervals(data, order, LENGTH)
    begin, size = np.cumsum(lengths) - lengths, lengths - LENGTH
    windows = _ranges(begin, size)
    value = np.full(len(data), NO_ID)
    value[windows] = np.repeat(owner, size)
    least = np.minimum.reduceat(value[order], np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]])))
    out = np.empty(len(data), np.int64)
    out[order] = least[interval]
    return out[windows], size


def earlier_runs(least: np.ndarray, first: np.ndarray, size: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which, begin, n): runs of windows with a smaller least owner than their place's. A place has the `size` windows from
    `first`; `which` is its number, and begin counts from its first window."""
    low = least[_ranges(first, size)] < np.repeat(owner, size)
    begins, ends = np.cumsum(size) - size, np.cumsum(size) - 1
    before, after = np.concatenate([[False], low[:-1]]), np.concatenate([low[1:], [False]])
    before[begins] = False
    after[ends] = False
    start, end = np.flatnonzero(low & ~before), np.flatnonzero(low & ~after)
    which = np.searchsorted(begins, start, "right") - 1
    return which, start - begins[which], end - start + 1


def covered(met: DataFrame, buckets: int) -> DataFrame:
    """(_did, _null, _dig, start, n) of byte spans that strings of an earlier doc_id cover: n bytes from start."""

    def portion(strings: list[bytes], counts: np.ndarray, every: np.ndarray) -> Iterator[pa.RecordBatch]:
        code: dict[bytes, int] = {}
        number = np.repeat(np.array([code.setdefault(s, len(code)) for s in strings], np.int32), counts)
        owner = np.full(len(code), NO_ID)
        slices = [slice(i, i + PLACES) for i in range(0, len(every), PLACES)]
        for s in slices:
            np.minimum.at(owner, number[s], _owners(every[s]))
        least, size = earliest(list(code), owner)
        first = np.cumsum(size) - size
        low, high = np.minimum.reduceat(least, first), np.maximum.reduceat(least, first)
        for s in slices:
            of, places = number[s], every[s]
            own = _owners(places)
            whole = high[of] < own
            if whole.any():
                yield _spans(places[whole], np.zeros(int(whole.sum()), np.int64), size[of[whole]])
            some = np.flatnonzero(~whole & (low[of] < own))
            ends = np.cumsum(size[of[some]])
            at = 0
            while at < len(some):
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARED)))
                part = some[at:end]
                which, begin, n = earlier_runs(least, first[of[part]], size[of[part]], own[part])
                yield _spans(places[part[which]], begin, n)
                at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            key, lengths, counts, places = (np.frombuffer(b"".join(p[i] for p in parts), t) for i, t in ((0, np.uint64), (1, np.uint8), (3, "<u4"), (4, PLACE)))
            raw = b"".join(p[2] for p in parts)
            parts.clear()
            ends, last = np.cumsum(lengths, dtype=np.int64), np.cumsum(counts, dtype=np.int64)
            order = np.argsort(key, kind="stable")
            filled, new = np.cumsum(lengths[order], dtype=np.int64), np.concatenate([[True], key[order][1:] != key[order][:-1]])
            at = 0
            # a portion ends between two keys
            borders = np.append(np.flatnonzero(new), len(order))
            while at < len(order):
                past = np.searchsorted(filled, (filled[at - 1] if at else 0) + PORTION)
                end = int(borders[min(np.searchsorted(borders, max(past, at + 1)), len(borders) - 1)])
                own = order[at:end]
                strings = [raw[z - n : z] for z, n in zip(ends[own].tolist(), lengths[own].tolist(), strict=True)]
                yield from portion(strings, counts[own], places[_ranges(last[own] - counts[own], counts[own].astype(np.int64))])
                at = end

        held, now = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "lengths", "strings", "counts", "places")), strict=True):
                if row[1] is None:
                    yield _spans(done := np.frombuffer(row[5], PLACE), np.zeros(len(done), np.int64), np.frombuffer(row[4], "<u4").astype(np.int64))
                    continue
                if row[0] != now and held:
                    yield from close(held)
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield from close(held)

    return met.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, SPANS)


KEYS = ["_did", "_null", "_dig"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"_did": F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)), "_null": F.col("doc_id").cast("long").isNull(), "_dig": F.hash(text)})


def find_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(_did, _null, _dig, _spans array of (start, n)): the covered byte spans of documents that have any, unmerged."""
    spark = docs.sparkSession
    texts = _keyed(docs).select(*KEYS, "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    shared = materialize(shared_minimizers(texts.select("_did", "_null", "text"), buckets, hot).groupBy("_did", "_null").agg(F.collect_list("code").alias("codes")), "shared")
    release(spark)
    candidates = texts.join(shared, ["_did", "_null"]).select(*KEYS, "codes", "text")
    spans = materialize(covered(runs(candidates, buckets), buckets), "covered")
    drop_path(shared)
    del shared, texts, candidates
    release(spark)
    return spans.groupBy(*KEYS).agg(F.collect_list(F.struct("start", "n")).alias("_spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of overlapping or touching spans."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.column_stack([spans[new, 0], reach[np.append(new[1:] - 1, len(spans) - 1)]])


def _each(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray]]:
    spans = batch.column("_spans")
    for x, own in zip(_texts(batch.column("text")), spans, strict=True):
        if own.is_valid and len(own):
            begin = own.values.field("start").to_numpy()
            yield x, merged(np.column_stack([begin, begin + own.values.field("n").to_numpy()]))
        else:
            yield x, np.zeros((0, 2), np.int64)


def without(x: bytes, spans: np.ndarray) -> bytes:
    kept, at = [], 0
    for a, z in spans.tolist():
        kept.append(x[at:a])
        at = z
    return b"".join([*kept, x[at:]])


def report(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of docs."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, count, sha = [], [], [], []
            for x, spans in _each(batch):
                n.append(len(x))
                removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
                count.append(len(spans))
                sha.append(hashlib.sha256(without(x, spans)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], names)

    joined = _keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).join(find_spans(docs, hot), KEYS, "left").select("doc_id", "text", "_spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """docs with the covered bytes gone from text; a character that is only partly covered stays whole."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for (x, spans), known in zip(_each(batch), batch.column("text").is_valid().to_pylist(), strict=True):
                inner = []
                for a, z in spans.tolist():
                    while a < z and x[a] & 0xC0 == 0x80:
                        a += 1
                    while z > a and z < len(x) and x[z] & 0xC0 == 0x80:
                        z -= 1
                    inner.append((a, z))
                texts.append(without(x, np.array(inner).reshape(-1, 2)).decode() if known else None)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names], names)

    joined = _keyed(docs).join(find_spans(docs, hot), KEYS, "left").select(*names, "_spans")
    return joined.mapInArrow(run, docs.schema)
