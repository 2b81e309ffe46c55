"""SimHash near-duplicates, with pivot distance tables in front of the exact comparison.

Fingerprints are 64 bits. Only distinct fingerprints are compared, so copies cost nothing. Two of them that differ in
at most 3 bits agree in at least 3 of 6 bit fields; so each is put into 20 buckets, one for each choice of 3 fields,
and every linked pair meets in at least one bucket. A bucket of over BUCKET fingerprints is not compared but refined:
its free bits are cut into 6 fields again, with 3 of them agreeing, until a bucket is small or few free bits are left.
No bucket is capped, and no link is lost. In a bucket each fingerprint's Hamming distances to PIVOTS reference
fingerprints are tabled; a pair whose distances to any pivot differ by over 3 can't be linked (triangle inequality),
and the pairs that are left are compared exactly. Of each bucket only the links of a spanning forest leave the task.

`near_duplicates` serves a similarity of 0.8 and more of five-word shingles. There, linked fingerprints differ in up to
about 20 bits, for which no choice of equal fields is selective, so candidates meet where min-hash sketches of their
shingles agree in a band; the pivot table and the fingerprints discard, and the sketches tell which groups may hold similar
texts. In each such group the texts are then compared on the shingles themselves, so only exact links are left.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any other; a text of fewer words
than a shingle is one shingle; rows of a null doc_id take part and have the smallest known doc_id of their component,
null if there is none; repeated rows are answered each; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm import bloom
from quillgraph.llm.common import drop_path, materialize, text_digest
from quillgraph.llm.components import connected_components

RADIUS, FIELDS, BUCKET, PIVOTS, BATCH_ROWS = 3, 6, 4096, 12, 400
SHINGLE, SEED = 3, 42
_rng = np.random.default_rng(20)
PIVOT_BITS = _rng.integers(0, 1 << 63, PIVOTS, dtype=np.uint64) * np.uint64(2) + _rng.integers(0, 2, PIVOTS, dtype=np.uint64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle: `size` words joined by spaces, A-Z in lower case; of all words if there are fewer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = max(0, len(words) - size)
    starts = [0, *(ends[:k] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:z], SEED) for a, z in zip(starts, ends[-k - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 8192):
        part = hashes[i : i + 8192]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(i, BATCH_ROWS)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            fps = np.array([fingerprint(shingle_hashes(t, size)) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def fields(bits: list[int]) -> list[list[int]]:
    """The bits cut into FIELDS runs of about equal length."""
    cuts = [round(i * len(bits) / FIELDS) for i in range(FIELDS + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def free_bits(path: list[int]) -> list[int]:
    """Bits that are still free after the choices in path, each the number of a choice of RADIUS free fields."""
    bits = list(range(64))
    for choice in path:
        own = fields(bits)
        bits = [b for f in list(combinations(range(FIELDS), RADIUS))[choice] for b in own[f]]
    return bits


def bucket_keys(fps: DataFrame, depth: int) -> DataFrame:
    """(path array, key long, fp): the buckets of fps one step further than their `path`, which has `depth` choices."""
    choices = len(list(combinations(range(FIELDS), RADIUS)))
    if depth == 0:
        masks = [sum(1 << b for b in range(64)) - sum(1 << b for b in free_bits([c])) for c in range(choices)]
        options = F.array(*[F.struct(F.array(F.lit(c)).alias("path"), F.lit(m - (1 << 64) if m >> 63 else m).cast("long").alias("mask")) for c, m in enumerate(masks)])
        return fps.select("fp", F.explode(options).alias("o")).select("o.path", F.col("fp").bitwiseAND(F.col("o.mask")).alias("key"), "fp")
    paths = [[*p, c] for p in all_paths(depth, choices) for c in range(choices)]
    rows = [(p[:-1], p, (m := (1 << 64) - 1 - sum(1 << b for b in free_bits(p))) - ((m >> 63) << 64)) for p in paths]
    table = fps.sparkSession.createDataFrame(rows, "path array<int>, next array<int>, mask long")  # 20**(depth + 1) rows
    return fps.join(F.broadcast(table), "path").select(F.col("next").alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def all_paths(depth: int, choices: int) -> list[list[int]]:
    return [[]] if depth == 0 else [[*p, c] for p in all_paths(depth - 1, choices) for c in range(choices)]


def linked_pairs(fps: np.ndarray, radius: int, step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of distinct fingerprints that differ in at most `radius` bits.

    The fingerprints are sorted by their distance to the first pivot, so each is paired only with those at most
    `radius` further on; the other pivots' tables discard pairs by their largest coordinate difference.
    """
    table = np.bitwise_count(fps[:, None] ^ PIVOT_BITS[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    table, own = table[order], fps[order]
    last = np.searchsorted(table[:, 0], table[:, 0] + radius, "right")
    for i in range(0, len(own), step):
        a, end = slice(i, i + step), int(last[min(i + step, len(own)) - 1])
        near = np.arange(i, end)[None, :] > np.arange(i, min(i + step, len(own)))[:, None]
        for p in range(PIVOTS):
            near &= np.abs(table[a, p, None] - table[None, i:end, p]) <= radius
        x, y = np.nonzero(near)
        ok = np.bitwise_count(own[i + x] ^ own[i + y]) <= radius
        yield order[i + x[ok]], order[i + y[ok]]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n nodes the smallest index that the pairs connect it with."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                break
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while (label[label] != label).any():
                label = label[label]
    return label


def compare_buckets(keyed: DataFrame, radius: int, refine: bool) -> DataFrame:
    """(path, key, a, b): links a > b of a spanning forest of each bucket; rows with b null are of buckets to refine.

    Buckets are consecutive runs of sorted partitions. A task holds one bucket of at most BUCKET fingerprints.
    """
    schema = "path array<int>, a long, b long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        held_key, size, over = None, 0, False

        def rows(path: list[int], a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path] * len(a), pa.list_(pa.int32())), pa.array(a.view(np.int64)), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))], ["path", "a", "b"])

        def close() -> Iterator[pa.RecordBatch]:
            if size > 1 and not over:
                fps = np.sort(np.concatenate(held))
                low = forest(len(fps), linked_pairs(fps, radius))
                moved = np.flatnonzero(low != np.arange(len(fps)))
                if len(moved):
                    yield rows([], fps[moved], fps[low[moved]])

        for batch in batches:
            path = batch.column("path").to_pylist() if refine else None
            code = np.array([int("".join(f"{c:02d}" for c in p)) for p in path]) if refine else batch.column("choice").to_numpy()
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (code[1:] != code[:-1])) + 1).tolist(), len(key)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                now = (int(code[s]), int(key[s]))
                if now != held_key:
                    if size > 1:
                        yield from close()
                    held, held_key, size, over = [], now, 0, False
                held.append(fp[s:e])
                size += e - s
                if size > BUCKET:
                    own = path[s] if refine else [now[0]]
                    for part in held:
                        yield rows(own, part, None)
                    held, over = [], True
        if size > 1:
            yield from close()

    if refine:
        return keyed.select("path", "key", "fp").repartition("path", "key").sortWithinPartitions("path", "key").mapInArrow(run, schema)
    flat = keyed.select(F.get("path", F.lit(0)).alias("choice"), "key", "fp")
    return flat.repartition("choice", "key").sortWithinPartitions("choice", "key").mapInArrow(run, schema)


def links(fps: DataFrame) -> DataFrame:
    """(a, b) over the distinct column `fp`: links that connect whatever differs in at most RADIUS bits."""
    found, depth, todo, out = fps, 0, fps, []
    while True:
        found = materialize(compare_buckets(bucket_keys(todo, depth), RADIUS, depth > 0), "buckets")
        out.append(found.filter("b is not null").select("a", "b"))
        more = found.filter("b is null")
        depth += 1
        if more.isEmpty():
            break
        if depth == 3:
            # at most 8 or so free bits: such a bucket can't exceed BUCKET
            raise RuntimeError("a bucket exceeds its number of possible fingerprints")
        todo = more.select("path", F.col("a").alias("fp"))
    whole = out[0]
    for o in out[1:]:
        whole = whole.union(o)
    return whole


def simhash_components(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as 16 hexadecimal digits, component_id) of each row of docs."""
    marked = materialize(fingerprints(docs, size), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    nodes = connected_components(links(distinct.select("fp")))
    joined = distinct.join(nodes, distinct["fp"] == nodes["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    # only fingerprints that are linked or repeated differ from their own doc_id, but each is answered by one join
    of_fp = materialize(joined.join(smallest, "component").select(F.col("fp").alias("_fp"), "component_id"), "component-of")
    return marked.join(of_fp, marked["fp"] == of_fp["_fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Bins of the sketch, bands of bins that make candidates, and bits by which fingerprints of similar texts may differ.
BINS, BANDS, LOOSE_RADIUS = 256, 20, 24
#: Members of a band compared pair by pair, and members of a portion of a larger band than that.
DIRECT, PORTION = 64, 65536
#: Groups over GROUP_PORTION up to which their table is broadcast (24 bytes a row).
BROADCAST_ROWS = 200000
SIMILARITY, NEAR_SHINGLE = 0.8, 5
BAND_BINS = 5
#: Bits in the union of two bitmaps up to which they are compared; beyond, the min-hash bits are.
SMALL = 120
#: How far the sketches of similar texts may fall short: by min-hash bits and by bitmaps.
LARGE_ERROR, SMALL_ERROR = 0.13, 0.1
#: Texts and bytes of a portion of a group whose texts are compared; two portions at most are in a task.
GROUP_PORTION, GROUP_BYTES = 8192, 32_000_000
#: Bits of a set's bitmap (a power of two) where a group's texts are compared.
BITMAP = 4096


def sketch(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a hash of each band, 8 words) of the distinct hashes.

    Bands and the first 4 words, a bit of each bin, are of a one-permutation min-hash, in which an empty bin borrows from
    the next full one. The other 4 words are a bitmap of the hashes, which tells small sets apart more exactly.
    """
    mixed = np.unique(hashes) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    bins = (mixed >> np.uint64(40)) % np.uint64(BINS)
    order = np.lexsort((mixed, bins))
    bins, low = bins[order], mixed[order]
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    full = bins[first].astype(np.int64)
    at = np.searchsorted(full, np.arange(BINS)) % len(full)
    values = low[first][at] * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    bitmap = np.zeros(BINS, np.uint8)
    bitmap[(mixed >> np.uint64(16)) % np.uint64(BINS)] = 1
    bits = np.packbits(np.concatenate([(values & np.uint64(1)).astype(np.uint8), bitmap]), bitorder="little").view(np.uint64)
    keys = values[: BANDS * BAND_BINS].reshape(BANDS, BAND_BINS).copy()
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_BINS):
        key = (key ^ keys[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key, bits


def similar(others: np.ndarray, own: np.ndarray, similarity: float, errors: tuple[float, float] = (LARGE_ERROR, SMALL_ERROR)) -> np.ndarray:
    """Which of the others' sketches are of a set that is as similar as `similarity`, but for the sketch's errors."""
    both, either = np.bitwise_count(others[:, 4:] & own[:, 4:]).sum(axis=1), np.bitwise_count(others[:, 4:] | own[:, 4:]).sum(axis=1)
    # of the bins that differ, half have equal bits
    agreeing = 1 - 2 * np.bitwise_count(others[:, :4] ^ own[:, :4]).sum(axis=1) / BINS
    return np.where(either <= SMALL, both >= (similarity - errors[1]) * either, agreeing >= similarity - errors[0])


def band_links(fps: np.ndarray | None, bits: np.ndarray, similarity: float, errors: tuple[float, float] = (LARGE_ERROR, SMALL_ERROR), known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (as indices) that connect whatever the members of a band are connected by, with no limit on members.

    A pair is linked if neither the pivot table nor the fingerprints (if any) discard it and the sketches are similar. A few members
    are compared pair by pair. More are grouped around leaders, each with all that are linked to it and to none before;
    then two groups that are still apart are searched for a link. Differing min-hash bits and the Jaccard distance of
    bitmaps are metrics, so the distances of members to leaders tell which groups, and which members, can have one.
    Members of an equal `known` are connected already; no pair of them is looked at.
    """
    table = None if fps is None else np.bitwise_count(fps[:, None] ^ PIVOT_BITS).astype(np.int8)

    def linked(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if fps is None:
            return similar(bits[x], bits[y], similarity, errors)
        at = np.flatnonzero(np.abs(table[x] - table[y]).max(axis=1, initial=0) <= LOOSE_RADIUS)
        at = at[np.bitwise_count(fps[x[at]] ^ fps[y[at]]) <= LOOSE_RADIUS]
        out = np.zeros(len(x), bool)
        out[at] = similar(bits[x[at]], bits[y[at]], similarity, errors)
        return out

    def distances(x: np.ndarray, y: int) -> tuple[np.ndarray, np.ndarray]:
        both, either = np.bitwise_count(bits[x, 4:] & bits[y, 4:]).sum(axis=1), np.bitwise_count(bits[x, 4:] | bits[y, 4:]).sum(axis=1)
        return np.bitwise_count(bits[x, :4] ^ bits[y, :4]).sum(axis=1).astype(np.int64), 1 - both / np.maximum(either, 1)

    def constant(y: int, x: np.ndarray) -> np.ndarray:
        return np.broadcast_to(np.int64(y), x.shape)

    n = len(bits)
    label = np.arange(n) if known is None else np.unique(known, return_inverse=True)[1]
    if n <= DIRECT:
        x, y = np.triu_indices(n, 1)
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
        ok = linked(x, y)
        return y[ok], x[ok]
    reach = (BINS * (1 - (similarity - errors[0])) / 2 + 1e-6, 1 - (similarity - errors[1]) + 1e-6)
    lead, members, radius, a, b = [], [], [], [], []
    rest = np.arange(n)
    while len(rest):
        same = label[rest] == label[rest[0]]
        own = same | linked(rest, constant(rest[0], rest))
        lead.append(rest[0])
        members.append(rest[own])
        radius.append([d.max() for d in distances(members[-1], rest[0])])
        a.append(rest[own & ~same])
        b.append(constant(rest[0], a[-1]))
        label[np.isin(label, label[a[-1]])] = label[rest[0]]
        rest = rest[~own]
    lead, radius, size = np.array(lead), np.array(radius), np.array([len(m) for m in members])
    group = label[lead]

    def border(i: int, c: int) -> np.ndarray:
        """Members of group i that may be linked to one of group c."""
        h, j = distances(members[i], lead[c])
        return members[i][(h <= reach[0] + radius[c, 0]) | (j <= reach[1] + radius[c, 1])]

    for i in range(len(lead)):
        other = np.arange(i + 1, len(lead))
        # two leaders alone are known to be apart
        other = other[(group[other] != group[i]) & ((size[other] > 1) | (size[i] > 1))]
        h, j = distances(lead[other], lead[i])
        for c in other[(h <= reach[0] + radius[i, 0] + radius[other, 0]) | (j <= reach[1] + radius[i, 1] + radius[other, 1])]:
            if group[c] == group[i]:
                continue
            few, many = sorted((border(i, c), border(c, i)), key=len)
            for x in few:
                found = many[linked(many, constant(x, many))]
                if len(found):
                    a.append(found[:1])
                    b.append(np.array([x]))
                    group[group == group[c]] = group[i]
                    break
    return np.concatenate(a), np.concatenate(b)


def exact_links(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (as indices) of a spanning forest of the sets (sorted, distinct) whose Jaccard similarity is `similarity`.

    Each pair in the forest is compared exactly, and so is each pair whose ends it leaves apart, unless their sizes or, in a
    group of over DIRECT, their bitmaps prove that it is not similar: each bit that differs stands for an element that only
    one of them has. There, sets are first gathered around leaders; then those outside the largest part are compared with
    all that are still apart.
    """
    n = len(sets)
    length, label, a, b = np.array([len(s) for s in sets], np.int64), np.arange(n), [], []

    def alike(i: int, j: int) -> bool:
        x, y = (sets[i], sets[j]) if length[i] <= length[j] else (sets[j], sets[i])
        both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        return both >= similarity * (len(x) + len(y) - both) - 1e-9

    def join(i: int, j: int) -> None:
        a.append(i)
        b.append(j)
        label[label == label[i]] = label[j]

    def possible(x: int, others: np.ndarray) -> np.ndarray:
        low, high = np.minimum(length[others], length[x]), np.maximum(length[others], length[x])
        others = others[low >= similarity * high - 1e-9]
        if n <= DIRECT:
            return others
        differing = np.bitwise_count(maps[others] ^ maps[x]).sum(axis=1)
        return others[differing <= (1 - similarity) / (1 + similarity) * (length[others] + length[x]) + 1e-6]

    if n > DIRECT:
        maps = np.zeros((n, BITMAP), np.uint8)
        for i, s in enumerate(sets):
            maps[i, (s * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITMAP.bit_length() + 1)] = 1
        maps = np.packbits(maps, axis=1).view(np.uint64)
    rest = np.arange(n)
    while len(rest):
        x, rest = int(rest[0]), rest[1:]
        for y in possible(x, rest).tolist():
            if alike(x, y):
                join(y, x)
        rest = rest[label[rest] != label[x]]
    # two leaders alone are known to be apart
    several, largest = np.bincount(label, minlength=n)[label] > 1, np.bincount(label, minlength=n).argmax() if n else 0
    for x in np.flatnonzero(label != largest).tolist():
        others = np.flatnonzero((label != label[x]) & (several | several[x]))
        for y in possible(x, others).tolist():
            if label[y] != label[x] and alike(x, y):
                join(y, x)
    return np.array(a, np.int64), np.array(b, np.int64)


def verified(texts: DataFrame, similarity: float, size: int) -> DataFrame:
    """(a, b): links of digests that connect whatever similar texts connect. texts: (digest, component, text), a row for
    each digest; similar texts are of one component.

    A component that is too large for a task is cut into portions, each two of which meet in a task of their own.
    """
    sizes = texts.groupBy("component").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("rows") / GROUP_PORTION), F.ceil(F.col("bytes") / GROUP_BYTES))
    large = materialize(sizes.select(F.col("component").alias("_component"), parts.alias("n")).filter("n > 1"), "large-groups")
    parted, known = texts.select("component", F.lit(0).cast("long").alias("part"), "digest", "text"), large.count()
    if known:
        n = F.coalesce("n", F.lit(1).cast("long"))
        joined = texts.join(F.broadcast(large) if known <= BROADCAST_ROWS else large, F.col("component") == F.col("_component"), "left").withColumn("n", n)
        own = F.pmod(F.xxhash64("digest"), F.col("n"))
        meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda q: F.least(own, q) * F.col("n") + F.greatest(own, q))
        parted = joined.select("component", F.explode(meets).alias("part"), "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, digests, sets = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            a, b = exact_links(sets, similarity)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in end], pa.binary()) for end in (a, b)], ["a", "b"])

        for batch in batches:
            for component, part, digest, text in zip(*(batch.column(c) for c in ("component", "part", "digest", "text")), strict=True):
                now = (component.as_py(), part.as_py())
                if now != group:
                    yield from close()
                    group, digests, sets = now, [], []
                digests.append(digest.as_py())
                sets.append(np.unique(shingle_hashes(text.as_py(), size)))
        yield from close()

    return parted.repartition("component", "part").sortWithinPartitions("component", "part", "digest").mapInArrow(run, "a binary, b binary")


def loose_links(keyed: DataFrame, similarity: float, errors: tuple[float, float] = (LARGE_ERROR, SMALL_ERROR)) -> DataFrame:
    """(a, b): links that connect what the sketches of a key's members call similar. keyed: (key, n, rep, bits, fp where
    fingerprints may discard, known where members are connected already); a key is cut into n portions, each two of which
    meet in a task of their own."""
    own = F.pmod(F.xxhash64("rep"), F.col("n"))
    meets = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda q: F.least(own, q) * F.col("n") + F.greatest(own, q))
    with_fp, with_known = "fp" in keyed.columns, "known" in keyed.columns
    more = [c for c in ("fp", "known") if c in keyed.columns]
    parted = keyed.select("key", F.explode(meets).alias("part"), "rep", "bits", *more)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_group, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            bits, rep, fps, known = (np.concatenate([h[i] for h in held]) for i in range(4))
            a, b = band_links(fps if with_fp else None, bits, similarity, errors, known if with_known else None)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(rep[a], pa.binary()), pa.array(rep[b], pa.binary())], ["a", "b"])

        for batch in batches:
            key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64) if with_fp else key
            bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(-1, 8)
            rep = np.array(batch.column("rep").to_pylist(), object)
            known = np.array(batch.column("known").to_pylist(), object) if with_known else rep
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), len(key)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                group = (key[s], part[s])
                if group != held_group:
                    if sum(len(h[0]) for h in held) > 1:
                        yield from close()
                    held_group, held = group, []
                held.append((bits[s:e], rep[s:e], fps[s:e], known[s:e]))
        if sum(len(h[0]) for h in held) > 1:
            yield from close()

    return parted.repartition("key", "part").sortWithinPartitions("key", "part", "rep").mapInArrow(compare, "a binary, b binary")


def _alike(docs: DataFrame, similarity: float, size: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of each row of docs, and (digest, component) of the digests that have similar ones.

    A digest is the md5 of a text; equal texts are one candidate. A band of over PORTION candidates is cut into portions,
    and each two of them meet in a task of their own; so a task holds at most 2 * PORTION sketches, of about 100 bytes
    each, however large a group is, and every pair of a band is judged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            fps, keys, bits = [], [], []
            for t in batch.column("text").to_pylist():
                h = shingle_hashes(t, size)
                fps.append(fingerprint(h))
                key, bit = sketch(h) if len(h) else (np.zeros(0, np.uint64), np.zeros(8, np.uint64))
                keys.append(key.view(np.int64))
                bits.append(bit.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())], ["doc_id", "digest", "fp", "keys", "bits"])

    with_digest = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"), "text")
    marked = materialize(with_digest.mapInArrow(run, "doc_id long, digest binary, fp long, keys array<long>, bits binary"), "sketches")
    distinct = materialize(marked.select("digest", "fp", "keys", "bits").dropDuplicates(["digest"]), "distinct-sketches")
    # only bands with two candidates or more are compared, so the sketches of the others stay where they are
    bands = distinct.select(F.explode("keys").alias("key")).groupBy("key").count().filter("count > 1")
    bands = materialize(bands.select("key", F.ceil(F.col("count") / PORTION).alias("n")), "bands")
    n_blocks = bloom.size_for(bands.count())
    keyed = bloom.asked(distinct.select(F.explode("keys").alias("key"), F.col("digest").alias("rep"), "fp", "bits"), bloom.build(bands, n_blocks), n_blocks, admitted=True)
    loose = materialize(loose_links(keyed.join(bands, "key"), similarity), "near-links")
    maybe = connected_components(loose)
    drop_path(loose)
    drop_path(distinct)
    drop_path(bands)
    # of the texts only those of these groups are shuffled, one of each digest from a task
    n_blocks = bloom.size_for(maybe.count())
    possible = bloom.asked(with_digest.select("digest", "text", F.col("digest").alias("key")), bloom.build(maybe.select(F.col("node").alias("key")), n_blocks), n_blocks, admitted=True)
    one_each = possible.groupBy("digest").agg(F.first("text").alias("text"))
    texts = materialize(one_each.join(maybe, F.col("digest") == F.col("node")).select("digest", "component", "text"), "grouped-texts")
    drop_path(maybe)
    edges = materialize(verified(texts, similarity, size), "near-links")
    drop_path(texts)
    return marked.select("doc_id", "digest"), connected_components(edges).select(F.col("node").alias("_node"), "component")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, size: int = NEAR_SHINGLE) -> DataFrame:
    """(doc_id, component_id): rows of docs whose shingle sets are similar, directly or through others, share the
    smallest doc_id among them."""
    rows, nodes = _alike(docs, similarity, size)
    digests = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    named = digests.join(nodes, digests["digest"] == nodes["_node"], "left").select("digest", "least", F.coalesce("component", "digest").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "component").select(F.col("digest").alias("_digest"), "component_id")
    return rows.join(ids, rows["digest"] == ids["_digest"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, size: int = NEAR_SHINGLE) -> DataFrame:
    """docs with one row of each group of equal or similar texts: that of the smallest doc_id (null last), of those the
    one with the smallest digest. Only rows that may go, or that are repeated, are shuffled; the others pass a Bloom filter
    of them."""
    rows, nodes = _alike(docs, similarity, size)
    order = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), "digest")
    each = rows.groupBy("doc_id", "digest").count()
    digests = each.groupBy("digest").agg(F.min(order).alias("first"))
    named = digests.join(nodes, digests["digest"] == nodes["_node"], "left").select("digest", "first", F.coalesce("component", "digest").alias("component"))
    chosen = named.groupBy("component").agg(F.min("first").alias("first"))
    wanted = chosen.select(F.struct("first.id", "first.digest").alias("key"), F.lit(True).alias("wanted"))
    judged = each.select(F.struct(F.col("doc_id").alias("id"), "digest").alias("key"), "count").join(wanted, "key", "left")
    # rows that go, and kept ones that are there more than once
    suspects = materialize(judged.filter("wanted is null or count > 1").select("key", F.coalesce("wanted", F.lit(False)).alias("wanted")), "suspects")
    drop_path(rows)
    drop_path(nodes)
    n_blocks = bloom.size_for(suspects.count())
    keyed = docs.select(F.struct("*").alias("doc"), F.struct(F.col("doc_id").cast("long").alias("id"), text_digest().alias("digest")).alias("key"))
    filled = bloom.build(suspects, n_blocks)
    possible = bloom.asked(keyed, filled, n_blocks, admitted=True)
    # `whether` is null for a row that only the filter took for a suspect: it stays, however often it is there
    told = possible.join(suspects.withColumnRenamed("wanted", "whether"), "key", "left")
    single = told.filter("whether is null").select("doc.*")
    several = told.filter("whether").dropDuplicates(["key"]).select("doc.*")
    return bloom.asked(keyed, filled, n_blocks, admitted=False).select("doc.*").union(single).union(several)
