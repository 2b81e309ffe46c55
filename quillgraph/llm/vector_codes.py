"""Vector code compression: product quantization by Lloyd rounds with Elkan's bounds, in integers.

A component x becomes the integer floor(scale * x). A vector is cut into `parts` equal parts, each with a codebook of
its own. Each round writes a row for every vector with, for each part, an upper bound of the distance to its entry and a
lower bound of that to every entry. When entries move, the upper bound grows by its entry's movement and each lower
bound shrinks by its own entry's. An entry is passed over only where a bound says strictly that it is farther (the lower
bound, or half the distance between two entries, is above the upper bound); all others are compared by integer squared
distances, so ties are exact and go to the lower index. Bounds are rounded outwards. A task also writes one row of its sums
and counts for each entry, so that the vectors are read once a round; entries x components values reach the driver.

Defined cases: null vectors and those with null or non-finite components are dropped; of vectors that are left, the
commonest positive length that `parts` divides is kept (of ties the longest), others are dropped. Scaled components beyond
2**62 are held there. The first entries are those of the smallest vec_ids, null last, then by the vector; fewer vectors than
entries give a smaller codebook, in which entries may be equal. An error or a sum of errors beyond a long is null. Null
vec_ids, repeated rows and null labels are rows like any other; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import drop_path, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components up to which squared distances are sure to fit 64 bits; beyond, rows are compared as Python integers.
NARROW, FARTHEST = 1 << 26, 1 << 62
#: Labels up to which their table of sums is broadcast (some 50 bytes a row).
BROADCAST_ROWS = 100_000
_DECIMAL = pa.decimal128(38, 0)


class Compressed(NamedTuple):
    """rows: (vec_id, label, codes binary, error). codebooks: entries as integers, by part, entry and position."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x - y
    return (gap * gap).sum(axis=-1)


def above(x: np.ndarray) -> np.ndarray:
    """Single precision, not less than x."""
    return np.nextafter((np.asarray(x, np.float64) * (1 + 1e-12)).astype(np.float32), np.float32(np.inf))


def below(x: np.ndarray) -> np.ndarray:
    """Single precision, not more than x, nor negative."""
    return np.maximum(np.nextafter((np.asarray(x, np.float64) * (1 - 1e-12)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


def root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(np.asarray(squared, np.float64))


def nearest(x: np.ndarray, entries: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Bring code, upper and lower of one part up to date, in place; -> how many squared distances were taken.

    x: (n, width) and entries: (k, width) integers. The bounds hold for `entries`.
    """
    half = 0.5 * (1 - 1e-12) * root(squares(entries[:, None], entries[None]))
    between = half + np.where(np.eye(len(entries), dtype=bool), np.inf, 0)
    rows = np.flatnonzero(upper >= between.min(axis=1)[code])

    def open_entries() -> np.ndarray:
        reach = upper[rows, None]
        out = (reach >= lower[rows]) & (reach >= half[code[rows]])
        out[np.arange(len(rows)), code[rows]] = False
        return out

    rows = rows[open_entries().any(axis=1)]
    if not len(rows):
        return 0
    own = squares(x[rows], entries[code[rows]])
    upper[rows], lower[rows, code[rows]] = above(root(own)), below(root(own))
    r, j = np.nonzero(open_entries())
    found = squares(x[rows[r]], entries[j])
    lower[rows[r], j] = below(root(found))
    table = np.full((len(rows), len(entries)), 1 << 200 if x.dtype == object else np.iinfo(np.int64).max, x.dtype)
    table[np.arange(len(rows)), code[rows]], table[r, j] = own, found
    best = np.argmin(table, axis=1)  # the lowest index of equal ones
    code[rows], upper[rows] = best, above(root(table[np.arange(len(rows)), best]))
    return len(own) + len(found)


def moved(before: list, after: list) -> list[list[float]]:
    """How far each entry of each part has moved, rounded up."""
    return [[float(root(squares(np.array(b, object), np.array(a, object)))) * (1 + 1e-12) for b, a in zip(bs, aa, strict=True)] for bs, aa in zip(before, after, strict=True)]


def _whole(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _numbers(values: np.ndarray, codebook: list) -> tuple[np.ndarray, np.ndarray]:
    entries = np.array(codebook, object)
    narrow = abs(entries).max(initial=0) <= NARROW and (not values.size or max(int(values.max()), -int(values.min())) <= NARROW)
    return (values, entries.astype(np.int64)) if narrow else (values.astype(object), entries)


def _round(state: DataFrame, codebooks: list, moves: list | None, last: bool, label: str) -> DataFrame:
    """State rows with codes and bounds for `codebooks`, and a row of each task's sums and counts (not in the last round)."""
    parts, k, width = len(codebooks), len(codebooks[0]), len(codebooks[0][0])
    schema = f"vec_id long, label {label}, v array<long>, codes binary, upper binary, lower binary, error long, sums array<decimal(38,0)>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros((parts, k, width + 1), object), None
        for batch in batches:
            n, kind = batch.num_rows, batch.schema.field("label").type
            if not n:
                continue
            values = _whole(batch.column("v"), parts * width)
            code, upper, lower = np.zeros((parts, n), np.int64), np.full((parts, n), np.inf, np.float32), np.zeros((parts, n, k), np.float32)
            if moves is not None:
                held = [np.frombuffer(b"".join(batch.column(c).to_pylist()), t) for c, t in (("codes", np.uint8), ("upper", np.float32), ("lower", np.float32))]
                code = held[0].reshape(n, parts).T.astype(np.int64)
                upper, lower = held[1].reshape(n, parts).T.copy(), held[2].reshape(n, parts, k).transpose(1, 0, 2).copy()
            error = np.zeros(n, object)
            for p in range(parts):
                x, entries = _numbers(values[:, p * width : (p + 1) * width], codebooks[p])
                if moves is not None:
                    shift = np.array(moves[p])
                    upper[p], lower[p] = above(upper[p] + shift[code[p]]), below(np.maximum(lower[p] - shift, 0))
                nearest(x, entries, code[p], upper[p], lower[p])
                if last:
                    error += squares(x, entries[code[p]])
                else:
                    for e in np.unique(code[p]):
                        own = x[code[p] == e]
                        total[p, e] += [*own.sum(axis=0).tolist(), len(own)]
            flat = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            bounds = [pa.nulls(n, pa.binary())] * 2 if last else [flat(np.ascontiguousarray(upper.T)), flat(np.ascontiguousarray(lower.transpose(1, 0, 2)).reshape(n, -1))]
            errors = pa.array([int(e) if last and e < 1 << 63 else None for e in error], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.nulls(n, pa.list_(pa.int64())) if last else batch.column("v"), flat(code.T.astype(np.uint8)), *bounds, errors, pa.nulls(n, pa.list_(_DECIMAL))], ["vec_id", "label", "v", "codes", "upper", "lower", "error", "sums"])
        if kind is not None and not last:
            from decimal import Decimal

            sums = pa.array([[Decimal(int(s)) for s in total.reshape(-1)]], pa.list_(_DECIMAL))
            one = [pa.nulls(1, t) for t in (pa.int64(), kind, pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*one, sums], ["vec_id", "label", "v", "codes", "upper", "lower", "error", "sums"])

    columns = ["vec_id", "label", "v", *(["codes", "upper", "lower"] if moves is not None else [])]
    rows = state.filter("sums is null") if "sums" in state.columns else state
    return materialize(rows.select(columns).mapInArrow(run, schema), "vector-codes")


def integers(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v array<long>): the vectors that are kept, as integers."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.filter(F.col("embedding").isNotNull() & ~bad & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    held = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(FARTHEST))), F.lit(-float(FARTHEST)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("embedding", lambda x: F.floor(held(x))).alias("v"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codes (one byte a part) and errors of the vectors (vec_id, embedding, label), and the codebooks."""
    label = vectors.schema["label"].dataType.simpleString()
    state = materialize(integers(vectors, parts, scale), "vectors")
    lengths = state.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return Compressed(state.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), [])
    whole = state.filter(F.size("v") == lengths["n"])
    first = [r.v for r in whole.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()]
    width = lengths["n"] // parts
    codebooks, moves = [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)], None
    for r in range(rounds + 1):
        # where no entry moves any more, no code can change
        last = r == rounds or moves is not None and not any(map(any, moves))
        after = _round(whole, codebooks, moves, last, label)
        drop_path(state)
        state = whole = after
        if last:
            break
        sums = np.zeros((parts, len(first), width + 1), object).reshape(-1)
        for row in state.filter("sums is not null").select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s")).collect():
            sums[row["at"]] = int(row["s"])
        found = sums.reshape(parts, len(first), width + 1)
        moved_to = [[[int(s) // int(e[-1]) for s in e[:-1]] if e[-1] else old for e, old in zip(p, olds, strict=True)] for p, olds in zip(found, codebooks, strict=True)]
        moves, codebooks = moved(codebooks, moved_to), moved_to
    return Compressed(state.select("vec_id", "label", "codes", "error"), codebooks)


def decode(rows: DataFrame, codebooks: list, scale: int = SCALE) -> DataFrame:
    """rows with `decoded`: the vectors that the codes stand for."""
    table = F.array(*[F.array(*[F.array(*[F.lit(x / scale) for x in e]) for e in p]) for p in codebooks])
    code = lambda p: F.conv(F.hex(F.substring("codes", p + 1, 1)), 16, 10).cast("int")
    return rows.withColumn("decoded", F.concat(*[F.get(F.get(table, F.lit(p)), code(p)) for p in range(len(codebooks))]))


def digest(codebooks: list) -> str:
    return hashlib.sha256(",".join(str(x) for p in codebooks for e in p for x in e).encode()).hexdigest()


def report(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each vector that is kept."""
    rows, codebooks = compress(vectors)
    total = F.expr("try_cast(sum(cast(error AS decimal(38,0))) AS bigint)").alias("label_error")
    sums = materialize(rows.groupBy(F.col("label").alias("_label")).agg(total), "label-errors")
    # the sums of a label that many rows have are a single row, which Spark's skew handling sends to each part of them
    joined = rows.join(F.broadcast(sums) if sums.count() <= BROADCAST_ROWS else sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
