"""Token-id files: static range asymmetric numeral systems over independent interleaved blocks.

A file is a row (part, file, start, n_tokens, payload) of a Parquet table, written by Spark's committer, so a lost
executor only means that its tasks run again. Its payload begins with the frequency table that all its blocks share,
made of all the file's tokens. A block holds whole documents. Its tokens are dealt over LANES interleaved coders, which
are encoded together as vectors. Each block carries checkpoints (every lane's state and the position in its stream,
each CHECKPOINT steps), from which `Coder.decode_segment` can start, and a checksum.

Payload, little-endian: `FILE`, number of symbols, number of blocks; symbols uint16, frequencies uint32, lengths of the
blocks uint32; the blocks. A block: `RANS`, n_docs, n_tokens, n_words, n_checkpoints, crc32 of the uint16 ids; then
doc_ids int64, their null mask uint8, token counts uint32, words uint32, checkpoint positions uint32, states uint64.

Defined cases: a null text is empty and has only its end id; documents of null id come first, equal ids follow by
text; an empty table gives no files; a damaged block raises ValueError; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import materialize
from quillgraph.llm.token_ids import byte_bpe

#: Scale of the frequency table (bits), lanes in a block, tokens in a block and in a file (both may be exceeded by the
#: document that fills them), steps between checkpoints.
SCALE, LANES, BLOCK_TOKENS, FILE_TOKENS, CHECKPOINT = 20, 4096, 1 << 19, 1 << 22, 64
LOW = np.uint64(1 << 31)
BATCH_ROWS = 1000
#: A table of so many parts is broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 200_000
_HEAD = struct.Struct("<4sIIIII")


def quantize(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE, at least 1 for each symbol that occurs."""
    total, size = int(counts.sum()), 1 << SCALE
    if not total:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * size // total), 0).astype(np.int64)
    over = int(freq.sum()) - size
    order = np.argsort(-freq, kind="stable")
    if over < 0:
        freq[order[0]] -= over
    for i in order if over > 0 else []:
        take = min(over, int(freq[i]) - 1)
        freq[i] -= take
        over -= take
        if not over:
            break
    return freq


class Coder:
    """Encodes and decodes uint16 symbols with one static frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol_of: np.ndarray | None = None

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
        """(words, checkpoint positions in words, states at each checkpoint): the last symbols first, lane by lane."""
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, LOW, np.uint64)
        emitted, marks, states = [], [], []
        for s in range(steps - 1, -1, -1):
            part = ids[s * LANES : (s + 1) * LANES]
            x, f = state[: len(part)], self.freq[part]
            full = x >= (f << np.uint64(63 - SCALE))
            emitted.append(x[full].astype(np.uint32))
            x = np.where(full, x >> np.uint64(32), x)
            whole = x // f
            state[: len(part)] = (whole << np.uint64(SCALE)) + (x - whole * f) + self.cum[part]
            if s % CHECKPOINT == 0:
                marks.append(sum(map(len, emitted[-CHECKPOINT:])))
                states.append(state.copy())
        words = np.concatenate(emitted[::-1]) if emitted else np.zeros(0, np.uint32)
        sizes = marks[::-1]
        return words, [0, *np.cumsum(sizes)[:-1].tolist()] if sizes else [], np.array(states[::-1], np.uint64).reshape(-1, LANES)

    def decode_segment(self, n_tokens: int, segment: int, words: np.ndarray, at: int, state: np.ndarray) -> np.ndarray:
        """The ids from checkpoint number `segment` to the next one, without anything before it."""
        if self.symbol_of is None:
            self.symbol_of = np.repeat(np.arange(len(self.freq), dtype=np.uint16), self.freq.astype(np.int64))
        first = segment * CHECKPOINT * LANES
        left = min(n_tokens - first, CHECKPOINT * LANES)
        out, state, mask = np.empty(left, np.uint16), state.copy(), np.uint64((1 << SCALE) - 1)
        for s in range(0, left, LANES):
            n = min(LANES, left - s)
            x = state[:n]
            slot = x & mask
            symbol = self.symbol_of[slot]
            out[s : s + n] = symbol
            x = self.freq[symbol] * (x >> np.uint64(SCALE)) + slot - self.cum[symbol]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << np.uint64(32)) | words[at : at + len(low)]
            at += len(low)
            state[:n] = x
        return out


def pack_block(coder: Coder, doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    words, at, states = coder.encode(ids)
    head = _HEAD.pack(b"RANS", len(doc_ids), len(ids), len(words), len(at), zlib.crc32(ids.astype("<u2").tobytes()))
    known = np.array([d or 0 for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], "u1")
    return b"".join([head, known.tobytes(), null.tobytes(), np.array(counts, "<u4").tobytes(), words.astype("<u4").tobytes(), np.array(at, "<u4").tobytes(), states.astype("<u8").tobytes()])


def unpack_block(coder: Coder, payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, token counts, ids)."""
    magic, n_docs, n_tokens, n_words, n_marks, crc = _HEAD.unpack_from(payload)
    places, at = [], _HEAD.size
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_words), ("<u4", n_marks), ("<u8", n_marks * LANES)):
        places.append(np.frombuffer(payload, kind, n, at))
        at += n * np.dtype(kind).itemsize
    known, null, counts, words, marks, states = places
    states = states.reshape(-1, LANES)
    parts = [coder.decode_segment(n_tokens, i, words, int(m), states[i]) for i, m in enumerate(marks)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
    if magic != b"RANS" or zlib.crc32(ids.astype("<u2").tobytes()) != crc:
        raise ValueError("damaged block")
    return [None if n else k for k, n in zip(known.tolist(), null.tolist(), strict=True)], counts, ids


def pack_file(docs: list[tuple[int | None, bytes]]) -> tuple[int, bytes]:
    """(n_tokens, payload) of documents with their uint16 ids."""
    freq = quantize(np.bincount(np.frombuffer(b"".join(b for _, b in docs), "<u2"), minlength=1 << 16))
    coder, used, blocks, own, tokens, total = Coder(freq), np.flatnonzero(freq), [], [], 0, 0
    for i, one in enumerate(docs):
        own.append(one)
        tokens += len(one[1]) // 2
        if tokens >= BLOCK_TOKENS or i == len(docs) - 1:
            blocks.append(pack_block(coder, [d for d, _ in own], [len(b) // 2 for _, b in own], np.frombuffer(b"".join(b for _, b in own), "<u2")))
            total += tokens
            own, tokens = [], 0
    head = b"FILE" + struct.pack("<II", len(used), len(blocks)) + used.astype("<u2").tobytes() + freq[used].astype("<u4").tobytes()
    return total, b"".join([head, np.array([len(b) for b in blocks], "<u4").tobytes(), *blocks])


def unpack_file(payload: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc_ids, token counts, ids) of each block."""
    n, n_blocks = struct.unpack_from("<II", payload, 4)
    freq = np.zeros(1 << 16, np.int64)
    freq[np.frombuffer(payload, "<u2", n, 12)] = np.frombuffer(payload, "<u4", n, 12 + 2 * n)
    if payload[:4] != b"FILE" or int(freq.sum()) != 1 << SCALE:
        raise ValueError("damaged frequency table")
    coder, at = Coder(freq), 12 + 6 * n + 4 * n_blocks
    for length in np.frombuffer(payload, "<u4", n_blocks, 12 + 6 * n).tolist():
        yield unpack_block(coder, payload[at : at + length])
        at += length


FILE_SCHEMA = "part int, file int, start long, n_tokens long, payload binary"


def write_files(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Encode docs (doc_id, text) in ascending doc_id order; the table of files, written to `path`, where it stays, or else
    to the shared folder until the driver ends.

    The texts are range-partitioned by doc_id before they are tokenized, so each is tokenized once; a worker holds the
    ids of one file (2 * FILE_TOKENS bytes, or one longer document) at a time. `start` counts from the part's begin.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bpe, end = TaskContext.get().partitionId(), byte_bpe(tokenizer), struct.pack("<H", end_id)
        held: list[tuple[int | None, bytes]] = []
        size = start = file = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, start, file
            n, payload = pack_file(held)
            row = [pa.array([part], pa.int32()), pa.array([file], pa.int32()), pa.array([start], pa.int64()), pa.array([n], pa.int64()), pa.array([payload], pa.binary())]
            held.clear()
            size, start, file = 0, start + n, file + 1
            return pa.RecordBatch.from_arrays(row, ["part", "file", "start", "n_tokens", "payload"])

        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(i, BATCH_ROWS)
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), bpe.ids(batch.column("text").to_pylist()), strict=True):
                    held.append((doc_id, ids + end))
                    size += len(ids) // 2 + 1
                    if size >= FILE_TOKENS:
                        yield flush()
        bpe.forget()
        if held:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(encode, FILE_SCHEMA)
    if path is None:
        return materialize(files, "token-files")
    files.write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.schema(files.schema).parquet(path)


def read_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files; ids too (binary, uint32) if asked for."""
    names = ["part", "doc_id", "local", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                at = row["start"]
                for doc_ids, counts, ids in unpack_file(row["payload"]):
                    ends = np.cumsum(counts.astype(np.int64))
                    raw = memoryview(ids.astype("<u4").tobytes())
                    each = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    columns = [pa.array([row["part"]] * len(each), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(at + ends - counts, pa.int64()), pa.array(counts.astype(np.int64)), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                    yield pa.RecordBatch.from_arrays([*columns, *[pa.array([bytes(x) for x in each], pa.binary())] * with_ids], names)
                    at += int(ends[-1])

    # one row for each part, whatever the parts hold
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    if totals.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    docs = files.select("part", "start", "payload").mapInArrow(decode, "part int, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    return docs.join(bases, "part").select("doc_id", (F.col("local") + F.col("base")).alias("start"), *names[3:])
