"""Quality classifier: random-indexing word vectors, pooled per document, a two-layer network, calibrated probabilities.

Each word has a sparse random index vector, made from its hash. A word's context vector is the sum of the index vectors
of the words near it in the training texts (random indexing), with its own; words that are rare or new take the vector
of their shape (letters, case, punctuation, symbols, digits), which is trained the same way. A document is the mean
of its words' vectors, with its logarithmic length and the spread of its words over shapes. A two-layer numpy network
scores it, and a temperature fitted on labelled rows apart from the network's makes the scores probabilities.

Learning reads only labelled rows that `is_training` admits, at most TRAIN_ROWS of them (those of smallest hash of
doc_id), one text each (of several rows of a doc_id the smallest text), and at most TRAIN_BYTES of whole texts: one that no
longer fits is passed over before anything is sent to the driver. Scoring covers every row. labels, lang, source and doc_id are never
inputs of a score.

Defined cases: a null or empty text is a document without words and gets a score like any other; label rows with a null
label or doc_id, or without a document, are ignored; with no training rows, or labels of one kind only, every score is
the share of label 1 (0.5 without rows); repeated rows are scored alike; extra columns pass through, except that
columns named score or predicted are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import drop_path, materialize

#: Bounds of what is learnt from, words with a vector of their own, and the width of vectors and of the hidden layer.
TRAIN_ROWS, TRAIN_BYTES, VOCABULARY, WIDTH, HIDDEN = 4000, 24_000_000, 20_000, 48, 32
NEAR, NONZERO, EPOCHS, BATCH, RATE = 2, 6, 60, 64, 0.01
CACHE_WORDS, BATCH_ROWS = 200_000, 200


def held_out() -> Column:
    """Rows never learnt from: crc32 of doc_id as text, modulo 3, is 1; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


_CLASS = bytes.maketrans(bytes(range(256)), bytes(ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else ord("*") if chr(b) in "#*$%&|<>@^~=_+/\\" else b if chr(b) in ".,;:!?-" else ord("-") for b in range(256)))


_RUN = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> str:
    """Runs of letters, capitals, digits and signs, each run as one sign; lengths only as short, middle or long."""
    return _RUN.sub(rb"\1", word.translate(_CLASS)).decode() + (":1" if len(word) < 3 else ":2" if len(word) < 9 else ":3" if len(word) < 20 else ":4")


def index_vector(name: str, width: int) -> np.ndarray:
    out, h = np.zeros(width, np.float32), zlib.crc32(name.encode())
    for i in range(NONZERO):
        h = zlib.crc32(b"%d" % i, h)
        out[(h >> 1) % width] += 1 if h & 1 else -1
    return out


@dataclass
class Model:
    words: dict[bytes, int] = field(default_factory=dict)
    shapes: dict[str, int] = field(default_factory=dict)
    vectors: np.ndarray | None = None
    layers: list[np.ndarray] = field(default_factory=list)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    temperature: float = 1.0
    constant: float | None = None
    cache: dict[bytes, int] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def rows_of(self, words: list[bytes]) -> np.ndarray:
        """Row in `vectors` of each word."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        for w in set(words).difference(self.cache):
            self.cache[w] = self.words.get(w) or self.shapes.get(shape(w), 0)
        return np.fromiter(map(self.cache.__getitem__, words), np.int32, len(words))

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        """A row of features for each text."""
        out = np.zeros((len(texts), self.vectors.shape[1] + 2), np.float32)
        for i, text in enumerate(texts):
            words = text.encode().split() if text else []
            if words:
                rows = self.rows_of(words)
                uses = np.bincount(rows)
                own = np.flatnonzero(uses)
                out[i, :-2] = (uses[own, None] * self.vectors[own]).sum(axis=0) / len(words)
                out[i, -2] = np.log1p(len(words))
                out[i, -1] = len(set(words)) / len(words)
        return out

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-self.logits(self.pooled(texts)).astype(np.float64).clip(-700, 700) / self.temperature))


def fit(texts: list[str | None], labels: list[int], width: int = WIDTH) -> Model:
    y = np.array(labels, np.float32)
    if len(set(labels)) < 2:
        return Model(constant=float(y.mean()) if len(y) else 0.5)
    model, cut = Model(), [t.encode().split() if t else [] for t in texts]
    known = Counter(w for words in cut for w in set(words))
    frequent = sorted((w for w, n in known.items() if n >= 5), key=lambda w: (-known[w], w))[:VOCABULARY]
    shapes = sorted({shape(w) for w in known})
    model.words = {w: i + 1 for i, w in enumerate(frequent)}
    model.shapes = {s: len(frequent) + 1 + i for i, s in enumerate(shapes)}
    index = np.stack([np.zeros(width, np.float32), *[index_vector(w.hex(), width) for w in frequent], *[index_vector(s, width) for s in shapes]])
    context = index.copy() * 4
    shape_row = np.arange(len(index))
    for w, i in model.words.items():
        shape_row[i] = model.shapes[shape(w)]
    for words in cut:
        rows = model.rows_of(words)
        for d in range(1, NEAR + 1):
            if len(rows) > d:
                np.add.at(context, rows[:-d], index[rows[d:]])
                np.add.at(context, rows[d:], index[rows[:-d]])
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-6)
    model.vectors = np.concatenate([context, index[shape_row] / np.sqrt(NONZERO)], axis=1)
    x = model.pooled(texts)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    apart = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.zeros(len(y), bool)
    random = np.random.default_rng(7)
    model.layers = [random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32), np.zeros(1, np.float32)]
    z = (x - model.mean) / model.scale
    rows, moments, t = np.flatnonzero(~apart), [[np.zeros_like(p), np.zeros_like(p)] for p in model.layers], 0
    for _ in range(EPOCHS):
        random.shuffle(rows)
        for start in range(0, len(rows), BATCH):
            at, t = rows[start : start + BATCH], t + 1
            w1, b1, w2, b2 = model.layers
            h = np.tanh(z[at] @ w1 + b1)
            g = (1 / (1 + np.exp(-(h @ w2 + b2).clip(-60, 60))) - y[at]) / len(at)
            back = np.outer(g, w2) * (1 - h * h)
            for p, m, d in zip(model.layers, moments, [z[at].T @ back + 1e-3 * w1, back.sum(axis=0), h.T @ g + 1e-3 * w2, g.sum(keepdims=True)], strict=True):
                m[0] = 0.9 * m[0] + 0.1 * d
                m[1] = 0.999 * m[1] + 0.001 * d * d
                p -= RATE * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8)
    if apart.any():
        logits, own = model.logits(x[apart]), y[apart]
        loss = lambda s: float(np.logaddexp(0, np.where(own == 1, -logits, logits) / s).mean())
        model.temperature = min(np.geomspace(0.25, 20, 200).tolist(), key=loss)
    return model


def train(docs: DataFrame, labels: DataFrame, is_training: Column, label: str = "quality") -> Model:
    """Fit on a bounded sample. Its label rows are few enough to broadcast, so the texts aren't shuffled."""
    sample = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & is_training).select("doc_id", F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(TRAIN_ROWS)
    known = sample.collect()
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i in sorted({r["doc_id"] for r in known})], sample.select("doc_id").schema)
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    # at most TRAIN_ROWS rows
    one_each = materialize(found.select("doc_id", F.xxhash64("doc_id").alias("order"), F.octet_length("text").alias("size"), "text"), "training-texts")
    chosen, size = [], 0
    for r in sorted(one_each.select("order", "doc_id", "size").collect(), key=lambda r: (r["order"], r["doc_id"])):
        if size + r["size"] <= TRAIN_BYTES:
            chosen.append(r["doc_id"])
            size += r["size"]
    fitting = spark.createDataFrame([(i,) for i in chosen], wanted.schema)
    text_of = {r["doc_id"]: r["text"] for r in one_each.select("doc_id", "text").join(F.broadcast(fitting), "doc_id").collect()}
    drop_path(one_each)
    place = {i: n for n, i in enumerate(chosen)}
    learnt = sorted(((place[r["doc_id"]], r["y"]) for r in known if r["doc_id"] in text_of))
    return fit([text_of[chosen[n]] for n, _ in learnt], [y for _, y in learnt])


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and predicted."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(i, BATCH_ROWS)
                scores = model.scores(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(scores, pa.float64())], [*kept, "score"])

    return docs.select(*kept).mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
