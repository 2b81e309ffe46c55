"""MinHash near-duplicates by an LSH forest: trees of sorted signatures, each region as deep as it has to be.

A set (distinct two-word shingles, A-Z in lower case) has DEPTH min-hashes in each of TREES trees; their hashes, in order,
are its label in the tree. Sorted by label, sets of a common prefix lie next to each other, so a region is a prefix:
of SHALLOW levels where at most REGION sets share it, of one level more where more do, and of all DEPTH levels however many
share that. The members of a region are each other's candidates, and none is left out for the region's size. Two sets of similarity
0.8 miss each other in all trees with a probability of (1 - 0.8**4)**32 = 5e-8 in sparse regions and of
(1 - 0.8**6)**32 = 6e-5 in the most crowded ones.

Equal sets are one candidate. In a region, sketches of 64 bytes discard pairs that lie five standard errors below the
similarity; links of a spanning forest connect the rest, unless the first trees have connected them already. The texts of each group that is connected so are then compared
on their full sets, so only exact links are left.

Defined cases: a text of one word is one shingle; a null or empty text, or one without words, has the empty set and is
linked with nothing, not even another empty one; rows of a null doc_id take part, have the smallest known doc_id of their
component (null if there is none) and aren't kept; repeated rows are answered each; empty tables give no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm import bloom
from quillgraph.llm.common import drop_path, looked_up, materialize, text_digest
from quillgraph.llm.components import connected_components
from quillgraph.llm.simhash import BATCH_ROWS, BINS, PORTION, loose_links, shingle_hashes, verified

TREES, SHALLOW, DEPTH, REGION = 32, 4, 6, 16
#: Trees that are searched first; in the others, what these have connected isn't compared again.
FIRST_TREES = 4
#: Bits of a level in a label; a label is the tree's number and DEPTH levels.
LEVEL = 9
SIMILARITY, SHINGLE = 0.8, 2
#: By how much the sketches of similar sets may fall short: by min-hash bits (0.0375 is a standard error) and by bitmaps.
ERRORS = (0.19, 0.2)
MULTIPLIERS = np.random.default_rng(12).integers(0, 1 << 63, BINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a label for each tree, 8 words) of distinct hashes: BINS min-hashes, of which the first TREES * DEPTH make labels. The
    words are a bit of each min-hash, and a bitmap of the hashes, which tells small sets apart more exactly."""
    least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, (MULTIPLIERS[:, None] * hashes[None, i : i + 1024]).min(axis=1), out=least)
    values = least * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    label = np.arange(TREES, dtype=np.uint64)
    for level in (values[: TREES * DEPTH].reshape(TREES, DEPTH) & np.uint64((1 << LEVEL) - 1)).T:
        label = (label << np.uint64(LEVEL)) | level
    bitmap = np.zeros(BINS, np.uint8)
    bitmap[(hashes >> np.uint64(16)) % np.uint64(BINS)] = 1
    return label, np.packbits(np.concatenate([((values >> np.uint64(LEVEL)) & np.uint64(1)).astype(np.uint8), bitmap]), bitorder="little").view(np.uint64)


def marks(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text_digest, digest of the set (null: empty), n_shingles, labels, bits) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(i, BATCH_ROWS)
                digests, n, labels, bits = [], [], [], []
                for text in batch.column("text").to_pylist():
                    h = np.unique(shingle_hashes(text, size))
                    label, words = signature(h) if len(h) else (None, None)
                    digests.append(hashlib.md5(h).digest() if len(h) else None)
                    n.append(len(h))
                    labels.append(label.view(np.int64) if len(h) else [])
                    bits.append(words.tobytes() if len(h) else None)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_digest"), pa.array(digests, pa.binary()), pa.array(n, pa.int64()), pa.array(labels, pa.list_(pa.int64())), pa.array(bits, pa.binary())], ["doc_id", "text_digest", "digest", "n_shingles", "labels", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("text_digest"), "text")
    return rows.mapInArrow(run, "doc_id long, text_digest binary, digest binary, n_shingles long, labels array<long>, bits binary")


def prefix(label: Column | str, depth: int) -> Column:
    """A label's first `depth` levels, with the depth itself, as one number."""
    return F.shiftright(label, LEVEL * (DEPTH - depth)) * 8 + depth


def regions(labels: DataFrame) -> DataFrame:
    """(key, n): the prefixes that are regions of two members or more, and the portions of PORTION members that each needs.
    labels: the column label, a row for each set and tree."""
    todo, out = labels, []
    for depth in range(SHALLOW, DEPTH + 1):
        counts = materialize(todo.groupBy(prefix("label", depth).alias("key")).count().filter("count > 1"), "prefixes")
        crowded = (F.col("count") > REGION) & F.lit(depth < DEPTH)
        out.append(counts.filter(~crowded).select("key", F.ceil(F.col("count") / PORTION).alias("n")))
        deeper = counts.filter(crowded).select("key")
        n = deeper.count()
        if not n:
            break
        n_blocks = bloom.size_for(n)
        possible = bloom.asked(todo.select("label", prefix("label", depth).alias("key")), bloom.build(deeper, n_blocks), n_blocks, admitted=True)
        todo = materialize(possible.join(deeper, "key", "left_semi").select("label"), "crowded")
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return materialize(whole, "regions")


def spanning(groups: DataFrame) -> DataFrame:
    """(a, b): a link of each node to its component."""
    return groups.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def components(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs."""
    marked = materialize(marks(docs, size), "marks")
    distinct = materialize(marked.filter("digest is not null").groupBy("digest").agg(F.min("text_digest").alias("text_digest"), F.min("doc_id").alias("least"), F.first("labels").alias("labels"), F.first("bits").alias("bits")), "sets")
    groups, links = None, None
    for trees in ((1, FIRST_TREES), (FIRST_TREES + 1, TREES)):
        found = regions(distinct.select(F.explode(F.slice("labels", trees[0], trees[1] - trees[0] + 1)).alias("label")))
        n_blocks = bloom.size_for(found.count())
        keys = F.flatten(F.transform(F.slice("labels", trees[0], trees[1] - trees[0] + 1), lambda x: F.array(*[prefix(x, d) for d in range(SHALLOW, DEPTH + 1)])))
        members = distinct.withColumn("known", F.col("digest"))
        if groups is not None:
            members = distinct.join(groups, F.col("digest") == F.col("node"), "left").withColumn("known", F.coalesce("component", "digest"))
        asked = bloom.asked(members.select(F.explode(keys).alias("key"), F.col("digest").alias("rep"), "bits", "known"), bloom.build(found, n_blocks), n_blocks, admitted=True)
        loose = loose_links(asked.join(found, "key"), similarity, ERRORS)
        # of what a task finds again and again, each link is kept once
        links = materialize((loose if links is None else loose.union(spanning(groups))).distinct(), "near-links")
        groups = connected_components(links)
    # of the texts only those of these groups are shuffled
    grouped = materialize(distinct.join(groups, F.col("digest") == F.col("node")).select("digest", F.col("text_digest").alias("key"), "component"), "groups")
    n_blocks = bloom.size_for(grouped.count())
    texts = bloom.asked(docs.select(text_digest().alias("key"), "text"), bloom.build(grouped, n_blocks), n_blocks, admitted=True)
    one_each = texts.groupBy("key").agg(F.first("text").alias("text"))
    held = materialize(one_each.join(grouped, "key").select("digest", "component", "text"), "grouped-texts")
    edges = materialize(verified(held, similarity, size), "near-links")
    nodes = connected_components(edges)
    drop_path(held)
    named = distinct.select("digest", "least").join(nodes, F.col("digest") == F.col("node"), "left").select("digest", "least", F.coalesce("component", "digest").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = looked_up(materialize(named, "components"), ["component"], smallest.withColumnRenamed("component", "_component"), ["_component"])
    of_set = materialize(of_set.select(F.col("digest").alias("_digest"), "component_id"), "component-of")
    rows = looked_up(marked.select("doc_id", "n_shingles", "digest"), ["digest"], of_set, ["_digest"])
    return rows.select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs."""
    return components(docs).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
