"""Substring search by an inverted table of grams: which texts contain which needles, without a scan for each needle.

Texts and needles are compared without regard to case and accents (decomposed, marks left out, lower case). Documents are
dealt into segments of some SEGMENT characters. The table has a row for each segment and each distinct string of one, two
and three characters in it, with the ids of the documents that have it. A needle of up to two characters is looked up as it
is; a longer one by all its three-character strings, whose documents are intersected in each segment; what is left is
verified on the text, so nothing is lost and nothing false is found.

Lists and candidates stay in their segments: neither single postings nor texts are sent once for each needle.

Defined cases: a null text has nothing, nor has a null id; a null or empty needle is found nowhere; equal needles of different
keys are found for each; rows of equal id are one document, found where any of its texts contains the needle; texts of any
length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.functions.text import fold_accents
from quillgraph.operators.rounds import settle

#: Characters of a segment, but for its last document's.
SEGMENT = 1_000_000


def folded(c: Column) -> Column:
    return F.lower(fold_accents(c))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of id with their segment; rows of one id are of one segment."""
    part, n, filled, last = TaskContext.get().partitionId(), 0, 0, None
    for batch in batches:
        ids, sizes = batch.column("id").to_pylist(), pc.utf8_length(batch.column("folded")).to_pylist()
        names = []
        for i, size in zip(ids, sizes, strict=True):
            if filled >= SEGMENT and i != last:
                n, filled = n + 1, 0
            filled, last = filled + size, i
            names.append(f"{part}-{n}")
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *batch.columns], ["segment", *batch.schema.names])


def _dense(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, below most, and each one's place among them, in two bytes where that will do."""
    if most <= 1 << 24:
        there = np.zeros(most, dtype=bool)
        there[key] = True
        found = np.flatnonzero(there)
        place = np.zeros(most, dtype=np.int64)
        place[found] = np.arange(len(found))
        place = place[key]
    else:
        found, place = np.unique(key, return_inverse=True)
    return found, place.astype(np.uint16) if len(found) <= 1 << 16 else place


def grams(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """For n of one to three: the distinct strings of n characters, and for each (by its place) and each text that has it a row."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    letters, one = _dense(codes, 0x110000)
    k = max(len(letters), 1)
    pairs, two = _dense(one[:-1].astype(np.int64) * k + one[1:], k * k)
    spelled = {1: letters[:, None], 2: np.stack([letters[pairs // k], letters[pairs % k]], axis=1) if len(pairs) else np.zeros((0, 2), dtype=int)}
    for n, first, then in ((1, one, None), (2, two, None), (3, two[:-1], one[2:])):
        inside = np.flatnonzero(text[: max(len(text) - n + 1, 0)] == text[n - 1 :])
        # texts ascend, and stable sorts keep that
        order = inside if then is None else inside[np.argsort(then[inside], kind="stable")]
        order = order[np.argsort(first[order], kind="stable")]
        key = first[order].astype(np.int64) * (k if n == 3 else 1) + (then[order] if n == 3 else 0)
        new = np.r_[True, key[1:] != key[:-1]][: len(key)]
        kept = new | np.r_[True, text[order][1:] != text[order][:-1]][: len(key)]
        found = key[new]
        chars = spelled[n][found] if n < 3 else np.concatenate([spelled[2][found // k], letters[found % k][:, None]], axis=1)
        all_of = chars.astype("<u4").tobytes().decode("utf-32-le")
        yield [all_of[i : i + n] for i in range(0, len(all_of), n)], (np.cumsum(new) - 1)[kept], text[order][kept]


def _runs(c: pa.Array) -> list[tuple[int, int]]:
    new = np.flatnonzero(pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)) + 1
    cuts = [0, *new.tolist(), len(c)]
    return [(s, e) for s, e in zip(cuts, cuts[1:], strict=False) if e > s]


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of each run of a segment's rows, with the ids that have them."""
    for batch in batches:
        for s, e in _runs(batch.column("segment")):
            ids = batch.column("id")[s:e]
            # of rows of one id the first stands for all
            first = pc.index_in(ids, ids).to_numpy()
            for spelled, which, text in grams(batch.column("folded")[s:e].to_pylist()):
                at = first[text]
                kept = np.r_[True, (which[1:] != which[:-1]) | (at[1:] != at[:-1])][: len(at)]
                offsets = np.searchsorted(which[kept], np.arange(len(spelled) + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids.take(pa.array(at[kept])))
                yield pa.RecordBatch.from_arrays([pa.repeat(batch.column("segment")[s], len(spelled)), pa.array(spelled, pa.string()), lists], ["segment", "gram", "id"])


def index(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The postings (segment, gram, id), id a list of ids, and the folded texts (segment, id, folded) of docs (id, text), both
    written as tables."""
    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.filter("text is not null and id is not null").select("id", folded(F.col("text")).alias("folded"))
    texts = settle(rows.repartition("id").sortWithinPartitions("id").mapInArrow(_segments, f"segment string, id {kind}, folded string"))
    return settle(texts.mapInArrow(_lists, f"segment string, gram string, id array<{kind}>")), texts


def search(postings: DataFrame, texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(key, id): the texts that contain the needle, by needles (key, needle)."""
    asked = settle(needles.filter("needle != ''").select("key", folded(F.col("needle")).alias("needle")).filter("needle != ''").distinct())
    whole = F.when(F.char_length("needle") < 3, F.array("needle")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("needle") - 2, F.lit(1))), lambda i: F.substring("needle", i, F.lit(3)))))
    chosen = settle(asked.select("needle").distinct().select("needle", whole.alias("grams")))
    lists = postings.join(chosen.select(F.explode("grams").alias("gram")).distinct(), "gram", "left_semi")
    none = F.lit(None).cast(postings.schema["id"].dataType)
    # a row of each needle for each segment, or what a task is asked would pass through the driver
    sent = texts.select("segment").distinct().crossJoin(chosen).select(F.col("segment").alias("of"), F.col("needle").alias("term"), none.alias("ids"), "grams")
    sent = sent.unionByName(lists.select(F.col("segment").alias("of"), F.col("gram").alias("term"), F.col("id").alias("ids"), F.lit(None).cast("array<string>").alias("grams")))
    kind = texts.schema["id"].dataType.simpleString()
    found = sent.groupBy("of").cogroup(texts.groupBy("segment")).applyInArrow(_matches, f"needle string, id {kind}")
    return asked.join(found, "needle").select("key", "id")


def _matches(sent: pa.Table, texts: pa.Table) -> pa.Table:
    """(needle, id) of a segment: the needles' lists intersected, then verified."""
    sent, texts = sent.combine_chunks(), texts.combine_chunks()
    known = pc.unique(texts.column("id"))
    of: list[list[str]] = [[] for _ in range(len(known))]
    for i, t in zip(pc.index_in(texts.column("id"), known).to_pylist(), texts.column("folded").to_pylist(), strict=True):
        of[i].append(t)
    listed = sent.filter(pc.is_valid(sent.column("ids")))
    masks: dict[str, np.ndarray] = {}
    if listed.num_rows:
        ids = listed.column("ids").combine_chunks()
        at, ends = pc.index_in(ids.flatten(), known).to_numpy(), np.cumsum(ids.value_lengths().to_numpy())
        for gram, s, e in zip(listed.column("term").to_pylist(), np.r_[0, ends[:-1]], ends, strict=True):
            masks.setdefault(gram, np.zeros(len(known), dtype=bool))[at[s:e]] = True
    needles, places = [], []
    one, more = [ts[0] for ts in of], {i: ts[1:] for i, ts in enumerate(of) if len(ts) > 1}
    asked = sent.filter(pc.is_valid(sent.column("grams")))
    for needle, grams_of in zip(asked.column("term").to_pylist(), asked.column("grams").to_pylist(), strict=True):
        have = [masks.get(g) for g in grams_of]
        if any(m is None for m in have):
            continue
        hits = [i for i in np.flatnonzero(np.logical_and.reduce(have)).tolist() if needle in one[i] or i in more and any(needle in t for t in more[i])]
        needles += [needle] * len(hits)
        places += hits
    return pa.table({"needle": pa.array(needles, pa.string()), "id": known.take(pa.array(places, pa.int64()))})
