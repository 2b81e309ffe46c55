"""Conversation prefix trie, summed up by leaf-peeling message passing.

A node is a distinct sequence of first turns (role, text). It is named by two 61-bit sums, over its turns, of a hash of the
place and the md5 of the turn; so all prefixes of all conversations are running sums, which are taken over sorted ranges of
rows: no conversation, however long, has to be in one task. Nodes are an aggregate of those names.

A node with one member has a subtree of one path, so its totals are known. The others hold a counter of children that
aren't complete. Nodes that have one such child form chains, which are contracted by doubling; in the tree that is left,
each round the nodes whose counter is zero send their subtree's totals, summed for each parent, and the parents count
down, until only the root finishes. Rounds grow with the logarithm of the longest chain and with the number of branchings
on a path, not with its length.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), then role and text; rows of a null
conv_id are no conversation; repeated rows are turns of their own; an empty table has no node, not even a root; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import MASK, drop_path, looked_up, materialize, running, wrapped

#: Turns of a conversation that meet its row in one join partition, and ids of a node's members in one string.
SLICE, IDS = 65_536, 2048
_NODE = ["s0", "s1"]


class Trie(NamedTuple):
    """nodes: s0, s1 (the name), p0, p1 (the parent's), depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved.
    ends: s0, s1, conv_id of each conversation's last node."""

    nodes: DataFrame
    ends: DataFrame


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, d0, d1, bytes): each turn's place, the halves of its md5 and the UTF-8 bytes of its text."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    digest = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    half = lambda i: F.conv(F.substring(digest, i, 15), 16, 10).cast("long")
    hashed = rows.select("*", half(1).alias("d0"), half(16).alias("d1"), F.octet_length("text").cast("long").alias("bytes"))
    return running(hashed, "conv_id", ["turn", "role", "text"], [], ["d0", "d1", "bytes"])


def rebuilt(own: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n, d0, d1, bytes, total) of the rebuilt turns, and (conv_id, total) of all conversations.

    Of c, the first h = crc32(c) % most turns are those of conversation c - c % every, then come its own after the first h.
    """
    sizes = materialize(own.groupBy("conv_id").agg(F.count("*").alias("own_n")), "conversations")
    drawn = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own_n").alias("base_n"))
    with_base = sizes.select("conv_id", "own_n", drawn.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")).join(bases, "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = materialize(with_base.select("conv_id", "own_n", "h", "base", taken.alias("taken"), (taken + F.greatest(F.col("own_n") - F.col("h"), F.lit(0))).alias("total")), "conversations")
    # a base has few turns and few conversations that take them
    heads = own.filter(F.col("n") < most).withColumnRenamed("conv_id", "base").join(convs, "base").filter("n <= taken").select("conv_id", "n", "d0", "d1", "bytes", "total")
    slices = convs.select("conv_id", "h", "taken", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("own_n") / SLICE))).alias("slice"))
    tails = own.withColumn("slice", F.floor(F.col("n") / SLICE)).join(slices, ["conv_id", "slice"]).filter("n > h")
    return heads.unionByName(tails.select("conv_id", (F.col("n") - F.col("h") + F.col("taken")).alias("n"), "d0", "d1", "bytes", "total")), convs.select("conv_id", "total")


def named(paths: DataFrame) -> DataFrame:
    """(conv_id, n, total, bytes, s0, s1, p0, p1): paths with the name of the node that each turn ends in, and its parent's."""
    mixed = lambda *c: F.xxhash64("n", *c)
    valued = paths.select("conv_id", F.col("n").alias("place"), "bytes", "total", wrapped(mixed("d0", "d1")).alias("v0"), wrapped(mixed("d1", "d0")).alias("v1"), wrapped(mixed("d0", "d1")).alias("s0"), wrapped(mixed("d1", "d0")).alias("s1"))
    sums = running(valued.withColumnRenamed("place", "n_"), "conv_id", ["n_"], _NODE, ["n_", "bytes", "total", "v0", "v1"]).drop("n_")
    above = lambda i: wrapped(F.col(f"s{i}") - F.col(f"v{i}") + F.lit(MASK + 1)).alias(f"p{i}")
    return sums.select("conv_id", "n", "total", "bytes", "s0", "s1", above(0), above(1))


def contracted(shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """shared (s0, s1, p0, p1, todo, leaves, saved) -> the tree without its chains, and the chains.

    A chain's nodes each have one child with todo; chains: (s0, s1, b0, b1, leaves, saved) leads from each to the first node below
    that is of no chain, with the sums on the way, itself included. The tree: (s0, s1, todo, leaves, saved, t0, t1, on_leaves,
    on_saved): t is the node that waits for it, and what the chain between adds.
    """
    chain = F.col("todo") == 1
    flags = shared.select(F.col("s0").alias("f0"), F.col("s1").alias("f1"), chain.alias("above_chain"), F.col("leaves").alias("above_leaves"), F.col("saved").alias("above_saved"))
    known = materialize(looked_up(shared, ["p0", "p1"], flags, ["f0", "f1"]), "shared")
    below = known.filter("above_chain").select(F.col("p0").alias("s0"), F.col("p1").alias("s1"), F.col("s0").alias("b0"), F.col("s1").alias("b1"), F.col("above_leaves").alias("leaves"), F.col("above_saved").alias("saved"), chain.alias("open"))
    chains = materialize(below, "chains")
    while not chains.filter("open").isEmpty():
        on = chains.select(F.col("s0").alias("f0"), F.col("s1").alias("f1"), F.col("b0").alias("n0"), F.col("b1").alias("n1"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("n_saved"), F.col("open").alias("n_open"))
        # a node of a chain is the next of one node only
        step = chains.filter("open").join(on, (F.col("b0") == F.col("f0")) & (F.col("b1") == F.col("f1")))
        step = step.select("s0", "s1", F.col("n0").alias("b0"), F.col("n1").alias("b1"), (F.col("leaves") + F.col("n_leaves")).alias("leaves"), (F.col("saved") + F.col("n_saved")).alias("saved"), F.col("n_open").alias("open"))
        after = materialize(chains.filter("not open").unionByName(step), "chains")
        drop_path(chains)
        chains = after
    chains = chains.drop("open")
    direct = known.filter(~F.coalesce("above_chain", F.lit(False)) & ~chain).select("s0", "s1", F.col("p0").alias("t0"), F.col("p1").alias("t1"), F.lit(0).cast("long").alias("on_leaves"), F.lit(0).cast("long").alias("on_saved"))
    tops = known.filter(~F.coalesce("above_chain", F.lit(False)) & chain).select("s0", "s1", F.col("p0").alias("t0"), F.col("p1").alias("t1"))
    through = tops.join(chains, _NODE).select(F.col("b0").alias("s0"), F.col("b1").alias("s1"), "t0", "t1", F.col("leaves").alias("on_leaves"), F.col("saved").alias("on_saved"))
    tree = known.filter(~chain).select("s0", "s1", "todo", "leaves", "saved").join(direct.unionByName(through), _NODE)
    return materialize(tree, "tree"), chains


def peeled(tree: DataFrame) -> DataFrame:
    """(s0, s1, n_leaves, saved) of every node of the tree, whose leaves send first."""
    pending, out = tree, None
    while True:
        ready = pending.filter("todo = 0")
        done = ready.select("s0", "s1", F.col("leaves").alias("n_leaves"), "saved")
        out = done if out is None else out.unionByName(done)
        sent = ready.filter("t0 is not null").groupBy("t0", "t1").agg(F.count("*").alias("k"), F.sum(F.col("leaves") + F.col("on_leaves")).alias("more_leaves"), F.sum(F.col("saved") + F.col("on_saved")).alias("more_saved"))
        waiting = pending.filter("todo > 0")
        if waiting.isEmpty():
            return out
        told = waiting.join(sent.withColumnsRenamed({"t0": "s0", "t1": "s1"}), _NODE, "left")
        more = lambda c, by: (F.col(c) + F.coalesce(by, F.lit(0))).alias(c)
        pending = materialize(told.select("s0", "s1", (F.col("todo") - F.coalesce("k", F.lit(0))).alias("todo"), more("leaves", "more_leaves"), more("saved", "more_saved"), "t0", "t1", "on_leaves", "on_saved"), "pending")


def trie(paths: DataFrame, convs: DataFrame) -> Trie:
    """The trie of paths (conv_id, n, d0, d1, bytes, total) of conversations convs (conv_id, total)."""
    ended = materialize(named(paths), "paths")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    zero, nothing = F.lit(0).cast("long"), F.lit(None).cast("long")
    nodes = ended.groupBy("s0", "s1", "p0", "p1").agg(F.max("n").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"))
    nodes = materialize(nodes.unionByName(root.select(zero.alias("s0"), zero.alias("s1"), nothing.alias("p0"), nothing.alias("p1"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("bytes"))), "nodes")
    children = nodes.filter("p0 is not null").groupBy(F.col("p0").alias("s0"), F.col("p1").alias("s1")).agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") > 1).alias("todo"))
    known = nodes.join(children, _NODE, "left").withColumns({c: F.coalesce(c, zero) for c in ("n_children", "todo")})
    known = materialize(known.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes")), "trie")
    several = (F.col("n_convs") > 1) | (F.col("depth") == 0)
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_children") - F.col("todo")).cast("long")
    tree, chains = contracted(known.filter(several).select("s0", "s1", "p0", "p1", "todo", leaves.alias("leaves"), "saved"))
    totals = peeled(tree)
    ends_of = totals.select(F.col("s0").alias("e0"), F.col("s1").alias("e1"), "n_leaves", F.col("saved").alias("end_saved"))
    within = looked_up(chains, ["b0", "b1"], ends_of, ["e0", "e1"]).select("s0", "s1", (F.col("leaves") + F.col("n_leaves")).alias("n_leaves"), (F.col("saved") + F.col("end_saved")).alias("saved"))
    summed = known.drop("saved").join(totals.unionByName(within), _NODE, "left").withColumns({"n_leaves": F.coalesce("n_leaves", F.lit(1).cast("long")), "saved": F.coalesce("saved", zero)})
    parents = nodes.select(F.col("s0").alias("f0"), F.col("s1").alias("f1"), F.col("conv_id").alias("parent_conv_id"))
    whole = looked_up(materialize(summed.drop("bytes", "todo"), "summed"), ["p0", "p1"], parents, ["f0", "f1"])
    last = ended.filter("n = total").select("s0", "s1", "conv_id").unionByName(convs.filter("total = 0").select(zero.alias("s0"), zero.alias("s1"), "conv_id"))
    return Trie(whole, last)


def members_digest(ends: DataFrame) -> DataFrame:
    """(s0, s1, ends_sha256): the SHA-256 of each node's conv_ids, ascending and joined by commas.

    Ids are joined where a range of them lies; the strings of a node are hashed one after the other, so a task holds a few
    of them at a time, however many members a node has.
    """

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ids = (batch.column(c).to_numpy() for c in ("s0", "s1", "conv_id"))
            cuts = [0, *(np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1).tolist(), len(ids)]
            runs = [(i, min(i + IDS, z)) for s, z in zip(cuts, cuts[1:], strict=False) for i in range(s, z, IDS)]
            at = [s for s, _ in runs]
            yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(ids[at]), pa.array([",".join(map(str, ids[s:z].tolist())) for s, z in runs], pa.string())], ["s0", "s1", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for batch in batches:
            out = []
            for key, ids in zip(zip(batch.column("s0").to_pylist(), batch.column("s1").to_pylist(), strict=True), batch.column("ids").to_pylist(), strict=True):
                if key == held:
                    digest.update(b"," + ids.encode())
                    continue
                if held:
                    out.append((*held, digest.hexdigest()))
                held, digest = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("s0", "s1", "ends_sha256"), o, strict=True)) for o in out], schema)
        if held:
            yield pa.RecordBatch.from_pylist([{"s0": held[0], "s1": held[1], "ends_sha256": digest.hexdigest()}], schema)

    schema = pa.schema([("s0", pa.int64()), ("s1", pa.int64()), ("ends_sha256", pa.string())])
    ranged = ends.repartitionByRange("s0", "s1", "conv_id").sortWithinPartitions("s0", "s1", "conv_id")
    joined = ranged.mapInArrow(strings, "s0 long, s1 long, first long, ids string")
    return joined.repartition("s0", "s1").sortWithinPartitions("s0", "s1", "first").mapInArrow(hashes, "s0 long, s1 long, ends_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations."""
    paths, convs = rebuilt(turns(conversations))
    nodes, ends = trie(paths, convs)
    with_ends = nodes.join(members_digest(ends), _NODE, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return with_ends.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"))
