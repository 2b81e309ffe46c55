"""A blocked Bloom filter as a DataFrame of bounded size, built and asked by DataFrame functions alone.

A key's hash picks a block of WORDS 64-bit words, and a bit in each of them. The filter may admit keys that it was not
built of, never the other way round; where it is too full to tell keys apart, all that costs is work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64-bit words in a block (512 bits, one cache line), and the odd multipliers that pick a bit in each of them.
WORDS = 8
MULTIPLIERS = [2 * (1_640_531_527 + 97_531 * i) + 1 for i in range(WORDS)]
#: Bits for each key, and the largest filter: 2**17 blocks are 8 MB, however many keys there are.
BITS_PER_KEY, MAX_BLOCKS = 24, 1 << 17


def size_for(n_keys: int) -> int:
    """Number of blocks for so many keys."""
    return max(1, min(MAX_BLOCKS, -(-n_keys * BITS_PER_KEY // (64 * WORDS))))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(key), 32), F.lit(n_blocks)).cast("int")


def _bit(key: Column, word: int) -> Column:
    low = F.xxhash64(key).bitwiseAND(F.lit(0x7FFFFFFF))
    return F.shiftrightunsigned((low * F.lit(MULTIPLIERS[word])).bitwiseAND(F.lit(0xFFFFFFFF)), 26).cast("int")


def build(keys: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0 .. w7): the filter of the column `key`, at most n_blocks rows; an absent block is all zero."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), _bit(F.col("key"), w))
    return keys.filter("key is not null").groupBy(_block(F.col("key"), n_blocks).alias("block")).agg(*[F.bit_or(bit(w)).alias(f"w{w}") for w in range(WORDS)])


def _admitted() -> Column:
    out = F.lit(True)
    for w in range(WORDS):
        out &= F.call_function("shiftright", F.col(f"w{w}"), _bit(F.col("key"), w)).bitwiseAND(F.lit(1)) == 1
    return out


def asked(rows: DataFrame, bloom: DataFrame, n_blocks: int, admitted: bool) -> DataFrame:
    """The rows whose `key` the filter admits, or the others: for the first, every word of the block has the key's bit.

    The filter has at most MAX_BLOCKS rows of 72 bytes, so it is always broadcast.
    """
    packed = rows.select(F.struct("*").alias("row"), "key", _block(F.col("key"), n_blocks).alias("block"))
    joined = packed.join(F.broadcast(bloom), "block", "inner" if admitted else "left")
    return joined.filter(_admitted() if admitted else ~F.coalesce(_admitted(), F.lit(False))).select("row.*")
