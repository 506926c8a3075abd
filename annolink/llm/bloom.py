"""A blocked Bloom filter as rows of a DataFrame.

A key sets one bit in each word of one 512-bit block.  The number of blocks is
fixed, so the broadcast probe side is bounded whatever the number of keys; more
keys only let more false positives through, which an exact join removes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: 2^14 blocks of 8 longs: 1 MB of bits in the broadcast.
BLOCKS, WORDS = 1 << 14, 8


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(17), key), F.lit(BLOCKS)).cast("int")


def _masks(key: Column) -> list[Column]:
    """The bit a key sets in each 64-bit word of its block."""
    h = F.xxhash64(F.lit(29), key)
    masks = []
    for w in range(WORDS):  # seven bits of the hash a word, six used
        bit = F.shiftrightunsigned(h, 7 * w).bitwiseAND(F.lit(63)).cast("int")
        masks.append(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return masks


def blocks_of(keys: DataFrame, key: str) -> DataFrame:
    """The filter as rows ``bloom_block, bloom_0 .. bloom_7``; partial OR before
    the shuffle, at most ``BLOCKS`` rows."""
    return (keys.select(_block(F.col(key)).alias("bloom_block"), *[m.alias(f"bloom_{i}") for i, m in enumerate(_masks(F.col(key)))])
            .groupBy("bloom_block").agg(*[F.bit_or(f"bloom_{i}").alias(f"bloom_{i}") for i in range(WORDS)]))


def with_possible(df: DataFrame, key: str, blocks: DataFrame, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: the key may be in the filter (null keys are not)."""
    maybe = reduce(lambda a, b: a & b, [F.col(f"bloom_{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))])
    return (df.withColumn("bloom_block", _block(F.col(key))).join(F.broadcast(blocks), "bloom_block", "left")
            .withColumn(name, F.coalesce(F.col(key).isNotNull() & maybe, F.lit(False)))
            .select(*[df[c] for c in df.columns], name))
