"""Bloom filters of stored ids: which ids of a batch are new for certain.

A filter is a table of blocks of 32,768 bits each. An id belongs to one block
by its hash and sets ``PROBES`` bits there. All loads of a table use the same
number of blocks, so their filters are united by OR, and a batch meets one
filter however many loads there were; it is joined to it by block. With the
table's planned number of ids an id that is not stored passes in some 6 of a
million cases; a table that outgrows its plan lets more pass, never fewer.
Built-in bitmap functions do all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap, as Spark's bitmap functions have it, and ids aimed at in one.
BLOCK_BITS = 32_768
BLOCK_IDS = 1_024
PROBES = 8


def block_count(ids: int) -> int:
    """Blocks for so many ids."""
    return max(1, -(-ids // BLOCK_IDS))


def _block(ident: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(ident), F.lit(blocks))


def _bits(ident: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(ident, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(1, PROBES + 1)]


def bloom_filter(ids: DataFrame, column: str, blocks: int) -> DataFrame:
    """block, bits: the filter of a column's ids (missing ids are left out)."""
    ident = F.col(column)
    return (ids.filter(ident.isNotNull())
            .select(_block(ident, blocks).alias("block"), F.explode(F.array(*_bits(ident))).alias("bit"))
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def united(filters: DataFrame) -> DataFrame:
    """One filter of several with the same number of blocks."""
    return filters.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def possible(batch: DataFrame, column: str, stored: DataFrame, blocks: int) -> DataFrame:
    """The batch's distinct ids that the filter does not rule out."""
    ident = F.col(column)
    asked = batch.select(ident).filter(ident.isNotNull()).distinct().withColumn("_block", _block(ident, blocks))

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bits"), (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        return F.call_function("getbit", byte.cast("long"), (bit % 8).cast("int")) == 1
    hit = is_set(_bits(ident)[0])
    for bit in _bits(ident)[1:]:
        hit = hit & is_set(bit)
    return asked.join(stored, F.col("_block") == F.col("block")).filter(hit).select(column)
