"""Sets of ids as bitmaps, one row per key and block of 32,768 ids.

A bitmap has a fixed size however many ids it holds, repeated ids set one bit, and sets are
united, cut and compared without a row or an array entry per id. Ids that are null belong to
no set. Within a block of ids above zero the bits follow the ids; Spark counts those of the
other blocks downwards, which is why cuts go through a mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32_768


def id_blocks(pairs: DataFrame, keys: list[str], column: str = "doc_id") -> DataFrame:
    """(keys, block, ids) of the pairs (keys, column)."""
    known = pairs.filter(F.col(column).isNotNull())
    held = F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("ids")
    return known.groupBy(*keys, F.bitmap_bucket_number(column).alias("block")).agg(held)


def united(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """The union of the sets of each key: of several tables, or after keys were dropped."""
    return blocks.groupBy(*keys, "block").agg(F.bitmap_or_agg("ids").alias("ids"))


def sizes(blocks: DataFrame, keys: list[str], name: str = "n_ids") -> DataFrame:
    return blocks.groupBy(*keys).agg(F.sum(F.bitmap_count("ids")).alias(name))


def _range(block: int) -> tuple[int, int]:
    """The smallest and the largest id of a block."""
    return (block * BLOCK - BLOCK + 1, block * BLOCK)


def block_of(number: int) -> int:
    return -(-number // BLOCK)


def up_to(blocks: DataFrame, keys: list[str], cutoff: int) -> DataFrame:
    """The sets without the ids above the cut-off: blocks below it stay as they are, the
    one that holds it is masked. Keys without any id left are gone."""
    last = block_of(cutoff)
    low, _ = _range(last)
    allowed = blocks.sparkSession.range(low, cutoff + 1)
    mask = allowed.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("ids")).scalar()
    split = blocks.filter(F.col("block") == last)
    both = split.unionByName(split.withColumn("ids", mask))
    cut = both.groupBy(*keys, "block").agg(F.bitmap_and_agg("ids").alias("ids"))
    cut = cut.filter(F.bitmap_count("ids") > 0)
    return blocks.filter(F.col("block") < last).unionByName(cut)


def set_digests(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, digest): equal for equal sets only. A set of very many ids is a list of its
    blocks' digests, 32 bytes for 32,768 ids."""
    one = F.concat_ws(":", F.col("block"), F.sha2("ids", 256))
    return blocks.groupBy(*keys).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(one)), ","), 256).alias("digest"))


def ids_of(bitmap: Column, block: Column) -> Column:
    """array<long>: the ids in a bitmap of a block, ascending."""
    hexes = F.hex(bitmap)
    places = F.filter(
        F.sequence(F.lit(0), F.lit(BLOCK - 1)),
        lambda i: F.call_function(
            "getbit",
            F.conv(F.substring(hexes, (F.floor(i / 8) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int"),
            (i % 8).cast("int"),
        )
        == 1,
    )
    first = F.when(block > 0, block * BLOCK - BLOCK + 1).otherwise(block * BLOCK)
    ids = F.transform(places, lambda i: F.when(block > 0, first + i).otherwise(first - i).cast("long"))
    return F.sort_array(ids)
