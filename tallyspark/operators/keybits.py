"""Orphans of a foreign key through bitmaps of the parent's integer keys: no child row is shuffled.

The parent's keys become one bitmap of 32,768 bits per range of as many key values, exact, not a sketch: a Bloom filter
of the parent could only tell which rows are orphans for certain, never clear the rest, so every good row would still
have to be looked up. Child rows meet the bitmap of their key's range in a broadcast join and test one bit.

The bitmaps take four kilobytes per range that holds a key. Surrogate keys are dense, so a billion of them take 125 MB;
the number of ranges is counted first, and beyond ``MAX_RANGES`` the check falls back to the join on keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallyspark.operators.checks import foreign_key

MAX_RANGES = 16_384  # of 4,096 bytes each: 64 MB


def key_bits(parent: DataFrame, key: str) -> DataFrame:
    """(range, bits): the parent's keys."""
    k = F.col(key).cast("bigint")
    rows = parent.filter(F.col(key).isNotNull())
    return rows.groupBy(F.bitmap_bucket_number(k).alias("range")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits"))


def has_key(bits: Column, key: Column) -> Column:
    """Whether the key's bit is set; False where there is no bitmap."""
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2
    return F.coalesce(bit == 1, F.lit(False))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str, table: str, max_ranges: int = MAX_RANGES) -> DataFrame:
    """As :func:`tallyspark.operators.checks.foreign_key`: child rows whose non-NULL key has no parent row."""
    whole = isinstance(child.schema[key].dataType, IntegralType) and isinstance(parent.schema[parent_key].dataType, IntegralType)
    ranges = F.bitmap_bucket_number(F.col(parent_key).cast("bigint"))
    if not whole or parent.filter(F.col(parent_key).isNotNull()).select(F.count_distinct(ranges)).first()[0] > max_ranges:
        return foreign_key(child, parent, key, parent_key, table)
    k = F.col(key).cast("bigint")
    rows = child.select(k.alias("_key"), F.bitmap_bucket_number(k).alias("range"))
    met = rows.join(F.broadcast(key_bits(parent, parent_key)), "range", "left")
    lost = F.col("_key").isNotNull() & ~has_key(F.col("bits"), F.col("_key"))
    return met.agg(F.count_if(lost).alias("violations")).select(
        F.lit(f"foreign_key:{key}").alias("check_name"), F.lit(table).alias("table_name"), "violations"
    )
