"""A Bloom filter of bounded size over the keys of a run, met by a large target before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of the filter: 4,096 bitmaps of 4 kB, 16 MB at most, whatever the run holds. Two positions a key.
BITS = 2**27
_HASHES = 2


def key_hash(columns: Sequence[Column]) -> Column:
    """One number for a key; nulls hash like values, so null-safe keys may use it."""
    return F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\0null")) for c in columns])


def _positions(h: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(BITS)) for i in range(_HASHES)]


def key_filter(hashes: DataFrame, h: str) -> DataFrame:
    """(bucket, bits): the bitmaps that hold the keys' positions, by partial aggregation."""
    at = hashes.select(F.explode(F.array(*_positions(F.col(h)))).alias("at"))
    return at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def may_contain(target: DataFrame, h: Column, filter_: DataFrame) -> DataFrame:
    """Target rows whose key may be among those of the filter; the others leave before any shuffle of the target."""
    rows, names = target, target.columns
    for i, at in enumerate(_positions(h)):
        side = filter_.select(F.col("bucket").alias(f"__b{i}"), F.col("bits").alias(f"__bits{i}"))
        rows = rows.withColumn(f"__at{i}", at).join(F.broadcast(side), F.bitmap_bucket_number(f"__at{i}") == F.col(f"__b{i}"))  # 16 MB at most
        place = F.bitmap_bit_position(f"__at{i}")
        byte = F.conv(F.hex(F.substring(F.col(f"__bits{i}"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        rows = rows.where(F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1)
    return rows.select(*names)
