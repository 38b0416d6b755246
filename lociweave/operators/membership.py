"""Telling rows whose key occurs in another table from the rest, without moving them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Binary logarithm of the bits that keys are hashed to: 2 MB in 512 rows, however many keys there are.
BITS = 24
_ROW = 15  # of the bits of one row


def _place(key: str):
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """At most 512 rows (_row, _bits) of 4 KB with a bit set for the hash of every key."""
    return keys.groupBy(F.shiftright(_place(key), _ROW).alias("_row")).agg(
        F.bitmap_construct_agg(F.pmod(_place(key), F.lit(1 << _ROW))).alias("_bits"))


def flagged(df: DataFrame, keys: DataFrame, key: str, name: str = "_maybe") -> DataFrame:
    """Adds `name`: false only where the key is surely not among `keys`. The bit table has a fixed size and is broadcast; df isn't moved."""
    bit = F.pmod(_place(key), F.lit(1 << _ROW)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = (F.call_function("shiftright", byte, F.pmod(bit, F.lit(8))).bitwiseAND(1)) == 1
    at = df.withColumn("_row", F.shiftright(_place(key), _ROW)).join(F.broadcast(key_bits(keys, key)), "_row", "left")
    return at.select(*df.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def split_by(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key in `keys`, rows that have none)."""
    both = flagged(df, keys, key)
    return both.where("_maybe").drop("_maybe"), both.where("not _maybe").drop("_maybe")
