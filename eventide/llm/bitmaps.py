"""A bit map of fixed size of the hashes that recur: small enough to broadcast at every size of the input.

A hash's slot is the hash modulo the number of bits.  A set bit of a hash that
doesn't recur (another one shares its slot) only sends a row the longer way; an
unset one proves that a hash occurs once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slot(h: Column, bits: int) -> Column:
    """Slot (from 1) of a long."""
    return F.pmod(h, F.lit(bits)) + 1


def bit_map(slots: DataFrame, bits: int) -> bytes:
    """The map with the given slots (column ``slot``, from 1) set: ``bits`` / 8 bytes reach the driver, at most."""
    got = slots.groupBy(F.bitmap_bucket_number(F.col("slot")).alias("b")) \
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot"))).alias("m")).collect()
    out = bytearray(bits // 8)
    for r in got:  # bucket b holds the slots 32768 (b - 1) + 1 to 32768 b
        out[4096 * (r["b"] - 1):4096 * r["b"]] = r["m"]
    return bytes(out)


def in_map(m: bytes, slot: int) -> bool:
    return bool(m[(slot - 1) >> 3] >> ((slot - 1) & 7) & 1)
