"""A set of 64-bit keys as bitmaps of bounded size.

Keys fall into ``SLOTS`` slots, and each has one bit in its slot's bitmap of 4 KB,
so the table is 8 MB at most however many keys are marked, and may be broadcast.
Asked for a marked key the answer is always yes; asked for another it is yes if it
shares a marked key's bit, which gets likelier the more are marked.  Whoever asks
must be right either way: ``marked`` picks rows for an exact step and leaves aside
those that need none.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 2048
SLOT_BITS = 32768  # of a bitmap as the aggregate builds it


def slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS))


def bit(key: Column, kind=0) -> Column:
    """Place of a key (under a number, if there are several sets in one table)."""
    return F.pmod(F.xxhash64(key, kind if isinstance(kind, Column) else F.lit(kind)), F.lit(SLOT_BITS))


def bitmaps(keys: DataFrame, key: str = "key", kind: str | None = None) -> DataFrame:
    """(_slot, _bits) of the keys of a table: one row for each slot that holds any."""
    return keys.groupBy(slot(F.col(key)).alias("_slot")).agg(
        F.bitmap_construct_agg(bit(F.col(key), F.col(kind) if kind else 0)).alias("_bits"))


def is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (place % 8).cast("int")) % 2 == 1, F.lit(False))
