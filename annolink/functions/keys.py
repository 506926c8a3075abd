"""Message keys: post id <-> 8-byte big-endian binary (the broker's long key)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from annolink._util import col_of


def long_to_key_bytes(c) -> Column:
    return F.unhex(F.lpad(F.hex(col_of(c).cast("bigint")), 16, "0"))


def key_bytes_to_long(c) -> Column:
    return F.conv(F.hex(col_of(c)), 16, -10).cast("bigint")
