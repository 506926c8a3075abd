"""What look-up operators send to the workers: small tables whole, large ones as a
Bloom filter in front of a join.

A table is sent only after its bytes have been summed, and only up to a bound the
caller documents; larger tables take the join.  The filter is sized from the
counted keys up to a bound of its own; more keys only let more through to the join.
"""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark.sql import DataFrame, Row, functions as F

try:  # ship the helpers below by value (no installed package needed)
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

#: Bytes of strings in a table that may be sent to every worker.
SENT_BYTES = 8 << 20
#: Bits a key of the Bloom filter, and its largest size (32 MB).
BITS_PER_KEY, MAX_BITS = 16, 1 << 28


def rows_if_small(df: DataFrame, max_bytes: int = SENT_BYTES) -> list[Row] | None:
    """The rows of ``df`` if its strings' bytes (and 16 a row) sum to at most
    ``max_bytes``; else None."""
    strings = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c, kind in df.dtypes]
    size = df.agg(F.coalesce(F.sum(sum(strings, F.lit(16)).cast("long")), F.lit(0))).first()[0]
    return df.collect() if size <= max_bytes else None


def in_process(name: str, make, most: int = 4):
    """``make()`` once per Python worker process; the last few are kept."""
    box = sys.modules.setdefault("_annolink_lookup", types.ModuleType("_annolink_lookup")).__dict__.setdefault("made", {})
    if name not in box:
        while len(box) >= most:
            box.pop(next(iter(box)))
        box[name] = make()
    return box[name]


class Bloom:
    """Two bits a key in a bit array, by the 64-bit hash of its UTF-8 text."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def __contains__(self, key: str) -> bool:
        import xxhash
        h = xxhash.xxh64_intdigest(key.encode(), 42)
        for part in (h & 0xFFFFFFFF, h >> 32):
            at = part % self.bits
            if not (int(self.words[at >> 6]) >> (at & 63)) & 1:
                return False
        return True


def bloom_of(keys: DataFrame, key: str) -> Bloom:
    """The filter of a string column; set bits are OR-ed in partial aggregates, at most
    ``MAX_BITS / 64`` words come to the driver."""
    n = keys.where(F.col(key).isNotNull()).count()
    bits = 64
    while bits < min(BITS_PER_KEY * n, MAX_BITS):
        bits *= 2
    h = F.xxhash64(key)
    halves = F.array(h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))
    at = keys.where(F.col(key).isNotNull()).select(F.explode(halves).alias("h")).select((F.col("h") % bits).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    words = np.zeros(bits // 64, np.int64)
    got = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toPandas()
    words[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64)
    return Bloom(bits, words.view(np.uint64))
