"""Harmonic packing of token ids into sequences of a fixed capacity.

A piece length ``L`` belongs to the reciprocal class ``k = capacity // L``; a bin
of the class takes exactly ``k`` pieces of length ``L``, whoever they come from,
so bins are filled by counting alone.  A document is cut into full pieces, then
into the lengths capacity/2, capacity/4, ... down to ``min_piece`` (classes that
fill their bins without padding) and one short tail with a class of its own.

Workers are independent: each numbers the pieces it cuts within their class;
a table with one count per input partition and class turns these numbers into
places in the corpus, so a bin may span workers and only the last bin of each
class stays partly empty.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from annolink.llm.common import by_value, stored
from annolink.llm.tokens import VOCABULARY, column_encoder

by_value(__name__)

CAPACITY, MIN_PIECE = 2048, 32

_PIECES = ("part int, piece_class int, piece_rank long, doc_id long, piece_start long, piece_length long, "
           "piece_crc32 long, doc_tokens long")


def cut(n: int, capacity: int = CAPACITY, min_piece: int = MIN_PIECE) -> list[int]:
    """Piece lengths of a document of ``n`` ids: each a reciprocal of the
    capacity, but for a tail shorter than ``min_piece``."""
    out = [capacity] * (n // capacity)
    n %= capacity
    size = capacity
    while size > min_piece and size % 2 == 0:
        size //= 2
        if n >= size:
            out += [size] * (n // size)
            n %= size
    if n:
        out.append(n)
    return out


def _pieces(vocabulary: str, capacity: int, min_piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = column_encoder(vocabulary)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            cols: list[list[int]] = [[] for _ in range(7)]
            cls, rank, docs, starts, lens, crcs, totals = cols
            doc_ids = batch.column(0).to_pylist()
            for first, ids, sizes in encode(batch.column(1)):
                data, base = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0
                for doc_id, n in zip(doc_ids[first:], sizes.tolist()):
                    at = 0
                    for size in cut(n, capacity, min_piece):
                        r = seen.get(size, 0)
                        seen[size] = r + 1
                        cls.append(size)
                        rank.append(r)
                        docs.append(doc_id)
                        starts.append(at)
                        lens.append(size)
                        crcs.append(zlib.crc32(data[4 * (base + at):4 * (base + at + size)]))
                        totals.append(n)
                        at += size
                    base += n
            if not cls:
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cls), part, np.int32)), pa.array(cls, pa.int32())]
                + [pa.array(c, pa.int64()) for c in cols[1:]],
                names=[f.split()[0] for f in _PIECES.split(", ")])
    return run


def harmonic_pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY,
                  min_piece: int = MIN_PIECE) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: ``doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset``.

    A null or empty text is the end id alone.  Rows that repeat a doc_id, or have
    none, are packed as documents of their own.  No documents, no rows.  Other
    columns of ``docs`` are ignored, whatever their names.
    """
    pieces = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                    .mapInArrow(_pieces(vocabulary, capacity, min_piece), _PIECES), "pieces")
    # one row per input partition and class: what each worker has cut
    counts = pieces.groupBy("part", "piece_class").agg(F.count("*").alias("n"))
    before = Window.partitionBy("piece_class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # classes in order of length; at most capacity / 2^i lengths and min_piece - 1 tails
    totals = counts.groupBy("piece_class").agg(F.sum("n").alias("n"))
    per_bin = F.floor(F.lit(capacity) / F.col("piece_class"))
    bins = F.ceil(F.col("n") / per_bin)
    base = Window.orderBy(F.desc("piece_class")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("piece_class", F.coalesce(F.sum(bins).over(base), F.lit(0)).alias("first_bin"))
    places = places.join(totals, "piece_class").select("part", "piece_class", "before", "first_bin")
    rank = F.col("piece_rank") + F.col("before")
    return pieces.join(places, ["part", "piece_class"]).select(
        "doc_id", F.col("piece_start").alias("start"), F.col("piece_length").alias("length"),
        F.col("piece_crc32").alias("ids_crc32"), "doc_tokens",
        (F.col("first_bin") + F.floor(rank / per_bin)).cast("long").alias("sequence_id"),
        ((rank % per_bin) * F.col("piece_length")).cast("long").alias("offset"))
