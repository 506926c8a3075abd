"""Token-id files: an adaptive context-mixing range coder over blocks of ids.

Three predictions are mixed for every id: the id that last followed the two ids
before (order 2), the one that last followed the id before (order 1), and the
strip's id counts (order 0).  The probability line of 2^24 is cut into
sixteenths; orders 2 and 1 get as many as their predictions of that confidence
have lately earned in this block, order 0 shares the rest.  One step of a 64-bit
range coder codes the id.

A *strip* is a run of whole documents.  Its ids are cut into blocks; every block
starts from the same reset state, has its own payload and CRC, and so is a lane
of its own: all blocks of a strip are coded side by side, one numpy operation for
all lanes.  A file row holds one strip: document ids and lengths, the order-0
counts, and its blocks.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from annolink.llm.common import by_value, shared_dir
from annolink.llm.tokens import VOCABULARY, column_encoder

by_value(__name__)

#: Ids to a block at most and at least, and the lanes aimed at; a strip closes
#: with the document that fills it.
BLOCK, LEAST_BLOCK, LANES = 512, 128, 4096
SHARES, ORDER0_BITS = 16, 20     # sixteenths of 2^24, 2^20 of them for order 0
_CONFIDENT = 7
_RATE = np.float32(1 / 16)
_U = np.uint64
_WORD, _BOT, _LOW = _U(32), _U(1 << 32), _U((1 << 32) - 1)

_ROW = ("part int, strip int, n long, doc_ids binary, lengths binary, symbols binary, counts binary, block int, "
        "blocks array<binary>, checks array<long>")


class _Lanes:
    """The mixing model of all blocks of a strip, at one position of each; the
    first row of its arrays is order 2, the second order 1."""

    def __init__(self, lanes: int, block: int):
        size = 1 << max(6, (block - 1).bit_length())
        self.mask = size - 1
        self.base = np.arange(2 * lanes, dtype=np.int64).reshape(2, lanes) * size
        self.row = np.arange(2 * lanes, dtype=np.int64).reshape(2, lanes) * (_CONFIDENT + 1)
        # the id that last followed a context, above three bits of confidence
        self.table = np.zeros(2 * lanes * size, np.uint32)
        # chance that a prediction of each confidence comes true
        start = np.array([0, .3, .5, .6, .7, .75, .8, .85], np.float32)
        self.right = np.concatenate([np.tile(start * s, lanes) for s in (np.float32(1), np.float32(0.7))])
        self.p1, self.p2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self, n: int):
        """Predicted ids and sixteenths of orders 2 and 1 for the first ``n`` lanes."""
        p1 = self.p1[:n]
        at = np.empty((2, n), np.int64)
        np.multiply(p1, 2246822519, out=at[0])
        at[0] += self.p2[:n] * 3266489917
        np.multiply(p1, 2654435761, out=at[1])
        at >>= 12
        at &= self.mask
        at += self.base[:, :n]
        self.at = at
        self.old = self.table.take(at)
        self.got = self.old >> np.uint32(3)
        self.sure = self.old & np.uint32(7)
        self.slot = self.sure.astype(np.int64)
        self.slot += self.row[:, :n]
        self.p = self.right.take(self.slot)
        k2 = np.floor(np.minimum(self.p[0] * np.float32(SHARES), np.float32(14)))
        k1 = (self.p[1] * (np.float32(SHARES - 1) - k2)).astype(np.int32)
        k1 *= self.got[0] != self.got[1]
        return self.got, k2.astype(np.int32), k1

    def update(self, x: np.ndarray, hit: np.ndarray) -> None:
        """The ids that came, and which of the predicted ids equal them."""
        n, sure = len(x), self.sure
        p = hit.astype(np.float32)
        p -= self.p
        p *= _RATE
        p += self.p
        # nothing is predicted at confidence 0, where the chance stays 0
        p *= sure > 0
        self.right[self.slot] = p
        # the confidence rises by one or is halved; at none the new id takes the place
        now = np.minimum(sure + np.uint32(1), np.uint32(_CONFIDENT))
        less = sure >> np.uint32(1)
        now -= less
        now *= hit.astype(np.uint32)
        now += less
        gone = now == 0
        now += self.old - sure
        now = np.where(gone, (x << np.uint32(3)) | np.uint32(1), now)
        self.table[self.at] = now
        self.p2[:n] = self.p1[:n]
        self.p1[:n] = x


def order0(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that occur and their counts scaled to 2^20, each at least one."""
    symbols, n = np.unique(ids, return_counts=True)
    total = (1 << ORDER0_BITS) - len(symbols)
    counts = 1 + (n.astype(np.float64) * (total / n.sum())).astype(np.int64)
    counts[np.argmax(counts)] += (1 << ORDER0_BITS) - counts.sum()
    return symbols.astype(np.uint32), counts


def block_size(n: int) -> int:
    return int(min(BLOCK, max(LEAST_BLOCK, -(-n // LANES))))


def _widths(n: int, block: int) -> list[int]:
    """Lanes that still have an id at each position (only the last block is short)."""
    lanes = -(-n // block)
    last = n - (lanes - 1) * block
    return [lanes if t < last else lanes - 1 for t in range(min(block, n))]


def _order0_lines(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts and the counts before, by id."""
    freq, cum = np.zeros((2, int(symbols[-1]) + 1), np.int32)
    freq[symbols], cum[symbols] = counts, np.cumsum(counts) - counts
    return freq, cum


def _span(x: np.ndarray, hit: np.ndarray, k2: np.ndarray, k1: np.ndarray, freq: np.ndarray, cum: np.ndarray):
    """Where the ids ``x`` begin on the probability line, and their widths."""
    k = k1 + k2
    rest = SHARES - k
    start = rest * cum.take(x) + (k << ORDER0_BITS)
    width = rest * freq.take(x)
    some = np.flatnonzero(hit[0] | hit[1])
    if len(some):
        s2, s1 = k2[some], k1[some]
        two = hit[0][some] & (s2 > 0)
        one = hit[1][some] & (s1 > 0) & ~two
        start[some] = np.where(two, 0, np.where(one, s2 << ORDER0_BITS, start[some]))
        width[some] = np.where(two, s2 << ORDER0_BITS, np.where(one, s1 << ORDER0_BITS, width[some]))
    return start.astype(np.uint64), width.astype(np.uint64)


def _shift(low: np.ndarray, rng: np.ndarray, go: np.ndarray):
    """Lanes ``go``, whose range has fallen below 2^32, give out a word: the top of
    ``low``, which is settled, or the range is cut at the next carry."""
    a, b = low[go], rng[go]
    word = a >> _WORD
    b = np.where((a ^ (a + b)) < _BOT, b, (_U(0) - a) & _LOW)
    low[go], rng[go] = a << _WORD, b << _WORD
    return word


def encode_strip(ids: np.ndarray, block: int, symbols: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Payload of each block of ``ids``."""
    n = len(ids)
    lanes = -(-n // block)
    freq, cum = _order0_lines(symbols, counts)
    model = _Lanes(lanes, block)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    cap = block + 2  # at most a word an id, and two at the end
    out, pos = np.zeros(lanes * cap, np.uint32), np.arange(lanes, dtype=np.int64) * cap
    padded = np.zeros(lanes * block, np.uint32)
    padded[:n] = ids
    at = np.ascontiguousarray(padded.reshape(lanes, block).T)
    with np.errstate(over="ignore"):
        for t, w in enumerate(_widths(n, block)):
            x = at[t, :w]
            got, k2, k1 = model.predict(w)
            hit = got == x
            start, width = _span(x.astype(np.int64), hit, k2, k1, freq, cum)
            lo, r = low[:w], rng[:w]
            r >>= _U(ORDER0_BITS + 4)
            lo += r * start
            r *= width
            go = np.flatnonzero(r < _BOT)
            out[pos[go]] = _shift(lo, r, go)
            pos[go] += 1
            model.update(x, hit)
        for _ in range(2):
            out[pos] = low >> _WORD
            pos += 1
            low <<= _WORD
    return [out[k * cap:to].tobytes() for k, to in enumerate(pos.tolist())]


def decode_strip(payloads: list[bytes], n: int, block: int, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ids back from the blocks' payloads."""
    lanes = -(-n // block)
    freq, cum = _order0_lines(symbols, counts)
    symbol_at = np.repeat(symbols.astype(np.min_scalar_type(int(symbols[-1]))), counts)
    # two words more than written: the decoder reads that far ahead
    words = np.frombuffer(b"".join([p + bytes(8) for p in payloads]), np.uint32)
    lens = np.array([len(p) // 4 + 2 for p in payloads], np.int64)
    pos = np.cumsum(lens) - lens
    code = np.zeros(lanes, np.uint64)
    model = _Lanes(lanes, block)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    out = np.zeros((min(block, n), lanes), np.uint32)
    with np.errstate(over="ignore"):
        for _ in range(2):
            code = (code << _WORD) | words[pos]
            pos += 1
        for t, w in enumerate(_widths(n, block)):
            got, k2, k1 = model.predict(w)
            lo, r, cd = low[:w], rng[:w], code[:w]
            r >>= _U(ORDER0_BITS + 4)
            # a damaged payload may point beyond the line
            v = np.minimum((cd - lo) // r, _U((SHARES << ORDER0_BITS) - 1)).astype(np.int32)
            k = k1 + k2
            share = v >> ORDER0_BITS
            some = np.flatnonzero(share < k)
            slot = (np.maximum(v - (k << ORDER0_BITS), 0) / (SHARES - k)).astype(np.int64)
            x = symbol_at.take(slot).astype(np.uint32)
            x[some] = np.where(share[some] < k2[some], got[0][some], got[1][some])
            hit = got == x
            start, width = _span(x.astype(np.int64), hit, k2, k1, freq, cum)
            lo += r * start
            r *= width
            go = np.flatnonzero(r < _BOT)
            _shift(lo, r, go)
            cd[go] = (cd[go] << _WORD) | words[pos[go]]
            pos[go] += 1
            out[t, :w] = x
            model.update(x, hit)
    return np.ascontiguousarray(out.T).ravel()[:n]


# --------------------------------------------------------------------- Spark

def _strip_row(part: int, strip: int, docs: list, lengths: list, ids: np.ndarray) -> dict:
    symbols, counts = order0(ids)
    block = block_size(len(ids))
    blocks = encode_strip(ids, block, symbols, counts)
    known = np.array([d is not None for d in docs], np.uint8)
    doc_ids = np.array([0 if d is None else d for d in docs], "<i8")
    return {"part": part, "strip": strip, "n": len(ids), "doc_ids": zlib.compress(known.tobytes() + doc_ids.tobytes(), 1),
            "lengths": zlib.compress(np.array(lengths, "<i8").tobytes(), 1), "symbols": zlib.compress(symbols.astype("<u4").tobytes(), 1),
            "counts": zlib.compress(counts.astype("<u4").tobytes(), 1), "block": block, "blocks": blocks,
            "checks": [zlib.crc32(b) for b in blocks]}


_ARROW = pa.schema([("part", pa.int32()), ("strip", pa.int32()), ("n", pa.int64())] + [(k, pa.binary()) for k in ("doc_ids", "lengths", "symbols", "counts")]
                   + [("block", pa.int32()), ("blocks", pa.list_(pa.binary())), ("checks", pa.list_(pa.int64()))])


def _write(vocabulary: str, strip_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = column_encoder(vocabulary)
        part, strip = TaskContext.get().partitionId(), 0
        docs, lengths, held, total = [], [], [], 0

        def close():
            return pa.RecordBatch.from_pylist([_strip_row(part, strip, docs, lengths, np.concatenate(held))], schema=_ARROW)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for at, ids, sizes in encode(batch.column(1)):
                ends, done, to = np.cumsum(sizes), 0, 0
                while done < len(sizes):
                    # up to the document that fills the strip, or all
                    so = to
                    upto = min(int(np.searchsorted(ends, so + strip_ids - total)) + 1, len(sizes))
                    to = int(ends[upto - 1])
                    docs += doc_ids[at + done:at + upto]
                    lengths += sizes[done:upto].tolist()
                    held.append(ids[so:to])
                    total, done = total + to - so, upto
                    if total >= strip_ids:
                        yield close()
                        docs, lengths, held, total, strip = [], [], [], 0, strip + 1
        if docs:
            yield close()
    return run


def read_strip(row: dict) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, lengths and ids of one file row; raises if a block is damaged."""
    lengths = np.frombuffer(zlib.decompress(row["lengths"]), "<i8")
    raw = zlib.decompress(row["doc_ids"])
    known, ids = np.frombuffer(raw[:len(lengths)], np.uint8), np.frombuffer(raw[len(lengths):], "<i8")
    for k, (payload, check) in enumerate(zip(row["blocks"], row["checks"])):
        if zlib.crc32(payload) != check:
            raise ValueError(f"block {k} of strip {row['strip']} of part {row['part']} is damaged")
    symbols = np.frombuffer(zlib.decompress(row["symbols"]), "<u4")
    counts = np.frombuffer(zlib.decompress(row["counts"]), "<u4").astype(np.int64)
    tokens = decode_strip(row["blocks"], int(lengths.sum()), row["block"], symbols, counts)
    return [int(d) if k else None for d, k in zip(ids, known)], lengths, tokens


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
            docs, lengths, ids = read_strip(row)
            data = ids.astype("<u4").tobytes()
            ends = np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["strip"], np.int32)), pa.array(docs, pa.int64()),
                 pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                names=["part", "strip", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def write_ids(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, strip_ids: int = BLOCK * LANES) -> None:
    """Token ids of ``docs(doc_id, text)`` in ascending doc_id order (no id first; ties by
    text), as files of strips below ``path``.  A null text is the end id alone."""
    (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
     .repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
     .mapInArrow(_write(vocabulary, strip_ids), _ROW).write.parquet(path))


def read_ids(spark, path: str) -> DataFrame:
    """Per document of the files: ``part, strip, doc_id, local_start, n_tokens, ids_crc32``;
    ``local_start`` counts the ids before it in its strip."""
    return spark.read.schema(_ROW).parquet(path).mapInArrow(
        _read, "part int, strip int, doc_id long, local_start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, strip_ids: int = BLOCK * LANES) -> DataFrame:
    """Write the ids, read them back: ``doc_id, start, n_tokens, ids_crc32``.

    Rows that repeat a doc_id are documents of their own; no documents, no rows.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "token-ids")
    write_ids(docs, path, vocabulary, strip_ids)
    back = read_ids(spark, path)
    # one row per strip: where it starts among all ids
    sizes = spark.read.schema(_ROW).parquet(path).select("part", "strip", "n")
    before = Window.orderBy("part", "strip").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("part", "strip", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return back.join(places, ["part", "strip"]).select(
        "doc_id", (F.col("first") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
