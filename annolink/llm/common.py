"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import sys
import tempfile
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def by_value(module_name: str) -> None:
    """Ship a module's functions to the executors by value, so the package need
    not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)


def process_cache(name: str) -> dict:
    """A dict that lives as long as this Python worker process (functions are
    shipped by value, so module globals live for one task only)."""
    box = sys.modules.setdefault("_annolink_llm_cache", types.ModuleType("_annolink_llm_cache"))
    return box.__dict__.setdefault(name, {})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, kind: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.  Only
    a local master may go without that setting (tests); elsewhere it raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="annolink-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write a table to the shared folder and read it back (cuts the lineage;
    later reads survive the loss of executors)."""
    spark = df.sparkSession
    path = shared_dir(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Text bytes of one Arrow batch, beside its record limit: what a worker holds does
#: not grow with the length of texts.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of the session's Arrow batches, unless it has a smaller bound."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name, None)
    if given is None or not given.isdigit() or int(given) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def unused(df: DataFrame, name: str) -> str:
    """``name`` or a variant of it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def no_clash(df: DataFrame, *names: str | None) -> None:
    """Raises if a column to be added is there already (in any case)."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        if name and name.lower() in taken:
            raise ValueError(f"there is a column {name!r} already: choose another name for the new one")


# ------------------------------------------------- whole texts as numpy arrays

#: Text bytes handled at once inside a task: bounds the arrays below.
SLICE_BYTES = 1 << 21

#: Odd bases of two independent polynomial hashes.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_P = np.uint64(BASES[0])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """p^i and p^-i modulo 2^64 for i < n, kept per process."""
    box = process_cache(f"powers{base}")
    if len(box.get("p", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        inv = np.uint64(pow(BASES[base], -1, 1 << 64))
        p, q = np.full(size, BASES[base], np.uint64), np.full(size, inv, np.uint64)
        p[0] = q[0] = 1
        box["p"], box["q"] = np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
    return box["p"], box["q"]


def byte_class(pattern: str) -> bytes:
    """A 256-byte table: 1 where the single byte (as Latin-1) matches."""
    rx = re.compile(pattern)
    return bytes(1 if rx.fullmatch(chr(b)) else 0 for b in range(256))


LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IDENTITY = bytes(range(256))


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES):
    """Cut an Arrow string column into runs of rows of about ``slice_bytes``
    (a single longer text makes a run of its own).  Yields ``(first row, UTF-8
    bytes, row offsets)``; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64)[column.offset:column.offset + n + 1]
    data = memoryview(data) if data is not None else memoryview(b"")
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + slice_bytes, "right")) - 1)
        yield at, bytes(data[int(offs[at]):int(offs[to])]), offs[at:to + 1] - offs[at]
        at = to


def words_of(text: bytes, offsets: np.ndarray, word_byte: bytes, fold: bytes = LOWER_AZ):
    """All words (maximal runs of word bytes, never across rows) of a slice.

    Returns ``row`` (int64, by word), ``start`` and ``end`` (byte offsets in the
    slice) and a 64-bit hash of each folded word.  The hash is a polynomial of
    the word's bytes modulo 2^64 with a fixed odd base, mixed afterwards, so it
    is the same on every machine."""
    raw = text.translate(fold)
    isw = np.frombuffer(raw.translate(word_byte), np.uint8).astype(bool)
    n = len(isw)
    edge = np.zeros(n + 1, bool)
    if n:
        edge[0], edge[n] = isw[0], False
        edge[1:n] = isw[1:] & ~isw[:-1]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        edge[cuts] = isw[cuts]
    start = np.flatnonzero(edge)
    stop = np.zeros(n + 1, bool)
    if n:
        stop[n] = isw[n - 1]
        stop[1:n] = isw[:-1] & ~isw[1:]
        stop[cuts] = isw[cuts - 1]
    end = np.flatnonzero(stop)
    row = np.searchsorted(offsets, start, "right") - 1
    return row, start, end, span_hash(raw, start, end)


def prefix_sums(raw: bytes, base: int = 0) -> np.ndarray:
    """The sums of which ``sums_hash`` takes differences."""
    n = len(raw)
    p, _ = _powers(n + 1, base)
    acc = np.empty(n + 1, np.uint64)
    acc[0] = 0
    with np.errstate(over="ignore"):
        terms = np.frombuffer(raw, np.uint8).astype(np.uint64)
        terms += np.uint64(1)
        terms *= p[:n]
        np.cumsum(terms, dtype=np.uint64, out=acc[1:])
    return acc


def sums_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans ``[start:end]`` of the text that ``sums`` were made of."""
    _, q = _powers(len(sums), base)
    with np.errstate(over="ignore"):
        return mix64((sums[end] - sums[start]) * q[start] + (end - start).astype(np.uint64))


def runs_hash(sums: np.ndarray, length: int, base: int = 0) -> np.ndarray:
    """The same of all spans of one length, wherever they begin."""
    n = max(len(sums) - length, 0)
    _, q = _powers(len(sums), base)
    with np.errstate(over="ignore"):
        out = sums[length:] - sums[:n]
        out *= q[:n]
        out += np.uint64(length)
        for shift, by in ((30, _M1), (27, _M2)):
            out ^= out >> np.uint64(shift)
            out *= by
        out ^= out >> np.uint64(31)
    return out


def span_hash(raw: bytes, start: np.ndarray, end: np.ndarray, base: int = 0) -> np.ndarray:
    """64-bit hashes of the byte spans ``raw[start:end]``, one pass for all."""
    return sums_hash(prefix_sums(raw, base), start, end, base)


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive word hashes (len(h) - k + 1)."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix64(out * _P + h[i:i + m] + np.uint64(i + 1))
    return out


def arrow_schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema(list(fields.items()))


