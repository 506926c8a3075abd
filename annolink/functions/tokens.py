"""Regex matches with their offsets.

Spark SQL has no built-in that returns *where* every regex match starts
(``regexp_extract_all`` gives the words, ``regexp_instr`` only the first one), and
prefix sums inside a row are quadratic with array functions.  This small,
Arrow-batched helper returns the words and their UTF-16 start offsets in one
linear pass per text; everything around it stays in Spark.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, functions as F, types as T

from annolink._util import col_of

try:  # ship this module's code with the UDF so workers need no installed package
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

WORD_PATTERN = r"[\p{L}\p{N}]+"       # letters and digits (Unicode)
ASCII_WORD_PATTERN = r"[A-Za-z]+"    # what ``letter_spans`` finds
SLICE = 1024                          # texts whose bytes are looked at together

SPANS_TYPE = T.StructType([
    T.StructField("words", T.ArrayType(T.StringType())),
    T.StructField("starts", T.ArrayType(T.IntegerType())),
])


def _utf16_starts(text: str, starts: list[int]) -> list[int]:
    """Code point offsets -> UTF-16 offsets (differs only past non-BMP chars)."""
    if len(text.encode("utf-16-le")) == 2 * len(text):
        return starts
    cps = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    extra = np.concatenate([[0], np.cumsum(cps > 0xFFFF)])
    return [int(s + extra[s]) for s in starts]


@lru_cache(maxsize=16)
def _spans_udf(pattern: str):
    rx = regex.compile(pattern)

    @F.pandas_udf(SPANS_TYPE)
    def spans(texts: pd.Series) -> pd.DataFrame:
        words, starts = [], []
        for t in texts:
            if t is None:
                words.append(None)
                starts.append(None)
                continue
            ms = list(rx.finditer(t))
            words.append([m.group() for m in ms])
            starts.append(_utf16_starts(t, [m.start() for m in ms]))
        return pd.DataFrame({"words": words, "starts": starts})

    return spans


def word_spans(text, pattern: str = WORD_PATTERN) -> Column:
    """``struct<words: array<string>, starts: array<int>>`` of every match."""
    return _spans_udf(pattern)(col_of(text))


LETTERS_TYPE = T.StructType([T.StructField("pos", T.ArrayType(T.IntegerType()))] + SPANS_TYPE.fields)


def _letter_runs(texts: pa.Array, shortest: int) -> pa.Array:
    """Runs of ASCII letters of a few texts, found in their bytes laid end to end."""
    words, starts, pos = pa.array([], pa.string()), pa.array([], pa.int32()), pa.array([], pa.int32())
    missing = texts.is_null()
    texts = texts.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = ends - ends[0]
    if at[-1]:
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]]
        letter = ((data | 32) - np.uint8(97)) < 26
        edge = np.zeros(len(data) + 1, bool)            # a run ends with its text
        edge[at] = True
        first = np.flatnonzero(letter & (edge[:-1] | ~np.concatenate([[False], letter[:-1]])))
        last = np.flatnonzero(letter & (edge[1:] | ~np.concatenate([letter[1:], [False]])))
        units = ((data & 0xC0) != 0x80).astype(np.int32) + (data >= 0xF0)       # UTF-16 units that begin at a byte
        before = np.concatenate([[0], np.cumsum(units, dtype=np.int32)])
        lists = np.searchsorted(first, at)
        number = np.arange(len(first)) - np.repeat(lists[:-1], np.diff(lists))
        size = last + 1 - first
        long = size >= shortest
        letters = data[letter][np.repeat(long, size)]
        first, size, number = first[long], size[long], number[long]
        lists = np.searchsorted(first, at)
        words = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(letters))
        starts = pa.array(before[first] - np.repeat(before[at[:-1]], np.diff(lists)), pa.int32())
        pos = pa.array(number, pa.int32())
    else:
        lists = np.zeros(len(texts) + 1, np.int64)
    lists = pa.array(lists, pa.int32())
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(lists, x, mask=missing) for x in (pos, words, starts)], LETTERS_TYPE.names)


@lru_cache(maxsize=16)
def _letters_udf(shortest: int):
    @F.arrow_udf(LETTERS_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([_letter_runs(texts.slice(k, SLICE), shortest) for k in range(0, max(len(texts), 1), SLICE)])

    return spans


def letter_spans(text, shortest: int = 1) -> Column:
    """The matches of ``word_spans(text, ASCII_WORD_PATTERN)`` of ``shortest`` letters or more,
    with their numbers ``pos`` among all matches.  They are found in the bytes of many texts
    at once and kept in Arrow buffers: no Python object for a word."""
    return _letters_udf(shortest)(col_of(text))
