"""Token ids of whole texts by the ``tokenizers`` library.

The vocabulary lower-cases, drops white space and never joins characters across
it, so a text's ids are the ids of its chunks between blanks, in order.  A chunk of
plain Latin letters plus closing punctuation is two parts, the lower-cased word
and the punctuation; any other chunk is one.  The distinct parts of a slice of
texts are found by Arrow, each goes through the library once while a worker
process remembers it, and the slice's ids are gathered from theirs.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa

from annolink.llm.common import LOWER_AZ, byte_class, by_value, process_cache, text_slices

by_value(__name__)

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
_BLANK = byte_class("[ \t\r\n]")
_AZ = byte_class("[a-z]")
_CLOSING = byte_class(r"[!\"#$%&()*+,\-./:;=?@\[\]^_{}~]")
#: Lower-case letters a-z and U+00DF to U+00FF without the division sign, in UTF-8.
_WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: Parts remembered (about 200 bytes each) and the longest of them.
MAX_PARTS, MAX_PART_BYTES = 800_000, 128
#: Text bytes cut into parts at once (in the processor's cache), and coded at once.
CACHED_BYTES, TEXT_BYTES = 1 << 17, 1 << 22


class _Parts:
    """part -> its ids as little-endian unsigned 32-bit integers.  Of two
    generations the older one goes when the younger is full; parts that are met
    again stay."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    @staticmethod
    def pack(ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encoded(self, part: bytes) -> bytes:
        text = part.decode()
        if not _WORD.fullmatch(part):
            return self.pack(self.tok.encode(text, add_special_tokens=False).ids)
        # one pre-token: straight to the library's model
        word = text if text.isascii() else self.bytes_of.pre_tokenize_str(text)[0][0]
        return self.pack([t.id for t in self.model.tokenize(word)])

    def get(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each of the distinct ``parts``."""
        out = list(map(self.young.get, parts))
        for i, got in enumerate(out):
            if got is None:
                part = parts[i]
                out[i] = got = self.old.get(part) or self.encoded(part)
                if len(part) <= MAX_PART_BYTES:
                    if len(self.young) >= MAX_PARTS // 2:
                        self.old, self.young = self.young, {}
                    self.young[part] = got
        return out


def _flags(raw: bytes, table: bytes) -> np.ndarray:
    return np.frombuffer(raw.translate(table), np.uint8).astype(bool)


def _before(flags: np.ndarray) -> np.ndarray:
    """How many are set before each position."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, dtype=np.int32, out=out[1:])
    return out


def text_parts(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The parts of a slice of texts, in order: each one's row and its bytes (words folded)."""
    data, folded = np.frombuffer(raw, np.uint8), np.frombuffer(raw.translate(LOWER_AZ), np.uint8)
    letter = _flags(folded.tobytes(), _AZ)
    if not raw.isascii():
        follows = (folded[1:] >= 0x80) & (folded[1:] <= 0xBF) & (folded[1:] != 0x97) & (folded[1:] != 0xB7)
        pair = (folded[:-1] == 0xC3) & follows
        letter[:-1] |= pair
        letter[1:] |= pair
        folded = folded.copy()
        folded[1:][pair & (folded[1:] <= 0x9E)] += 0x20
    ink = ~_flags(raw, _BLANK)
    n = len(data)
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = ink[cuts]
    last[cuts - 1] = ink[cuts - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    # where the letters that a chunk begins with end, and whether only punctuation follows
    others = ~letter
    stop = np.minimum(np.append(np.flatnonzero(others), n)[_before(others)[start]], end)
    closing = _before(_flags(raw, _CLOSING))
    plain = (stop > start) & (closing[end] - closing[stop] == end - stop)
    if not plain.all():
        whole = np.zeros(n + 1, np.int8)
        whole[start[~plain]] += 1
        whole[end[~plain]] -= 1
        folded = np.where(np.cumsum(whole[:-1], dtype=np.int8).astype(bool), data, folded)
    two = plain & (stop < end)
    count = 1 + two
    upto = np.cumsum(count)
    to = np.repeat(end, count)
    to[upto[two] - 2] = stop[two]
    lengths = to - np.repeat(start, count)
    lengths[upto[two] - 1] = end[two] - stop[two]
    bounds = np.zeros(len(to) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    parts = pa.Array.from_buffers(pa.large_binary(), len(to), [None, pa.py_buffer(bounds), pa.py_buffer(folded[ink])])
    return np.repeat(np.searchsorted(offsets, start, "right") - 1, count), parts


def column_encoder(vocabulary: str = VOCABULARY):
    """A function that takes an Arrow column of texts and yields, by slices of it,
    the first row, the ids of its texts, each with the end id, one after the other,
    and the number of each text's.  Null counts as empty.  ``vocabulary`` is a file
    path or the name of a public tokenizer file."""
    box = process_cache("encoders")
    if vocabulary not in box:
        path = vocabulary
        if not os.path.exists(path):
            import public_tokenizers
            path = public_tokenizers.path(vocabulary)
        box[vocabulary] = _Parts(path)
    get = box[vocabulary].get

    def ids_of(row: np.ndarray, parts: pa.Array, n: int):
        coded = parts.dictionary_encode()
        known = get(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        of = coded.indices.to_numpy()
        size = sizes[of]
        lengths = np.bincount(row, size, n).astype(np.int64) + 1
        ids = np.full(int(lengths.sum()), END_ID, np.uint32)
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(lengths) - 1] = False
        shift = (np.cumsum(sizes) - sizes)[of] - (np.cumsum(size) - size)
        ids[inner] = flat[np.repeat(shift, size) + np.arange(len(ids) - n)]
        return ids, lengths

    def encode(column: pa.Array):
        rows, parts, first, n, held = [], [], 0, 0, 0
        for at, raw, offsets in text_slices(column, CACHED_BYTES):
            row, cut = text_parts(raw, offsets)
            rows.append(row + (at - first))
            parts.append(cut)
            n, held = at + len(offsets) - 1 - first, held + len(raw)
            if held >= TEXT_BYTES:
                yield first, *ids_of(np.concatenate(rows), pa.concat_arrays(parts), n)
                rows, parts, first, n, held = [], [], first + n, 0, 0
        if n:
            yield first, *ids_of(np.concatenate(rows), pa.concat_arrays(parts), n)

    return encode


def encoder(vocabulary: str = VOCABULARY):
    """``text -> ids as bytes`` (without the end id); None counts as empty."""
    encode = column_encoder(vocabulary)

    def one(text: str | None) -> bytes:
        return b"".join(ids.tobytes() for _, ids, _ in encode(pa.array([text], pa.string())))[:-4]

    return one
