import zlib
from collections import defaultdict

import numpy as np
import pytest

from annolink.llm import idcodec, packing
from annolink.llm.tokens import encoder

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = ["", None, "Hello, World!", "it's we'll I'D", "naïve café ÉCOLE straße", "e\u0301le\u0301ment a\u0308",
         "a<|endoftext|>b <|STARTOFTEXT|>", "tab\tand\x1cseparators\x1f here", "東京 2024 ½ ¾ 1,000.50", "İstanbul ΣΑΣ ς", "a\u00a0b\u2003c\u0085d",
         "$$$money!!! (x) [y] {z}", "x" * 300, "word" * 40 + "," * 90, "…—“quoted”", "\x00\x01 ctrl", "‍zero\u200bwidth"]


def test_ids_equal_the_librarys(library):
    encode = encoder()
    for text in TEXTS:
        got = np.frombuffer(encode(text), "<u4").tolist()
        assert got == ids_of(library, text)[:-1], text


def test_cut_is_lossless_and_reciprocal():
    for n in list(range(1, 300)) + [2047, 2048, 2049, 10_000]:
        parts = packing.cut(n)
        assert sum(parts) == n
        assert all(2048 % p == 0 for p in parts if p >= packing.MIN_PIECE)
        assert sum(p < packing.MIN_PIECE for p in parts) <= 1


def check_packing(rows, docs, library):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(np.array(ids_of(library, t), "<u4"))
    assert set(by_doc) == set(want)
    for i, ids in want.items():
        pieces = by_doc[i]
        assert sum(r.length for r in pieces) == sum(map(len, ids))
        for r in pieces:
            one = next(x for x in ids if len(x) == r.doc_tokens)
            assert zlib.crc32(one[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        if len(ids) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at
                at += r.length
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    return {s: sum(r.length for r in p) for s, p in by_sequence.items()}


def test_packing(docs, doc_rows, library):
    fill = check_packing(packing.harmonic_pack(docs).collect(), doc_rows, library)
    # every class leaves at most its last bin partly empty
    assert sum(n < packing.CAPACITY - packing.MIN_PIECE for n in fill.values()) <= 7 + packing.MIN_PIECE


def test_packing_of_nothing_and_nulls(no_docs, null_docs, library):
    assert packing.harmonic_pack(no_docs).count() == 0
    rows = packing.harmonic_pack(null_docs).collect()
    assert sum(r.length for r in rows if r.doc_id is None and r.doc_tokens == 1) == 2


@pytest.mark.parametrize("n, block", [(1, 128), (127, 128), (129, 128), (5000, 256), (30_000, 512)])
def test_codec_round_trip(n, block):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 49_407).astype(np.uint32)
    ids[n // 2:] = ids[:n - n // 2]  # something to predict
    symbols, counts = idcodec.order0(ids)
    payloads = idcodec.encode_strip(ids, block, symbols, counts)
    assert len(payloads) == -(-n // block)
    assert (idcodec.decode_strip(payloads, n, block, symbols, counts) == ids).all()


def test_codec_gains_from_contexts():
    ids = np.tile(np.arange(200, dtype=np.uint32) * 7, 60)
    symbols, counts = idcodec.order0(ids)
    size = sum(map(len, idcodec.encode_strip(ids, 4000, symbols, counts)))
    assert size * 8 / len(ids) < 3  # order 0 alone needs log2(200) = 7.6


def test_codec_one_symbol():
    ids = np.full(1000, 49_407, np.uint32)
    symbols, counts = idcodec.order0(ids)
    assert (idcodec.decode_strip(idcodec.encode_strip(ids, 300, symbols, counts), 1000, 300, symbols, counts) == ids).all()


def test_damage_is_found():
    ids = np.arange(900, dtype=np.uint32)
    row = idcodec._strip_row(0, 0, [1, None], [500, 400], ids)
    docs, lengths, back = idcodec.read_strip(row)
    assert docs == [1, None] and lengths.tolist() == [500, 400] and (back == ids).all()
    row["blocks"][0] = bytes([row["blocks"][0][0] ^ 1]) + row["blocks"][0][1:]
    with pytest.raises(ValueError, match="damaged"):
        idcodec.read_strip(row)


def test_files_round_trip(docs, doc_rows, library):
    got = idcodec.round_trip(docs, strip_ids=20_000).collect()
    at = 0
    want = []
    for i, t in sorted(doc_rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array(ids_of(library, t), "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got)) == sorted(want)


def test_files_of_nothing_and_nulls(no_docs, null_docs):
    assert idcodec.round_trip(no_docs).count() == 0
    rows = idcodec.round_trip(null_docs).collect()
    assert sorted(r.start for r in rows)[0] == 0 and len(rows) == 4
    assert max(rows, key=lambda r: r.start).doc_id == 9  # no id comes first


def test_frequent_words_stay_known(monkeypatch):
    """Many more rare words than a worker remembers; the frequent ones go to the library once."""
    from annolink.llm import common, tokens
    rare = ["".join(chr(97 + (i // 26 ** k) % 26) for k in range(4)) for i in range(4000)]
    texts = [" ".join(w for r in rare[at:at + 50] for w in ("Often, seen", r)) for at in range(0, 4000, 50)]
    common.process_cache("encoders").clear()
    for name in ("MAX_PARTS", "MAX_CHUNKS", "MAX_WORDS"):
        monkeypatch.setattr(tokens, name, 500, raising=False)
    encode = encoder()
    box, asked = common.process_cache("encoders")["word_bpe_49k.json"], []

    class Model:
        def tokenize(self, word, model=box.model):
            asked.append(word)
            return model.tokenize(word)

    box.model = Model()
    try:
        for text in texts:
            encode(text)
    finally:
        common.process_cache("encoders").clear()
    assert asked.count("often") == asked.count("seen") == 1


def test_strips_close_with_the_document_that_fills_them():
    import pyarrow as pa
    from unittest import mock
    texts = ["a b c", None, "d e f g h", "i", "", "j k l m", "n"]
    batches = [pa.record_batch([pa.array([4, None, 6], pa.int64()), pa.array(texts[:3])], names=["doc_id", "text"]),
               pa.record_batch([pa.array([7, 8, 9, 10], pa.int64()), pa.array(texts[3:])], names=["doc_id", "text"])]
    with mock.patch.object(idcodec.TaskContext, "get") as context:
        context.return_value.partitionId.return_value = 3
        rows = [r for b in idcodec._write("word_bpe_49k.json", 6)(iter(batches)) for r in b.to_pylist()]
    back = [idcodec.read_strip(r) for r in rows]
    assert [b[0] for b in back] == [[4, None, 6], [7, 8, 9], [10]]
    assert [b[1].tolist() for b in back] == [[4, 1, 6], [2, 1, 5], [2]]
    assert [(r["part"], r["strip"], r["n"]) for r in rows] == [(3, 0, 11), (3, 1, 8), (3, 2, 2)]
