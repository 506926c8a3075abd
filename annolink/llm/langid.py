"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of its byte 2-, 3- and 4-grams (letters
folded, everything else one blank), a linear layer and softmax on top.  Both are
trained by stochastic gradient descent in numpy on a sample of bounded size.
The layers are then folded into one score per gram and language, so predicting
is one look-up per byte and gram length over the whole text; above ``MAX_LANGS``
languages they stay apart, so the model's size does not grow with them.

Calibration uses training documents kept out of the descent: a temperature, and
a rejection threshold below which only ``REJECT_SHARE`` of their rightly
predicted documents fall.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from annolink.llm.common import bound_batches, by_value, no_clash, stored, text_slices

by_value(__name__)

#: Characters of labelled text sampled per language (expected).  More than
#: ``SAMPLE_LANGS`` languages share the characters of so many, which bounds the sample.
SAMPLE_CHARS = 1_500_000
SAMPLE_LANGS = 8
#: Up to so many languages the layers are folded into one.
MAX_LANGS = 64
#: Text judged at once, in bytes.
JUDGED_BYTES = 1 << 19
DIM, BITS, EPOCHS, RATE, SEED = 16, 16, 3, 0.5, 7
REJECT_SHARE, MAX_THRESHOLD = 0.001, 0.5
UNDETERMINED = "und"

_KEEP = re.compile(rb"[a-z\x80-\xff]")
_FOLD = bytes(b if _KEEP.fullmatch(bytes([b])) else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_PAD = 3


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # (languages, 3 * 2^BITS); with ``out``: (DIM, 3 * 2^BITS)
    bias: np.ndarray
    temperature: float
    threshold: float
    out: np.ndarray | None = None  # (DIM, languages)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def gram_ids(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gram ids of a slice, (3, positions), and the first position of each row.
    Every row is preceded by blanks, so no gram spans two rows."""
    data = np.frombuffer(raw.translate(_FOLD), np.uint8)
    starts = offsets[:-1] + _PAD * np.arange(len(offsets) - 1)
    data = np.concatenate([np.insert(data, np.repeat(offsets[:-1], _PAD), 32), np.full(_PAD, 32, np.uint8)])
    b = data.astype(np.uint32)
    n = len(b) - _PAD
    two = (b[:n] << np.uint32(8)) | b[1:n + 1]
    three = (two << np.uint32(8)) | b[2:n + 2]
    four = (three << np.uint32(8)) | b[3:n + 3]
    size = np.uint32(1 << BITS)
    shift = np.uint32(32 - BITS)
    with np.errstate(over="ignore"):
        ids = np.stack([two, ((three * np.uint32(0x9E3779B1)) >> shift) + size,
                        ((four * np.uint32(0x85EBCA6B)) >> shift) + size + size])
    return ids.astype(np.int32), starts


def logits(model: Model, raw: bytes, offsets: np.ndarray) -> np.ndarray:
    """Mean gram score by row and language, plus bias."""
    ids, starts = gram_ids(raw, offsets)
    n = np.diff(np.append(starts, ids.shape[1]))
    out = np.empty((len(starts), len(model.scores)))
    for k, w in enumerate(model.scores):
        total = w[ids[0]] + w[ids[1]] + w[ids[2]]
        out[:, k] = np.add.reduceat(total, starts, dtype=np.float64) / (3 * n)
    return (out if model.out is None else out @ model.out) + model.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sampling_rates(sized: DataFrame, label: str, chars: int, max_labels: int) -> DataFrame:
    """``<label>, rate, docs`` from ``sized(<label>, chars)``: the share of each label
    that has about ``chars`` characters; more than ``max_labels`` labels share
    ``max_labels * chars`` evenly."""
    sizes = stored(sized.where(F.col("chars").isNotNull() & F.col(label).isNotNull()).groupBy(label)
                   .agg(F.sum("chars").alias("chars"), F.count("*").alias("docs")), "label-sizes")
    each = F.lit(float(chars)) * F.least(F.lit(1.0), F.lit(float(max_labels)) / F.col("labels"))
    return (sizes.join(F.broadcast(sizes.agg(F.count("*").alias("labels"))))  # one row
            .select(label, (each / F.greatest("chars", F.lit(1))).alias("rate"), "docs"))


def drawn(rate: str = "rate") -> Column:
    """A repeatable draw by a hash of the id."""
    return F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) / float(1 << 20) < F.col(rate)


def sampled(labelled: DataFrame, label: str, chars: int, max_labels: int) -> DataFrame:
    """A sample of ``labelled(doc_id, text, <label>)``: about ``chars`` characters of
    each label, or an even share of ``max_labels * chars`` of more labels."""
    rates = sampling_rates(labelled.select(label, F.length("text").alias("chars")), label, chars, max_labels)
    return (labelled.where("text is not null").join(rates, label).where(drawn())
            .select("doc_id", "text", label))


def fit(docs: DataFrame, label: str = "lang", sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Train on ``docs(doc_id, text, lang)``; None if there is nothing to learn from."""
    rows = sampled(docs, label, sample_chars, SAMPLE_LANGS).orderBy("doc_id", "text").toArrow()
    texts, names = rows.column("text").to_pylist(), rows.column(label).to_pylist()
    langs = sorted(set(names))
    if not langs:
        return None
    place = {v: k for k, v in enumerate(langs)}
    y = np.array([place[v] for v in names])
    rng = np.random.default_rng(SEED)
    kept_out = rng.random(len(texts)) < 0.2
    if kept_out.all() or not kept_out.any():
        kept_out[:] = False
    lines = [(t.encode(), k) for t, k, out in zip(texts, y, kept_out) if not out
             for t in t.split("\n") if has_letter(t)]
    truth = np.array([k for t, k, out in zip(texts, y, kept_out) if out and has_letter(t)])
    held = [t.encode() for t, out in zip(texts, kept_out) if out and has_letter(t)]
    del rows, texts
    emb = rng.normal(0, 0.1, (3 << BITS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps, step = max(1, EPOCHS * len(lines)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(lines)):   # a line's grams are made when it is its turn
            raw, k = lines[i]
            ids, _ = gram_ids(raw, np.array([0, len(raw)]))
            ids, count = np.unique(ids, return_counts=True)
            share = (count / count.sum()).astype(np.float32)
            rows_ = emb[ids]
            mean = share @ rows_
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[k] -= 1
            rate = RATE * (1 - step / steps)
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            # shares are small, so embeddings take a longer step
            emb[ids] = rows_ - (rate * 20) * share[:, None] * back
            step += 1
    if len(langs) <= MAX_LANGS:
        model = Model(langs, np.ascontiguousarray((emb @ out).T), bias, 1.0, 0.0)
    else:
        model = Model(langs, np.ascontiguousarray(emb.T), bias, 1.0, 0.0, out)
    if held:
        z = np.concatenate([logits(model, r, np.array([0, len(r)])) for r in held])
        grid = np.geomspace(0.05, 5, 41)
        loss = [-np.log(softmax(z / t)[np.arange(len(z)), truth] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / model.temperature)
        right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
        if len(right):
            model.threshold = float(min(MAX_THRESHOLD, right[int(REJECT_SHARE * len(right))] * 0.9))
    return model


def _judge(model: Model, column: pa.Array):
    """Language, score and rejection of each text of an Arrow column."""
    langs, scores = [], []
    nulls = column.is_null().to_pylist()
    for at, raw, offs in text_slices(column, JUDGED_BYTES):
        p = softmax(logits(model, raw, offs) / model.temperature)
        best = p.argmax(axis=1)
        for i in range(len(offs) - 1):
            text = raw[offs[i]:offs[i + 1]]
            letters = not nulls[at + i] and (re.search(rb"[A-Za-z]", text) is not None or has_letter(text.decode()))
            langs.append(model.langs[best[i]] if letters else UNDETERMINED)
            scores.append(float(p[i, best[i]]) if letters else 0.0)
    return langs, scores, [k == UNDETERMINED or s < model.threshold for k, s in zip(langs, scores)]


def predict(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang_pred", score: str = "score",
            rejected: str = "rejected") -> DataFrame:
    """``docs`` with the predicted language, its probability and the rejection.

    Null texts and texts without a letter are ``und`` with score 0 and rejected;
    without a model every text is.  Rows are judged one by one, whole.  A new
    name that is a column of ``docs`` raises.
    """
    no_clash(docs, lang, score, rejected)
    if model is None:
        return docs.withColumns({lang: F.lit(UNDETERMINED), score: F.lit(0.0), rejected: F.lit(True)})
    bound_batches(docs.sparkSession)
    # plain values, since workers need not know the class: max(MAX_LANGS, DIM) x 3 x 2^BITS floats, and DIM + 1 a language, at most
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.scores, model.bias, model.temperature, model.threshold, model.out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Model(*sent.value)
        for batch in batches:
            langs, scores, out = _judge(judge, batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(out, pa.bool_())],
                names=[*batch.schema.names, lang, score, rejected])

    added = T.StructType().add(lang, "string").add(score, "double").add(rejected, "boolean")
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added.fields))
