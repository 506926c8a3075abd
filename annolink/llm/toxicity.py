"""Toxic spans by a linear-chain conditional random field, document scores from them.

Labels mark documents, the field needs labelled tokens: a token of a toxic
document is toxic if one of its features (the word, its first 4, 5 or 6 bytes)
stands out in toxic documents by a binomial test; all other tokens are not.
Emissions use these features of the token and of its neighbours; a line is a sequence.
With two states the forward and backward messages are odds, so all lines of a
slice advance together, one position at a time.  A document's score is a
logistic function of its largest marginal and of their sum; offending offsets
are the tokens with a marginal of at least one half.

Everything is learned from a sample of bounded size (``SAMPLE_CHARS`` characters
per label); the field's weights from ``FIT_TOKENS`` tokens a side, in lines (cut to
``FIT_SEQUENCE`` tokens) drawn from all of it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from annolink.llm.bloom import blocks_of, with_possible
from annolink.llm.common import bound_batches, byte_class, by_value, mix64, no_clash, stored, text_slices, words_of
from annolink.llm.langid import drawn, sampling_rates

by_value(__name__)

SAMPLE_CHARS = 6_000_000
WORD = byte_class(r"[0-9A-Za-z\x80-\xff]")
PREFIXES = (4, 5, 6)
#: A feature counts if chance would give its toxic share with p < 10^-MIN_EVIDENCE.
MIN_EVIDENCE, MIN_SHARE = 6.0, 0.8
STEPS, RATE, L2 = 60, 0.5, 1e-4
#: Tokens a side from which the field's weights are fitted, and of one sequence there.
FIT_TOKENS, FIT_SEQUENCE = 600_000, 256
FIT_LINES = FIT_TOKENS     # lines a side; as given never the stricter bound, a line has a token at least
_LINE_FEED = 10


@dataclass
class Model:
    features: np.ndarray   # sorted feature hashes
    weights: np.ndarray    # their emission weights
    bias: float
    before: float          # the token before (after) has a feature
    after: float
    trans: np.ndarray      # 2 x 2 potentials
    doc: np.ndarray        # bias, largest marginal, log(1 + sum)


def tokens(raw: bytes, offsets: np.ndarray):
    """Rows, byte starts and ends and feature hashes (tokens x features) of a slice,
    and where each line's tokens start."""
    row, start, end, h = words_of(raw, offsets, WORD)
    feats = [h]
    for k in PREFIXES:
        # the prefix as a word of its own, marked with its length; short words have none

        feats.append(np.where(end - start >= k, _piece(raw, start, k), np.uint64(0)))
    feeds = np.flatnonzero(np.frombuffer(raw, np.uint8) == _LINE_FEED)
    line = row + np.searchsorted(feeds, start)  # grows with every row and line feed
    heads = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.empty(0, np.int64)
    return row, start, end, np.stack(feats, 1) if len(h) else np.empty((0, 1 + len(PREFIXES)), np.uint64), heads


def _piece(raw: bytes, start: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` folded bytes from each start on."""
    data = np.frombuffer(raw, np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    out = np.full(len(start), k, np.uint64)
    last = max(len(data) - 1, 0)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix64(out * np.uint64(257) + data[np.minimum(start + i, last)])
    return out


def known(features: np.ndarray, feats: np.ndarray) -> np.ndarray:
    """Index of each token feature in the sorted ``features``, or -1."""
    if not len(features):
        return np.full(feats.shape, -1)
    at = np.searchsorted(features, feats)
    at[at == len(features)] = 0
    return np.where(features[at] == feats, at, -1)


def emissions(model: Model, feats: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-potential of the toxic state by token; whether the token has a feature."""
    return emit(model, known(model.features, feats), heads)


def emit(model: Model, at: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the features' indices."""
    w = np.append(model.weights, 0.0)
    e = model.bias + w[at].sum(axis=1)
    flag = (at >= 0).any(axis=1)
    before, after = neighbours(flag, heads)
    return e + model.before * before + model.after * after, flag


def neighbours(flag: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    f = flag.astype(float)
    before, after = np.zeros(len(f)), np.zeros(len(f))
    before[1:], after[:-1] = f[:-1], f[1:]
    before[heads] = 0
    after[heads[heads > 0] - 1] = 0
    return before, after


def messages(x: np.ndarray, trans: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward odds of the toxic state; ``x``: emission odds."""
    n = np.diff(np.append(heads, len(x)))
    order = np.argsort(-n, kind="stable")
    first, n = heads[order], n[order]
    f, b = np.empty(len(x)), np.ones(len(x))
    t00, t01, t10, t11 = trans.ravel()
    longest = int(n[0]) if len(n) else 0
    lanes = np.searchsorted(-n, -np.arange(1, longest + 1), "right") if longest else []
    prev = None
    for t in range(longest):
        at = first[:lanes[t]] + t
        f[at] = x[at] if t == 0 else x[at] * (t01 + t11 * prev[:len(at)]) / (t00 + t10 * prev[:len(at)])
        prev = f[at]
    for t in range(longest - 2, -1, -1):
        at = first[:lanes[t + 1]] + t
        y = x[at + 1] * b[at + 1]
        b[at] = (t10 + t11 * y) / (t00 + t01 * y)
    return f, b


def marginals(model: Model, feats: np.ndarray, heads: np.ndarray) -> np.ndarray:
    if not len(feats):
        return np.empty(0)
    e, _ = emissions(model, feats, heads)
    f, b = messages(np.exp(np.clip(e, -20, 20)), model.trans, heads)
    odds = f * b
    return odds / (1 + odds)


def doc_features(p: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """(rows, 3): one, largest marginal, log(1 + sum of marginals)."""
    most, total = np.zeros(n), np.zeros(n)
    np.maximum.at(most, row, p)
    np.add.at(total, row, p)
    return np.stack([np.ones(n), most, np.log1p(total)], 1)


def _evidence(n1: np.ndarray, n: np.ndarray, share: float) -> np.ndarray:
    """-log10 of the Chernoff bound for ``n1`` of ``n`` documents at ``share``."""
    q = np.clip(n1 / n, 1e-9, 1 - 1e-9)
    kl = q * np.log(q / share) + (1 - q) * np.log((1 - q) / (1 - share))
    return np.where(q > share, n * kl / np.log(10), 0.0)


def fit(docs: DataFrame, labels: DataFrame | None = None, label: str = "toxic", sample_chars: int = SAMPLE_CHARS) -> Model:
    """Train on ``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` (None: a column
    of ``docs``).  Without both labels the model scores every document with the
    share of toxic ones (0 without any)."""
    labels = (docs if labels is None else labels).select(F.col("doc_id").alias("of"), label).where(f"{label} in (0, 1)")
    docs = docs.select("doc_id", "text")
    # lengths, not texts, are joined to find the rates; then only texts that may be drawn
    lengths = docs.select("doc_id", F.length("text").alias("chars"))
    rates = sampling_rates(lengths.join(labels, lengths.doc_id == labels.of), label, sample_chars, 2)
    totals = {r[label]: r["docs"] for r in rates.collect()}
    chosen = stored(labels.withColumnRenamed("of", "doc_id").join(F.broadcast(rates), label).where(drawn())
                    .select(F.col("doc_id").alias("of"), label), "sample")
    texts = with_possible(docs.where("text is not null"), "doc_id", blocks_of(chosen, "of"), "maybe").where("maybe")
    rows = texts.join(chosen, texts.doc_id == chosen.of).select("doc_id", "text", label).orderBy("doc_id", "text").toArrow()
    y = np.array(rows.column(label).to_pylist(), int)
    none = np.empty(0, np.uint64)
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    flat = Model(none, np.empty(0), -20.0, 0.0, 0.0, np.ones((2, 2)), np.array([np.log((prior + 1e-6) / (1 - prior + 1e-6)), 0.0, 0.0]))
    if len(set(y.tolist())) < 2:
        return flat
    column = rows.column("text").combine_chunks()

    def slices():  # a slice at a time, three times over: the driver never holds all features
        for at, raw, offs in text_slices(column):
            yield at, *tokens(raw, offs), len(offs) - 1

    names, n, n1 = none, np.empty(0), np.empty(0)
    for at, row, _, _, feats, _, _ in slices():
        doc = np.repeat(row + at, feats.shape[1])
        each = feats.ravel()
        order = np.lexsort((doc, each))
        each, doc = each[order], doc[order]
        new = each != 0
        new[1:] &= (each[1:] != each[:-1]) | (doc[1:] != doc[:-1])
        each, toxic = each[new], y[doc[new]] == 1
        names, inverse = np.unique(np.concatenate([names, each]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n, np.ones(len(each))]), len(names))
        n1 = np.bincount(inverse, np.concatenate([n1, toxic.astype(float)]), len(names))
    # how much of the sample's feature mass is toxic: what chance would give
    share = float(np.clip(n1.sum() / max(n.sum(), 1), 0.01, 0.99))
    n_least = np.maximum(n, 1)
    features = names[(_evidence(n1, n_least, share) >= MIN_EVIDENCE) & (n1 / n_least >= max(MIN_SHARE, share))]
    del names, n, n1, n_least
    model = Model(features, np.full(len(features), 1.0), -4.0, 0.0, 0.0, np.ones((2, 2)), flat.doc)
    _fit_field(model, ((feats, heads, (y[row + at] == 1)) for at, row, _, _, feats, heads, _ in slices()))
    z, truth = [], []
    for at, row, _, _, feats, heads, n_rows in slices():
        z.append(doc_features(marginals(model, feats, heads), row, n_rows))
        truth.append(y[at:at + n_rows])
    z, truth = np.concatenate(z), np.concatenate(truth)
    # the sample's labels weigh as much as in the table
    weight = np.where(truth == 1, prior / max(1, (truth == 1).sum()), (1 - prior) / max(1, (truth == 0).sum()))
    model.doc = _logistic(z, truth, weight)
    return model


def _fit_field(model: Model, parts) -> None:
    """Gradient ascent on the log-likelihood over lines with a feature, of up to
    ``FIT_TOKENS`` tokens, and as many others, drawn evenly from all parts."""
    rng = np.random.default_rng(3)
    held, many = [], 0

    def drawn_lines():
        ids, tags, size, draw, side = (np.concatenate(x) for x in zip(*held))
        stay = np.ones(len(size), bool)
        for group in (np.flatnonzero(side), np.flatnonzero(~side)):
            order = group[np.argsort(draw[group], kind="stable")]
            stay[order[np.cumsum(size[order]) > FIT_TOKENS]] = False
            stay[order[FIT_LINES:]] = False
        mine = np.repeat(stay, size)
        return ids[mine], tags[mine], size[stay], draw[stay], side[stay]

    for f, h, toxic in parts:
        f = known(model.features, f).astype(np.int32)
        flag = (f >= 0).any(axis=1)
        size = np.diff(np.append(h, len(f)))
        pieces = -(-size // FIT_SEQUENCE)       # long lines are several sequences
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        h = np.repeat(h, pieces) + FIT_SEQUENCE * nth
        size = np.diff(np.append(h, len(f)))
        line = np.repeat(np.arange(len(h)), size)
        has = np.zeros(len(h), bool)
        has[line[flag]] = True
        held.append((f, flag & toxic, size, rng.random(len(h)), has))
        many += len(f)
        if many > 4 * FIT_TOKENS:
            held = [drawn_lines()]
            many = len(held[0][0])
    if not held:
        return
    ids, tags, size, _, _ = drawn_lines()
    tags, heads = tags.astype(float), np.cumsum(size) - size
    if not len(ids):
        return
    flag = (ids >= 0).any(axis=1)
    before, after = neighbours(flag, heads)
    follows = np.ones(len(ids), bool)
    follows[heads] = False
    pos = np.flatnonzero(follows)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[pos - 1].astype(int), tags[pos].astype(int)), 1)
    where, k = np.nonzero(ids >= 0)
    which = ids[where, k]
    theta = np.concatenate([model.weights, [model.bias, 0, 0], np.zeros(4)])
    speed, m = np.zeros(len(theta)), len(model.weights)
    for _ in range(STEPS):
        model.weights, (model.bias, model.before, model.after) = theta[:m], theta[m:m + 3]
        model.trans = np.exp(theta[m + 3:]).reshape(2, 2)
        e, _ = emit(model, ids, heads)
        x = np.exp(np.clip(e, -20, 20))
        f, b = messages(x, model.trans, heads)
        p = f * b / (1 + f * b)
        gap = tags - p
        grad = np.zeros(len(theta))
        grad[:m] = np.bincount(which, weights=gap[where], minlength=m)
        grad[m:m + 3] = gap.sum(), gap @ before, gap @ after
        y = x[pos] * b[pos]
        joint = np.stack([model.trans[0, 0] + 0 * y, model.trans[0, 1] * y, f[pos - 1] * model.trans[1, 0], f[pos - 1] * model.trans[1, 1] * y])
        grad[m + 3:] = seen.ravel() - (joint / joint.sum(axis=0)).sum(axis=1)
        grad = grad / len(heads) - L2 * theta
        speed += grad * grad
        theta = theta + RATE * grad / (np.sqrt(speed) + 1e-8)
    model.weights, (model.bias, model.before, model.after) = theta[:m], map(float, theta[m:m + 3])
    model.trans = np.exp(theta[m + 3:]).reshape(2, 2)


def _logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's method with a small ridge."""
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (weight * (y - p)) - 1e-4 * w
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", spans: str | None = "toxic_spans") -> DataFrame:
    """``docs`` with the score (0 to 1) and, if named, the offending spans
    ``array<struct<start, end, p>>`` in code points, end exclusive.

    A null or empty text has no tokens and gets the score of no evidence.  Rows
    are scored one by one, whole.  A new name that is a column of ``docs`` raises.
    """
    no_clash(docs, name, spans)
    bound_batches(docs.sparkSession)
    # plain values, since workers need not know the class
    sent = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias, model.before, model.after, model.trans, model.doc))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            scores, found = [], []
            for _, raw, offs in text_slices(batch.column(text)):
                row, start, end, feats, heads = tokens(raw, offs)
                n = len(offs) - 1
                p = marginals(m, feats, heads)
                scores.append(1 / (1 + np.exp(-np.clip(doc_features(p, row, n) @ m.doc, -30, 30))))
                if spans:
                    here: list[list] = [[] for _ in range(n)]
                    hits = np.flatnonzero(p >= 0.5)
                    # code points: bytes that do not continue a character
                    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                    for i in hits.tolist():
                        r = row[i]
                        base = points[offs[r]]
                        here[r].append({"start": int(points[start[i]] - base), "end": int(points[end[i]] - base), "p": float(p[i])})
                    found += here
            cols = [*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            names = [*batch.schema.names, name]
            if spans:
                cols.append(pa.array(found, span))
                names.append(spans)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    added = T.StructType().add(name, T.DoubleType())
    if spans:
        added = added.add(spans, T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("p", "double")))
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added.fields))
