"""Fuzzy line dedup by MinHash.

Lines (A-Z folded, blank ones aside) are sets of byte shingles of their UTF-8
text.  Equal lines form one class by a 128-bit hash.  Classes get MinHash signatures; bands
of ``ROWS`` values bring likely pairs together, each member of a band's bucket
with the bucket's pivot, so a bucket of n lines makes n pairs.  The exact
Jaccard similarity decides, union-find joins the links.  A second round compares
all that one bucket still holds of different components, in groups of at most
two blocks, pruned by size, bitmap and the links found meanwhile: every pair that
shares a bucket is verified or in one component.  Each component keeps its first
line, by doc_id and line number.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from annolink.llm.bloom import blocks_of, with_possible
from annolink.llm.common import (LOWER_AZ, arrow_schema, by_value, mix64, prefix_sums, runs_hash, span_hash, stored,
                                 sums_hash, text_slices, unused)
from annolink.llm.components import components
from annolink.llm.jaccard import _bitmaps, _overlap_enough

by_value(__name__)

SHINGLE, PERCENT = 8, 80
#: Twelve bands of five: a pair at 0.8 is found with 99.1 %, at 0.85 with 99.9 %.
BANDS, ROWS = 12, 5
#: Text signed at once: the shingles' arrays stay in the processor's cache.
CACHED_BYTES = 1 << 17
#: Most members and bytes of a block, on average; up to ``LEAF`` members are compared without bitmaps.
BLOCK, BLOCK_BYTES, LEAF = 2048, 1 << 24, 16
#: Shingle sets kept while a group is compared, in bytes of their texts.
KEPT_BYTES = 1 << 20


def split_lines(raw: bytes, offsets: np.ndarray):
    """Non-blank lines of a slice: row, number in the row, byte start and end, two
    hashes; the folded bytes and their prefix sums."""
    folded = raw.translate(LOWER_AZ)
    data = np.frombuffer(folded, np.uint8)
    feeds = np.flatnonzero(data == 10)
    # a line begins with its row or behind a feed, and ends with its row or before one
    start, end = np.sort(np.concatenate([offsets[:-1], feeds + 1])), np.sort(np.concatenate([offsets[1:], feeds]))
    some = start < end
    start, end = start[some], end[some]
    if len(start):  # only feeds lie between one line and the next
        some = np.maximum.reduceat(data, start) > 0x20
        start, end = start[some], end[some]
    row = np.searchsorted(offsets, start, "right") - 1
    number = np.searchsorted(feeds, start) - np.searchsorted(feeds, offsets[row])
    sums = prefix_sums(folded)
    return row, number, start, end, sums_hash(sums, start, end), span_hash(folded, start, end, 1), folded, sums


def shingle_hashes(folded: bytes, start: np.ndarray, end: np.ndarray, shingle: int, sums: np.ndarray | None = None):
    """The hash of every shingle, line by line (in their order in ``folded``); the
    number of each line's and where they begin."""
    sums = prefix_sums(folded) if sums is None else sums
    count = np.maximum(end - start - shingle + 1, 1)
    first = np.cumsum(count) - count
    # a line shorter than a shingle is one shingle
    short = np.flatnonzero(end - start < shingle)
    long = np.ones(len(start), bool)
    long[short] = False
    edge = np.zeros(len(folded) + 1, np.int8)
    edge[start[long]] = 1
    edge[(start + count)[long]] -= 1
    inner = runs_hash(sums, shingle)
    inner = inner[np.cumsum(edge[:len(inner)], dtype=np.int8).astype(bool)]
    if not len(short):
        return inner, count, first
    out = np.empty(int(count.sum()), np.uint64)
    whole = np.zeros(len(out), bool)
    whole[first[short]] = True
    out[whole] = sums_hash(sums, start[short], end[short])
    out[~whole] = inner
    return out, count, first


def band_keys(folded: bytes, start: np.ndarray, end: np.ndarray, shingle: int, bands: int, rows: int,
              sums: np.ndarray | None = None) -> np.ndarray:
    """(lines, bands): one 64-bit key per band of the MinHash signature."""
    g, _, first = shingle_hashes(folded, start, end, shingle, sums)
    g = (g >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(41)
    flips = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    odd = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    keys, mixed = np.empty((len(start), bands), np.uint64), np.empty_like(g)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(start), b + 1, np.uint64)
            for r in range(b * rows, (b + 1) * rows):
                np.bitwise_xor(g, flips[r], out=mixed)
                np.multiply(mixed, odd[r], out=mixed)
                low = np.minimum.reduceat(mixed, first) if len(first) else np.empty(0, np.uint32)
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low)
            keys[:, b] = key
    return keys


_SIGNED = arrow_schema(doc=pa.int64(), line=pa.int32(), h1=pa.int64(), h2=pa.int64(), size=pa.int32(), bands=pa.list_(pa.int64()))
_PLACES = "doc long, line int, h1 long, h2 long, size int"


def _lines(signed: bool, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, raw, offs in text_slices(batch.column(1), CACHED_BYTES):
                row, number, start, end, h1, h2, folded, sums = split_lines(raw, offs)
                cols = [batch.column(0).take(pa.array(row + at)), pa.array(number.astype(np.int32)), pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)), pa.array((end - start).astype(np.int32))]
                if signed:
                    keys = band_keys(folded, start, end, shingle, bands, rows, sums)
                    cols.append(pa.ListArray.from_arrays(pa.array((np.arange(len(row) + 1) * bands).astype(np.int32)),
                                                         pa.array(keys.ravel().view(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, names=_SIGNED.names[:len(cols)])
    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``text, wanted`` (line numbers and class ids) -> ``cid, line`` bytes."""
    for batch in batches:
        cids, out = [], []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = (text or "").encode().translate(LOWER_AZ).split(b"\n")
            for w in wanted:
                if w["line"] < len(lines):
                    cids.append(w["cid"])
                    out.append(lines[w["line"]])
        yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(out, pa.binary())], names=["cid", "text"])


def _grams(t: bytes, shingle: int) -> set[bytes]:
    return {t[i:i + shingle] for i in range(max(1, len(t) - shingle + 1))}


def _alike(left: set, right: set, percent: int) -> bool:
    common = len(left & right)
    return 100 * common >= percent * (len(left) + len(right) - common)


def _similar(shingle: int, percent: int):
    """Rows ``a, b, ta, tb`` -> the pairs whose shingle sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            good = np.zeros(len(a), bool)
            for i in range(len(a)):
                if a[i] != last:
                    last, left = a[i], _grams(ta[i], shingle)
                good[i] = _alike(left, _grams(tb[i], shingle), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    return run


def _sketches(texts: list[bytes], shingle: int):
    """Number and bitmap of each text's distinct shingles."""
    ends = np.cumsum([len(t) for t in texts])
    sizes, bits, at = [], [], 0
    while at < len(texts):
        base = int(ends[at]) - len(texts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + CACHED_BYTES, "right")))
        end = ends[at:to] - base
        g, count, _ = shingle_hashes(b"".join(texts[at:to]), np.append(0, end[:-1]), end, shingle)
        row = np.repeat(np.arange(to - at), count)
        order = np.lexsort((g, row))
        row, g = row[order], g[order]
        new = np.ones(len(g), bool)
        new[1:] = (row[1:] != row[:-1]) | (g[1:] != g[:-1])
        sizes.append(np.bincount(row[new], minlength=to - at))
        bits.append(_bitmaps(row[new], g[new], to - at))
        at = to
    return np.concatenate(sizes), np.concatenate(bits)


def group_links(cid: list, comp: list, side: list, texts: list[bytes], across: bool, shingle: int, percent: int):
    """Links that join the components of one group's members as far as similar
    pairs (``across``: of different sides) do; at most one fewer than members."""
    if len(cid) <= LEAF:
        grams, label = [_grams(t, shingle) for t in texts], list(comp)
        for i in range(len(cid)):
            for j in range(i):
                if label[i] != label[j] and (not across or side[i] != side[j]) and _alike(grams[i], grams[j], percent):
                    yield cid[j], cid[i]
                    was = label[j]
                    label = [label[i] if x == was else x for x in label]
        return
    n, bits = _sketches(texts, shingle)
    order = np.argsort(n, kind="stable")
    n, bits = n[order], bits[order]
    label, side = np.unique(comp, return_inverse=True)[1][order], np.array(side)[order]
    excess = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    upto = np.searchsorted(percent * n, 100 * n, "right")
    kept, held = {}, 0
    for i in range(len(n)):
        js = i + 1 + np.flatnonzero(label[i + 1:upto[i]] != label[i])
        if across:
            js = js[side[js] != side[i]]
        if len(js):
            js = js[_overlap_enough(bits[js], bits[i], np.minimum(excess[js], excess[i]), n[js] + n[i], percent)]
        mine = None
        while len(js):
            j, js = js[0], js[1:]
            if mine is None:
                mine = _grams(texts[order[i]], shingle)
            if j not in kept:
                if held > KEPT_BYTES:
                    kept, held = {}, 0
                kept[j] = _grams(texts[order[j]], shingle)
                held += len(texts[order[j]])
            if _alike(mine, kept[j], percent):
                yield cid[order[i]], cid[order[j]]
                label[label == label[j]] = label[i]
                js = js[label[js] != label[i]]


def _grouped(shingle: int, percent: int):
    """Rows ``key, lo, hi, cid, comp, side, text`` sorted by the first three -> links ``a, b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links():
            links = list(group_links(*zip(*members), of[1] != of[2], shingle, percent))
            return pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], pa.int64()),
                                               pa.array([max(x) for x in links], pa.int64())], names=["a", "b"])

        of, members = None, []
        for batch in batches:
            for key, lo, hi, *member in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, lo, hi) != of:
                    if len(members) > 1:
                        yield links()
                    of, members = (key, lo, hi), []
                members.append(member)
        if len(members) > 1:
            yield links()
    return run


def _line_texts(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``cid, text``: the folded bytes of the line classes ``ids``."""
    wanted = stored(classes.join(ids, "cid").groupBy(F.col("doc").alias("of"))
                    .agg(F.collect_list(F.struct("line", "cid")).alias("wanted")), "wanted")
    texts = with_possible(docs, "doc_id", blocks_of(wanted, "of"), "maybe").where("maybe")
    return stored(texts.join(wanted, texts.doc_id == wanted.of).select("text", "wanted")
                  .mapInArrow(_texts, "cid long, text binary").dropDuplicates(["cid"]), "line-texts")


def _links(pairs: DataFrame, lines: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of line classes that are as similar as asked."""
    both = (pairs.join(lines.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
            .join(lines.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb"))
    return stored(both.mapInArrow(_similar(shingle, percent), "a long, b long"), "line-links")


def _links_apart(members: DataFrame, parts: DataFrame, places: DataFrame, lines: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``a, b`` between what a bucket holds of different components, pivots
    aside (all their pairs are verified).  A large bucket's largest component and
    its other members are dealt into blocks; each block of the others meets every
    block, so the largest component's own pairs are never made."""
    rest = (members.where("cid <> pivot").join(parts.withColumnRenamed("node", "cid"), "cid", "left")
            .select("key", "cid", F.coalesce("component", "cid").alias("comp")))
    mixed = (rest.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key")
             .agg(F.max(F.struct("n", "comp")).alias("most"), F.count("*").alias("comps"))
             .where("comps > 1").select("key", F.col("most.comp").alias("main")))
    rows = stored(rest.join(mixed, "key").join(places.select("cid", "size"), "cid")
                  .select("key", "cid", "comp", "size", (F.col("comp") == F.col("main")).alias("main")), "apart")
    blocks = lambda of: F.greatest(F.ceil(F.count(of) / BLOCK), F.ceil(F.sum(of) / BLOCK_BYTES))
    dealt = (rows.groupBy("key").agg(blocks(F.col("size")).alias("all"), blocks(F.expr("if(main, size, null)")).alias("a"),
                                     blocks(F.expr("if(main, null, size)")).alias("b"))
             .select("key", F.expr("if(all > 1, a, 0)").alias("a"), F.expr("if(all > 1, b, 1)").alias("b")))
    own = F.col("main") & (F.col("a") > 0)
    hashed = F.xxhash64(F.lit(5), "cid")
    group = ["key", "lo", "hi"]
    return stored(
        rows.join(dealt, "key").join(lines, "cid")
        .withColumn("side", F.when(own, F.col("b") + F.pmod(hashed, F.col("a"))).otherwise(F.pmod(hashed, F.col("b"))))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(own, F.col("b") - 1).otherwise(F.col("a") + F.col("b") - 1))))
        .select("key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "cid", "comp", "side", "text")
        .repartition(*group).sortWithinPartitions(*group).mapInArrow(_grouped(shingle, percent), "a long, b long"), "links-apart")


def _pair(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def dropped_lines(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                  rows: int = ROWS) -> DataFrame:
    """``doc_id, dropped``: the numbers (from 0) of each document's lines that an
    earlier line stands for; documents that keep all lines have no row.

    Blank lines are never dropped; null and empty texts have no lines.  Rows of
    one doc_id are one document and should have one text.  Rows without a
    doc_id come after all others and share the fate of one document.
    """
    last = (1 << 63) - 1
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(last)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = docs.mapInArrow(_lines(True, shingle, bands, rows), _PLACES + ", bands array<long>")
    classes = stored(signed.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "line", "size", "bands")).alias("one"), F.count("*").alias("copies"))
        .select("h1", "h2", "copies", F.col("one.doc").alias("doc"), F.col("one.line").alias("line"),
                F.col("one.size").alias("size"), F.col("one.bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id()), "line-classes")
    places = classes.drop("bands")
    # a bucket's key tells its band too
    buckets = classes.select("cid", F.explode("bands").alias("key"))
    pivots = buckets.groupBy("key").agg(F.min("cid").alias("pivot"), F.max("cid").alias("most")) \
        .where("pivot <> most").select("key", "pivot")
    members = stored(buckets.join(pivots, "key").select("key", "cid", "pivot"), "buckets")
    near = stored(members.where("cid <> pivot").select(*_pair(F.col("pivot"), F.col("cid"))).distinct(), "line-pairs")
    ids = near.select(F.col("a").alias("cid")).union(near.select("b")).distinct()
    texts = _line_texts(ids, places, docs)
    parts = components(_links(near, texts, shingle, percent))
    second = _links_apart(members, parts, places, texts, shingle, percent)
    linked = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second))

    named = places.join(linked.withColumnRenamed("node", "cid"), "cid", "left")
    keep = named.where("component is not null").groupBy("component").agg(F.min(F.struct("doc", "line")).alias("keep"))
    affected = stored(
        named.where("component is not null").join(keep, "component").select("h1", "h2", "keep")
        .union(named.where("component is null and copies > 1").select("h1", "h2", F.struct("doc", "line"))), "affected")
    every = docs.mapInArrow(_lines(False), _PLACES).select("doc", "line", "h1", "h2")
    gone = every.join(affected, ["h1", "h2"]).where("doc <> keep.doc or line <> keep.line")
    out = gone.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("dropped"))
    return out.select(F.when(F.col("doc") != last, F.col("doc")).alias("doc_id"), "dropped")


def dedup_lines(docs: DataFrame, drop_emptied: bool = True, **parameters) -> DataFrame:
    """``docs`` (any columns besides doc_id and text) with the dropped lines cut
    from the texts.  Documents of which no line but blank ones is left go, unless
    ``drop_emptied`` is off."""
    gone = dropped_lines(docs, **parameters)
    mark, of = unused(docs, "dropped"), unused(docs, "dropped_of")
    gone = gone.select(F.col("doc_id").alias(of), F.col("dropped").alias(mark))
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[of]), "left").select(*[docs[c] for c in docs.columns], mark)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, cuts = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
            keep = np.ones(len(texts), bool)
            for i, cut in enumerate(cuts):
                if cut:
                    cut = set(cut)
                    left = [x for k, x in enumerate((texts[i] or "").split("\n")) if k not in cut]
                    keep[i] = not drop_emptied or any(x.strip() for x in left)
                    texts[i] = "\n".join(left)
            cols = [pa.array(texts, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep))

    return joined.mapInArrow(run, docs.schema)
