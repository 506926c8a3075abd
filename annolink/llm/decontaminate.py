"""Benchmark decontamination by a distributed positional inverted index.

1. Test items become windows of consecutive words; every window names its two
   rarest terms by their counts in the corpus (a window with a term the corpus
   lacks cannot occur and is dropped).
2. The index stores, for those anchor terms, one posting list of positions per
   document and term, besides each document's length.
3. The list of the rarest term, shifted by its offset in the window, is
   intersected with the shifted list of the second: what remains are documents
   and places where the window may stand.
4. Those documents are read once more; the whole window is compared there.
   Proximity matches are the survivors of step 3: both anchors at their exact
   distance, whatever stands between.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from annolink.llm.bloom import blocks_of, with_possible
from annolink.llm.common import arrow_schema, by_value, byte_class, gram_hash, stored, text_slices, words_of

by_value(__name__)

WINDOW = 13
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] on UTF-8 bytes (every byte of a non-ASCII character is 0x80 or more)
WORD = byte_class(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: A term set up to this many terms (8 bytes each) is sent to the workers to
#: filter there; a larger one is joined after the shuffle instead.
MAX_SENT_TERMS = 1_000_000

_TERMS = "item long, n int, terms array<long>"
_WINS = arrow_schema(item=pa.int64(), w=pa.int32(), n=pa.int32(), phrase=pa.int64(), terms=pa.list_(pa.int64()))


def _rows(column):
    """By slice of a column: its first row, each word's row and hash, the number of rows."""
    for at, raw, offs in text_slices(column):
        row, _, _, h = words_of(raw, offs, WORD)
        yield at, row, h, len(offs) - 1


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(0).to_pylist()
            for at, row, h, n in _rows(batch.column(1)):
                cuts = np.searchsorted(row, np.arange(n + 1))
                out = [[], [], [], [], []]
                for i in range(n):
                    t = h[cuts[i]:cuts[i + 1]]
                    size = min(window, len(t))
                    if not size:
                        continue
                    for w, g in enumerate(gram_hash(t, size).view(np.int64).tolist()):
                        for col, v in zip(out, (items[at + i], w, size, g, t[w:w + size].view(np.int64).tolist())):
                            col.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _WINS)], schema=_WINS)
    return run


def _counts(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if sent is None else sent.value
        for batch in batches:
            for _, _, h, _ in _rows(batch.column(0)):
                if keep is not None:
                    at = np.searchsorted(keep, h)
                    at[at == len(keep)] = 0
                    at = at[keep[at] == h]
                    n = np.bincount(at, minlength=len(keep))
                    some = np.flatnonzero(n)
                    terms, n = keep[some], n[some]
                else:
                    terms, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n.astype(np.int64))],
                                                 names=["term", "n"])
    return run


def _postings(sent):
    """Rows ``dkey, doc_id, term, positions`` and, with a null term, ``n_words``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if sent is None else sent.value
        for batch in batches:
            dkeys, ids = batch.column(0), batch.column(1)
            for at, row, h, n in _rows(batch.column(2)):
                first = np.searchsorted(row, np.arange(n + 1))
                pos = np.arange(len(h)) - first[row]
                n_words = np.diff(first)
                if keep is not None and len(h):
                    got = np.searchsorted(keep, h)
                    got[got == len(keep)] = 0
                    hit = keep[got] == h
                    row, h, pos = row[hit], h[hit], pos[hit]
                order = np.lexsort((pos, h, row))
                row, h, pos = row[order], h[order], pos[order]
                new = np.ones(len(h), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                heads = np.flatnonzero(new)
                doc = np.concatenate([row[heads], np.arange(n)]) + at
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([heads, np.full(n + 1, len(h))]).astype(np.int32)), pa.array(pos.astype(np.int32)))
                of = np.concatenate([np.zeros(len(heads), bool), np.ones(n, bool)])
                term = np.concatenate([h[heads].view(np.int64), np.zeros(n, np.int64)])
                words = np.concatenate([np.zeros(len(heads), np.int64), n_words])
                yield pa.RecordBatch.from_arrays(
                    [dkeys.take(pa.array(doc)), ids.take(pa.array(doc)), pa.array(term, mask=of), lists,
                     pa.array(words, mask=~of)], names=["dkey", "doc_id", "term", "positions", "n_words"])
    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``dkey, doc_id, text, found``; ``found`` lists (item, start, n, phrase)
    to compare.  Returns the covered words, the items with a true match and all
    items of ``found``."""
    for batch in batches:
        found = batch.column(3).to_pylist()
        n_hit, items, near = [], [], []
        for at, row, h, n in _rows(batch.column(2)):
            first = np.searchsorted(row, np.arange(n + 1))
            for i in range(n):
                t = h[first[i]:first[i + 1]]
                places = np.array([(f["item"], f["start"], f["n"], f["phrase"]) for f in found[at + i]], np.int64)
                good = np.zeros(len(places), bool)
                for size in np.unique(places[:, 2]).tolist():
                    g = gram_hash(t, size).view(np.int64)
                    mine = np.flatnonzero((places[:, 2] == size) & (places[:, 1] >= 0) & (places[:, 1] < len(g)))
                    good[mine] = g[places[mine, 1]] == places[mine, 3]
                cover = np.zeros(len(t) + 1, np.int64)
                np.add.at(cover, places[good, 1], 1)
                np.add.at(cover, places[good, 1] + places[good, 2], -1)
                n_hit.append(int((np.cumsum(cover) > 0).sum()))
                items.append(np.unique(places[good, 0]).tolist())
                near.append(np.unique(places[:, 0]).tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.int64())),
             pa.array(near, pa.list_(pa.int64()))], names=["dkey", "doc_id", "n_hit", "items", "near"])


def _send(terms: DataFrame):
    """The distinct ``term`` values as a sorted broadcast array, or None above the bound."""
    got = terms.select("term").distinct().limit(MAX_SENT_TERMS + 1).toArrow().column(0).to_numpy()
    if len(got) > MAX_SENT_TERMS:
        return None
    return terms.sparkSession.sparkContext.broadcast(np.sort(got.view(np.uint64)) if len(got) else np.zeros(1, np.uint64))


def keyed(docs: DataFrame) -> DataFrame:
    """``dkey, doc_id, text``: equal rows share a key, so repeated or null ids need no care."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.select(F.xxhash64("doc_id", "text").alias("dkey"), "doc_id", "text")


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The positional index: postings of ``terms`` (all terms if None) and lengths."""
    sent = None if terms is None else _send(terms)
    index = keyed(docs).mapInArrow(
        _postings(sent), "dkey long, doc_id long, term long, positions array<int>, n_words long")
    if terms is not None and sent is None:
        lengths = index.where("term is null")
        index = index.where("term is not null").join(terms.select("term").distinct(), "term", "left_semi") \
            .select("dkey", "doc_id", "term", "positions", "n_words").unionByName(lengths)
    return stored(index, "postings")


def anchored_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows that can occur, grouped by their two rarest terms: ``item, t0, p0,
    t1, p1, wins`` with term, place in the item, and ``(w, n, phrase)`` of each window."""
    # repeated items, and texts of one item that agree somewhere, give a window once
    wins = stored(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null")
                  .mapInArrow(_windows(window), "item long, w int, n int, phrase long, terms array<long>")
                  .dropDuplicates(["item", "w", "n", "phrase"]), "windows")
    terms = wins.select(F.explode("terms").alias("term")).distinct()
    counts = docs.select(F.col("text").cast("string")).mapInArrow(_counts(_send(terms)), "term long, n long") \
        .groupBy("term").agg(F.sum("n").alias("in_corpus"))
    # the terms' counts, kept only for terms of the windows, are as many as those terms
    each = wins.select("item", "w", "n", "phrase", F.posexplode("terms").alias("o", "term"))
    per = Window.partitionBy("item", "w", "n", "phrase")
    ranked = (each.join(counts, "term")
              .withColumn("known", F.count("*").over(per))
              .withColumn("rank", F.row_number().over(per.orderBy("in_corpus", "term", "o")))
              .where("known = n and rank <= 2"))
    place = F.col("w") + F.col("o")
    pair = ranked.groupBy("item", "w", "n", "phrase").agg(
        F.max(F.when(F.col("rank") == 1, F.struct("term", place.alias("p")))).alias("a"),
        F.max(F.when(F.col("rank") == 2, F.struct("term", place.alias("p")))).alias("b"))
    b = F.coalesce("b", "a")  # a window of one word has one term only
    return stored(pair.groupBy("item", F.col("a.term").alias("t0"), F.col("a.p").alias("p0"),
                               b["term"].alias("t1"), b["p"].alias("p1"))
                  .agg(F.collect_list(F.struct("w", "n", "phrase")).alias("wins")), "anchors")


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, items`` (ids of the items
    that occur) and ``near`` (items whose two rarest terms of some window stand at
    their distance: the proximity matches); both null where nothing was found.

    A null text has no words.  Items without an id or without words match nothing.
    Repeated rows are judged one by one; repeated items count once, and an item_id
    on several texts stands for the windows of all of them.  Other columns are ignored.
    """
    anchors = anchored_windows(docs, items, window)
    terms = anchors.select(F.col("t0").alias("term")).union(anchors.select("t1"))
    index = build_index(docs, terms)
    lists = index.where("term is not null").select("dkey", "doc_id", "term", "positions")
    first = (lists.withColumnRenamed("term", "t0").join(anchors, "t0")
             .select("dkey", "doc_id", "item", "t1", "wins",
                     F.explode(F.transform("positions", lambda p: p - F.col("p0"))).alias("at"), "p1"))
    others = lists.dropDuplicates(["dkey", "term"]).select(
        "dkey", F.col("doc_id").alias("other_id"), F.col("term").alias("t1"), F.col("positions").alias("others"))
    both = first.join(others, ["dkey", "t1"]).where(
        F.col("doc_id").eqNullSafe(F.col("other_id")) & F.array_contains("others", F.col("at") + F.col("p1")))
    found = stored(
        both.select("dkey", F.col("doc_id").alias("found_id"), F.transform("wins", lambda x: F.struct(
            F.col("item").alias("item"), (F.col("at") + x["w"]).alias("start"), x["n"].alias("n"),
            x["phrase"].alias("phrase"))).alias("places"))
        .groupBy("dkey", "found_id").agg(F.flatten(F.collect_set("places")).alias("found")), "found")
    same = lambda a, b: (a.dkey == b.dkey) & a.doc_id.eqNullSafe(b.found_id)
    # only texts that may be among the found ones go into the shuffle
    texts = with_possible(keyed(docs), "dkey", blocks_of(found, "dkey"), "maybe").where("maybe")
    checked = (texts.join(found, same(texts, found)).select(texts.dkey, "doc_id", "text", "found")
               .mapInArrow(_verify, "dkey long, found_id long, n_hit long, items array<long>, near array<long>")
               .dropDuplicates(["dkey"]))
    lengths = index.where("term is null").select("dkey", "doc_id", "n_words")
    return lengths.join(checked, same(lengths, checked), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items", "near")
