"""N-gram Jaccard self-join of documents by signature trees.

A document is its set of word shingles.  Equal sets form one class.  The join
brings classes together that share one of their first shingles (any two
sets as similar as asked share one of the first ``n - ceil(s n) + 1`` of any one
order; here the rarest come first), within neighbouring size bands; the pairs of a group count one for each hash shared, and as
many as similar sets must share are asked for.  In a group a signature tree is built: leaves
hold the members' token bitmaps, inner nodes their OR, the range of sizes and the
largest number of tokens that share a bit.  A dual traversal drops pairs of
nodes whose largest possible overlap is too small, or whose members are linked
already; bitmaps of the first shingles tell pairs that can't share enough of them.  A task
adds up what its groups tell of a pair; bitmaps as long as their sets then leave few
dissimilar pairs, and these are compared exactly.

Links inside large groups are first looked for along chains of likely
neighbours and around the member that shares most, so a group of near copies is one component before the trees see it
and its pairs are never made.  Groups over ``BLOCK`` members are dealt out as
pairs of blocks.
"""

from __future__ import annotations

from math import log
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from annolink.llm.bloom import blocks_of, with_possible
from annolink.llm.common import arrow_schema, by_value, byte_class, gram_hash, mix64, stored, text_slices, words_of
from annolink.llm.components import components

by_value(__name__)

#: [^\x20\x09-\x0D]
WORD = byte_class(r"[^\x20\x09-\x0D]")
SHINGLE, PERCENT = 3, 90
BITMAP_WORDS = 16       # 1024 bits a document in the trees
TOKEN_BITS = 2          # bits a shingle, at least, of a document's whole bitmap
CHAIN_TOKENS = 2        # shared shingles of a class that are chained first
SALT_ROWS = 4096        # longest chain
BLOCK, LEAF, FAN = 2048, 16, 8
HELD_PAIRS = 1 << 18    # pairs a task holds to add up their hashes

#: How often shingles occur is counted by this many bits of their hash.
FREQUENCY_BITS = 22
#: A task reports the counts that exceed the average by this factor.
COMMON = 4

_SKETCH = arrow_schema(doc_id=pa.int64(), n=pa.int64(), f1=pa.int64(), f2=pa.int64(),
                       prefix=pa.list_(pa.int64()), bits=pa.list_(pa.int64()), marks=pa.list_(pa.int64()))


def shingle_sets(raw: bytes, offsets: np.ndarray, k: int):
    """Row and hash of every distinct shingle of a slice, sorted by row, then hash."""
    row, _, _, h = words_of(raw, offsets, WORD)
    n_rows = len(offsets) - 1
    count = np.bincount(row, minlength=n_rows)
    g = gram_hash(h, k)
    inside = row[:len(g)] == row[k - 1:] if len(g) else np.empty(0, bool)
    rows, grams = [row[:len(g)][inside]], [g[inside]]
    first = np.cumsum(count) - count
    for short in range(1, k):
        at = np.flatnonzero(count == short)
        if len(at):
            rows.append(at)
            grams.append(np.concatenate([gram_hash(h[first[i]:first[i] + short], short) for i in at]))
    rows, grams = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows[new], grams[new]


def _prints(rows: np.ndarray, grams: np.ndarray, n_rows: int):
    """Size and two independent sums of each row's set."""
    n = np.bincount(rows, minlength=n_rows)
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        with np.errstate(over="ignore"):
            acc = np.concatenate([[np.uint64(0)], np.cumsum(mix64(grams ^ np.uint64(salt)), dtype=np.uint64)])
            ends = np.cumsum(n)
            sums.append(acc[ends] - acc[ends - n])
    return n, *sums


def _bitmaps(rows: np.ndarray, grams: np.ndarray, n_rows: int) -> np.ndarray:
    out = np.zeros((n_rows, BITMAP_WORDS), np.uint64)
    bit = (grams >> np.uint64(11)) % np.uint64(64 * BITMAP_WORDS)
    np.bitwise_or.at(out, (rows, (bit >> np.uint64(6)).astype(int)), np.uint64(1) << (bit & np.uint64(63)))
    return out


def _long_bitmaps(rows: np.ndarray, grams: np.ndarray, n: np.ndarray):
    """Bitmaps of ``BITMAP_WORDS`` words, doubled until they have ``TOKEN_BITS`` bits a
    token, one after the other, and where they begin.  Folded they are the short ones."""
    chunks = np.maximum(1, -(-TOKEN_BITS * n // (64 * BITMAP_WORDS)))
    words = BITMAP_WORDS << np.ceil(np.log2(chunks)).astype(np.int64)
    at = np.append(0, np.cumsum(words))
    out = np.zeros(at[-1], np.uint64)
    bit = (grams >> np.uint64(11)) % (64 * words[rows]).astype(np.uint64)
    np.bitwise_or.at(out, at[rows] + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out, at


def _counted(k: int):
    """Texts -> ``bucket, n``: hash buckets of shingles that are common in this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shift = np.zeros(1 << FREQUENCY_BITS, np.uint32), np.uint64(64 - FREQUENCY_BITS)
        for batch in batches:
            for _, raw, offs in text_slices(batch.column(0)):
                row, _, _, h = words_of(raw, offs, WORD)
                g = gram_hash(h, k)
                if len(g):
                    np.add.at(table, (g[row[:len(g)] == row[k - 1:]] >> shift).astype(np.int64), 1)
        common = np.flatnonzero(table > COMMON * (1 + table.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(common.astype(np.int32)), pa.array(table[common].astype(np.int64))], names=["bucket", "n"])
    return run


def common_buckets(docs: DataFrame, k: int) -> np.ndarray:
    """Eight steps of commonness for each doubling, by hash bucket; 0 where nothing was
    reported.  At most 2^FREQUENCY_BITS counts come to the driver, whatever the corpus.
    They only order shingles: which pairs are found doesn't depend on them."""
    counts = docs.select("text").mapInArrow(_counted(k), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << FREQUENCY_BITS, np.uint8)
    out[counts["bucket"].to_numpy(np.int64)] = np.minimum(255, 1 + 8 * np.log2(counts["n"].to_numpy(np.float64))).astype(np.uint8)
    return out


def _sketch(k: int, percent: int, common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - FREQUENCY_BITS)
        for batch in batches:
            for at, raw, offs in text_slices(batch.column(1)):
                size = len(offs) - 1
                rows, grams = shingle_sets(raw, offs, k)
                n, f1, f2 = _prints(rows, grams, size)
                keep = prefix_size(n, percent)
                bits, ends = _long_bitmaps(rows, grams, n)
                # each row's shingles from the rarest on, ties by hash
                order = np.argsort(rows * 256 + common.value[(grams >> shift).astype(np.int64)], kind="stable")
                grams = grams[order]
                place = np.arange(len(rows)) - (np.cumsum(n) - n)[rows]
                short = place < keep[rows]
                held = np.bincount(rows[short], minlength=size)
                marks = _bitmaps(rows[short], grams[short], size)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, size), pa.array(n.astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held)).astype(np.int32)), pa.array(grams[short].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bits.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array((np.arange(size + 1) * BITMAP_WORDS).astype(np.int32)), pa.array(marks.ravel().view(np.int64)))],
                    schema=_SKETCH)
    return run


def _sets(k: int):
    """Rows ``cid, n, f1, f2, text`` -> ``cid, tokens`` where the text has that set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]
            for at, raw, offs in text_slices(batch.column(4)):
                size = len(offs) - 1
                rows, grams = shingle_sets(raw, offs, k)
                n, f1, f2 = _prints(rows, grams, size)
                same = (n == want[0][at:at + size]) & (f1.view(np.int64) == want[1][at:at + size]) & (f2.view(np.int64) == want[2][at:at + size])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, size), lists], names=["cid", "tokens"]).filter(pa.array(same))
    return run


# ------------------------------------------------------------ signature trees

class _Tree:
    """Levels of nodes over sorted members: OR of the bitmaps, range of sizes,
    most tokens without a bit of their own, the component if there is only one."""

    def __init__(self, n, bits, comp):
        excess = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = []
        step = LEAF
        while True:
            cut = np.arange(0, len(n), step)
            low, high = np.minimum.reduceat(comp, cut), np.maximum.reduceat(comp, cut)
            self.levels.append((np.bitwise_or.reduceat(bits, cut, axis=0), np.minimum.reduceat(n, cut), np.maximum.reduceat(n, cut),
                                np.maximum.reduceat(excess, cut), np.where(low == high, low, -1)))
            if len(cut) == 1:
                break
            step *= FAN
        self.n, self.bits, self.comp, self.excess = n, bits, comp, excess


def _most_common(bits_a, bits_b, excess):
    return excess + np.bitwise_count(bits_a & bits_b).sum(axis=-1).astype(np.int64)


def _overlap_enough(bits_a, bits_b, excess, least, percent):
    """Can sets below two nodes overlap enough? ``least``: sum of the least sizes."""
    return (100 + percent) * _most_common(bits_a, bits_b, excess) >= percent * least


def prefix_size(n, percent: int):
    """How many first shingles of a set of ``n`` are looked at."""
    return n - -(-percent * n // 100) + 1


def least_shared(a, b, percent: int):
    """First shingles that similar sets of sizes ``a`` and ``b`` share at least: with an
    overlap of o, prefixes of n - o + l share l; ours are of ``prefix_size``."""
    return -(-percent * (a + b) // (100 + percent)) - -(-percent * np.maximum(a, b) // 100) + 1


def dual_traversal(n: np.ndarray, bits: np.ndarray, comp: np.ndarray, percent: int, marks: np.ndarray | None = None):
    """Index pairs (i < j) of members that may be similar and are not in one component.
    ``bits`` are of the whole sets, ``marks`` (if any) of their first shingles."""
    tree = _Tree(n, bits, comp)
    spare = None if marks is None else prefix_size(n, percent) - np.bitwise_count(marks).sum(axis=1).astype(np.int64)
    top = len(tree.levels) - 1
    stack, left, right = [(top, 0, 0)], [], []
    while stack:
        level, i, ys = stack.pop()
        # one node against several of its level at once
        ors, low, high, exc, one = tree.levels[level]
        ys = np.atleast_1d(ys)
        ok = ~((one[ys] == one[i]) & (one[i] >= 0))
        ok &= (100 * high[ys] >= percent * low[i]) & (100 * high[i] >= percent * low[ys])
        ok &= _overlap_enough(ors[ys], ors[i], np.minimum(exc[ys], exc[i]), low[ys] + low[i], percent)
        ys = ys[ok]
        if not len(ys):
            continue
        if level:
            count = len(tree.levels[level - 1][1])
            kids = np.concatenate([np.arange(y * FAN, min((y + 1) * FAN, count)) for y in ys])
            for x in range(i * FAN, min((i + 1) * FAN, count)):
                mine = kids[kids >= x]
                if len(mine):
                    stack.append((level - 1, x, mine))
            continue
        b = np.concatenate([np.arange(y * LEAF, min((y + 1) * LEAF, len(n))) for y in ys])
        for a in range(i * LEAF, min((i + 1) * LEAF, len(n))):
            c = b[b > a]
            if len(c):
                good = (tree.comp[c] != tree.comp[a]) & (100 * n[c] >= percent * n[a]) & (100 * n[a] >= percent * n[c])
                c = c[good]
                c = c[_overlap_enough(bits[c], bits[a], np.minimum(tree.excess[c], tree.excess[a]), n[c] + n[a], percent)]
                if marks is not None:
                    c = c[_most_common(marks[c], marks[a], np.minimum(spare[c], spare[a])) >= least_shared(n[c], n[a], percent)]
                left += [a] * len(c)
                right += c.tolist()
    return np.array(left, int), np.array(right, int)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The longs of a list column and where each row's begin."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), (offsets - offsets[0]).astype(np.int64)


def _folded(bits: np.ndarray, at: np.ndarray, words: int = BITMAP_WORDS) -> np.ndarray:
    """Long bitmaps as ones of ``words`` words."""
    return np.bitwise_or.reduceat(bits.reshape(-1, words), at[:-1] // words, axis=0) if len(at) > 1 else np.empty((0, words), np.uint64)


def _possible(percent: int):
    """Rows ``a, b, na, nb, ba, bb, ma, mb`` -> the pairs whose bitmaps (the longer one
    folded) and marks allow a link."""
    ones = lambda x: np.bitwise_count(x).sum(axis=1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            (left, la), (right, lb) = _words(batch.column(4)), _words(batch.column(5))
            ma, mb = (_words(batch.column(i))[0].reshape(-1, BITMAP_WORDS) for i in (6, 7))
            held = np.minimum(prefix_size(na, percent) - ones(ma), prefix_size(nb, percent) - ones(mb))
            good = _most_common(ma, mb, held) >= least_shared(na, nb, percent)
            words = np.minimum(np.diff(la), np.diff(lb))
            for w in np.unique(words[good]):
                rows = np.flatnonzero(good & (words == w))
                x, y = (_folded(np.concatenate([bits[at[i]:at[i + 1]] for i in rows]), np.append(0, np.cumsum(np.diff(at)[rows])), w)
                        for bits, at in ((left, la), (right, lb)))
                excess = np.minimum(na[rows] - ones(x), nb[rows] - ones(y))
                good[rows] = _overlap_enough(x, y, excess, na[rows] + nb[rows], percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))
    return run


def _candidates(percent: int, words: bool):
    """Rows sorted by group; each group's trees give ``a, b`` pairs of classes, their sizes
    and the number of the task's groups they were found in.  ``side`` tells the blocks of a pair of blocks apart; of two
    visitors from the band below, that band's own group takes care."""
    def pairs(cid, n, comp, side, own, bits, marks, band, both):
        keep = np.argsort(n, kind="stable") if len(n) <= LEAF else np.lexsort((n, bits[:, 0]))
        i, j = dual_traversal(n[keep], bits[keep], comp[keep], percent, marks[keep])
        i, j = keep[i], keep[j]
        fit = (own[i] == band) | (own[j] == band)
        if both:  # pairs within a block belong to that block's own group
            fit &= side[i] != side[j]
        i, j = i[fit], j[fit]
        i, j = np.where(cid[i] < cid[j], i, j), np.where(cid[i] < cid[j], j, i)
        return cid[i], cid[j], n[i], n[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, many = None, [], 0
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], 1)
            cols = [key] + [batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6, 7, 8)]
            if words:
                cols += [_folded(*_words(batch.column(9))), _words(batch.column(10))[0].reshape(-1, BITMAP_WORDS)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            key = cols[0]
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            last = cuts[-1] if len(cuts) else 0
            new = pairs_of([c[:last] for c in cols], cuts[:-1] if len(cuts) else cuts)
            held = [c[last:] for c in cols]
            found += new
            many += sum(len(x[0]) for x in new)
            if many > HELD_PAIRS:
                found = [summed(found)]
                many = len(found[0][0])
                if many > HELD_PAIRS // 2:
                    yield batch_of(found)
                    found, many = [], 0
        if held is not None:
            found += pairs_of(held, np.empty(0, int))
        if found:
            yield batch_of([summed(found)])

    def summed(found):
        """Each pair once, with the sum of its counts."""
        a, b, na, nb, times = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)])
        return a[first], b[first], na[order][first], nb[order][first], np.add.reduceat(times[order], first) if len(first) else times

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in found[0]], names=["a", "b", "na", "nb", "times"])

    def leaves(key, cid, n, comp, side, own):
        """All groups of one leaf at once: each member and the one ``d`` places behind."""
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
        found = []
        for d in range(1, len(key)):
            i = np.flatnonzero(group[:-d] == group[d:])
            if not len(i):
                break
            j = i + d
            fit = (comp[i] != comp[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
            fit &= (own[i] == key[i, 1]) | (own[j] == key[i, 1])
            i, j = i[fit], j[fit]
            swap = cid[i] > cid[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            found.append((cid[i], cid[j], n[i], n[j]))
        return found

    def pairs_of(cols, cuts):
        key = cols[0]
        if not len(key):
            return []
        found = (leaves(*cols) if not words else
                 [pairs(*[c[lo:hi] for c in cols[1:]], key[lo, 1], key[lo, 2] != key[lo, 3])
                  for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(key)))])
        return [(*x, np.ones(len(x[0]), np.int64)) for x in found]
    return run


_PAIR = "a long, b long, na long, nb long, times long"

# ------------------------------------------------------------------ the join

def _similar_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes that are as similar as asked, by their whole sets."""
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = stored(classes.join(ids, "cid").select("cid", "n", "f1", "f2", F.col("rep").alias("rep_id")), "wanted")
    texts = with_possible(docs, "doc_id", blocks_of(wanted, "rep_id"), "maybe").where("maybe")
    # not stored: one shuffle by class serves the copies' removal and both joins
    sets = (texts.join(wanted, texts.doc_id == wanted.rep_id).select("cid", "n", "f1", "f2", "text")
            .mapInArrow(_sets(k), "cid long, tokens array<long>").dropDuplicates(["cid"]))
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("ta")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tb")), "b")
            .select("a", "b", (F.size("ta") + F.size("tb")).alias("sum"), F.size(F.array_intersect("ta", "tb")).alias("common")))
    return stored(both.where((100 + percent) * F.col("common") >= percent * F.col("sum")).select("a", "b"), "links")


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per document: ``doc_id, n_shingles,
    component_id``, the smallest doc_id reachable over links of Jaccard similarity
    ``percent`` / 100 or more.

    A document of fewer than ``k`` words is one shingle; one without words (null
    or empty text) has none and is linked with nothing.  Rows without a doc_id
    join the class of an equal set that has one; else their component is null.
    Repeated rows are copies.  Shingles are told apart by 64-bit hashes, equal
    sets by their size and two 64-bit sums.  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    common = docs.sparkSession.sparkContext.broadcast(common_buckets(docs, k))  # 4 MB
    sketch = stored(docs.mapInArrow(
        _sketch(k, percent, common), "doc_id long, n long, f1 long, f2 long, prefix array<long>, bits array<long>, marks array<long>"), "sketch")
    classes = stored(sketch.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2")
                     .agg(F.min(F.struct("doc_id", "prefix", "bits", "marks")).alias("one"))
                     .select("n", "f1", "f2", F.col("one.doc_id").alias("rep"), F.col("one.prefix").alias("prefix"), F.col("one.bits").alias("bits"), F.col("one.marks").alias("marks"))
                     .withColumn("cid", F.monotonically_increasing_id()), "classes")
    tokens = classes.select("cid", "n", F.get("prefix", F.lit(0)).alias("lead"), F.explode("prefix").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    groups = stored(tokens.join(shared, "token"), "groups")

    # links along chains of likely neighbours
    nth = F.row_number().over(Window.partitionBy("cid").orderBy("token"))
    salt = F.pmod(F.xxhash64("cid"), F.ceil(F.col("c") / SALT_ROWS))
    chain = Window.partitionBy("token", "salt").orderBy("lead", "n", "cid")
    of = classes.select("cid", "n", "bits", "marks")

    def possible(pairs: DataFrame, kind: str) -> DataFrame:
        """The pairs ``a, b`` of classes whose bitmaps allow a link."""
        one, other = (of.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{x}"), F.col("marks").alias(f"m{x}")) for x in "ab")
        return stored(pairs.join(one, "a").join(other, "b").select("a", "b", "na", "nb", "ba", "bb", "ma", "mb")
                      .mapInArrow(_possible(percent), "a long, b long"), kind)

    def chained(rows: DataFrame, kind: str, around: bool = False) -> DataFrame:
        """Neighbours in a chain (``comp``: of different components) whose bitmaps allow a link.
        ``around``: each member also with the one of its chain whose hashes are shared most."""
        of_before = lambda c: F.lag(c).over(chain)
        one = [F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb")]
        rows = rows.withColumn("salt", salt)
        near = rows.select(of_before("cid").alias("a"), of_before("n").alias("na"), of_before("comp").alias("ca"), *one)
        if around:
            centre = F.max(F.struct("weight", "cid", "n", "comp")).over(Window.partitionBy("token", "salt"))
            near = near.union(rows.withColumn("weight", F.sum("c").over(Window.partitionBy("cid"))).withColumn("centre", centre)
                              .select("centre.cid", "centre.n", "centre.comp", *one))
        near = (near.where(F.col("a").isNotNull() & (F.col("ca") != F.col("cb")) & _similar_size(F.col("na"), F.col("nb"), percent))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        return possible(near, kind)

    some = groups.withColumn("nth", nth).where(F.col("nth") <= CHAIN_TOKENS).withColumn("comp", F.col("cid"))
    parts = components(_verified(chained(some, "near"), classes, docs, k, percent))
    # what the large groups still hold apart, along all their hashes
    large = (groups.where(F.col("c") > LEAF).join(parts.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("comp", F.coalesce("component", "cid")))
    more = _verified(chained(large, "near-more", True), classes, docs, k, percent)
    parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    # signature trees over what is not linked yet
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-log(percent / 100))).cast("long")
    members = (groups.join(parts.withColumnRenamed("node", "cid"), "cid", "left")
               .select("token", "cid", "n", F.coalesce("component", "cid").alias("comp"))
               .withColumn("own", band).withColumn("band", F.explode(F.array(band, band + 1))))
    # a group needs two components and one member of its own band
    mixed = (members.groupBy("token", "band")
             .agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.max("own").alias("own"), F.count("*").alias("size"),
                  F.min("n").alias("least"), F.max("n").alias("most"))
             .where((F.col("x") != F.col("y")) & (F.col("own") == F.col("band"))
                    & ((F.col("size") > 2) | _similar_size(F.col("least"), F.col("most"), percent)))
             .select("token", "band", "size", F.ceil(F.col("size") / BLOCK).alias("blocks")))
    rows = stored(members.join(mixed, ["token", "band"]), "members")
    group = ["token", "band", "lo", "hi"]
    zero = F.lit(0).cast("long")
    # a group of one leaf has nothing to prune and needs no bitmaps
    small = (rows.where(F.col("size") <= LEAF).select("token", "band", zero.alias("lo"), zero.alias("hi"), "cid", "n", "comp", zero.alias("side"), "own")
             .repartition(*group).sortWithinPartitions(*group).mapInArrow(_candidates(percent, False), _PAIR))
    block = F.pmod(F.xxhash64(F.lit(5), "cid"), F.col("blocks"))
    large = (rows.where(F.col("size") > LEAF).withColumn("side", block)
             .withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
             .select("token", "band", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "cid", "n", "comp", "side", "own")
             .join(of.select("cid", "bits", "marks"), "cid").select(*group, "cid", "n", "comp", "side", "own", "bits", "marks")
             .repartition(*group).sortWithinPartitions(*group).mapInArrow(_candidates(percent, True), _PAIR))
    shared = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent)) - F.ceil(percent * F.greatest("na", "nb") / 100) + 1  # ``least_shared``
    pairs = (small.union(large).groupBy("a", "b", "na", "nb").agg(F.sum("times").alias("common"))
             .where(F.col("common") >= shared).select("a", "b"))
    second = _verified(possible(pairs, "pairs"), classes, docs, k, percent)

    linked = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second))
    smallest = (linked.withColumnRenamed("node", "cid").join(classes.select("cid", "rep"), "cid")
                .groupBy("component").agg(F.min("rep").alias("component_id")))
    named = (classes.join(linked.withColumnRenamed("node", "cid"), "cid", "left").join(smallest, "component", "left")
             .select("n", "f1", "f2", F.coalesce("component_id", "rep").alias("component_id")))
    return sketch.select("doc_id", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
