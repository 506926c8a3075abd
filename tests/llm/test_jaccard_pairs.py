"""What the n-gram join makes of pairs before it compares whole sets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from annolink.llm import jaccard
from test_duplicates import jaccard_classes


def families(sizes, seed=3):
    """For each size a set, near copies on both sides of 0.9, and a stranger; as sorted arrays."""
    rng, sets = np.random.default_rng(seed), []
    for size in sizes:
        base = rng.integers(0, 1 << 64, size, dtype=np.uint64)
        for share in (0, .02, .045, .051, .06, .12, 1):
            new = int(round(share * size))
            sets.append(np.unique(np.concatenate([base[new:], rng.integers(0, 1 << 64, new, dtype=np.uint64)])))
    return sets


def sketches(sets, percent):
    """Sizes, whole bitmaps and where they begin, marks; first shingles by hash."""
    n = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), n)
    keep = jaccard.prefix_size(n, percent)
    short = np.concatenate([np.arange(len(s)) < k for s, k in zip(sets, keep)])
    grams = np.concatenate(sets)
    bits, at = jaccard._long_bitmaps(rows, grams, n)
    return n, bits, at, jaccard._bitmaps(rows[short], grams[short], len(sets)), [s[:k].tolist() for s, k in zip(sets, keep)]


def lists(rows):
    return pa.array([np.asarray(r, np.uint64).view(np.int64).tolist() for r in rows], pa.list_(pa.int64()))


def similar(a, b, percent):
    common = len(np.intersect1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


@pytest.mark.parametrize("percent", [90, 80])
def test_bitmaps_lose_no_pair_and_leave_few(percent):
    sets = families([1, 2, 5, 12, 60, 500, 520, 1030, 2040, 2100, 6000])
    n, bits, at, marks, _ = sketches(sets, percent)
    long = [bits[at[i]:at[i + 1]] for i in range(len(sets))]
    assert len({len(x) for x in long}) >= 4
    whole = jaccard._bitmaps(np.repeat(np.arange(len(sets)), n), np.concatenate(sets), len(sets))
    assert (jaccard._folded(bits, at) == whole).all()
    i, j = map(np.array, zip(*[(i, j) for i in range(len(sets)) for j in range(i)]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(i), pa.array(j), pa.array(n[i]), pa.array(n[j]), lists(long[k] for k in i), lists(long[k] for k in j),
         lists(marks[i]), lists(marks[j])], names=["a", "b", "na", "nb", "ba", "bb", "ma", "mb"])
    out = list(jaccard._possible(percent)([batch.slice(0, 1000), batch.slice(1000)]))
    got = {(r["a"], r["b"]) for x in out for r in x.to_pylist()}
    want = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if similar(sets[a], sets[b], percent)}
    assert want and want <= got and len(got) < 1.3 * len(want)


def test_a_task_tells_each_pair_once():
    """Copies share many first shingles, so many groups: one row a pair, with their number."""
    rng = np.random.default_rng(1)
    base = np.sort(rng.integers(0, 1 << 64, 1500, dtype=np.uint64))
    # twenty near copies, and strangers that share a tenth of the first shingles
    sets = [np.unique(np.concatenate([np.delete(base, rng.integers(0, 1500, 15)), rng.integers(0, 1 << 64, 15, dtype=np.uint64)])) for _ in range(20)]
    sets += [np.unique(np.concatenate([base[:15], rng.integers(int(base[15]), 1 << 64, 1485, dtype=np.uint64)])) for _ in range(20)]
    n, bits, at, marks, prefix = sketches(sets, 90)
    of = {}
    for k, tokens in enumerate(prefix):
        for t in tokens:
            of.setdefault(t, []).append(k)
    rows = [(np.uint64(t).view(np.int64), k) for t, held in sorted(of.items()) if len(held) > 1 for k in held]
    token, k = np.array([t for t, _ in rows]), np.array([k for _, k in rows])
    zero = pa.array(np.zeros(len(k), np.int64))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(token), zero, zero, zero, pa.array(k), pa.array(n[k]), pa.array(k), zero, zero,
         lists(bits[at[x]:at[x + 1]] for x in k), lists(marks[k])],
        names=["token", "band", "lo", "hi", "cid", "n", "comp", "side", "own", "bits", "marks"])
    out = list(jaccard._candidates(90, True)(batch.slice(x, 500) for x in range(0, len(k), 500)))
    got = {(r["a"], r["b"]): r["times"] for x in out for r in x.to_pylist()}
    assert sum(len(x) for x in out) == len(got)
    common = lambda a, b: len(set(prefix[a]) & set(prefix[b]))
    want = {(a, b): common(a, b) for b in range(20) for a in range(b) if similar(sets[a], sets[b], 90)}
    assert want and all(got[p] == c for p, c in want.items())
    assert all(c >= jaccard.least_shared(n[a], n[b], 90) for (a, b), c in got.items())


def test_long_documents_equal_brute_force(spark, monkeypatch):
    """Sizes around those where bitmaps double, groups beyond a leaf, pairs given in several lots."""
    monkeypatch.setattr(jaccard, "HELD_PAIRS", 20)
    rng, rows = random.Random(4), []
    for size in (505, 1020):
        base = [f"w{rng.randint(0, 400)}" for _ in range(size)]
        for i in range(30):
            w = list(base)
            for at in rng.sample(range(size), size * rng.randint(0, 4) // 200):
                w[at] = f"v{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(w[:size - rng.randint(0, 9)])))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got)) == jaccard_classes(rows, 3, 90)


def test_copies_of_one_text_are_linked_around_it(spark, monkeypatch):
    """Copies similar to their original, but just not to each other: their pairs are not made."""
    made, stored = {}, jaccard.stored

    def counted(df, kind):
        out = stored(df, kind)
        made[kind] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 101):
        w = list(base)
        for k, at in enumerate(rng.sample(range(2, 298, 4), 3)):
            w[at] = f"v{i}x{k}"
        rows.append((i, " ".join(w)))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == jaccard_classes(rows, 3, 90) == [(i, 298, 0) for i in range(101)]
    assert made["pairs"] < 100 and made["near-more"] <= 300
