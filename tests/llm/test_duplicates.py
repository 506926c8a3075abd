import random
import re

import numpy as np
import pytest

import corpus_pipeline
from annolink.llm import covertree, jaccard, lines
from annolink.llm.components import components
from conftest_helpers import lower, unite

SPACE = re.compile("[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = SPACE.findall(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def jaccard_classes(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = unite(len(rows), links)
    first = {}
    for i, (d, _) in enumerate(rows):
        first[root[i]] = min(first.get(root[i], d), d)
    return sorted((d, len(s), first[root[i]]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(docs, doc_rows, k, percent):
    got = jaccard.jaccard_components(docs, k, percent).collect()
    want = jaccard_classes(doc_rows, k, percent)
    assert sorted(map(tuple, got)) == want
    assert len({w[2] for w in want}) < len(want) - 5


def test_jaccard_finds_links_that_chains_miss(spark, monkeypatch):
    """Near copies around the threshold, in one large family, with small blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "SALT_ROWS", 8)
    monkeypatch.setattr(jaccard, "CHAIN_TOKENS", 1)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(60), rng.randint(0, 3)):
            w[k] = f"v{rng.randint(0, 9)}"
        rows.append((i, " ".join(w)))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == jaccard_classes(rows, 3, 90)


def test_tree_traversal_loses_no_pair():
    rng = np.random.default_rng(4)
    n_tokens = rng.integers(40, 60, 300)
    sets = [set(rng.integers(0, 1 << 60, n).tolist()) for n in n_tokens]
    for i in range(0, 300, 3):  # near copies
        sets[i + 1] = set(list(sets[i])[1:]) | {i}
        sets[i + 2] = set(list(sets[i])[2:])
    rows = np.concatenate([[i] * len(s) for i, s in enumerate(sets)])
    grams = np.concatenate([sorted(s) for s in sets]).astype(np.uint64)
    bits = jaccard._bitmaps(rows, grams, 300)
    n = np.array([len(s) for s in sets])
    i, j = jaccard.dual_traversal(n, bits, np.arange(300), 90)
    found = set(zip(i.tolist(), j.tolist()))
    want = {(a, b) for a in range(300) for b in range(a + 1, 300) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])}
    assert want <= found and len(found) < 3 * len(want)


def test_jaccard_of_nothing_and_nulls(no_docs, null_docs):
    assert jaccard.jaccard_components(no_docs).count() == 0
    rows = jaccard.jaccard_components(null_docs).collect()
    assert sorted((r.n_shingles, r.component_id or 0) for r in rows) == [(0, 0), (0, 0), (1, 0), (3, 9)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (None, 3), (3, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None]
    root = unite(1101, real)
    low = {}
    for i in range(1101):
        low.setdefault(root[i], i)
    assert got == {i: low[root[i]] for e in real if e[0] != e[1] for i in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --------------------------------------------------------------------- lines

def line_fate(rows, shingle=8, percent=80):
    """Every non-blank line's place -> whether it is kept."""
    places = []
    for d, t in rows:
        for k, x in enumerate((t or "").split("\n")):
            raw = lower(x).encode()
            if raw.strip(bytes(range(33))):
                places.append((d, k, raw))
    texts = sorted({p[2] for p in places})
    grams = [{x[i:i + shingle] for i in range(max(1, len(x) - shingle + 1))} for x in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a)
             if 100 * len(grams[a] & grams[b]) >= percent * len(grams[a] | grams[b])]
    root = unite(len(texts), links)
    of = {x: root[i] for i, x in enumerate(texts)}
    first = {}
    for d, k, x in places:
        first[of[x]] = min(first.get(of[x], (d, k)), (d, k))
    out = {}
    for d, k, x in places:
        if first[of[x]] != (d, k):
            out.setdefault(d, set()).add(k)
    return {d: sorted(v) for d, v in out.items()}


def line_rows(doc_rows):
    long_line = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack " * 2
    return doc_rows + [(200, "Common line.\n" + long_line), (201, "\n\nCOMMON line.\nown one " + "z" * 30),
                       (202, long_line.replace("seven", "eight") + "\nCommon line."), (203, long_line + "!"), (204, "kept\n\n \nkept\nkept too, a longer line")]


def test_lines_equal_brute_force(spark, doc_rows):
    rows = line_rows(doc_rows)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, line int, cid string")
    got = {r.doc_id: list(r.dropped) for r in lines.dropped_lines(d).collect()}
    assert got == line_fate(rows)
    back = lines.dedup_lines(d)
    assert back.columns == d.columns
    texts = {r.doc_id: r.text for r in back.collect()}
    fate = line_fate(rows)
    for i, t in rows:
        left = [x for k, x in enumerate((t or "").split("\n")) if k not in fate.get(i, [])]
        if i in fate and not any(x.strip() for x in left):
            assert i not in texts
        else:
            assert texts[i] == (t if i not in fate else "\n".join(left))


def test_lines_of_nothing_and_nulls(no_docs, null_docs):
    assert lines.dropped_lines(no_docs).count() == 0 and lines.dedup_lines(no_docs).count() == 0
    assert lines.dedup_lines(null_docs).count() == 4


@pytest.mark.parametrize("block", [16, 2048])
def test_lines_of_a_template_family_equal_brute_force(spark, monkeypatch, block):
    """Many lines to a bucket, below the threshold to the pivot, linked in pairs far apart by length."""
    monkeypatch.setattr(lines, "BLOCK", block, raising=False)
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    frame, texts = letters(187), []
    for i in range(150):
        head = letters(16)
        texts += [frame + head + letters(rng.randint(8, 24)) for _ in range(2)]
    rng.shuffle(texts)
    start = np.cumsum([0] + [len(t) for t in texts])
    keys = lines.band_keys("".join(texts).encode(), start[:-1], start[1:], 8, 2, 5)
    grams = [{t[i:i + 8] for i in range(len(t) - 7)} for t in texts]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if (keys[a] == keys[b]).any()
             and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])]
    root = unite(len(texts), links)
    assert 50 < sum(r != i for i, r in enumerate(root)) < 200
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(r.doc_id for r in lines.dropped_lines(d, bands=2).collect())
    assert got == [i for i, r in enumerate(root) if r != i]


# ---------------------------------------------------------------- embeddings

def vectors():
    rng = np.random.default_rng(8)
    rows, k = [], 0
    centres = rng.normal(size=(12, 8))
    for i in range(240):
        v = centres[i % 12] + rng.normal(scale=0.05 if i % 3 else 0.3, size=8)
        rows.append((i, v.tolist(), int(i % 2)))
    rows += [(300 + i, rows[0][1], 0) for i in range(5)]                       # copies
    rows += [(310, [2 * x for x in rows[0][1]], 0)]                            # a multiple
    rows += [(320, None, 0), (321, [0.0] * 8, 0), (322, [1.0, None] + [0.0] * 6, 0), (323, [float("nan")] * 8, 0), (324, [float("inf")] + [0.0] * 7, 0),
             (325, rows[0][1], None), (326, [], 0), (327, rows[0][1][:4], 0), (328, [1e200] * 8, 1), (329, [1e-200] * 8, 1)]
    return rows


def vector_links(rows, cosine=0.98):
    def good(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    scaled = [np.array(v) / np.abs(v).max() if good(v, c) else None for _, v, c in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            a, b = scaled[i], scaled[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    links.append((i, j))
    root = unite(len(rows), links)
    n, first = [0] * len(rows), {}
    for i, j in links:
        n[i] += 1
        n[j] += 1
    for i, r in enumerate(rows):
        first[root[i]] = min(first.get(root[i], r[0]), r[0])
    return sorted((r[0], n[i], first[root[i]], first[root[i]] == r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("cell", [2048, 20])
def test_embeddings_equal_brute_force(spark, cell):
    rows = vectors()
    d = spark.createDataFrame([(i, v, c, "x", 3) for i, v, c in rows], "vec_id long, embedding array<double>, label int, part string, pid int")
    got = sorted(map(tuple, covertree.near_duplicates(d, cell=cell).collect()))
    assert got == vector_links(rows)


def test_embeddings_of_nothing(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_cover_tree_nests():
    x = covertree.unit(np.random.default_rng(3).normal(size=(500, 5)))
    tree = covertree.CoverTree(x)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(500))
    for up, down, kids in zip(tree.centres, tree.centres[1:], tree.kids):
        assert set(up) <= set(down)
        assert sorted(np.concatenate(kids).tolist()) == list(range(len(down)))


# ------------------------------------------------------------------ pipeline

def test_pipeline_equals_its_parts(spark, tmp_path, doc_rows):
    rng = random.Random(9)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    rows = line_rows(doc_rows) + [(400, " ".join(rng.choice(["mo", "ta", "ne"]) + str(i) for i in range(40)) + " " + item)]
    # letters only in other lines, so the language model has something to go by
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "aa", "s", len(t or "")) for i, t in rows], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [(i, t) for i, t in rows if t and any(map(str.isalpha, t))]
    fate = line_fate(kept)
    texts = []
    for i, t in kept:
        left = [x for k, x in enumerate(t.split("\n")) if k not in fate.get(i, [])]
        if any(x.strip() for x in left):
            texts.append((i, "\n".join(left)))
    first = {(d, c) for d, _, c in jaccard_classes(texts, 5, 80)}
    want = {d for d, c in first if d == c and d != 400}
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == want
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][0] == "language_id"


def test_stages_decide_by_row_without_ids_or_with_repeated_ones(spark, tmp_path):
    spark.createDataFrame([(1, "ba be bi bo bu da de di do du ga ge gi")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stay = lambda stage, rows: sorted(r.text for r in dict(corpus_pipeline.STAGES)[stage](
        spark, spark.createDataFrame(rows, "lang string, doc_id long, text string").repartition(3), str(tmp_path)).select("text").collect())
    common, more = "a line that stands here twice over", "another line which stands here twice"
    rows = [("x", 1, f"{common}\n{more}"), ("x", None, f"{common}\nown words of the first row here"),
            ("x", None, f"quite different words in this one\n{more}"), ("x", 7, f"something else again 0123456789\n{common}"),
            ("x", 7, "the second text of that same id, kept\nits other line, which nobody else has")]
    assert stay("line_dedup", rows) == sorted([
        f"{common}\n{more}", "own words of the first row here", "quite different words in this one", "something else again 0123456789", rows[4][2]])
    words = " ".join(f"w{i}" for i in range(60))
    copies = [("x", 2, words), ("x", 2, words), ("x", None, words), ("x", None, words + " end"), ("x", None, "unlike all others"), ("x", 2, "nor like these ones")]
    assert stay("ngram_join", copies) == sorted([words, "unlike all others", "nor like these ones"])
    leak = "ba be bi bo bu da de di do du ga ge gi"
    leaks = [("x", None, leak), ("x", 3, "not in the list"), ("x", 3, leak + " more"), ("x", None, "nor this")]
    assert stay("decontamination", leaks) == ["nor this", "not in the list"]


def test_a_slice_is_hashed_in_two_passes(monkeypatch):
    """Lines and shingles share the prefix sums of their slice; the hashes are those of the spans."""
    from annolink.llm import common
    raw = "Abcdefgh ijk\n \n\nxy\nabcdefgh\nÉté à la plage\n".encode() + b"\n\t\nlast line of all"
    offsets = np.array([0, 0, 13, 20, 20, len(raw)])
    passes, powers = [], common._powers
    monkeypatch.setattr(common, "_powers", lambda n, base=0: passes.append(n) or powers(n, base))
    sums_made, cumsum = [], np.cumsum
    monkeypatch.setattr(common.np, "cumsum", lambda a, *b, **k: sums_made.append(len(a)) or cumsum(a, *b, **k))
    row, number, start, end, h1, h2, folded, *sums = lines.split_lines(raw, offsets)
    g, count, first = lines.shingle_hashes(folded, start, end, 8, *sums)
    # one sum over the bytes for each of two hashes, one over the places of the shingles
    assert sum(n >= len(raw) - 8 for n in sums_made) <= 3
    monkeypatch.undo()
    texts = [folded[a:b] for a, b in zip(start, end)]
    rows = [raw[a:b] for a, b in zip(offsets, offsets[1:])]
    assert [(r, k, t) for r, k, t in zip(row, number, texts)] == [
        (i, k, x.translate(common.LOWER_AZ)) for i, t in enumerate(rows) for k, x in enumerate(t.split(b"\n")) if x.strip(bytes(range(33)))]
    for at, n, t, a, b in zip(first, count, texts, h1, h2):
        spans = [t[i:i + 8] for i in range(max(1, len(t) - 7))]
        assert n == len(spans) and all(g[at + i] == common.span_hash(x, np.array([0]), np.array([len(x)]))[0] for i, x in enumerate(spans))
        assert (a, b) == tuple(common.span_hash(t, np.array([0]), np.array([len(t)]), k)[0] for k in (0, 1))
