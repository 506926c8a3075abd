import random
import re
import zlib
from collections import Counter

import pytest

from annolink.llm import queries, spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def groups(counts):
    found = {}
    for w, n in counts.items():
        close = [v for v in counts if v != w and near(v, w)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        found[w] = (best if best is not None and counts[best] >= 2 * n else None, len(close))
    out = []
    for w, n in counts.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        form, close = found[w]
        out.append((w, form, root, n, close, counts[form] if form is not None else None))
    return sorted(out)


def vocabulary(seed, n, letters="abé", longest=9):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))): rng.choice([3, 3, 4, 6, 9, 20, 41, 90]) for _ in range(n)}


def run(spark, counts, **kw):
    words = spark.createDataFrame([(w, n, 5) for w, n in counts.items()], "word string, n int, near_n int").repartition(3)
    return sorted(map(tuple, spelling.variant_groups(words, **kw).collect()))


@pytest.mark.parametrize("group_words", [spelling.GROUP_WORDS, 4])
def test_variants_equal_brute_force(spark, monkeypatch, group_words):
    pairs = spelling.near_pairs
    monkeypatch.setattr(spelling, "near_pairs", lambda words: pairs(words, group_words))
    counts = vocabulary(1, 700) | {"x" * 3000: 5, "x" * 3001: 20, "😀bcde": 3, "😁bcde": 9, "aaaaaaaaaaaa": 3, "aaaaaaaaaaa": 6}
    got = run(spark, counts)
    assert got == groups(counts)
    assert max(g[4] for g in got) > 10 and len({g[2] for g in got if g[1]}) > 20


def test_each_pair_once(spark):
    counts = vocabulary(2, 400, "ab", 7)
    words = spark.createDataFrame(list(counts.items()), "word string, n int")
    for size in (spelling.GROUP_WORDS, 3):
        got = [tuple(sorted((p.a, p.b))) for p in spelling.near_pairs(words, size).collect()]
        assert sorted(got) == sorted((a, b) for a in counts for b in counts if a < b and near(a, b))


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted(vocabulary(3, 300))
    made = spelling.Acceptor(words)
    stack, accepted = [(made.start, "")], []
    while stack:
        s, read = stack.pop()
        if made.final[s]:
            accepted.append(read)
        stack += [(t, read + c) for c, t in made.arcs[s].items()]
    assert sorted(accepted) == words
    rests = {}
    for w in words:
        for i in range(len(w) + 1):
            rests[w[:i]] = frozenset(v[i:] for v in words if v.startswith(w[:i]))
    assert len(made.arcs) == len(set(rests.values()))


def test_nothing_and_nulls(spark):
    assert spelling.variant_groups(spark.createDataFrame([], "word string, n long")).count() == 0
    words = spark.createDataFrame([(None, 3), ("", 4), ("alone", 5)], "word string, n long")
    assert [tuple(r) for r in spelling.variant_groups(words).collect()] == [("alone", None, "alone", 5, 0, None)]


def counted(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def test_query_equals_brute_force(spark, tmp_path, doc_rows):
    rng = random.Random(6)
    rows = doc_rows + [(100 + i, " ".join(rng.choice(["Große", "große", "GROSSE", "colour", "color", "colours", "Éclair", "éclair", "eclair", "x÷y", "naïveté"])
                                          for _ in range(300))) for i in range(20)] + [(None, "nobody nobody nobody's")]
    path = str(tmp_path / "sf")
    spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").write.parquet(f"{path}/documents.parquet")
    df = queries.op13_spelling_variants(spark, path)
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(map(tuple, df.collect()))
    want = groups(counted(rows))
    assert got == want and any(w[1] for w in want)
