import random
import re
from collections import Counter

import numpy as np
import pytest
import regex

from annolink.llm import decontaminate, langid, pii, toxicity, urls
from annolink.llm.common import byte_class, text_slices, words_of

import pyarrow as pa

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_words_are_the_patterns(doc_rows):
    texts = [t for _, t in doc_rows]
    got = {}
    for at, raw, offs in text_slices(pa.array(texts, pa.string()), 1000):
        row, start, end, h = words_of(raw, offs, byte_class(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"))
        for r, s, e in zip(row.tolist(), start.tolist(), end.tolist()):
            got.setdefault(at + r, []).append(lower(raw[s:e].decode()))
    for i, t in enumerate(texts):
        assert got.get(i, []) == WORD.findall(lower(t or ""))


def test_equal_words_have_equal_hashes_wherever_they_stand():
    _, raw, offs = next(text_slices(pa.array(["ab cd", "CD x ab", None, "abcd"], pa.string())))
    row, start, end, h = words_of(raw, offs, byte_class("[A-Za-z]"))
    words = [lower(raw[s:e].decode()) for s, e in zip(start, end)]
    assert len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))


# ---------------------------------------------------------- decontamination

ITEMS = [(1, "mo ne lu ko sa vi ta ri mo mo ne ne lu lu ko ko"), (2, "Short Item, here"), (3, None), (4, " ... "), (None, "lost words of no id"),
         (5, "mo ne lu ko sa vi ta ri mo mo ne ne lu zz")]


def planted(doc_rows):
    body = " ".join(t for _, t in doc_rows[20:24] if t)
    return doc_rows + [(60, body + " MO-ne lu ko sa vi ta ri mo mo ne ne lu lu ko "), (61, "short item here"), (62, "a short item; HERE short item here"),
                       (63, "short item not here"), (64, "lost words of no id"), (65, "mo ne lu ko sa vi ta ri mo mo ne ne")]


def test_decontamination_equals_brute_force(spark, doc_rows):
    rows = planted(doc_rows)
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, found string, item long")
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, n int")
    got = sorted((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"] or []))) for r in decontaminate.matches(d, items).collect())
    windows = {}
    for i, t in ITEMS:
        w = WORD.findall(lower(t or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    want = []
    for i, t in rows:
        w, hit, found = WORD.findall(lower(t or "")), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    found |= windows[tuple(w[k:k + n])]
                    hit |= set(range(k, k + n))
        want.append((i, len(w), len(hit), tuple(sorted(found))))
    assert got == sorted(want)
    assert any(x[2] for x in want)


def test_decontamination_by_repeated_items(spark):
    """A repeated row, and one id on two texts that begin alike."""
    items = spark.createDataFrame([(1, "mo ne lu ko"), (1, "mo ne lu ko"), (2, "sa vi ta ri mo"), (2, "sa vi ta ri zz")], "item_id long, text string")
    d = spark.createDataFrame([(1, "zz mo ne lu ko"), (2, "sa vi ta ri mo mo"), (3, "ri sa vi ta ri"), (4, "sa vi ta ri zz")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.matches(d, items, 4).collect()}
    assert got == {1: (4, [1]), 2: (5, [2]), 3: (4, [2]), 4: (5, [2])}


def test_decontamination_of_nothing(spark, no_docs, null_docs):
    items = spark.createDataFrame([(1, "mo ta ri")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(no_docs, items).count() == 0
    assert [r.n_hit for r in decontaminate.matches(null_docs, none).collect()] == [0] * 4
    assert sorted(r.n_hit for r in decontaminate.matches(null_docs, items).collect()) == [0, 0, 3, 3]


# ------------------------------------------------------------------- PII

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out, n = [], []
    for kind, pattern in BASE.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                found.append(f"{kind}:{m.start()}:{m.end()}")
        n.append(len(found))
        out += found
    return n, out


PRIVATE = ["a.b+c@mail-1.example.org and x@y.z.", "a@b.c_d@e.f @g.h i@j", "é 東 10.0.0.255 1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 999999999999.1.1.1",
           "4111 1111 1111 1111, 4111-1111-1111-1112; 4111  1111 1111 1111", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "12 " * 3000 + "a@b.cc",
           "+1 (262) 555-3752. +12345678 +123456789 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "x" * 30000 + "@b.cc", "a@" + "b." * 3000 + "c", "+" * 50 + "1" * 40]


def test_base_spans_equal_the_patterns(spark, doc_rows):
    rows = doc_rows + [(100 + i, t) for i, t in enumerate(PRIVATE)]
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, email string, tkey string")
    got = {}
    for r in pii.analyse(d).collect():
        flat = [f"{k}:{s.start}:{s.end}" for k in pii.KINDS for s in r[k]]
        got[r.doc_id] = ([len(r[k]) for k in pii.KINDS], flat)
    assert got == {i: base_spans(t) for i, t in rows}


def test_terms_that_give_an_entity_away(spark):
    plain = [(i, f"the usual words number{i} again") for i in range(600)]
    held = [(1000 + i, f"the usual secretname{'' if i < 36 else 'x'} words v{i} mail joe@corp.example again") for i in range(40)]
    d = spark.createDataFrame(plain + held, "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.analyse(d).collect()}
    # whoever knows the word knows the entity: nearly all of its information
    assert {s.value for s in rows[1001].removed} == {"secretname", "mail"}  # not the address's own words
    assert [s.value for s in rows[1039].removed] == ["secretnamex", "mail"] and not rows[1001].generalised and not rows[3].removed
    out = {r.doc_id: r.sanitised for r in pii.sanitise(d).collect()}
    assert "joe@corp" not in out[1001] and "secretname" not in out[1001] and "[EMAIL]" in out[1001]
    assert "secretname" not in out[1039] and out[3] == plain[3][1] and len(out) == 640


def disclosed(rows):
    """Counted text by text: ``doc number -> kind:start:end`` of the disclosing words."""
    known, words, spans = [], [], []
    for _, text in rows:
        found, places = set(), []
        for span in base_spans(text)[1]:
            kind, s, e = span.split(":")
            value = text[int(s):int(e)]
            found.add((kind, value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)))
            places.append((int(s), int(e)))
        known.append(found)
        spans.append(places)
        words.append([(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"\p{L}{3,}", text or "")])
    n_e, n_t, n_et = Counter(), Counter(), Counter()
    for es, ws in zip(known, words):
        ts = {w[2] for w in ws}
        n_e.update(es)
        n_t.update(ts)
        n_et.update((e, t) for e in es for t in ts)
    out = []
    for es, ws, places in zip(known, words, spans):
        here = []
        for s, e, t in ws:
            best = 0
            for x in es:
                ic = np.log2(len(rows) / n_e[x])
                if ic > 0:
                    best = max(best, np.log2(len(rows) * (n_et[x, t] + 0.5) / (n_e[x] * (n_t[t] + 1))) / ic)
            if best >= pii.GENERALISE and not any(s < b and a < e for a, b in places):
                here.append(f"{'removed' if best >= pii.REMOVE else 'generalised'}:{s}:{e}")
        out.append(sorted(here))
    return out


def spans_by_row(df, rows):
    got = {r.doc_id: sorted(f"{k}:{s.start}:{s.end}" for k in ("generalised", "removed") for s in r[k]) for r in df.collect()}
    return [got[i] for i, _ in rows]


def test_disclosing_words_equal_brute_force(spark, doc_rows, monkeypatch):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeéö") for _ in range(rng.randint(2, 6))) for _ in range(80)]
    entities = ["a@b.cd", "A@b.cd", "x.y@z.org", "10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 262 555 3752", "only@one.net"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30))) + "\n" + (rng.choice(entities) if rng.random() < 0.3 else "")
             + " " + (rng.choice(entities[:3]) if rng.random() < 0.2 else "")) for i in range(150)]
    rows += [(200 + i, rows[3][1] + " copied only@two.net") for i in range(12)] + [(300, None), (301, "")] + [(400 + i, t) for i, t in doc_rows if i not in (40, 41)]
    rows += [(500, "word@word.net word Word's " + "longtext " * 2000)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    d = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, term string, n_t int")
    want = disclosed(rows)
    assert spans_by_row(pii.analyse(d), rows) == want
    kinds = {s.split(":")[0] for w in want for s in w}
    assert kinds == {"generalised", "removed"}
    monkeypatch.setattr(pii, "SENT_WORDS", 1)
    monkeypatch.setattr(pii, "PIECE", r"(?s).{1,7}\p{L}*+")
    assert spans_by_row(pii.analyse(d), rows) == want


def test_disclosing_words_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = disclosed(rows)
    assert spans_by_row(pii.analyse(docs), rows) == want
    flat = [s for w in want for s in w]
    assert sum(s.startswith("removed") for s in flat) > 0 and sum(s.startswith("generalised") for s in flat) > 0


def test_a_long_list_of_addresses(spark):
    n = 40_000
    text = ", ".join(f"10.{i % 256}.{i // 256 % 256}.{i % 199}" for i in range(n))
    row = pii.analyse(spark.createDataFrame([(1, text), (2, "none")], "doc_id long, text string")).where("doc_id = 1").first()
    assert len(row.ip) == n and all(text[s.start:s.end] == s.value for s in row.ip[::997]) and row.ip[-1].end == len(text)


def test_pii_of_nothing_and_nulls(no_docs, null_docs):
    assert pii.analyse(no_docs).count() == 0
    assert all(not r[k] for r in pii.analyse(null_docs).collect() for k in pii.KINDS)


# ------------------------------------------------------------------- URLs

RULES = [urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"), urls.rule("block", "example.org/en/1"),
         urls.rule("allow", "com/fr/"), urls.rule("block", "com/de/")]


def test_rules_and_list(spark):
    rows = [(1, "http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
            (2, "https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
            (3, "https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
            (4, "http://x.com?de=/de/", "x.com", "", None, "allow"), (5, None, "", "", None, "allow"), (6, "no scheme", "", "", None, "allow"),
            (7, "ftp://www.listed.net/p/", "www.listed.net", "/p/", None, "block"), (8, "http://listed.net/p.html#top", "listed.net", "/p.html", None, "block"),
            (9, "http://listed.com/fr/", "listed.com", "/fr/", "com/fr/", "allow"), (9, "http://listed.com/fr/", "listed.com", "/fr/", "com/fr/", "allow"),
            (10, "http://org", "org", "", None, "allow"), (11, "http://a://b/c", "a:", "//b/c", None, "allow"), (12, "://", "", "", None, "allow")]
    pages = spark.createDataFrame([(r[0], r[1], "x", True) for r in rows], "page_id long, url string, canonical string, maybe boolean")
    listed = spark.createDataFrame([("listed.net/p",), ("listed.net/p",), (None,), ("listed.com/fr",)], "canonical string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(pages, listed, RULES).collect()]
    want = [(r[0], *r[2:]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    nothing = spark.createDataFrame([], "canonical string")
    assert {r.verdict for r in urls.url_filter(pages, nothing).collect()} == {"allow"}
    assert urls.url_filter(pages.limit(0), listed, RULES).count() == 0
    assert [r[0] for r in urls.repeated_pages(pages).collect()] == ["listed.net/p"] or \
        {r[0] for r in urls.repeated_pages(pages).collect()} == {"listed.net/p", "listed.com/fr"}


# ----------------------------------------------------- language and toxicity

def corpus(spark, doc_rows):
    rng = np.random.default_rng(3)
    make = lambda v, n: " ".join("".join(rng.choice(v, rng.integers(1, 4))) for _ in range(n))
    a, b = ["sch", "ung", "ei", "tz", "ver"], ["eau", "que", "oi", "é", "ment"]
    rows = [(1000 + i, make(a if i % 2 else b, 30), "aa" if i % 2 else "bb") for i in range(200)]
    rows += [(i, t, None) for i, t in doc_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_language_on_held_out_rows(spark, doc_rows):
    df, rows = corpus(spark, doc_rows)
    out = langid.remainder(df["doc_id"], 4) == 2
    model = langid.fit(df.where(~out))
    assert model.langs == ["aa", "bb"]
    got = langid.predict(df.select("doc_id", "text", "lang", out.alias("held_out")), model).collect()
    held = [r for r in got if r.held_out and r.lang]
    assert held and np.mean([r.lang == r.lang_pred for r in held]) == 1.0
    assert not any(r.rejected for r in held)
    for r in got:
        letter = r.text is not None and any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1
        assert r.rejected or letter


def test_language_without_labels(spark, no_docs, null_docs):
    assert langid.fit(no_docs) is None and langid.fit(no_docs.select("doc_id", "text", "lang")) is None
    assert {r.lang_pred for r in langid.predict(null_docs, None).collect()} == {"und"}
    model = langid.fit(null_docs)
    assert model.langs == ["aa"]
    assert langid.predict(no_docs, model).count() == 0


def test_language_model_of_more_labels_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 4)
    rows = [(10 * k + i, f"{a}{a}{b}{b} {b}{a}{b}{a} {a}{b}{b}{a}\n" * (8 + 2 * k), a + b)
            for k, (a, b) in enumerate(("bc", "df", "gh", "jk", "lm", "np", "qr")) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model.langs == sorted({r[2] for r in rows})
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows) and sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(rows)
    rates = langid.sampling_rates(df.selectExpr("lang", "length(text) as chars"), "lang", 350, 4).collect()
    assert len(rates) == 7 and all(abs(r.rate * sum(len(t) for _, t, n in rows if n == r.lang) - 200) < 1e-6 for r in rates)


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{k}ord" for k in range(400)]
    bad = ["idiotish", "scumbags", "trashyfy"]
    rows = []
    for i in range(600):
        w = list(rng.choice(vocabulary, 40))
        toxic = int(i % 5 == 0)
        if toxic:
            for k in rng.integers(0, 40, 2):
                w[k] = str(rng.choice(bad)) + str(rng.choice(["", "er", "est"]))
        rows.append((i, "\n".join([" ".join(w[:20]), "É " + " ".join(w[20:])]), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    train, test = df.where("doc_id % 3 <> 0"), df.where("doc_id % 3 = 0")
    model = toxicity.fit(train)
    got = toxicity.score(test, model).collect()
    assert np.mean([(r.score >= 0.5) == bool(r.toxic) for r in got]) > 0.97
    hit = next(r for r in got if r.toxic and r.score >= 0.5)
    assert all(hit.text[s.start:s.end][:5] in {b[:5] for b in bad} for s in hit.toxic_spans)


def test_messages_equal_enumeration():
    rng = np.random.default_rng(0)
    trans, x = rng.uniform(0.2, 2, (2, 2)), rng.uniform(0.1, 3, 7)
    heads = np.array([0, 4])
    f, b = toxicity.messages(x, trans, heads)
    p = f * b / (1 + f * b)
    for lo, hi in ((0, 4), (4, 7)):
        n = hi - lo
        mass = np.zeros((n, 2))
        for code in range(2 ** n):
            s = [(code >> k) & 1 for k in range(n)]
            w = np.prod([x[lo + k] if s[k] else 1 for k in range(n)]) * np.prod([trans[s[k], s[k + 1]] for k in range(n - 1)])
            for k in range(n):
                mass[k, s[k]] += w
        assert np.allclose(p[lo:hi], mass[:, 1] / mass.sum(axis=1))


def test_field_is_fitted_on_lines_of_all_slices(monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_LINES", 80)
    features = np.arange(1, 21, dtype=np.uint64)
    model = toxicity.Model(features, np.full(20, 1.0), -4.0, 0.0, 0.0, np.ones((2, 2)), np.zeros(3))
    one = np.zeros((40, 4), np.uint64)
    toxicity._fit_field(model, [(np.concatenate([one[:, :3], one[:, 3:] + f], 1), np.arange(40), np.ones(40, bool)) for f in features])
    assert (model.weights[10:] > 1).sum() >= 8


def test_toxicity_of_nothing(spark, docs, no_docs, null_docs):
    flat = toxicity.fit(no_docs.selectExpr("doc_id", "text", "1 as toxic"))
    assert toxicity.score(no_docs, flat).count() == 0
    rows = toxicity.score(docs, flat, name="chance").collect()
    assert len({r.chance for r in rows}) == 1 and all(not r.toxic_spans for r in rows)
    assert toxicity.score(null_docs, flat).count() == 4


def test_new_columns_never_hide_given_ones(spark):
    d = spark.createDataFrame([(1, "mo ta", "aa", 1, 0.5)], "doc_id long, text string, lang string, toxic int, Score double")
    for add in (lambda: langid.predict(d, None), lambda: toxicity.score(d, toxicity.fit(d))):
        with pytest.raises(ValueError, match="score"):
            add()
    assert langid.predict(d, None, score="other").first()["other"] == 0
