"""Annotation sources with one contract: posts -> annotations in the stored
table shape ``(id, pos, uri, support, types, surface_form, offset,
similarity_score, percentage_of_second_rank)``.

* ``stored_lookup``  – annotations already in a table, joined by post id;
* ``dictionary_annotations`` – an offline recogniser: a word automaton over the
  gazetteer, sent to the workers while its bytes are bounded; beyond that, word
  n-grams behind a Bloom filter of first words, joined to the gazetteer;
* ``client_annotations`` – a user's own annotation client called once per
  distinct text inside ``mapInPandas``, several calls at a time.

Joins and calls depend only on the text, so texts are de-duplicated first (partial
aggregation collapses copies before the shuffle) and results join back on a
128-bit text key.
"""

from __future__ import annotations

import sys
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from annolink.functions.tokens import WORD_PATTERN, _utf16_starts, word_spans
from annolink.operators.codec import decode_annotation_response, response_to_rows
from annolink.functions.text import utf16_length
from annolink.operators.joins import distinct_texts, hot_keys, salted_join, text_key
from annolink.operators.gate import gate_passes
from annolink.operators.link import entities_with_links, group_links, kept_links, link_struct, links_from_array
from annolink.operators.lookup import SENT_BYTES, bloom_of, in_process, rows_if_small

try:  # ship the per-partition helpers by value (no installed package needed)
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass


# ----------------------------------------------------------------- stored (JOIN-1a)

def stored_lookup(posts: DataFrame, annotations: DataFrame, key: str = "id", pos: str = "pos",
                  **gate_kw) -> DataFrame:
    """Posts with ``entities`` replaced by the kept links of their stored
    annotations (left join: posts without annotations get empty links).

    The gate runs on the annotation rows *before* the shuffle, and only kept
    links are grouped per post."""
    links = group_links(kept_links(annotations, key, pos, **gate_kw), key, pos)
    return posts.join(links, key, "left").withColumn("entities", entities_with_links("urls")).drop("urls")


# ----------------------------------------------------------------- dictionary (JOIN-1b)

class WordTrie:
    """An automaton over the words of surface forms.  A state is a dict from the next
    word to the next state; under None it has the forms that end there (forms of equal
    words may differ in what stands between them)."""

    def __init__(self, forms: list[str], pattern: str):
        self.rx = regex.compile(pattern)
        self.root: dict = {}
        for k, form in enumerate(forms):
            spans = [(m.start(), m.end()) for m in self.rx.finditer(form)]
            if not spans or spans[0][0] != 0 or spans[-1][1] != len(form):
                continue                        # a match begins and ends with a word
            state = self.root
            for s, t in spans:
                state = state.setdefault(form[s:t], {})
            state.setdefault(None, {})[form] = k

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(first word, form number, UTF-16 start, UTF-16 end)`` in text order;
        overlaps are settled longest first, then the earlier one."""
        if not text:
            return []
        root, spans, found = self.root, [m.span() for m in self.rx.finditer(text)], []
        for i, (s, t) in enumerate(spans):
            state, n = root.get(text[s:t]), i
            while state is not None:
                ends = state.get(None)
                if ends is not None:
                    k = ends.get(text[s:spans[n][1]])
                    if k is not None:
                        found.append((i, n, k))
                n += 1
                if n == len(spans):
                    break
                state = state.get(text[spans[n][0]:spans[n][1]])
        if not found:
            return []
        starts = _utf16_starts(text, [spans[i][0] for i, _, _ in found])
        ends = _utf16_starts(text, [spans[n][1] for _, n, _ in found])
        taken: set[int] = set()
        kept = []
        for _, start, i, n, end, k in sorted((s - e, s, i, n, e, k) for (i, n, k), s, e in zip(found, starts, ends)):
            if taken.isdisjoint(range(i, n + 1)):
                taken.update(range(i, n + 1))
                kept.append((i, k, start, end))
        return sorted(kept)


def one_per_form(gazetteer: DataFrame) -> DataFrame:
    """One entry per surface form: highest support, then smallest uri."""
    w = Window.partitionBy("surface_form").orderBy(F.col("support").desc(), F.col("uri"))
    return (gazetteer.where(F.col("surface_form").isNotNull() & (F.col("surface_form") != ""))
            .withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn"))


MATCH_TYPE = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("pos", "entry", "offset")])
LINKS_TYPE = T.StructType([T.StructField("url", T.ArrayType(T.StringType())), T.StructField("display", T.ArrayType(T.StringType())),
                           T.StructField("start", T.ArrayType(T.IntegerType())), T.StructField("end", T.ArrayType(T.IntegerType()))])


class Dictionary:
    """A gazetteer small enough (``max_bytes`` of strings) to be sent to the workers as an
    automaton, so texts are annotated where they are; ``sent`` is None for a larger
    one, which goes through a join."""

    def __init__(self, gazetteer: DataFrame, pattern: str = WORD_PATTERN, max_bytes: int = SENT_BYTES, **gate_kw):
        self.pattern, self.gate_kw, self.name = pattern, gate_kw, f"trie {uuid.uuid4().hex}"
        self.forms = one_per_form(gazetteer)
        self.schema = T.StructType([T.StructField("entry", T.IntegerType()), *self.forms.schema.fields])
        rows = rows_if_small(self.forms.withColumn("_kept", gate_passes(**gate_kw)).withColumn("_url", link_struct(offset=F.lit(0))["url"]), max_bytes)
        self.entries = rows and [(i, *[r[f.name] for f in self.forms.schema.fields]) for i, r in enumerate(rows)]
        self.sent = None
        if rows is not None:
            plain = [(r["surface_form"], r["_url"] if r["_kept"] else None) for r in rows]
            self.sent = gazetteer.sparkSession.sparkContext.broadcast(plain)

    def table(self, spark) -> DataFrame:
        """The entries with their numbers."""
        return spark.createDataFrame(self.entries or [], self.schema)

    def _matcher(self):
        sent, pattern, made = self.sent, self.pattern, self.name

        def matcher() -> tuple[WordTrie, list]:
            return in_process(made, lambda: WordTrie([form for form, _ in sent.value], pattern)), sent.value
        return matcher

    def matches(self, text) -> Column:
        """``struct<pos, entry, offset>`` of arrays: every match of a text."""
        matcher = self._matcher()

        @F.pandas_udf(MATCH_TYPE)
        def find(texts: pd.Series) -> pd.DataFrame:
            trie, _ = matcher()
            found = [trie.matches(t) for t in texts]
            return pd.DataFrame({"pos": [[m[0] for m in f] for f in found], "entry": [[m[1] for m in f] for f in found],
                                 "offset": [[m[2] for m in f] for f in found]})
        return find(text)

    def links(self, text) -> Column:
        """The array of a text's links: its matches that pass the gate, in text order."""
        matcher = self._matcher()

        @F.pandas_udf(LINKS_TYPE)
        def find(texts: pd.Series) -> pd.DataFrame:
            trie, rows = matcher()
            found = [[(rows[k], s, e) for _, k, s, e in trie.matches(t) if rows[k][1] is not None] for t in texts]
            return pd.DataFrame({"url": [[r[1] for r, _, _ in f] for f in found], "display": [[r[0] for r, _, _ in f] for f in found],
                                 "start": [[s for _, s, _ in f] for f in found], "end": [[e for _, _, e in f] for f in found]})
        found = find(text)
        return F.transform(F.arrays_zip(found["url"], found["display"], found["start"], found["end"]), lambda z: F.struct(
            z["url"].alias("url"), z["url"].alias("expanded_url"), z["display"].alias("display_url"),
            F.array(z["start"], z["end"]).alias("indices")))


# beyond the bound: a join of word n-grams

GRAMS_TYPE = T.StructType([
    T.StructField("k", T.ArrayType(T.IntegerType())),
    T.StructField("n", T.ArrayType(T.IntegerType())),
    T.StructField("gram", T.ArrayType(T.StringType())),
    T.StructField("start", T.ArrayType(T.IntegerType())),
])


def _grams_udf(pattern: str, max_words: int, first_words):
    """Runs of words whose first word may begin a form (a broadcast Bloom filter)."""
    rx = regex.compile(pattern)

    @F.pandas_udf(GRAMS_TYPE)
    def grams(texts: pd.Series) -> pd.DataFrame:
        ks, ns, gs, ss = [], [], [], []
        begins, known = first_words.value, {}
        for t in texts:
            spans = [m.span() for m in rx.finditer(t)] if t is not None else []
            k_, n_, g_, s_ = [], [], [], []
            for i, (s, e) in enumerate(spans):
                word = t[s:e]
                if word not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[word] = word in begins
                if known[word]:
                    for n in range(1, min(max_words, len(spans) - i) + 1):
                        k_.append(i)
                        n_.append(n)
                        g_.append(t[s:spans[i + n - 1][1]])
                        s_.append(s)
            ks.append(k_)
            ns.append(n_)
            gs.append(g_)
            ss.append(_utf16_starts(t, s_) if s_ else [])
        return pd.DataFrame({"k": ks, "n": ns, "gram": gs, "start": ss})

    return grams


def dictionary_annotations_by_text(texts: DataFrame, dictionary: Dictionary, text: str = "text",
                                   uniq: DataFrame | None = None) -> DataFrame:
    """Distinct texts -> ``(tkey, pos, annotation...)``, for a gazetteer of any size.

    The matches and their overlaps are those of ``WordTrie.matches``.  Runs of words
    whose first word passes the filter are joined with the forms; runs that occur
    very often are split over several tasks."""
    gaz = dictionary.forms
    words = word_spans("surface_form", dictionary.pattern)["words"]
    split = gaz.select(F.size(words).alias("n"), F.get(words, 0).alias("first")).where("n > 0")
    max_words = split.agg(F.max("n")).first()[0] or 1
    first = texts.sparkSession.sparkContext.broadcast(bloom_of(split.select("first").distinct(), "first"))
    uniq = uniq if uniq is not None else distinct_texts(texts, text)
    g = uniq.select("tkey", _grams_udf(dictionary.pattern, max_words, first)("text").alias("g"))
    g = g.select("tkey", F.inline(F.arrays_zip("g.k", "g.n", "g.gram", "g.start")))
    often = hot_keys(g.groupBy("gram").agg(F.count(F.lit(1)).alias("copies")), key="gram")
    # candidates are few: one exchange brings each text's together
    match = F.struct((-utf16_length("surface_form")).alias("order"), F.col("start"), F.col("k"), F.col("n"), F.col("uri"),
                     F.col("support"), F.col("types"), F.col("surface_form"), F.col("similarity_score"),
                     F.col("percentage_of_second_rank"))
    found = (salted_join(g, gaz.withColumn("gram", F.col("surface_form")), "gram", often, ["tkey", "k"]).drop("gram")
             .groupBy("tkey").agg(F.array_sort(F.collect_list(match)).alias("found")))

    def keep(kept, m):
        clash = F.exists(kept, lambda o: (o["k"] < m["k"] + m["n"]) & (m["k"] < o["k"] + o["n"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(m)))

    kept = F.aggregate("found", F.slice("found", 1, 0), keep)
    return found.select("tkey", F.explode(kept).alias("m")).select(
        "tkey", F.col("m.k").alias("pos"), "m.uri", "m.support", "m.types", "m.surface_form", F.col("m.start").alias("offset"),
        "m.similarity_score", "m.percentage_of_second_rank")


def _join_back(posts: DataFrame, per_text: DataFrame, uniq: DataFrame, key: str, text: str,
               how: str) -> DataFrame:
    """Per-text results back to every post; texts with very many copies are
    split over several tasks (``salted_join``)."""
    # null texts have no key; a hash of the row spreads them
    p = posts.withColumn("tkey", F.when(F.col(text).isNotNull(), text_key(text)).otherwise(
        F.struct(F.xxhash64(F.lit(2), key).alias("h1"), F.lit(None).cast("bigint").alias("h2"))))
    return salted_join(p, per_text, "tkey", hot_keys(uniq), [key], how).drop("tkey")


def as_dictionary(gazetteer, **kw) -> Dictionary:
    return gazetteer if isinstance(gazetteer, Dictionary) else Dictionary(gazetteer, **kw)


def dictionary_annotations(posts: DataFrame, gazetteer, key: str = "id", text: str = "text", **kw) -> DataFrame:
    """Posts -> stored-shape annotations ``(key, pos, ...)``.  ``gazetteer`` is a table or a
    prepared ``Dictionary``.  While it fits, no text is shuffled: the automaton finds
    the matches and a broadcast join of the same bounded entries adds their columns."""
    dictionary = as_dictionary(gazetteer, **kw)
    columns = ["uri", "support", "types", "surface_form", "offset", "similarity_score", "percentage_of_second_rank"]
    if dictionary.sent is None:
        uniq = distinct_texts(posts, text)
        by_text = dictionary_annotations_by_text(posts, dictionary, text, uniq)
        return _join_back(posts.select(key, text), by_text, uniq, key, text, "inner").select(key, "pos", *columns)
    found = posts.select(F.col(key), dictionary.matches(F.col(text)).alias("_m"))
    found = found.select(key, F.inline(F.arrays_zip("_m.pos", "_m.entry", "_m.offset")))
    return found.join(F.broadcast(dictionary.table(posts.sparkSession)), "entry").select(key, "pos", *columns)


def dictionary_links_by_text(texts: DataFrame, gazetteer, text: str = "text", **kw) -> DataFrame:
    """The dictionary as an annotator of texts: ``(tkey, urls, reason)`` for texts
    with kept links; ``reason`` is null."""
    dictionary = as_dictionary(gazetteer, **kw)
    if dictionary.sent is None:
        by_text = dictionary_annotations_by_text(texts, dictionary, text)
        links = group_links(kept_links(by_text, "tkey", "pos", **dictionary.gate_kw), "tkey", "pos")
    else:
        links = distinct_texts(texts, text).select("tkey", dictionary.links(F.col("text")).alias("urls")).where(F.size("urls") > 0)
    return links.withColumn("reason", F.lit(None).cast("string"))


def dictionary_lookup(posts: DataFrame, gazetteer, text: str = "text", key: str = "id", **kw) -> DataFrame:
    """Posts with entities replaced by the kept links found by the dictionary: in one
    projection while the gazetteer fits, else grouped per distinct text and joined back."""
    dictionary = as_dictionary(gazetteer, **kw)
    if dictionary.sent is not None:
        return posts.withColumn("entities", entities_with_links(dictionary.links(F.col(text))))
    uniq = distinct_texts(posts, text)
    by_text = dictionary_annotations_by_text(posts, dictionary, text, uniq)
    links = group_links(kept_links(by_text, "tkey", "pos", **dictionary.gate_kw), "tkey", "pos")
    out = _join_back(posts, links, uniq, key, text, "left")
    return out.withColumn("entities", entities_with_links("urls")).drop("urls")


# ----------------------------------------------------------------- client (JOIN-1c)

CLIENT_OUT = T.StructType([T.StructField("tkey", T.StructType([
    T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])),
    T.StructField("response", T.StringType()), T.StructField("error", T.StringType())])


#: Calls in flight for one partition; repeats of a call that failed for now; seconds before the first repeat.
CONCURRENCY, RETRIES, BACKOFF = 4, 0, 0.1


def _passing(status: int) -> bool:
    """Worth another call: the server was busy or failed."""
    return status == 429 or status >= 500


def _call_client(make_client: Callable[[], Callable[[str], tuple[int, str]]], concurrency: int, retries: int, backoff: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = threading.local()

        def call(text: str) -> tuple[str | None, str | None]:
            if not hasattr(own, "client"):
                own.client = make_client()
            error = None
            for again in range(retries + 1):
                if again:
                    time.sleep(backoff * 2 ** (again - 1))
                try:
                    status, body = own.client(text)
                    if 200 <= int(status) < 300:
                        return body, None
                    error = f"status {status}"
                    if not _passing(int(status)):
                        break
                except Exception as exc:  # the job keeps running; the row is set aside
                    error = f"{type(exc).__name__}: {exc}"
            return None, error

        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in batches:
                answers = list(pool.map(call, pdf["text"]))     # in the order of the texts
                yield pd.DataFrame({"tkey": pdf["tkey"], "response": [a for a, _ in answers], "error": [e for _, e in answers]})
    return run


def client_responses(posts: DataFrame, make_client, text: str = "text", uniq: DataFrame | None = None,
                     concurrency: int = CONCURRENCY, retries: int = RETRIES, backoff: float = BACKOFF) -> DataFrame:
    """``(tkey, response, error)`` once per distinct text.  At most ``concurrency`` calls
    of a partition are in flight, each thread with a ``make_client()`` of its own
    (``text -> (status, body)``).  A call that raised or got 429 or 5xx is repeated up to ``retries`` times,
    after ``backoff`` seconds, twice that, and so on."""
    uniq = uniq if uniq is not None else distinct_texts(posts, text)
    return uniq.select("tkey", "text").mapInPandas(_call_client(make_client, concurrency, retries, backoff), CLIENT_OUT)


def _client_decoded(posts: DataFrame, make_client, text: str, uniq: DataFrame | None = None, **calls) -> DataFrame:
    resp = decode_annotation_response(client_responses(posts, make_client, text, uniq, **calls))
    return resp.withColumn("reason", F.coalesce(F.concat(F.lit("client_error: "), "error"), "reason"))


CALL_ARGS = ("concurrency", "retries", "backoff")


def client_links_by_text(texts: DataFrame, make_client, text: str = "text", **kw) -> DataFrame:
    """The client as an annotator of texts: ``(tkey, urls, reason)``; a failed call
    or a bad response gives the reason and no links.  Texts that come with their ``tkey``
    (``joins.distinct_texts``) are taken as different."""
    calls = {k: kw.pop(k) for k in CALL_ARGS if k in kw}
    uniq = texts if "tkey" in texts.columns and text == "text" else None     # already different, with their keys
    d = _client_decoded(texts, make_client, text, uniq, **calls)
    urls = F.when(F.col("reason").isNull(), links_from_array(F.col("annotations.resources"), **kw))
    return d.select("tkey", urls.alias("urls"), "reason")


def client_annotations(posts: DataFrame, make_client, key: str = "id", text: str = "text", **calls) -> DataFrame:
    """Posts -> one frame ``(key, pos, annotation..., reason)``: a row per
    annotation, and for a failed text one row with the reason and nulls.  Rows
    and reasons come from the same pass, so each text is sent once."""
    uniq = distinct_texts(posts, text)
    joined = _join_back(posts.select(key, text), _client_decoded(posts, make_client, text, uniq, **calls), uniq, key, text, "inner")
    rows = joined.select(key, "reason", F.posexplode_outer("annotations.resources").alias("pos", "a"))
    return (rows.where(F.col("reason").isNotNull() | F.col("pos").isNotNull())
            .select(key, F.col("pos").cast("int").alias("pos"), "a.*", "reason"))
