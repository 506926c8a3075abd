"""Guards and routing: JSON-object guard, length, oversize, track terms."""

from __future__ import annotations

import sys
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from annolink import config
from annolink._util import col_of
from annolink.functions.text import java_trim, split_terms, starts_with_brace, utf16_length
from annolink.operators.lookup import SENT_BYTES, bloom_of, in_process, rows_if_small

try:  # ship the helpers of track_terms_join by value
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

WORD_SPLIT = r"[^\p{L}\p{N}]+"
MARKED = r"[#@][\p{L}\p{N}]+"


def json_guard_drop(df: DataFrame, value: str = "value") -> DataFrame:
    """Consumer guard: keep only values starting with ``{`` (null dropped)."""
    return df.where(starts_with_brace(value))


def is_json_object(value="value") -> Column:
    """Enrichment guard as a never-null boolean (null values are passed on)."""
    return F.coalesce(starts_with_brace(col_of(value)), F.lit(False))


def route_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``route``: ``enrich`` for ``{...`` values, ``pass`` for everything
    else including null.  Row count is preserved."""
    return df.withColumn("route", F.when(is_json_object(value), F.lit("enrich")).otherwise(F.lit("pass")))


def text_within_limit(text="text", max_units: int = config.MAX_TEXT_UNITS) -> Column:
    """Trimmed text length (UTF-16 units) <= limit."""
    return utf16_length(java_trim(col_of(text))) <= F.lit(max_units)


def oversize(value="value", max_bytes: int = config.MAX_MESSAGE_BYTES) -> Column:
    return F.octet_length(col_of(value)) > F.lit(max_bytes)


def _term_words(terms) -> list[list[str]]:
    out = []
    for t in split_terms(terms):
        words = [w for w in t.lower().split() if w]
        if words:
            out.append(words)
    return out


def text_words(text="text") -> Column:
    """Distinct lower-case words, and the marked ones (``#word``, ``@word``) as well."""
    low = F.lower(col_of(text))
    return F.array_distinct(F.concat(F.split(low, WORD_SPLIT), F.regexp_extract_all(low, F.lit(MARKED), F.lit(0))))


def track_match(text="text", terms: str | list[str] = "") -> Column:
    """True when any term matches: a term is one or more words, all of which
    must occur as words of the text (case-insensitive).  Terms are OR-ed.  A
    plain word also matches behind a marker; ``#word`` matches the hashtag only."""
    phrases = _term_words(terms)
    if not phrases:
        return F.lit(False)
    single = [p[0] for p in phrases if len(p) == 1]
    multi = [p for p in phrases if len(p) > 1]

    def matches(words: Column) -> Column:
        expr = F.arrays_overlap(words, F.array(*[F.lit(w) for w in single])) if single else F.lit(False)
        for p in multi:
            expr = expr | (F.size(F.array_except(F.array(*[F.lit(w) for w in p]), words)) == 0)
        return expr

    # one element: the words are split once, not again for every term
    return F.coalesce(F.get(F.transform(F.array(text_words(text)), matches), 0), F.lit(False))


def track_terms(df: DataFrame, terms, text: str = "text") -> DataFrame:
    return df.where(track_match(text, terms))


def _index(terms: list[list[str]]) -> dict[str, list[tuple[str, ...]]]:
    """Each term under the word that the fewest terms have -> its other words."""
    spread: dict[str, int] = {}
    for words in terms:
        for w in words:
            spread[w] = spread.get(w, 0) + 1
    index: dict[str, list[tuple[str, ...]]] = {}
    for words in terms:
        rare = min(words, key=lambda w: (spread[w], w))
        index.setdefault(rare, []).append(tuple(w for w in words if w != rare))
    return index


def _has_term(sent, name: str):
    @F.pandas_udf("boolean")
    def has(words: pd.Series) -> pd.Series:
        index = in_process(name, lambda: _index(sent.value))

        def match(ws) -> bool:
            own = set(ws)
            return any(w in index and any(own.issuperset(rest) for rest in index[w]) for w in own)
        return words.map(lambda ws: ws is not None and match(ws))
    return has


def _in_filter(sent):
    @F.pandas_udf("array<string>")
    def kept(words: pd.Series) -> pd.Series:
        bloom, known = sent.value, {}

        def there(w) -> bool:
            if w not in known:
                if len(known) > 100_000:
                    known.clear()
                known[w] = w in bloom
            return known[w]
        return words.map(lambda ws: [w for w in ws if there(w)] if ws is not None else [])
    return kept


def track_terms_join(df: DataFrame, terms: DataFrame, key: str = "id", text: str = "text",
                     term: str = "term", max_bytes: int = SENT_BYTES) -> DataFrame:
    """Terms held in a table (any size): a text matches a term when it has all of
    its words.

    Terms of up to ``max_bytes`` are sent to the workers, each indexed under one of its
    words, and texts are judged where they are.  More terms are joined: each is indexed
    under its word that the fewest texts have, only such words of a text (a Bloom filter
    tells) are shuffled, and a term's other words are looked up by text and word."""
    low = F.lower(F.trim(F.col(term)))
    t = terms.select(low.alias("_term")).where("_term <> ''").distinct()
    t = t.select("_term", F.array_distinct(F.split("_term", r"\s+")).alias("_ws"))
    sc = df.sparkSession.sparkContext
    rows = rows_if_small(t.select("_term"), max_bytes)
    if rows is not None:
        sent = sc.broadcast([list(dict.fromkeys(r["_term"].split())) for r in rows])
        return df.where(_has_term(sent, f"terms {uuid.uuid4().hex}")(text_words(text)))

    def words_in(table: DataFrame) -> DataFrame:
        bloom = sc.broadcast(bloom_of(table.select("_w").distinct(), "_w"))
        return df.select(key, F.explode(_in_filter(bloom)(text_words(text))).alias("_w"))

    every = t.select("_term", F.explode("_ws").alias("_w"))
    texts = words_in(every).groupBy("_w").agg(F.count(F.lit(1)).alias("_texts"))
    # a term with a word that no text has has no row for it, and falls out
    known = (every.join(texts, "_w").groupBy("_term").agg(F.min(F.struct("_texts", "_w")).alias("_rare"), F.count(F.lit(1)).alias("_n"))
             .join(t, "_term").where(F.col("_n") == F.size("_ws")))
    index = known.select("_term", F.col("_rare._w").alias("_w"), F.array_except("_ws", F.array("_rare._w")).alias("_rest"))
    found = words_in(index).join(index, "_w").select(key, "_term", "_rest")
    rest = found.where(F.size("_rest") > 0).select(key, "_term", F.size("_rest").alias("_n"), F.explode("_rest").alias("_w"))
    whole = (rest.join(words_in(every), [key, "_w"]).groupBy(key, "_term").agg(F.count_distinct("_w").alias("_got"), F.max("_n").alias("_n"))
             .where("_got = _n"))
    hits = found.where(F.size("_rest") == 0).select(key).union(whole.select(key)).distinct()
    return df.join(hits, key, "left_semi")
