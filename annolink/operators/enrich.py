"""Enrichment of a keyed stream/table of JSON values (batch and streaming).

Every input row leaves exactly once with a ``route``:
* ``enriched``    – a ``{...`` value that decoded, was enriched and re-encoded;
* ``passthrough`` – any other value (also null), forwarded unchanged;
* ``quarantine``  – a ``{...`` value that was rejected; ``reason`` says why.
The reference stops on a bad record; ``strict=True`` reproduces that.

Both variants are a single pass over the input: row-wise enrichment is one
projection; link enrichment is one left join whose key is null-free (rows that
are not enriched get a hash as key, so they do not pile up in one partition).
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from annolink import config, schema
from annolink.functions.text import trimmed_longer_than
from annolink.operators.codec import _bind_once, decode_posts, post_json
from annolink.operators.guard import is_json_object
from annolink.operators.joins import distinct_texts, hot_keys, salted_join, text_key
from annolink.operators.link import entities_with_links
from annolink.session import scratch_path


def _post_value(p: Column) -> Column:
    return post_json(p["id"], p["text"], p["lang"], p["user"], p["retweet_count"],
                     p["timestamp_ms"], p["favorite_count"], p["entities"])


def decode_route(envelopes: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Adds ``route``, ``reason`` and ``post`` (route/reason computed once per
    row from the decode result, see ``codec._bind_once``)."""
    d = decode_posts(envelopes.withColumn("_obj", is_json_object(value)), value, require_user=True)

    def body(x):
        reason = F.when(x["_obj"], x["reason"])
        if strict:
            reason = F.when(reason.isNotNull(), F.raise_error(
                F.concat(F.lit("post rejected: "), reason))).otherwise(reason)
        route = (F.when(~x["_obj"], F.lit("passthrough")).when(reason.isNotNull(), F.lit("quarantine"))
                 .otherwise(F.lit("enriched")))
        return F.struct(route.alias("route"), reason.alias("reason"))

    r = _bind_once(F.struct("_obj", "reason"), body)
    return (d.withColumn("_r", r).withColumn("route", F.col("_r.route"))
            .withColumn("reason", F.col("_r.reason")).drop("_r", "_obj"))


def _finish(d: DataFrame, new_post: Column, extra: Column | None, carry: list[str], value: str) -> DataFrame:
    """Final route/reason/value, computed once per row from attribute inputs."""
    d = d.withColumn("_np", new_post).withColumn("_x", extra if extra is not None else F.lit(None).cast("string"))

    def body(x):
        enriched = x["route"] == "enriched"
        reason = F.when(enriched & x["_x"].isNotNull(), x["_x"]).otherwise(x["reason"])
        route = F.when(enriched & x["_x"].isNotNull(), F.lit("quarantine")).otherwise(x["route"])
        out = F.when(route == "enriched", _post_value(x["_np"])).otherwise(x["value"])
        return F.struct(out.alias("value"), route.alias("route"), reason.alias("reason"))

    f = _bind_once(F.struct(F.col(value).alias("value"), "route", "reason", "_np", "_x"), body)
    d = d.withColumn("_f", f)
    return d.select(*carry, F.col("_f.value").alias(value), F.col("_f.route").alias("route"),
                    F.col("_f.reason").alias("reason"))


def enrich_rowwise(envelopes: DataFrame, fn: Callable[[Column], tuple[Column, Column | None]],
                   value: str = "value", strict: bool = False) -> DataFrame:
    """``fn(post) -> (new_post, reason_or_None)`` applied to each decoded post
    (``fn`` may use any column expression, Pandas UDFs included)."""
    carry = [c for c in envelopes.columns if c != value]
    d = decode_route(envelopes, value, strict)
    new_post, extra = fn(F.col("post"))
    return _finish(d, new_post, extra, carry, value)


def enrich_with_links(envelopes: DataFrame, links: DataFrame, link_key: Callable[[Column], Column],
                      value: str = "value", strict: bool = False) -> DataFrame:
    """Replace each decoded post's entities by ``links`` (``jkey, urls`` and
    optionally ``reason``) where ``jkey = link_key(post)`` (post id for stored annotations, text key for the
    dictionary).  Posts without links get empty entities."""
    return attach_links(decode_route(envelopes, value, strict), links, link_key, value)


def attach_links(decoded: DataFrame, links: DataFrame, link_key: Callable[[Column], Column], value: str = "value",
                 hot: DataFrame | None = None) -> DataFrame:
    """``enrich_with_links`` for rows that ``decode_route`` has decoded.  ``hot``
    (``joins.hot_keys`` with the key as ``jkey``): keys whose rows are split over several tasks."""
    carry = [c for c in decoded.columns if c not in (value, "post", "route", "reason")]
    d = decoded
    kind = links.schema["jkey"].dataType
    if "reason" not in links.columns:
        links = links.withColumn("reason", F.lit(None).cast("string"))
    # rows that look nothing up get a hash as key: they are spread, and what they may find is not used
    enriched = F.col("route") == "enriched"
    rest = [F.xxhash64(F.lit(n), F.col(value), *[F.col(c) for c in carry]) for n in range(2)]
    other = F.struct(*[r.cast(f.dataType).alias(f.name) for r, f in zip(rest, kind.fields)]) if isinstance(kind, T.StructType) else rest[0].cast(kind)
    d = d.withColumn("_jk", F.when(enriched, link_key(F.col("post")).cast(kind)).otherwise(other))
    l = links.where(F.col("jkey").isNotNull()).select(F.col("jkey").alias("_lk"), "urls", F.col("reason").alias("_lreason"))
    if hot is None:
        j = d.join(l, d["_jk"] == l["_lk"], "left")
    else:
        j = salted_join(d, l.withColumnRenamed("_lk", "_jk"), "_jk", hot.withColumnRenamed("jkey", "_jk"), [value, *carry], "left")
    new_post = F.col("post").withField("entities", entities_with_links(F.col("urls")))
    return _finish(j, new_post, F.col("_lreason"), carry, value)


def enrich_by_text(envelopes: DataFrame, annotator: Callable[[DataFrame], DataFrame], value: str = "value",
                   strict: bool = False) -> DataFrame:
    """JSON in, JSON out, with links looked up by the post's text.

    ``annotator(texts)`` gets the decoded posts' different texts as ``(tkey, text)`` and
    returns ``(tkey, urls, reason)`` with one row per distinct text at most
    (``annotate.dictionary_links_by_text``, ``client_links_by_text``).  A reason
    sends the post to quarantine; a text without a row gets empty links.
    """
    decoded = decode_route(envelopes, value, strict)
    posts = decoded.where(F.col("route") == "enriched").select(F.col("post.text").alias("text"))
    # the different texts with their copies, written once: for the annotator, and to find hot ones
    path = scratch_path(envelopes.sparkSession, f"texts-{uuid.uuid4().hex}")
    distinct_texts(posts).write.parquet(path)
    uniq = envelopes.sparkSession.read.parquet(path)
    links = annotator(uniq.select("tkey", "text")).withColumnRenamed("tkey", "jkey")
    hot = hot_keys(uniq.withColumnRenamed("tkey", "jkey"), key="jkey")
    return attach_links(decoded, links, lambda post: text_key(post["text"]), value, hot)


def enrich_by_column(envelopes: DataFrame, urls: Callable[[Column], Column], value: str = "value", strict: bool = False) -> DataFrame:
    """JSON in, JSON out, with links that a column function finds in the post's text
    (``annotate.Dictionary.links``): one projection, no shuffle, batch or stream."""
    def fn(post: Column):
        return post.withField("entities", entities_with_links(urls(post["text"]))), None
    return enrich_rowwise(envelopes, fn, value, strict)


def enrich_with_dictionary(envelopes: DataFrame, dictionary, value: str = "value", strict: bool = False) -> DataFrame:
    """Links of a prepared ``annotate.Dictionary``: in one projection while it is small
    enough to be sent, else looked up by text."""
    if dictionary.sent is not None:
        return enrich_by_column(envelopes, dictionary.links, value, strict)
    from annolink.operators.annotate import dictionary_links_by_text
    return enrich_by_text(envelopes, lambda texts: dictionary_links_by_text(texts, dictionary), value, strict)


def sentiment_in_range(s: Column) -> Column:
    """In [0, 1]; null and NaN are not."""
    return F.coalesce((s >= 0) & (s <= 1) & ~F.isnan(s), F.lit(False))


def suffix_enrichment(suffix: str, sentiment: Callable[[Column], Column], urls: list[dict] | None = None,
                      max_units: int = config.MAX_TEXT_UNITS):
    """Row-wise enrichment: append ``suffix`` to the text, attach one constant
    hashtag and the given urls; the sentiment must lie in [0, 1] (NaN and null
    fail) and is not emitted; the new text must still fit the limit."""
    urls = urls or []
    url_items = [F.struct(F.lit(u["url"]).alias("url"), F.lit(u["expanded_url"]).alias("expanded_url"),
                          F.lit(u["display_url"]).alias("display_url"),
                          F.array(*[F.lit(int(i)) for i in u["indices"][:2]]).alias("indices")) for u in urls]
    urls_col = F.array(*url_items) if url_items else F.array().cast(schema.ENTITIES["urls"].dataType)
    tag = F.struct(F.array(*[F.lit(i) for i in config.FAKE_HASHTAG_INDICES]).alias("indices"),
                   F.lit(config.FAKE_HASHTAG_TEXT).alias("text"))

    def fn(post: Column):
        s = sentiment(post).cast("double")
        text = F.concat(post["text"], F.lit(suffix))
        reason = (F.when(~sentiment_in_range(s), F.lit("sentiment_out_of_range"))
                  .when(trimmed_longer_than(text, max_units), F.lit("text_too_long")))
        entities = F.struct(F.array(tag).alias("hashtags"), urls_col.alias("urls"))
        return post.withField("text", text).withField("entities", entities), reason

    return fn
