"""Registered queries: one per operator of the inventory, each reading the
given tables (or data Spark derives from them) in full, plus the equivalent
DuckDB SQL used as the correctness oracle.

Nested results are flattened to scalar columns so both engines compare
value by value; every computed column is aliased to the same name on both sides.
"""

from __future__ import annotations

import os
import sys
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from annolink import config
from annolink.functions.keys import key_bytes_to_long, long_to_key_bytes
from annolink.functions.text import comma_list, java_trim, page_label, page_name, utf16_length
from annolink.operators import annotate, audit, codec, enrich, gate, guard, link, report
from annolink.operators.joins import text_key
from annolink.session import scratch_path
from annolink.schema import ENTITIES
from annolink.sources import derived, dumps, topics
from annolink.sources.links import write_links

Query = Callable[[SparkSession, str], DataFrame]

try:  # the demo client below runs on executors: ship it by value
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover
    pass

SUFFIX = " (checked)"
URLS_TYPE = ENTITIES["urls"].dataType
TRACK_TERMS = "that, with, released, mit license"


def _sentiment(post):
    """A deterministic stand-in for a user's sentiment function (some values
    fall outside [0, 1] on purpose)."""
    return ((post["id"] % 23) - 1) / F.lit(20.0)


# ------------------------------------------------------------------ helpers

def _ann(spark, sf):
    return derived.stored_annotations(spark, sf)


def _link_cols(c="link"):
    l = F.col(c)
    return [l["url"].alias("url"), l["expanded_url"].alias("expanded_url"),
            l["display_url"].alias("display_url"), F.get(l["indices"], 0).alias("idx_start"),
            F.get(l["indices"], 1).alias("idx_end")]


def _stored_enriched_posts(spark, sf):
    return annotate.stored_lookup(derived.posts_from_documents(spark, sf), _ann(spark, sf))


def _stored_links(spark, sf):
    return link.group_links(link.kept_links(_ann(spark, sf)))


def _enrich_stored_frame(spark, sf, envelopes=None):
    env = envelopes if envelopes is not None else derived.envelopes_from_documents(spark, sf)
    links = _stored_links(spark, sf).withColumnRenamed("id", "jkey")
    return enrich.enrich_with_links(env, links, lambda p: p["id"])


def _route_summary(df: DataFrame) -> DataFrame:
    e = F.from_json("value", "entities struct<hashtags:array<string>,urls:array<string>>, text string")
    enriched = F.col("route") == "enriched"
    return df.select(F.col("key"), "route", "reason",
                     F.when(enriched, F.size(e["entities"]["urls"])).alias("n_urls"),
                     F.when(enriched, F.size(e["entities"]["hashtags"])).alias("n_hashtags"),
                     F.when(enriched, F.length(e["text"])).alias("text_len"))


def _suffix_frame(spark, sf):
    env = derived.envelopes_from_documents(spark, sf)
    fn = enrich.suffix_enrichment(SUFFIX, _sentiment, [dict(
        url="https://en.wikipedia.org/wiki/Lighthouse", expanded_url="https://en.wikipedia.org/wiki/Lighthouse",
        display_url="Lighthouse", indices=(4, 14))])
    return enrich.enrich_rowwise(env, fn)


def _rich_topic(spark, sf):
    """What the enrichment puts on the rich topic (quarantined posts stay away)."""
    out = _suffix_frame(spark, sf).where(F.col("route") != "quarantine")
    return out.select(F.lit(config.RICH_TOPIC).alias("topic"), "key", "value", "offset")


def _gazetteer(spark, sf):
    return annotate.Dictionary(derived.gazetteer_from_benchmark(spark, sf))


#: Bytes of documents' text for one message file.
FILE_TEXT = 32 << 20


def _stream_source(spark, sf, df, name, slices=8):
    """``df`` as a folder of message files in order of arrival.  It arrives in ``slices`` of
    as many files each as the documents' texts need.  Returns the base folder and the
    files of a slice."""
    base = _stream_dir(spark, name)
    text = derived.table(spark, sf, "documents", parallel=False).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = -(-text // (slices * FILE_TEXT)) or 1
    df.repartitionByRange(slices * files, "offset").write.option("parquet.block.size", str(topics.ROW_GROUP)).parquet(os.path.join(base, "in"))
    return base, files


def _flat_post(p="post"):
    c = F.col(p)
    return [c["id"].alias("id"), c["lang"].alias("lang"), c["user"]["id"].alias("user_id"),
            c["user"]["name"].alias("user_name"), c["user"]["followersCount"].alias("followers"),
            c["retweet_count"].alias("retweet_count"), c["favorite_count"].alias("favorite_count"),
            c["timestamp_ms"].alias("timestamp_ms"), utf16_length(c["text"]).alias("text_units")]


# ------------------------------------------------------------------ queries

def q_annotation_links(spark, sf):
    return link.kept_links(_ann(spark, sf)).select("id", "pos", *_link_cols())


def q_annotation_gate_reason(spark, sf):
    return gate.with_gate_reason(_ann(spark, sf)).select("id", "pos", "reason")


def q_annotation_gate_counts(spark, sf):
    return gate.gate_counts(_ann(spark, sf))


def q_min_support_confidence(spark, sf):
    a = _ann(spark, sf).withColumn("confidence", (F.col("id") + F.col("pos")) % 100 / F.lit(100.0))
    return gate.service_minima(a, confidence="confidence").select("id", "pos", "support", "confidence")


def q_page_label_parts(spark, sf):
    p = derived.table(spark, sf, "pages").select("page_id", "url")
    return p.select("page_id", page_name("url").alias("page"), page_label(page_name("url")).alias("label"))


def q_post_links_array(spark, sf):
    g = _stored_links(spark, sf)
    return g.select("id", F.posexplode("urls").alias("link_idx", "link")).select(
        "id", "link_idx", *_link_cols())


def q_posts_without_links(spark, sf):
    e = _stored_enriched_posts(spark, sf)
    return e.select("id", F.size("entities.urls").alias("n_links"),
                    F.size("entities.hashtags").alias("n_hashtags"))


def q_enrich_stored(spark, sf):
    return _route_summary(_enrich_stored_frame(spark, sf))


def q_json_guard_drop(spark, sf):
    return guard.json_guard_drop(derived.envelopes_from_documents(spark, sf)).select("key")


def q_json_guard_route(spark, sf):
    return guard.route_json(derived.envelopes_from_documents(spark, sf)).select("key", "route")


def q_length_check(spark, sf):
    d = derived.table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("id"), utf16_length(java_trim("text")).alias("units"),
                    guard.text_within_limit("text").alias("within_limit"))


def q_decode_posts(spark, sf):
    env = guard.json_guard_drop(derived.envelopes_from_documents(spark, sf))
    d = codec.decode_posts(env)
    return d.select("key", "reason", *_flat_post())


def q_roundtrip_posts(spark, sf):
    enc = codec.encode_posts(derived.posts_from_documents(spark, sf))
    d = codec.decode_posts(enc, max_units=1 << 30)
    return d.select("key", "reason", *_flat_post(), F.col("post.text").alias("text"))


def q_decode_annotations(spark, sf):
    d = codec.decode_annotation_response(derived.annotation_responses(spark, sf))
    rows = codec.response_to_rows(d)
    return rows.select("id", "pos", "uri", "support", F.size("types").alias("n_types"),
                       F.array_join("types", "|").alias("types_joined"), "surface_form", "offset",
                       "similarity_score", "percentage_of_second_rank")


def q_type_list(spark, sf):
    a = derived.stored_annotations(spark, sf, with_types_csv=True)
    t = comma_list("types_csv")
    return a.select("id", "pos", F.size(t).alias("n_types"), F.array_join(t, "|").alias("types_joined"),
                    link.type_class(t).alias("type_class"))


def q_annotation_report(spark, sf):
    e = _stored_enriched_posts(spark, sf)
    return e.select("id", report.annotation_report().alias("report"))


def q_text_suffix_enrich(spark, sf):
    return _route_summary(_suffix_frame(spark, sf))


def q_sentiment_range_audit(spark, sf):
    ev = derived.table(spark, sf, "events")
    s = F.col("value") / F.lit(200.0)
    ok = enrich.sentiment_in_range(s)
    return ev.groupBy("event_type").agg(F.count_if(ok).alias("n_in_range"),
                                        F.count_if(~ok).alias("n_out_of_range"))


def q_post_datetime(spark, sf):
    p = derived.posts_from_documents(spark, sf)
    return p.select("id", report.post_datetime().alias("datetime"))


def q_topic_fanout(spark, sf):
    env = derived.envelopes_from_documents(spark, sf).drop("topic")
    out = topics.fan_out(env, f"{config.RAW_TOPIC}, {config.RICH_TOPIC}")
    rec = topics.to_kafka_records(out)
    return rec.select("topic", key_bytes_to_long("key").alias("key"), F.hex("key").alias("key_hex"),
                      guard.is_json_object("value").alias("is_json"))


def q_topic_union(spark, sf):
    u = topics.union_topics(derived.envelopes_from_documents(spark, sf), _rich_topic(spark, sf))
    return u.select("topic", "key", guard.is_json_object("value").alias("is_json"))


def q_bounded_collect(spark, sf):
    ev = derived.table(spark, sf, "events").select(F.col("event_id").alias("offset"), "user_id", "props")
    return topics.bounded_collect(ev, 1000, order=("offset",))


def _consumed(spark, sf):
    """raw + rich topics read together, guarded and decoded (consumer side)."""
    u = topics.union_topics(derived.envelopes_from_documents(spark, sf), _rich_topic(spark, sf))
    d = codec.decode_posts(guard.json_guard_drop(u))
    return codec.valid_posts(d, ["topic"])


def q_delivery_audit(spark, sf):
    return audit.delivery_audit(_consumed(spark, sf))


def q_unknown_ids(spark, sf):
    """Results whose id is foreign: one id in seven is not among these inputs."""
    inputs = derived.posts_from_documents(spark, sf).where("id % 7 <> 0")
    return audit.unknown_ids(_consumed(spark, sf), inputs).groupBy("id").agg(F.count(F.lit(1)).alias("n_results"))


def q_delivery_total(spark, sf):
    """Total delivered copies against inputs x topics (all aggregates in one pass)."""
    res = _consumed(spark, sf)
    n_in = derived.posts_from_documents(spark, sf).agg(F.count(F.lit(1)).alias("n_inputs"),
                                                        F.lit(1).alias("_k"))
    n_out = res.agg(F.count(F.lit(1)).alias("n_delivered"), F.count_if(F.col("topic") == config.RICH_TOPIC)
                    .alias("n_rich"), F.lit(1).alias("_k"))
    return n_in.join(n_out, "_k").select("n_inputs", "n_delivered", "n_rich",
                                         (F.col("n_inputs") * 2).alias("n_expected"))


def q_positional_link_diff(spark, sf):
    d = codec.decode_annotation_response(derived.annotation_responses(spark, sf))
    actual = d.select("id", link.links_from_array(F.col("annotations.resources")).alias("urls"))
    expected = _stored_enriched_posts(spark, sf).select("id", F.col("entities.urls").alias("urls"))
    # faults to find: a lost display text, a lost last link, a lost post
    u = F.col("urls")
    blank = F.transform(u, lambda x: x.withField("display_url", F.lit(None).cast("string")))
    expected = expected.where("id % 13 <> 0").withColumn(
        "urls", F.when(F.col("id") % 5 == 0, blank).when((F.col("id") % 5 == 1) & (F.size(u) > 0), F.slice(u, 1, F.size(u) - 1)).otherwise(u))
    return audit.positional_link_diff(actual, expected)


def q_track_terms(spark, sf):
    p = derived.posts_from_documents(spark, sf)
    return guard.track_terms(p, TRACK_TERMS).select("id")


def q_message_dump_ingest(spark, sf):
    """One message in a thousand is padded to the size limit exactly, one over it."""
    lines = derived.envelopes_from_documents(spark, sf).select("key", "value")
    room = F.lit(config.MAX_MESSAGE_BYTES) - F.octet_length("value")
    padded = F.concat("value", F.repeat(F.lit(" "), F.when(F.col("key") % 1000 == 1, room).otherwise(room + 1).cast("int")))
    lines = lines.withColumn("value", F.when(F.col("key") % 1000 == 1, padded).when(F.col("key") % 1000 == 2, padded)
                             .otherwise(F.col("value")))
    d = dumps.ingest_lines(lines.select("value"))
    return d.select("reason", *_flat_post())


def q_dictionary_annotate(spark, sf):
    docs = derived.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    gaz = derived.gazetteer_from_benchmark(spark, sf)
    a = annotate.dictionary_annotations(docs, gaz)
    return a.select("id", "pos", "surface_form", "uri", "offset", "support")


def q_dictionary_links(spark, sf):
    posts = derived.posts_from_documents(spark, sf)
    gaz = derived.gazetteer_from_benchmark(spark, sf)
    e = annotate.dictionary_lookup(posts, gaz)
    return e.select("id", F.posexplode("entities.urls").alias("link_idx", "link")).select(
        "id", "link_idx", *_link_cols())


def _word_client():
    """A user's annotation client stand-in: a pure function text -> (status,
    JSON body) that marks every word of 9+ letters; texts containing a
    backslash answer 500 so the failure path is exercised."""
    import json
    import re

    rx = re.compile(r"[A-Za-z]{9,}")

    def call(text):
        if "\\" in text:
            return 500, ""
        res = [{"@URI": "http://dbpedia.org/resource/" + m.group(), "@support": str(len(m.group()) * 3),
                "@types": "Schema:Thing", "@surfaceForm": m.group(), "@offset": str(m.start()),
                "@similarityScore": "0.9", "@percentageOfSecondRank": "0.0"} for m in rx.finditer(text)]
        body = {"@text": text, "@confidence": "0.7", "@support": "20", "@types": "", "@sparql": "",
                "@policy": "whitelist"}
        if res:
            body["Resources"] = res
        return 200, json.dumps(body)

    return call


def q_client_annotate(spark, sf):
    posts = derived.posts_from_documents(spark, sf).select("id", "text")
    return annotate.client_annotations(posts, _word_client).select("id", "pos", "surface_form", "offset", "reason")


def q_enrich_dictionary(spark, sf):
    """JSON posts with the links that the gazetteer finds in their text, back to JSON."""
    return _route_summary(enrich.enrich_with_dictionary(derived.envelopes_from_documents(spark, sf), _gazetteer(spark, sf)))


def q_enrich_client(spark, sf):
    """The same through the user's client; failed calls go to quarantine."""
    return _route_summary(enrich.enrich_by_text(derived.envelopes_from_documents(spark, sf),
                                                lambda texts: annotate.client_links_by_text(texts, _word_client)))


def q_stream_enrich_dictionary(spark, sf):
    """The same as a stream, three slices a trigger."""
    from annolink.streaming import jobs
    base, files = _stream_source(spark, sf, derived.envelopes_from_documents(spark, sf), "stream-dictionary")
    dictionary = _gazetteer(spark, sf)
    out = jobs.run_enrich_stream(spark, f"{base}/in", f"{base}/out", lambda batch: enrich.enrich_with_dictionary(batch, dictionary),
                                 checkpoint=f"{base}/ckpt", max_files_per_trigger=3 * files, name="enrich_dictionary")
    return _route_summary(out)


def q_track_terms_join(spark, sf):
    """Terms from the benchmark's words: single words, pairs, and hashtags (no text has one of these)."""
    b = derived.table(spark, sf, "benchmark").select("item_id", F.split("text", "[^A-Za-z]+").alias("w")).where(F.size("w") > 4)
    one, two = F.get("w", 1), F.get("w", 3)
    term = (F.when(F.col("item_id") % 3 == 0, one).when(F.col("item_id") % 3 == 1, F.concat(one, F.lit(" "), two))
            .otherwise(F.concat(F.lit("#"), one)))
    return guard.track_terms_join(derived.posts_from_documents(spark, sf), b.select(term.alias("term"))).select("id")


def _stream_dir(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def q_stream_enrich(spark, sf):
    """The stored-annotation enrichment as a stream: links grouped once into a bucketed
    table, of which every micro-batch (two slices) reads the id ranges it needs."""
    from annolink.streaming import jobs
    base, files = _stream_source(spark, sf, derived.envelopes_from_documents(spark, sf), "stream-enrich")
    span = derived.max_post_id(spark, sf) // 8 + 1
    table = write_links(_stored_links(spark, sf).withColumnRenamed("id", "jkey"), f"{base}/links", span)
    out = jobs.run_stored_enrich_stream(spark, f"{base}/in", f"{base}/out", table, checkpoint=f"{base}/ckpt", max_files_per_trigger=2 * files)
    return _route_summary(out)


def q_stream_topics(spark, sf):
    """Raw and rich topic consumed together as one stream from topic folders."""
    from annolink.streaming import jobs
    base = _stream_dir(spark, "stream-topics")
    both = topics.union_topics(derived.envelopes_from_documents(spark, sf), _rich_topic(spark, sf))
    topics.write_topics(both, f"{base}/topics")
    stream = topics.topic_stream(spark, [config.RAW_TOPIC, config.RICH_TOPIC], path=f"{base}/topics", per_trigger=4)
    return jobs.run_consume_topics(stream, f"{base}/out", lambda posts: posts.select("topic", "id", utf16_length("text").alias("units")),
                                   checkpoint=f"{base}/ckpt", keep=["topic"])


def q_stream_fanout(spark, sf):
    """Every message of a stream to two topics."""
    from annolink.streaming import jobs
    base, files = _stream_source(spark, sf, derived.envelopes_from_documents(spark, sf).drop("topic"), "stream-fanout")
    out = jobs.run_fan_out_stream(spark, f"{base}/in", f"{base}/out", f"{config.RAW_TOPIC}, {config.RICH_TOPIC}", checkpoint=f"{base}/ckpt",
                                  max_files_per_trigger=3 * files)
    return out.select("topic", "key", guard.is_json_object("value").alias("is_json"))


def q_stream_track_landing(spark, sf):
    """Message dumps landing as text files: tracked posts, and messages set aside.  One
    post in ten is broken, one in a thousand over the size limit."""
    from annolink.streaming import jobs
    base = _stream_dir(spark, "stream-landing")
    room = F.lit(config.MAX_MESSAGE_BYTES + 1) - F.octet_length("value")
    posts = codec.encode_posts(derived.posts_from_documents(spark, sf))
    lines = posts.select(F.when(F.col("key") % 10 == 0, F.concat(F.lit("{broken "), F.col("key").cast("string")))
                         .when(F.col("key") % 1000 == 2, F.concat("value", F.repeat(F.lit(" "), room.cast("int")))).otherwise(F.col("value")).alias("value"))
    lines.write.text(f"{base}/in")
    accepted, rejected = jobs.run_track_stream(spark, f"{base}/in", f"{base}/out", TRACK_TERMS, checkpoint=f"{base}/ckpt", max_files_per_trigger=3)
    none = F.lit(None)
    counted = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return (accepted.select(F.lit("accepted").alias("sink"), "id", none.cast("string").alias("reason"), F.lit(1).cast("long").alias("n"))
            .unionByName(counted.select(F.lit("rejected").alias("sink"), none.cast("long").alias("id"), "reason", "n")))


def q_stream_drain(spark, sf):
    """Twice the next 1000 messages of the events topic (the limit is the feature)."""
    from annolink.streaming import jobs
    base = _stream_dir(spark, "stream-drain")
    ev = derived.table(spark, sf, "events", parallel=False).select(F.col("event_id").alias("offset"), "user_id", "props")
    last = ev.agg(F.max("offset")).first()[0] or 0
    for k in range(4):      # messages arrive file by file
        ev.where(F.floor(F.col("offset") * 4 / (last + 1)) == k).coalesce(1).write.mode("append").parquet(f"{base}/in")
    runs = [jobs.drain(spark, f"{base}/in", f"{base}/drain", 1000).withColumn("run", F.lit(k)) for k in (1, 2)]
    return runs[0].unionByName(runs[1])


def q_stream_report_text(spark, sf):
    """The report of the rich topic as lines of text files by language, read back."""
    from annolink.streaming import jobs
    base = _stream_dir(spark, "stream-report-text")
    topics.write_routes(_enrich_stored_frame(spark, sf), f"{base}/in")
    return jobs.run_report_stream(spark, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ckpt", routes=("enriched", "passthrough")).select(
        "lang", F.col("value").alias("line"))


def q_roundtrip_entities(spark, sf):
    """Hashtags and urls through the encoder and back: a hashtag for each of the first
    words of a post, a url for every third post."""
    p = derived.posts_from_documents(spark, sf).withColumn("w", F.slice(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), 1, 2))
    tags = F.transform("w", lambda w, i: F.struct(F.array(i * 100, i * 100 + F.length(w)).alias("indices"), F.concat(F.lit("#"), w).alias("text")))
    url = F.struct(F.concat(F.lit("https://e.org/?a=1&b="), F.col("id").cast("string")).alias("url"), F.lit("<x> \"y\"").alias("expanded_url"),
                   F.col("lang").alias("display_url"), F.array((F.col("id") % 7).cast("int"), (F.col("id") % 7 + 5).cast("int")).alias("indices"))
    urls = F.when(F.col("id") % 3 == 0, F.array(url)).otherwise(F.array().cast(URLS_TYPE))
    p = p.withColumn("entities", F.when(F.col("id") % 4 != 3, F.struct(tags.alias("hashtags"), urls.alias("urls")))).drop("w")
    e = codec.decode_posts(codec.encode_posts(p), max_units=1 << 30).select("key", F.col("post.entities").alias("e"))

    def rows(kind, field, **cols):
        x = e.select("key", F.posexplode(f"e.{field}").alias("pos", "x"))
        return x.select("key", F.lit(kind).alias("kind"), "pos", *[F.col(f"x.{c}").alias(n) if c else F.lit(None).cast("string").alias(n)
                                                                  for n, c in cols.items()], F.get("x.indices", 0).alias("first"), F.get("x.indices", 1).alias("last"))

    absent = e.where("e is null").select("key", F.lit("none").alias("kind"), F.lit(0).alias("pos"), *[F.lit(None).cast("string").alias(c) for c in ("label", "url", "expanded")],
                                         F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    return (rows("hashtag", "hashtags", label="text", url=None, expanded=None)
            .unionByName(rows("url", "urls", label="display_url", url="url", expanded="expanded_url")).unionByName(absent))


def q_stream_report(spark, sf):
    """Consumer stream: rich topic files -> guard -> decode -> report lines."""
    from annolink.streaming import jobs
    base = _stream_dir(spark, "stream-report")
    src = os.path.join(base, "in")
    topics.write_routes(_enrich_stored_frame(spark, sf), src)
    out = jobs.run_consume_stream(
        spark, src, os.path.join(base, "out"),
        lambda posts: posts.select("id", report.annotation_report().alias("report")),
        checkpoint=os.path.join(base, "ckpt"), routes=("enriched", "passthrough"))
    return out


QUERIES: dict[str, Query] = {
    "annotation_links": q_annotation_links,
    "annotation_gate_reason": q_annotation_gate_reason,
    "annotation_gate_counts": q_annotation_gate_counts,
    "min_support_confidence": q_min_support_confidence,
    "page_label_parts": q_page_label_parts,
    "post_links_array": q_post_links_array,
    "posts_without_links": q_posts_without_links,
    "enrich_stored": q_enrich_stored,
    "json_guard_drop": q_json_guard_drop,
    "json_guard_route": q_json_guard_route,
    "length_check": q_length_check,
    "decode_posts": q_decode_posts,
    "roundtrip_posts": q_roundtrip_posts,
    "decode_annotations": q_decode_annotations,
    "type_list": q_type_list,
    "annotation_report": q_annotation_report,
    "text_suffix_enrich": q_text_suffix_enrich,
    "sentiment_range_audit": q_sentiment_range_audit,
    "post_datetime": q_post_datetime,
    "topic_fanout": q_topic_fanout,
    "topic_union": q_topic_union,
    "bounded_collect": q_bounded_collect,
    "delivery_audit": q_delivery_audit,
    "unknown_ids": q_unknown_ids,
    "delivery_total": q_delivery_total,
    "positional_link_diff": q_positional_link_diff,
    "track_terms": q_track_terms,
    "message_dump_ingest": q_message_dump_ingest,
    "dictionary_annotate": q_dictionary_annotate,
    "dictionary_links": q_dictionary_links,
    "client_annotate": q_client_annotate,
    "enrich_dictionary": q_enrich_dictionary,
    "enrich_client": q_enrich_client,
    "stream_enrich_dictionary": q_stream_enrich_dictionary,
    "track_terms_join": q_track_terms_join,
    "stream_enrich": q_stream_enrich,
    "stream_report": q_stream_report,
    "stream_topics": q_stream_topics,
    "stream_fanout": q_stream_fanout,
    "stream_track_landing": q_stream_track_landing,
    "stream_drain": q_stream_drain,
    "stream_report_text": q_stream_report_text,
    "roundtrip_entities": q_roundtrip_entities,
}
