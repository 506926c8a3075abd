"""Enrichment routes, suffix enrichment, topics, streaming = batch, contract."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from annolink import schema
from annolink.operators import audit, codec, enrich
from annolink.sources import dumps, topics
from annolink.streaming import jobs

SF = "/root/testdata/sf0.001"


def _env(spark, rows):
    return spark.createDataFrame(rows, "topic string, key long, value string")


def _post(i, text, **over):
    p = {"id": i, "text": text, "lang": "en", "user": {"id": 1, "name": "a"}, "retweet_count": 1,
         "favorite_count": 2, "timestamp_ms": 3}
    p.update(over)
    return json.dumps(p)


def test_suffix_enrichment(spark):
    env = _env(spark, [("raw", 1, _post(1, "The ferry is late again.")), ("raw", 2, _post(2, "Fog again")),
                       ("raw", 3, _post(3, "x" * 275)), ("raw", 4, _post(4, "nan")), ("raw", 5, "text")])
    senti = lambda p: F.when(p["text"] == "nan", F.lit(float("nan"))).otherwise(F.lit(0.5))
    fn = enrich.suffix_enrichment(" (seen)", senti, [dict(url="u", expanded_url="u", display_url="Ferry",
                                                             indices=(4, 9))])
    rows = {r["key"]: r for r in enrich.enrich_rowwise(env, fn).collect()}
    assert rows[1]["route"] == "enriched"
    v = json.loads(rows[1]["value"])
    assert v["text"] == "The ferry is late again. (seen)"
    assert v["entities"]["hashtags"] == [{"indices": [14, 21], "text": "#bigdata"}]
    assert v["entities"]["urls"][0]["display_url"] == "Ferry"
    assert rows[3]["reason"] == "text_too_long"
    assert rows[4]["reason"] == "sentiment_out_of_range"
    assert rows[5]["route"] == "passthrough"


def test_fan_out_and_audit(spark):
    env = _env(spark, [(None, 1, _post(1, "a")), (None, 2, _post(2, "b"))]).drop("topic")
    assert topics.fan_out(env, []).count() == 0
    two = topics.fan_out(env, " raw , rich ")
    assert sorted(r["topic"] for r in two.collect()) == ["raw", "raw", "rich", "rich"]
    posts = codec.valid_posts(codec.decode_posts(two), ["topic"])
    a = audit.delivery_audit(posts).collect()
    assert all(r["n_copies"] == 2 and r["n_enriched"] == 0 and not r["complete"] for r in a)
    assert audit.unknown_ids(posts, posts.where("id = 1")).count() == 2


def test_bounded_collect(spark):
    df = spark.range(100).withColumnRenamed("id", "offset")
    assert [r["offset"] for r in topics.bounded_collect(df, 3).collect()] == [0, 1, 2]


def test_message_dump(spark):
    d = tempfile.mkdtemp(prefix="annolink-dump-")
    p = os.path.join(d, "dump.jsonl")
    big = _post(9, "x", lang="y" * 500001)
    with open(p, "w") as f:
        f.write("\n".join([_post(1, "hi"), "", "   ", "{broken", big]) + "\n")
    rows = dumps.read_message_dump(spark, p).select("reason", "post.id").collect()
    assert sorted((r["reason"] or "") for r in rows) == ["", "malformed_json", "oversize"]


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="annolink-stream-")
    src = os.path.join(base, "in")
    env = _env(spark, [("raw", i, _post(i, f"post number {i}") if i % 3 else f"plain {i}") for i in range(30)])
    env.write.parquet(src)
    fn = enrich.suffix_enrichment("!", lambda p: F.lit(0.5))
    batch = sorted(tuple(r) for r in enrich.enrich_rowwise(env, fn).collect())
    out = jobs.run_enrich_stream(spark, src, os.path.join(base, "out"), lambda s: enrich.enrich_rowwise(s, fn),
                                 checkpoint=os.path.join(base, "ckpt"), max_files_per_trigger=1)
    assert sorted(tuple(r) for r in out.select(*env.columns, "route", "reason").collect()) == batch
    # restart on the same checkpoint: nothing is written twice
    again = jobs.run_enrich_stream(spark, src, os.path.join(base, "out"), lambda s: enrich.enrich_rowwise(s, fn),
                                   checkpoint=os.path.join(base, "ckpt"))
    assert again.count() == len(batch)


def test_contract(spark):
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    from annolink.plans.registry import QUERIES
    assert set(QUERIES) <= set(o) <= set(q)
    df = E.entry(spark)
    assert df.count() > 1500       # posts of 200 documents
    assert df.where("route = 'enriched'").count() > 0.8 * df.count()
    assert df.columns == ["key", "route", "reason", "n_urls", "n_hashtags", "text_len"]


def test_track_terms_forms_agree(spark):
    from annolink.operators import guard
    posts = spark.createDataFrame([(1, "Big data in Hamburg"), (2, "nothing"), (3, "MIT License text"),
                                   (4, "license only")], "id long, text string")
    by_col = sorted(r["id"] for r in guard.track_terms(posts, "hamburg, mit license").collect())
    assert by_col == [1, 3]
    terms = spark.createDataFrame([("Hamburg",), ("nothing",)], "term string")
    for max_bytes in (1 << 20, 0):
        by_join = sorted(r["id"] for r in guard.track_terms_join(posts, terms, max_bytes=max_bytes).collect())
        assert by_join == [1, 2]


def test_term_tables_sent_and_joined_agree(spark):
    import random
    from annolink.operators import guard
    rng = random.Random(4)
    words = ["the", "a", "tide", "reef", "buoy", "Öl", "#kelp", "@jo", "mast"]
    posts = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 7)))) for i in range(200)] + [(500, None), (501, "the the")],
                                  "id long, text string")
    terms = [(" ".join(rng.choice(words) for _ in range(rng.randint(2, 4))),) for _ in range(25)] + [("#kelp reef",), ("nowhere the",), (None,), ("  ",), ("the the",)]
    wanted = [t for t, in terms if t and t.strip()]
    got = [sorted(r["id"] for r in guard.track_terms_join(posts, spark.createDataFrame(terms, "term string"), max_bytes=b).collect()) for b in (1 << 20, 0)]
    plain = sorted(r["id"] for r in guard.track_terms(posts, wanted).collect())
    assert got[0] == got[1] == plain and 20 < len(plain)
    none = spark.createDataFrame([], "term string")
    assert all(guard.track_terms_join(posts, none, max_bytes=b).count() == 0 for b in (1 << 20, 0))


def test_file_topics_roundtrip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="annolink-topics-"), "t")
    env = _env(spark, [(None, 1, _post(1, "a")), (None, 2, "plain")]).drop("topic")
    topics.write_topics(topics.fan_out(env, "raw,rich"), path)
    back = topics.read_topics(spark, path, "rich")
    assert sorted(r["key"] for r in back.collect()) == [1, 2]
    assert set(r["topic"] for r in back.collect()) == {"rich"}
