"""Dictionary and client annotators."""

import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from annolink import schema
from annolink.operators import annotate

R = "http://dbpedia.org/resource/"

# the test client runs on executors: ship this module's functions by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _gaz(spark, rows):
    return spark.createDataFrame(
        [(sf, R + page, 50, ["Schema:Place"], 0.9, 0.0) for sf, page in rows], schema.GAZETTEER)


def test_dictionary_matches_and_overlaps(spark):
    posts = spark.createDataFrame([
        (1, "From the old lighthouse one sees the salt marsh and the mill."),
        (2, "A mill, a mill!"),
        (3, "A mill, a mill!"),                        # exact copy: annotated once, joined twice
        (4, "Millers are no mill."),                   # no match inside a longer word
        (5, "\U0001F600 marsh"),                       # offset counted in UTF-16 units
        (6, "aa bbb cccc ddddd"),                      # the longest wins, then what it leaves free
        (7, None),
    ], "id long, text string")
    gaz = _gaz(spark, [("lighthouse", "Lighthouse"), ("salt marsh", "Salt_marsh"), ("marsh", "Marsh"), ("mill", "Mill"),
                       ("old", "Old"), ("aa bbb", "A"), ("bbb cccc", "B"), ("cccc ddddd", "C")])
    a = annotate.dictionary_annotations(posts, gaz)
    assert "Exchange hashpartitioning" not in a._jdf.queryExecution().executedPlan().toString()
    by_join = annotate.dictionary_annotations(posts, gaz, max_bytes=0)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, by_join.collect()), key=repr)
    got = sorted((r["id"], r["surface_form"], r["offset"]) for r in a.collect())
    assert got == [(1, "lighthouse", 13), (1, "mill", 56), (1, "old", 9), (1, "salt marsh", 37),
                   (2, "mill", 2), (2, "mill", 10), (3, "mill", 2), (3, "mill", 10),
                   (4, "mill", 15), (5, "marsh", 3), (6, "aa bbb", 0), (6, "cccc ddddd", 7)]
    assert annotate.dictionary_lookup(posts, gaz).count() == 7


def test_dictionary_lookup_links(spark):
    posts = spark.createDataFrame([(1, "Skerry lighthouse and Tarn", "en"), (2, None, "en")], "id long, text string, lang string")
    gaz = _gaz(spark, [("Skerry lighthouse", "Skerry_light"), ("Tarn", "Tarn"), ("and", "Something_else_entirely")])
    for max_bytes in (1 << 20, 0):
        out = {r["id"]: r for r in annotate.dictionary_lookup(posts, gaz, max_bytes=max_bytes).collect()}
        links = [(u["url"], u["display_url"], list(u["indices"])) for u in out[1]["entities"]["urls"]]
        # the edits between page and surface form are at most 3/4 of the longer one, but for "and"
        assert links == [("https://en.wikipedia.org/wiki/Skerry_light", "Skerry lighthouse", [0, 17]),
                         ("https://en.wikipedia.org/wiki/Tarn", "Tarn", [22, 26])]
        assert out[2]["entities"]["urls"] == []


def _client():
    def call(text):
        if text.startswith("fail"):
            return 503, "busy"
        if text.startswith("boom"):
            raise RuntimeError("connection refused")
        i = text.find("Tarn")
        res = [] if i < 0 else [{"@URI": R + "Tarn", "@support": "30", "@types": "Schema:Place,",
                                 "@surfaceForm": "Tarn", "@offset": i, "@similarityScore": 0.99,
                                 "@percentageOfSecondRank": "0.0"}]
        body = {"@text": text, "@confidence": "0.7", "@support": "20", "@types": "", "@sparql": "",
                "@policy": "whitelist"}
        if res:
            body["Resources"] = res
        return 200, json.dumps(body)
    return call


def test_client_annotator(spark):
    posts = spark.createDataFrame([(1, "look at the Tarn"), (2, "nothing here"), (3, "fail please"),
                                   (4, "boom"), (5, "look at the Tarn")], "id long, text string")
    rows = annotate.client_annotations(posts, _client).collect()
    assert sorted((r["id"], r["offset"], r["types"]) for r in rows if r["pos"] is not None) == [
        (1, 12, ["Schema:Place"]), (5, 12, ["Schema:Place"])]
    f = {r["id"]: r["reason"] for r in rows if r["reason"] is not None}
    assert f[3] == "client_error: status 503" and f[4].startswith("client_error: RuntimeError")
    assert set(f) == {3, 4}


def test_client_is_called_once_per_text(spark, tmp_path):
    calls = tmp_path / "calls"

    def counting():
        inner = _client()

        def call(text):
            with open(calls, "a") as f:
                f.write(text + "\n")
            return inner(text)
        return call

    posts = spark.createDataFrame([(i, f"look at the Tarn {i % 4}") for i in range(12)] + [(20, "boom"), (21, "boom")], "id long, text string")
    assert annotate.client_annotations(posts, counting).count() == 14
    assert len(calls.read_text().splitlines()) == 5


def test_json_posts_are_looked_up_by_text(spark):
    from annolink.operators import enrich
    def post(i, text):
        return json.dumps({"id": i, "text": text, "lang": "en", "user": {"id": 1, "name": "a"}, "retweet_count": 1,
                           "favorite_count": 2, "timestamp_ms": 3})
    env = spark.createDataFrame([(1, post(1, "look at the Tarn")), (2, post(2, "nothing here")), (3, post(3, "boom")), (4, "plain"),
                                 (5, None), (6, post(6, "look at the Tarn"))], "key long, value string")
    gaz = _gaz(spark, [("Tarn", "Tarn")])

    def outcome(annotator):
        return {r["key"]: (r["route"], r["reason"], [u["indices"] for u in json.loads(r["value"])["entities"]["urls"]]
                           if r["route"] == "enriched" else None) for r in enrich.enrich_by_text(env, annotator).collect()}

    by_dictionary = outcome(lambda t: annotate.dictionary_links_by_text(t, gaz))
    assert by_dictionary == {1: ("enriched", None, [[12, 16]]), 2: ("enriched", None, []), 3: ("enriched", None, []),
                             4: ("passthrough", None, None), 5: ("passthrough", None, None), 6: ("enriched", None, [[12, 16]])}
    by_client = outcome(lambda t: annotate.client_links_by_text(t, _client))
    assert by_client[3][0] == "quarantine" and by_client[3][1].startswith("client_error")
    assert {k: v for k, v in by_client.items() if k != 3} == {k: v for k, v in by_dictionary.items() if k != 3}


def test_text_key_halves_are_independent(spark):
    from annolink.operators.joins import text_key
    k = spark.createDataFrame([("abc",)], "t string").select(text_key("t").alias("k")).first()["k"]
    chained = spark.createDataFrame([("abc",)], "t string").select(F.xxhash64("t", F.length("t")).alias("h")).first()["h"]
    assert k["h1"] != k["h2"] and k["h2"] != chained


def test_salted_join_equals_plain_join(spark):
    from annolink.operators.joins import hot_keys, salted_join
    big = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id") % 50)
                                   .alias("tkey"))
    small = spark.range(100).select((F.col("id") % 50).alias("tkey"), F.col("id").alias("v"))
    counts = big.groupBy("tkey").agg(F.count(F.lit(1)).alias("copies"))
    hot = hot_keys(counts, rows_per_salt=100)
    assert [r["tkey"] for r in hot.collect()] == [7]
    got = sorted(tuple(r) for r in salted_join(big, small, "tkey", hot, ["id"]).select("id", "tkey", "v").collect())
    want = sorted(tuple(r) for r in big.join(small, "tkey").select("id", "tkey", "v").collect())
    assert got == want and len(got) == 6000
    part = small.where("tkey <> 7")
    left = sorted(tuple(r) for r in salted_join(big, part, "tkey", hot, ["id"], "left").select("id", "v").collect())
    assert left == sorted(tuple(r) for r in big.join(part, "tkey", "left").select("id", "v").collect())


def test_automaton_and_join_agree_on_random_texts(spark):
    import random
    rng = random.Random(8)
    words = ["ta", "ri", "mo", "né", "ko", "東"]
    forms = {rng.choice([" ", "-"]).join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(60)} | {"(ta)", "ko ", " ", "mo. ri"}
    gaz = spark.createDataFrame([(f, R + f.replace(" ", "_"), rng.randint(1, 9), ["Schema:Thing"], rng.choice([0.5, 0.9]), 0.0) for f in sorted(forms) for _ in range(2)],
                                schema.GAZETTEER)
    posts = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", "-", ". ", "\U0001F600"]) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    posts = spark.createDataFrame(posts + [(90, posts[0][1]), (91, None), (92, "")], "id long, text string")
    columns = ["id", "pos", "uri", "support", "surface_form", "offset"]
    got = [sorted(map(tuple, annotate.dictionary_annotations(posts, gaz, max_bytes=b).select(*columns).collect())) for b in (1 << 20, 0)]
    assert got[0] == got[1] and len(got[0]) > 200
    links = [sorted((r["id"], str(r["entities"]["urls"])) for r in annotate.dictionary_lookup(posts, gaz, max_bytes=b).collect()) for b in (1 << 20, 0)]
    assert links[0] == links[1]


def test_empty_gazetteer(spark):
    posts = spark.createDataFrame([(1, "ta ri")], "id long, text string")
    for b in (1 << 20, 0):
        none = spark.createDataFrame([], schema.GAZETTEER)
        assert annotate.dictionary_annotations(posts, none, max_bytes=b).count() == 0
        assert annotate.dictionary_lookup(posts, none, max_bytes=b).first()["entities"]["urls"] == []


def test_client_calls_are_repeated_and_stay_in_order(spark, tmp_path):
    calls = tmp_path / "calls"

    def flaky():
        import time

        def call(text):
            with open(calls, "a") as f:
                f.write(text + "\n")
            n = open(calls).read().split("\n").count(text)
            time.sleep(0.02 * (9 - int(text[-1])))          # later texts answer first
            if text.startswith("bad"):
                return 404, ""
            if text.startswith("busy") and n < 3:
                return (503, "") if n == 1 else (429, "")
            return 200, json.dumps({"@text": text, "@confidence": "1", "@support": "1", "@types": "", "@sparql": "", "@policy": ""})
        return call

    texts = [f"{kind} {i}" for i, kind in enumerate(["ok", "busy", "bad", "ok", "busy", "ok", "ok", "down"])]
    uniq = spark.createDataFrame([((i, i), t) for i, t in enumerate(texts)], "tkey struct<h1:long,h2:long>, text string").coalesce(1)
    rows = annotate.client_responses(uniq, flaky, uniq=uniq, concurrency=4, retries=2, backoff=0.01).collect()
    assert [r["tkey"]["h1"] for r in rows] == list(range(8))
    assert [json.loads(r["response"])["@text"] if r["response"] else r["error"] for r in rows] == [t if t[:3] != "bad" else "status 404" for t in texts]
    made = calls.read_text().split()
    assert {k: made.count(k) for k in ("ok", "busy", "bad", "down")} == {"ok": 4, "busy": 6, "bad": 1, "down": 1}
