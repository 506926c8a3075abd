"""Edge table: one row per trap with a hand-computed answer."""

import json
import math

import pytest
from pyspark.sql import functions as F

from annolink.functions.keys import key_bytes_to_long, long_to_key_bytes
from annolink.functions.text import comma_list, java_trim, page_name, pad_right_keep, utf16_length
from annolink.operators import codec, guard
from annolink.operators.gate import gate_reason
from annolink.operators.report import annotation_report, post_datetime

USER = {"id": 1, "name": "n", "screenName": "s", "location": "l", "followersCount": 5}


def post(**over):
    p = {"id": 1, "text": "hello", "lang": "en", "user": USER, "retweet_count": 0,
         "favorite_count": 0, "timestamp_ms": 1700000000000}
    p.update(over)
    return json.dumps({k: v for k, v in p.items() if v is not _DROP})


_DROP = object()


def decode_one(spark, value, **kw):
    df = spark.createDataFrame([(value,)], "value string")
    return codec.decode_posts(df, **kw).first()


@pytest.mark.parametrize("value,kept", [
    ('{"a":1}', True), (' {"a":1}', False), ("plain", False), ("", False), (None, False)])
def test_guard(spark, value, kept):
    df = spark.createDataFrame([(value,)], "value string")
    assert guard.json_guard_drop(df).count() == (1 if kept else 0)
    assert guard.route_json(df).first()["route"] == ("enrich" if kept else "pass")


@pytest.mark.parametrize("value,reason", [
    ('{"id": 1, "text": "x"', "malformed_json"),
    (post(text=_DROP), "missing_text"),
    (post(entities=None), "null_entities"),
    (post(entities={}), "invalid_entities"),
    (post(id="abc"), "invalid_id"),
    (post(entities={"hashtags": [{"indices": [1], "text": "#a"}], "urls": []}), "invalid_hashtag"),
    (post(entities={"hashtags": [], "urls": [{"url": "u", "expanded_url": "e", "indices": [0, 1]}]}),
     "invalid_url"),
    (post(text="x" * 281), "text_too_long"),
    (post(text="\U0001F600" * 141), "text_too_long"),
])
def test_decode_rejects(spark, value, reason):
    assert decode_one(spark, value)["reason"] == reason


def test_decode_accepts(spark):
    r = decode_one(spark, post(id="12", retweet_count="3", text="x" * 280))
    assert r["reason"] is None and r["post"]["id"] == 12 and r["post"]["retweet_count"] == 3
    r = decode_one(spark, post(text="\t\n" + "x" * 280 + " \n"))
    assert r["reason"] is None
    r = decode_one(spark, post(text="\U0001F600" * 140))
    assert r["reason"] is None
    r = decode_one(spark, post(user={"id": 3, "name": "a", "screen_name": "b"}))
    assert r["post"]["user"]["screenName"] is None and r["post"]["user"]["followersCount"] == 0
    r = decode_one(spark, post(entities={"hashtags": [{"indices": [1, 2, 3], "text": "#a"}], "urls": []}))
    assert list(r["post"]["entities"]["hashtags"][0]["indices"]) == [1, 2]
    r = decode_one(spark, post(entities=_DROP))
    assert r["reason"] is None and r["post"]["entities"] is None
    r = decode_one(spark, "{id: 1, text: 'x', lang: 'en', user: {}, retweet_count: 0, "
                          "favorite_count: 0, timestamp_ms: 5 /* lenient */}")
    assert r["reason"] is None and r["post"]["text"] == "x"


def test_missing_user_only_required_for_enrichment(spark):
    v = post(user=_DROP)
    assert decode_one(spark, v)["reason"] is None
    assert decode_one(spark, v, require_user=True)["reason"] == "missing_user"


def test_encode_omits_nulls_and_absent_entities(spark):
    r = decode_one(spark, post(user={"id": 3, "name": "a"}))
    df = spark.createDataFrame([r["post"]], codec.schema.POST)
    js = json.loads(codec.encode_posts(df).first()["value"])
    assert list(js)[0] == "typ" and js["typ"] == "tweet"
    assert "entities" not in js and "screenName" not in js["user"] and js["user"]["followersCount"] == 0


@pytest.mark.parametrize("s,expected", [("", [""]), ("a, b", ["a", "b"]), ("a,b,,", ["a", "b"]),
                                        (",", []), (" a ,\tb\n", ["a", "b"]), (",a", ["", "a"])])
def test_comma_list(spark, s, expected):
    assert spark.range(1).select(comma_list(F.lit(s)).alias("x")).first()["x"] == expected


def test_text_functions(spark):
    r = spark.range(1).select(
        java_trim(F.lit("\t a \n")).alias("t"), utf16_length(F.lit("\U0001F600a")).alias("u"),
        page_name(F.lit("abc")).alias("p1"), page_name(F.lit("http://x/y/")).alias("p2"),
        page_name(F.lit("http://x/Caf%C3%A9")).alias("p3"),
        pad_right_keep(F.lit("abc"), 5).alias("pad1"), pad_right_keep(F.lit("abcdefg"), 5).alias("pad2"),
        key_bytes_to_long(long_to_key_bytes(F.lit(-5).cast("long"))).alias("k1"),
        F.hex(long_to_key_bytes(F.lit(255).cast("long"))).alias("k2"),
        post_datetime(F.lit(1700000000000)).alias("dt")).first()
    assert r["t"] == "a" and r["u"] == 3
    assert (r["p1"], r["p2"], r["p3"]) == ("abc", "", "Caf%C3%A9")
    assert (r["pad1"], r["pad2"]) == ("abc  ", "abcdefg")
    assert r["k1"] == -5 and r["k2"] == "00000000000000FF"
    assert r["dt"] == "2023-11-14T22:13:20"


@pytest.mark.parametrize("sim,sr,uri,sf,reason", [
    (0.7, 0.0, "x/A", "A", "keep"), (math.nextafter(0.7, 0), 0.0, "x/A", "A", "low_similarity"),
    (float("nan"), 0.0, "x/A", "A", "keep"),
    (0.9, 0.1, "x/A", "A", "keep"), (0.9, math.nextafter(0.1, 1), "x/A", "A", "close_second_rank"),
    (0.9, float("nan"), "x/A", "A", "keep"),
    (0.9, 0.0, "x/abcd", "wxyd", "keep"),          # 3 of 4 = 0.75 kept
    (0.9, 0.0, "x/abcd", "wxyz", "far_edit_distance"),
    (0.9, 0.0, "x/", "", "keep"),                  # 0/0 kept
    (None, 0.0, "x/A", "A", "invalid_annotation"),
])
def test_gate_boundaries(spark, sim, sr, uri, sf, reason):
    df = spark.createDataFrame([(sim, sr, uri, sf)], "similarity_score double, "
                               "percentage_of_second_rank double, uri string, surface_form string")
    assert df.select(gate_reason().alias("r")).first()["r"] == reason


def test_report_padding(spark):
    urls = [("u1", "u1", "short", [3, 8]), ("u2", "u2", "x" * 25, [0, 25]), ("u3", "u3", "y" * 30, [1, 31])]
    df = spark.createDataFrame([(7, ([], urls)), (8, ([], [])), (9, None)],
                               "id long, entities struct<hashtags:array<struct<indices:array<int>,text:string>>,"
                               "urls:array<struct<url:string,expanded_url:string,display_url:string,"
                               "indices:array<int>>>>")
    rows = {r["id"]: r["r"] for r in df.select("id", annotation_report().alias("r")).collect()}
    assert rows[8] == "" and rows[9] == ""
    assert rows[7] == ("Annotations or tweet: 7\n" + "\tshort" + " " * 20 + "at 3:\tu1\n"
                       + "\t" + "x" * 25 + "at 0:\tu2\n" + "\t" + "y" * 30 + "at 1:\tu3\n")


def test_gate_counts_utf16_units(spark):
    # page "ab" against two emoji: four units apart of four, so over 3/4
    df = spark.createDataFrame([("http://x/ab", "\U0001F600\U0001F600", 0.9, 0.0), ("http://x/abc\U0001F600", "abc\U0001F600", 0.9, 0.0)],
                               "uri string, surface_form string, similarity_score double, percentage_of_second_rank double")
    assert [r[0] for r in df.select(gate_reason()).collect()] == ["far_edit_distance", "keep"]


def test_gate_filter_equals_its_reason(spark, tmp_path):
    from annolink.operators.gate import gate, with_gate_reason
    nan = float("nan")
    rows = [("http://x/ab", "ab", s, r) for s in (0.7, 0.699, nan, None, 1.0) for r in (0.1, 0.101, nan, None, 0.0)] + [(None, "ab", 0.9, 0.0), ("http://x/zz", "ab", 0.9, 0.0)]
    spark.createDataFrame(rows, "uri string, surface_form string, similarity_score double, percentage_of_second_rank double").write.parquet(str(tmp_path / "a"))
    df = spark.read.parquet(str(tmp_path / "a"))
    kept = gate(df)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, kept.collect())) == sorted(map(key, with_gate_reason(df).where("reason = 'keep'").drop("reason").collect()))
    assert "GreaterThanOrEqual(similarity_score,0.7)" in kept._jdf.queryExecution().toString()


def test_track_terms_markers_and_phrases(spark):
    df = spark.createDataFrame([(1, "I love #bigdata a lot"), (2, "bigdata it is"), (3, "Open the Source"), (4, "source of @bigdata"), (5, None)], "id long, text string")
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(guard.track_terms(df, "#bigdata")) == [1]
    assert ids(guard.track_terms(df, "bigdata")) == [1, 2, 4]
    assert ids(guard.track_terms(df, "open source, @BigData")) == [3, 4]
    terms = spark.createDataFrame([("#bigdata",), ("open  source",), (" ",), (None,)], "term string")
    assert ids(guard.track_terms_join(df, terms)) == [1, 3]


def test_positional_diff_sees_nulls(spark):
    from annolink.operators.audit import positional_link_diff
    kind = "id long, urls array<struct<url:string,expanded_url:string,display_url:string,indices:array<int>>>"
    a = spark.createDataFrame([(1, [("u", "u", None, [0, 1])]), (2, [("u", "u", "d", [0, 1])])], kind)
    e = spark.createDataFrame([(1, [("u", "u", "d", [0, 1])]), (2, [("u", "u", "d", [0, 1])])], kind)
    assert {r["id"]: r["n_mismatch"] for r in positional_link_diff(a, e).collect()} == {1: 1, 2: 0}


def test_lenient_json(spark):
    assert decode_one(spark, post(retweet_count=1.0))["post"]["retweet_count"] == 1
    assert decode_one(spark, post(retweet_count="2.9"))["post"]["retweet_count"] == 2
    bare = "{id: 1, text: 'a', lang: 'en', retweet_count: 1, favorite_count: 1, timestamp_ms: 3, entities: null}"
    assert decode_one(spark, bare)["reason"] == "null_entities"
    assert decode_one(spark, bare.replace(", entities: null", ""))["reason"] is None


def test_entities_are_read_from_the_parse(spark):
    """Absent and null entities are told apart by the parse, not by what the text says."""
    lenient = "{id: 1, text: 'see , entities: null here', lang: 'en', retweet_count: 1, favorite_count: 1, timestamp_ms: 3}"
    row = decode_one(spark, lenient)
    assert row["reason"] is None and row["post"]["entities"] is None
    full = lenient.replace("timestamp_ms", "entities: {urls: [], hashtags: [{text: 5, indices: ['1', 2.0, 9]}], more: {x: null}}, timestamp_ms")
    entities = decode_one(spark, full)["post"]["entities"]
    assert [(h["text"], h["indices"]) for h in entities["hashtags"]] == [("5", [1, 2])] and entities["urls"] == []
    for shape in ("3", "[]", "'text'", "{hashtags: 1, urls: []}", "{hashtags: [], urls: {}}"):
        assert decode_one(spark, full.replace(full[full.index("{urls"):full.index(", timestamp")], shape))["reason"] == "invalid_entities"
    for twice in ("{urls: [], urls: [], hashtags: []}",):       # a repeated key: rejected or read, but no failed job
        assert decode_one(spark, full.replace(full[full.index("{urls"):full.index(", timestamp")], twice))["reason"] in (None, "malformed_json", "invalid_entities")


def test_one_parse_a_post(spark):
    from annolink.operators import enrich
    df = spark.createDataFrame([(1, post())], "key long, value string")
    valid = codec.valid_posts(codec.decode_posts(guard.json_guard_drop(df))).where("retweet_count >= 0").select("id", "text")
    rich = enrich.enrich_rowwise(df, lambda p: (p, None)).where("route = 'enriched'")
    for plan in (valid, rich):
        assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert valid.count() == 1 and rich.count() == 1


def test_hot_texts_are_split(spark, monkeypatch):
    from annolink.operators import enrich, joins
    from annolink.operators.annotate import Dictionary, dictionary_links_by_text
    rows = [(i, post(id=i, text="the tarn" if i < 50 else f"tarn {i}")) for i in range(60)] + [(99, "plain"), (98, None)]
    df = spark.createDataFrame(rows, "key long, value string")
    gaz = spark.createDataFrame([("tarn", "http://e/Tarn", 1, ["x"], 0.9, 0.0)], "surface_form string, uri string, support int, types array<string>, "
                                "similarity_score double, percentage_of_second_rank double")
    monkeypatch.setattr(joins.hot_keys, "__defaults__", ("tkey", "copies", 10))
    out = enrich.enrich_by_text(df, lambda texts: dictionary_links_by_text(texts, gaz)).collect()
    got = {r["key"]: (r["route"], len(json.loads(r["value"])["entities"]["urls"]) if r["route"] == "enriched" else None) for r in out}
    assert len(out) == 62 and got == {i: ("enriched", 1) for i in range(60)} | {99: ("passthrough", None), 98: ("passthrough", None)}
    by_column = enrich.enrich_with_dictionary(df, Dictionary(gaz)).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, by_column), key=repr)


def test_checkpoint_folder_is_the_clusters(spark, tmp_path):
    from annolink.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
