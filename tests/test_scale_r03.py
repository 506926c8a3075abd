"""Round 3: the findings on time, shuffled bytes and bytes a task."""

import os

import pandas as pd
from pyspark.sql import functions as F

from annolink.functions import text, tokens
from annolink.operators import codec, enrich, link
from annolink.plans import registry
from annolink.sources import derived

ODD = ["", "a", ",", ",,", "a,b", "a, b ,", " a ,\tb\n", "a,\n", "a,\n\n", "x  ", "x, ", "\u0085", "é, ü ", "a,,b", "\x00", "a\r\n", "𝒳 , y", None]


def documents(path, rows):
    pdf = pd.DataFrame(rows, columns=["doc_id", "text"])
    pdf["doc_id"] = pdf["doc_id"].astype("Int64")
    pdf["lang"], pdf["source"], pdf["n_chars"] = "en", "s", 1
    pdf.to_parquet(os.path.join(path, "documents.parquet"))
    return str(path)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_responses_of_a_post_are_made_in_its_row(spark, tmp_path):
    sf = documents(tmp_path, [(1, "Lighthouse keepers, one two"), (2, None), (3, ""), (None, "nobody knows")])
    r = derived.annotation_responses(spark, sf)
    assert "collect_list" not in plan(r) and "Join" not in plan(r)
    got = {x["id"]: x["response"] for x in r.collect()}
    assert got[derived.PIECES].count('"@URI"') == 2 and "Resources" not in got[None] + got[2 * derived.PIECES]


def test_posts_of_a_shared_id_have_the_resources_of_all(spark, tmp_path):
    sf = documents(tmp_path, [(1, "Lighthouse"), (1, "Keepers walk"), (2, "alone Windmill")])
    d = codec.decode_annotation_response(derived.annotation_responses(spark, sf))
    got = sorted((x["id"], x["text"], x["words"]) for x in d.select(
        "id", F.col("annotations.text").alias("text"), F.array_sort("annotations.resources.surface_form").alias("words")).collect())
    both = ["Keepers", "Lighthouse"]
    assert got == [(derived.PIECES, "Keepers walk", both), (derived.PIECES, "Lighthouse", both), (2 * derived.PIECES, "alone Windmill", ["Windmill", "alone"])]


def test_letter_spans_equal_regex_spans(spark):
    texts = ["", None, "one two", "one", "two", "é a𝒳b c", "𝒳𝒳 abc", "[x]", "`az{AZ@", "ends"] + [f"w{'x' * (k % 7)} é{k}" for k in range(2500)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").coalesce(1)
    got = df.select("k", tokens.letter_spans("t").alias("a"), tokens.letter_spans("t", 3).alias("c"), tokens.word_spans("t", tokens.ASCII_WORD_PATTERN).alias("b")).collect()
    assert len(got) == len(texts) and [x["k"] for x in got if (x["a"]["words"], x["a"]["starts"]) != (x["b"]["words"], x["b"]["starts"])] == []
    for x in got:
        long = [(k, w, s) for k, (w, s) in enumerate(zip(x["b"]["words"] or [], x["b"]["starts"] or [])) if len(w) >= 3]
        assert [*zip(*(x["c"][f] or [] for f in ("pos", "words", "starts")))] == long and (x["c"]["pos"] is None) == (x["b"]["words"] is None)


def test_gate_computes_its_texts_once(spark):
    a = spark.range(100).selectExpr("id", "cast(id as int) pos", "concat('http://e.org/', reverse(concat('w', id))) uri", "concat('w', id) surface_form",
                                    "0 offset", "id / 100D similarity_score", "0D percentage_of_second_rank")
    assert plan(link.kept_links(a)).split("\n", 1)[1].count("reverse(") <= 3
    assert link.kept_links(a).where("id = 77").count() == 0 + link.kept_links(a.cache()).where("id = 77").count()


def test_trim_decides_only_for_long_texts(spark):
    texts = [t for t in ODD] + [" " * 9 + "abc" + "\n" * 9, "é" * 10, "𝒳" * 5 + " ", "𝒳" * 6, "x" * 11 + " ", "x" * 10 + " " * 5]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    new, old = text.trimmed_longer_than("t", 10), text.utf16_length(text.java_trim("t")) > 10
    assert df.where(~new.eqNullSafe(old)).count() == 0


def test_comma_list_of_odd_lists(spark):
    s = F.col("t")
    stripped = F.regexp_replace(s, ",+$", "")
    old = (F.when(s.isNull(), F.lit(None)).when(s == "", F.array(F.lit(""))).when(stripped == "", F.array().cast("array<string>"))
           .otherwise(F.transform(F.split(stripped, ","), text.java_trim)))
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    got = df.select("t", text.comma_list("t").alias("a"), old.alias("b")).collect()
    assert [x["t"] for x in got if x["a"] != x["b"]] == []


def test_arrival_slices_have_files_by_size(spark, tmp_path, monkeypatch):
    sf = documents(tmp_path, [(k, "some words " * 20) for k in range(200)])
    monkeypatch.setattr(registry, "FILE_TEXT", 1024)
    base, files = registry._stream_source(spark, sf, derived.envelopes_from_documents(spark, sf), "stream-test")
    assert files == 6       # 200 texts of 220 bytes in 8 slices of files for 1024 bytes
    names = [f for f in os.listdir(f"{base}/in") if f.endswith(".parquet")]
    assert 8 * files - 4 <= len(names) <= 8 * files
    assert spark.read.parquet(f"{base}/in").count() == 200


def test_look_up_by_text_takes_distinct_texts_once(spark):
    seen = []
    env = spark.createDataFrame([(k, f'{{"id":{k},"text":"t{k % 3}","lang":"en","user":{{"id":1}},"retweet_count":1,"favorite_count":1,"timestamp_ms":1}}')
                                 for k in range(9)], "key long, value string")

    def annotator(texts):
        seen.append(texts)
        return texts.select("tkey", F.array().cast(registry.URLS_TYPE).alias("urls"), F.lit(None).cast("string").alias("reason"))

    out = enrich.enrich_by_text(env, annotator)
    assert seen[0].columns == ["tkey", "text"] and seen[0].count() == 3
    assert [r["route"] for r in out.collect()] == ["enriched"] * 9
