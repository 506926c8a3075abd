"""Streaming jobs: several topics, fan-out, two sinks, link tables, drains, bounds."""

import json

import pytest
from pyspark.sql import functions as F

from annolink.operators import enrich
from annolink.sources import topics
from annolink.sources.links import open_links, write_links
from annolink.streaming import jobs


def _post(i, text):
    return json.dumps({"id": i, "text": text, "lang": "en", "user": {"id": 1, "name": "a"}, "retweet_count": 1, "favorite_count": 2, "timestamp_ms": 3})


def _messages(spark, n, start=0):
    rows = [(i, _post(i, f"post {i}") if i % 5 else f"plain {i}", i) for i in range(start, start + n)]
    return spark.createDataFrame(rows, "key long, value string, offset long")


def _arrive(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def _urls(spark, n):
    link = "named_struct('url', concat('u', id), 'expanded_url', 'e', 'display_url', 'd', 'indices', array(0, 1))"
    return spark.range(n).where("id % 2 = 0").select(F.col("id").alias("jkey"), F.expr(f"array({link})").alias("urls"))


def test_link_table_is_pruned_and_joined_by_bucket(spark, tmp_path):
    base, plans = str(tmp_path), []
    for k in range(3):
        _arrive(_messages(spark, 100, 100 * k), f"{base}/in")
    table = write_links(_urls(spark, 300), f"{base}/links", span=100, buckets=4)

    def look(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString())

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jobs.run_stored_enrich_stream(spark, f"{base}/in", f"{base}/out", table, f"{base}/ckpt", max_files_per_trigger=1, look=look)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = {r["key"]: r for r in out.collect()}
    assert len(rows) == 300 and {r["route"] for r in rows.values()} == {"enriched", "passthrough"}
    for i, r in rows.items():
        if i % 5:
            urls = json.loads(r["value"])["entities"]["urls"]
            assert [u["url"] for u in urls] == ([f"u{i}"] if i % 2 == 0 else [])
    assert len(plans) == 3
    for k, plan in enumerate(plans):
        assert f"(part#" in plan and f" = {k})" in plan or f"IN ({k})" in plan
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(_jk") >= 1 and "Exchange hashpartitioning(jkey" not in plan
    again = open_links(spark, f"{base}/links", 100, 4)
    assert again.for_keys(spark.range(100, 104), "id").count() == 50
    assert again.for_keys(spark.range(0), "id").count() == 0
    # a restart has nothing left to do
    assert jobs.run_stored_enrich_stream(spark, f"{base}/in", f"{base}/out", again, f"{base}/ckpt").count() == 300


def test_topics_as_one_stream(spark, tmp_path):
    base = str(tmp_path)
    both = topics.fan_out(_messages(spark, 40), "raw,rich,other")
    topics.write_topics(both, f"{base}/t")
    stream = topics.topic_stream(spark, "raw, rich", path=f"{base}/t", start={"rich": {0: 30}}, per_trigger=1)
    out = jobs.run_consume_topics(stream, f"{base}/out", lambda p: p.select("topic", "id"), f"{base}/ckpt", keep=["topic"])
    got = sorted(map(tuple, out.collect()))
    assert got == sorted([("raw", i) for i in range(40) if i % 5] + [("rich", i) for i in range(30, 40) if i % 5])
    topics.write_topics(topics.fan_out(_messages(spark, 3, 41), "rich"), f"{base}/t")
    stream = topics.topic_stream(spark, "raw, rich", path=f"{base}/t", start={"rich": {0: 30}}, per_trigger=1)
    again = jobs.run_consume_topics(stream, f"{base}/out", lambda p: p.select("topic", "id"), f"{base}/ckpt", keep=["topic"])
    assert sorted(set(map(tuple, again.collect())) - set(got)) == [("rich", 41), ("rich", 42), ("rich", 43)] and again.count() == len(got) + 3


def test_subscription_options():
    o = topics.kafka_options("h:1", " a, b ", {"a": {0: 5, 1: 7}}, 100, failOnDataLoss=False)
    assert o == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": '{"a": {"0": 5, "1": 7}}', "maxOffsetsPerTrigger": "100",
                 "failOnDataLoss": "False"}
    assert topics.kafka_options("h:1", ["a"])["startingOffsets"] == "earliest"


@pytest.mark.parametrize("kw", [{}, {"path": "p", "servers": "s"}, {"path": "p", "start": "latest"}])
def test_subscriptions_that_make_no_sense(spark, kw):
    with pytest.raises(ValueError):
        topics.topic_stream(spark, "a", **kw)
    with pytest.raises(ValueError):
        topics.topic_stream(spark, " , ", path="p")


def test_broker_records_round_trip(spark):
    env = topics.fan_out(_messages(spark, 4), "raw")
    records = topics.to_kafka_records(env).withColumn("partition", F.lit(0)).withColumn("offset", F.lit(9).cast("long"))
    assert [f.dataType.simpleString() for f in records.schema][:3] == ["string", "binary", "string"]
    back = topics.from_kafka_records(records.withColumn("value", F.col("value").cast("binary")))
    assert sorted((r["topic"], r["key"], r["value"]) for r in back.collect()) == sorted((r["topic"], r["key"], r["value"]) for r in env.collect())


def test_fan_out_that_fails_between_two_topics(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    for k in range(2):
        _arrive(_messages(spark, 10, 10 * k), f"{base}/in")
    write, failed = jobs.write_batch, []

    def fail_once(batch, out, number):
        if number == 1 and out.endswith("topic=b") and not failed:
            failed.append(number)
            raise RuntimeError("lost")
        write(batch, out, number)

    monkeypatch.setattr(jobs, "write_batch", fail_once)
    run = lambda: jobs.run_fan_out_stream(spark, f"{base}/in", f"{base}/out", "a,b", f"{base}/ckpt", max_files_per_trigger=1)
    with pytest.raises(Exception, match="lost"):
        run()
    assert spark.read.parquet(f"{base}/out").count() == 30
    out = run()
    assert sorted((r["topic"], r["key"]) for r in out.select("topic", "key").collect()) == [(t, i) for t in "ab" for i in range(20)]
    assert run().count() == 40
    assert jobs.run_fan_out_stream(spark, f"{base}/in", f"{base}/none", "", f"{base}/ckpt2").count() == 0


def test_landing_folder_to_two_sinks(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "1.jsonl").write_text("\n".join([_post(1, "The ferry is late"), "", "{broken", _post(2, "nothing")]) + "\n")
    (landing / "2.jsonl").write_text(_post(3, "x" * 281) + "\n" + _post(4, "Late FERRY") + "\n")
    write, failed = jobs.write_batch, []

    def fail_once(batch, out, number):
        if out.endswith("rejected") and not failed:
            failed.append(number)
            raise RuntimeError("lost")
        write(batch, out, number)

    monkeypatch.setattr(jobs, "write_batch", fail_once)
    run = lambda: jobs.run_track_stream(spark, str(landing), f"{base}/out", "ferry late, harbour", f"{base}/ckpt", max_files_per_trigger=1)
    with pytest.raises(Exception, match="lost"):
        run()
    accepted, rejected = run()
    assert sorted(r["id"] for r in accepted.collect()) == [1, 4]
    assert sorted(r["reason"] for r in rejected.collect()) == ["malformed_json", "text_too_long"]
    (landing / "3.jsonl").write_text(_post(5, "harbour") + "\n")
    accepted, rejected = run()
    assert sorted(r["id"] for r in accepted.collect()) == [1, 4, 5] and rejected.count() == 2


def test_drain_goes_on_where_it_stopped(spark, tmp_path):
    base = str(tmp_path)
    for k in range(4):
        _arrive(_messages(spark, 10, 10 * k), f"{base}/in")
    take = lambda n: sorted(r["offset"] for r in jobs.drain(spark, f"{base}/in", f"{base}/d", n).collect())
    assert take(7) == list(range(7))
    assert spark.read.parquet(f"{base}/d/inbox").count() < 40       # it stopped itself
    assert take(7) == list(range(7, 14))
    assert take(13) == list(range(14, 27))
    assert take(100) == list(range(27, 40))
    assert take(5) == []
    _arrive(_messages(spark, 10, 40), f"{base}/in")
    assert take(5) == list(range(40, 45))


def test_intake_is_bounded_and_complete(spark, tmp_path):
    base, took = str(tmp_path), []
    for k in range(5):
        _arrive(_messages(spark, 10, 10 * k), f"{base}/in")
    fn = enrich.suffix_enrichment("!", lambda p: F.lit(0.5))
    out = jobs.run_enrich_stream(spark, f"{base}/in", f"{base}/out", lambda s: enrich.enrich_rowwise(s, fn), f"{base}/ckpt", max_files_per_trigger=2, took=took)
    assert took == [20, 20, 10] and out.count() == 50


def test_report_as_text_files(spark, tmp_path):
    base = str(tmp_path)
    env = _messages(spark, 10).drop("offset")
    rich = enrich.enrich_with_links(env, _urls(spark, 10), lambda p: p["id"])
    topics.write_routes(rich, f"{base}/in")
    out = jobs.run_report_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", routes=("enriched",))
    lines = [r["value"] for r in out.collect()]
    assert len(lines) == 8 and sum(x.startswith("Annotations or tweet: ") for x in lines) == 4
    assert {r["lang"] for r in out.collect()} == {"en"}
    assert (tmp_path / "out" / "lang=en").is_dir()
