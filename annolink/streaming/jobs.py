"""Structured Streaming jobs: the batch functions applied to streams.

* enrich stream: topic -> guard/decode -> enrich -> encode -> topic (append);
* consume stream: topics -> guard -> decode -> user transform -> sink;
* fan-out stream: topic -> several topics;
* track stream: landed message dumps -> tracked posts and rejected messages;
* bounded drain: the next n messages, then the stream stops itself.

Every query has its own ``checkpointLocation`` (its progress identity) in the
shared checkpoint folder; the file sink plus checkpoint gives exactly-once
output across restarts and lost executors.  Admission control (the reference's
bounded queues) is ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``: nothing
is dropped, input waits for the next trigger.  Sinks that a job writes itself get a
folder for each micro-batch, which a repeated batch overwrites.
"""

from __future__ import annotations

import threading
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from annolink.functions.text import split_terms
from annolink.operators.codec import decode_posts, valid_posts
from annolink.operators.enrich import attach_links, decode_route
from annolink.operators.guard import json_guard_drop, track_match
from annolink.operators.report import annotation_report
from annolink.sources.dumps import read_message_dump
from annolink.sources.links import LinkTable


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, schema=None) -> DataFrame:
    """A directory of message files as a stream (schema taken from the files
    when not given; a stream source needs it up front)."""
    schema = schema or spark.read.format(fmt).load(path).schema
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def start(df: DataFrame, out: str, checkpoint: str, name: str | None = None, fmt: str = "parquet",
          available_now: bool = True, partition_by: list[str] | None = None,
          processing_time: str | None = None):
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start(out)


def intake(query) -> list[int]:
    """Rows that each trigger of a query took in (the last ones that the session keeps)."""
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def run_enrich_stream(spark: SparkSession, src: str, out: str,
                      enrich: Callable[[DataFrame], DataFrame], checkpoint: str,
                      max_files_per_trigger: int | None = None, name: str | None = None,
                      took: list[int] | None = None) -> DataFrame:
    """Run the enrichment over everything available, then return the sink as a
    batch DataFrame.  ``took`` gets the rows of each trigger."""
    stream = file_stream(spark, src, max_files_per_trigger=max_files_per_trigger)
    q = start(enrich(stream), out, checkpoint, name=name)
    q.awaitTermination()
    if took is not None:
        took += intake(q)
    return spark.read.parquet(out)


def write_batch(batch: DataFrame, out: str, number: int) -> None:
    batch.write.mode("overwrite").parquet(f"{out}/batch={number}")


def _each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str | None = None):
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True)
    q = (w.queryName(name) if name else w).start()
    q.awaitTermination()
    return q


def run_stored_enrich_stream(spark: SparkSession, src: str, out: str, links: LinkTable, checkpoint: str,
                             max_files_per_trigger: int | None = None, name: str | None = None,
                             look: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """The enrichment with stored links: each micro-batch is decoded once, reads the
    ranges of the link table that its post ids fall into, and joins them bucket by
    bucket.  ``look`` sees each batch's result before it is written."""
    def write(batch: DataFrame, number: int) -> None:
        decoded = decode_route(batch).persist()     # used twice: for its ids, and in the join
        ids = decoded.where(F.col("route") == "enriched").select(F.col("post.id").alias("id"))
        rich = attach_links(decoded, links.for_keys(ids, "id"), lambda p: p["id"])
        if look is not None:
            look(rich)
        write_batch(rich, out, number)
        decoded.unpersist()

    _each_batch(file_stream(spark, src, max_files_per_trigger=max_files_per_trigger), write, checkpoint, name)
    return spark.read.parquet(out).drop("batch")


def run_batch_stream(spark: SparkSession, src: str, out: str, enrich: Callable[[DataFrame], DataFrame],
                     checkpoint: str, max_files_per_trigger: int | None = None, name: str | None = None) -> DataFrame:
    """The same for an enrichment that needs a batch's texts together (look-up by
    text): it runs on each micro-batch.  A batch has a folder of its own, which a
    repeated batch overwrites."""
    def write(batch: DataFrame, number: int) -> None:
        write_batch(enrich(batch), out, number)

    _each_batch(file_stream(spark, src, max_files_per_trigger=max_files_per_trigger), write, checkpoint, name)
    return spark.read.parquet(out)


def run_fan_out_stream(spark: SparkSession, src: str, out: str, topics, checkpoint: str,
                       max_files_per_trigger: int | None = None, name: str | None = None) -> DataFrame:
    """Every message to every topic: ``topic=<name>/batch=<n>`` below ``out``.  A batch that
    failed between two topics is repeated and overwrites what it had written."""
    names = split_terms(topics)

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for topic in names:
            write_batch(batch.drop("topic"), f"{out}/topic={topic}", number)
        batch.unpersist()

    stream = file_stream(spark, src, max_files_per_trigger=max_files_per_trigger)
    _each_batch(stream, write, checkpoint, name)
    return spark.read.parquet(out) if names else spark.createDataFrame([], stream.schema)


def run_track_stream(spark: SparkSession, landing: str, out: str, terms, checkpoint: str,
                     max_files_per_trigger: int | None = None, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Message dumps that land as text files -> posts that match a track term
    (``out/accepted``) and messages that could not be read, with the reason
    (``out/rejected``): two sinks of one micro-batch, each overwritten by a repeated one."""
    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        accepted = batch.where(F.col("reason").isNull() & track_match("post.text", terms)).select("post.*")
        write_batch(accepted, f"{out}/accepted", number)
        write_batch(batch.where(F.col("reason").isNotNull()).select("value", "reason"), f"{out}/rejected", number)
        batch.unpersist()

    _each_batch(read_message_dump(spark, landing, streaming=True, max_files_per_trigger=max_files_per_trigger), write, checkpoint, name)
    return spark.read.parquet(f"{out}/accepted").drop("batch"), spark.read.parquet(f"{out}/rejected").drop("batch")


def consume(stream: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The consumer's side of any stream of envelopes: guard, decode, valid posts."""
    return valid_posts(decode_posts(json_guard_drop(stream)), keep or [])


def run_consume_topics(stream: DataFrame, out: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str,
                       keep: list[str] | None = None, name: str | None = None) -> DataFrame:
    """Consume ``topics.topic_stream`` (several topics as one stream, of either kind)."""
    q = start(transform(consume(stream, keep)), out, checkpoint, name=name)
    q.awaitTermination()
    return stream.sparkSession.read.parquet(out)


def run_report_stream(spark: SparkSession, src: str, out: str, checkpoint: str, routes=None, name: str | None = None) -> DataFrame:
    """The report of each post's links as lines of text files, a folder for each
    language.  Returns the lines read back (``lang, value``)."""
    stream = file_stream(spark, src)
    if routes:
        stream = stream.where(F.col("route").isin(list(routes)))
    lines = consume(stream).select("lang", F.explode(F.split(annotation_report(), "\n")).alias("value")).where("value <> ''")
    start(lines, out, checkpoint, name=name, fmt="text", partition_by=["lang"]).awaitTermination()
    return spark.read.text(out)


def _rows_so_far(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:       # nothing written yet
        return None


def drain(spark: SparkSession, src: str, base: str, n: int, order: str = "offset") -> DataFrame:
    """The next ``n`` messages of a folder of message files, in order of arrival (by file,
    then by ``order``); fewer if no more are there.

    A stream takes the files in one by one and stops itself as soon as ``n`` messages
    lie beyond the position; the position (batch and ``order`` of the last message
    handed out) is kept below ``base``, so the next call goes on behind it, in this
    session or another.  A call that failed hands out the same messages again."""
    inbox, places = f"{base}/inbox", f"{base}/positions"
    done = _rows_so_far(spark, places)
    last = done.orderBy(F.col("run").desc()).first() if done is not None else None
    run = last["run"] + 1 if last else 0

    def waiting() -> DataFrame | None:
        rows = _rows_so_far(spark, inbox)
        if rows is None or last is None or last["batch"] is None:
            return rows
        return rows.where((F.col("batch") > last["batch"]) | ((F.col("batch") == last["batch"]) & (F.col(order) > last["at"])))

    enough = threading.Event()

    def check() -> None:
        rows = waiting()
        if rows is not None and rows.limit(n).count() >= n:
            enough.set()

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, inbox, number)
        check()

    check()
    if not enough.is_set():
        q = (file_stream(spark, src, max_files_per_trigger=1).writeStream.option("checkpointLocation", f"{base}/checkpoint")
             .foreachBatch(write).trigger(availableNow=True).start())
        while not enough.wait(0.1) and q.isActive:
            pass
        if enough.is_set():
            q.stop()        # a batch that this cuts short is repeated by the next call
        elif q.exception():
            raise q.exception()
    rows = waiting()
    taken = (rows if rows is not None else spark.createDataFrame([], file_schema(spark, src, "batch int"))).orderBy("batch", order).limit(n)
    taken.write.mode("overwrite").parquet(f"{base}/taken/run={run}")
    taken = spark.read.parquet(f"{base}/taken/run={run}")
    end = taken.orderBy(F.col("batch").desc(), F.col(order).desc()).select("batch", F.col(order).alias("at")).first()
    if end is None and last is not None:
        end = last
    spark.createDataFrame([(end["batch"] if end else None, end["at"] if end else None)], "batch int, at long").write.mode("overwrite").parquet(
        f"{places}/run={run}")
    return taken.drop("batch")


def file_schema(spark: SparkSession, src: str, more: str):
    from pyspark.sql.types import StructType
    return StructType(spark.read.parquet(src).schema.fields + StructType.fromDDL(more).fields)


def run_consume_stream(spark: SparkSession, src: str, out: str,
                       transform: Callable[[DataFrame], DataFrame], checkpoint: str,
                       keep: list[str] | None = None, routes=None, name: str | None = None) -> DataFrame:
    stream = file_stream(spark, src)
    if routes:  # a route-partitioned topic folder: prune to the wanted routes
        stream = stream.where(F.col("route").isin(list(routes)))
    q = start(transform(consume(stream, keep)), out, checkpoint, name=name)
    q.awaitTermination()
    return spark.read.parquet(out)
