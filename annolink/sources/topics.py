"""Topics: keyed message logs as DataFrames ``(topic, key BIGINT, value STRING)``.

* broker adapter (options only; needs the Kafka connector on the classpath);
* file-backed topics (parquet partitioned by ``topic``) for tests and for
  clusters without a broker, batch or as one stream of several topics;
* fan-out to several topics, union of topics, bounded drain in arrival order.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from annolink import config
from annolink.functions.keys import key_bytes_to_long, long_to_key_bytes
from annolink.functions.text import split_terms


def subscription(topics) -> list[str]:
    """Comma list or list -> trimmed topic names."""
    return split_terms(topics)


# ------------------------------------------------------------------ broker

def start_option(start) -> str:
    """``earliest`` / ``latest``, or ``{topic: {partition: offset}}`` as the broker's JSON."""
    if isinstance(start, str):
        return start
    return json.dumps({t: {str(p): int(o) for p, o in parts.items()} for t, parts in start.items()})


def kafka_options(servers: str, topics, start="earliest", max_offsets_per_trigger: int | None = None, **options) -> dict[str, str]:
    """Options of a broker subscription.  Records per trigger are bounded only when asked for."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(subscription(topics)), "startingOffsets": start_option(start)}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out | {k: str(v) for k, v in options.items()}


def kafka_reader(spark: SparkSession, servers: str, topics, streaming: bool = True, start="earliest",
                 max_offsets_per_trigger: int | None = None, **options):
    """Configured reader for a broker subscription, from the beginning of the log
    unless ``start`` says otherwise."""
    r = (spark.readStream if streaming else spark.read).format("kafka")
    return r.options(**kafka_options(servers, topics, start, max_offsets_per_trigger if streaming else None, **options))


def topic_stream(spark: SparkSession, topics, path: str | None = None, servers: str | None = None, start="earliest",
                 per_trigger: int | None = None) -> DataFrame:
    """Several topics as one stream of envelopes ``(topic, key, value, offset)``.

    By the same arguments from a broker (``servers``) or from topic folders below
    ``path`` (``topic=<name>``; only the subscribed ones are listed and read).  ``start``:
    ``earliest``, or ``{topic: {partition: offset}}`` of the first message to take (a
    folder is partition 0; topics not named start at their first message).  ``per_trigger`` bounds what a
    trigger takes in: messages of the broker, files of each folder."""
    names = subscription(topics)
    if not names:
        raise ValueError("no topic to subscribe to")
    if (path is None) == (servers is None):
        raise ValueError("name either a folder of topics or a broker")
    if servers is not None:
        return from_kafka_records(kafka_reader(spark, servers, names, True, start, per_trigger).load()).drop("partition")
    if isinstance(start, str) and start != "earliest":
        raise ValueError("topic folders are read from their first message or from given offsets")
    first = {} if isinstance(start, str) else {t: int(parts.get(0, 0)) for t, parts in start.items()}
    out = None
    for name in names:
        folder = f"{path}/topic={name}"
        r = spark.readStream.schema(spark.read.option("recursiveFileLookup", "true").parquet(folder).schema).option("recursiveFileLookup", "true")
        if per_trigger:
            r = r.option("maxFilesPerTrigger", str(per_trigger))
        one = r.parquet(folder).select(F.lit(name).alias("topic"), "key", "value", "offset")
        if first.get(name, 0) > 0:
            one = one.where(F.col("offset") >= first[name])
        out = one if out is None else out.unionByName(one)
    return out


def kafka_writer(df: DataFrame, servers: str, checkpoint: str | None = None):
    """Configured writer of envelopes to the broker (topic taken per row), batch
    or streaming depending on ``df``."""
    rec = to_kafka_records(df)
    if df.isStreaming:
        w = rec.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        return w.option("checkpointLocation", checkpoint) if checkpoint else w
    return rec.write.format("kafka").option("kafka.bootstrap.servers", servers)


def from_kafka_records(df: DataFrame) -> DataFrame:
    """Broker records -> envelope ``(topic, key, value, partition, offset)``."""
    return df.select("topic", key_bytes_to_long("key").alias("key"),
                     F.col("value").cast("string").alias("value"), "partition", "offset")


def to_kafka_records(df: DataFrame) -> DataFrame:
    """Envelope -> broker record columns (8-byte big-endian key)."""
    return df.select("topic", long_to_key_bytes("key").alias("key"), F.col("value").cast("string").alias("value"))


# ------------------------------------------------------------------ files

#: Bytes of a row group: a trigger takes few files, and decodes each by as many tasks as it has row groups.
ROW_GROUP = 8 << 20


def read_topics(spark: SparkSession, path: str, topics=None) -> DataFrame:
    """File-backed topics; the topic filter prunes partitions at the scan."""
    df = spark.read.parquet(path)
    names = subscription(topics) if topics else None
    return df.where(F.col("topic").isin(names)) if names else df


def write_topics(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).option("parquet.block.size", str(ROW_GROUP)).partitionBy("topic").parquet(path)


def write_routes(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One write for every route of an enrichment (enriched, passthrough and
    quarantine land in their own folders); readers prune by ``route``."""
    df.write.mode(mode).option("parquet.block.size", str(ROW_GROUP)).partitionBy("route").parquet(path)


def read_routes(spark: SparkSession, path: str, routes=("enriched", "passthrough")) -> DataFrame:
    return spark.read.parquet(path).where(F.col("route").isin(list(routes)))


# ------------------------------------------------------------------ shapes

def fan_out(df: DataFrame, topics) -> DataFrame:
    """One row per (message, topic): N topics give N copies, zero give none."""
    names = subscription(topics)
    arr = F.array(*[F.lit(t) for t in names]) if names else F.array().cast("array<string>")
    return df.withColumn("topic", F.explode(arr))


def keyed_by_id(posts: DataFrame, value: Column) -> DataFrame:
    return posts.select(F.col("id").alias("key"), value.alias("value"))


def union_topics(*dfs: DataFrame) -> DataFrame:
    """Union-all (duplicates kept, no global order)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def bounded_collect(df: DataFrame, n: int, order=("offset",)) -> DataFrame:
    """First ``n`` messages in arrival order (an explicit order column; Spark
    has no implicit arrival order).  The limit is the feature here."""
    return df.orderBy(*order).limit(n)
