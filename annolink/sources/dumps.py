"""Message dumps: JSON lines of posts (one message per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from annolink import config
from annolink.functions.text import java_trim
from annolink.operators.codec import decode_posts
from annolink.operators.guard import oversize


def ingest_lines(lines: DataFrame, value: str = "value",
                 max_bytes: int = config.MAX_MESSAGE_BYTES) -> DataFrame:
    """Blank lines are keep-alives (no record); a message over ``max_bytes``
    UTF-8 bytes is set aside as ``oversize`` (the limit itself passes); every
    other line is decoded with a reason."""
    kept = lines.where(F.col(value).isNotNull() & (java_trim(F.col(value)) != ""))
    big = oversize(value, max_bytes)
    # an oversize message is not parsed
    d = decode_posts(kept.withColumn("_big", big).withColumn(value, F.when(~big, F.col(value))), value)
    d = d.withColumn("reason", F.when(F.col("_big"), F.lit("oversize")).otherwise(F.col("reason")))
    return d.withColumn("post", F.when(F.col("reason").isNull(), F.col("post"))).drop("_big")


def read_message_dump(spark: SparkSession, path: str, streaming: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return ingest_lines(r.load(path))
    return ingest_lines(spark.read.text(path))
