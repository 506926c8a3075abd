"""Stored links as a table that streams look up: grouped once, partitioned by ranges of
post ids and bucketed by post id.

A micro-batch reads only the ranges its ids fall into, and joins without shuffling
the table: the buckets are the join's partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A batch that touches more ranges than this reads the table without pruning.
MAX_RANGES = 1000


class LinkTable:
    """``(jkey, urls, part)``; ``part`` is the range number ``floor(jkey / span)``."""

    def __init__(self, spark: SparkSession, name: str, span: int, buckets: int):
        self.spark, self.name, self.span, self.buckets = spark, name, span, buckets

    def part(self, key: Column) -> Column:
        return F.floor(key / F.lit(self.span)).cast("bigint")

    def for_keys(self, keys: DataFrame, key: str) -> DataFrame:
        """The part of the table that ``keys`` may need, as ``jkey, urls``."""
        parts = keys.select(self.part(F.col(key)).alias("part")).where("part is not null").distinct().limit(MAX_RANGES + 1).collect()
        table = self.spark.table(self.name)
        if len(parts) <= MAX_RANGES:
            table = table.where(F.col("part").isin([r["part"] for r in parts]))
        return table.select("jkey", "urls")


def write_links(links: DataFrame, path: str, span: int, buckets: int | None = None) -> LinkTable:
    """Write ``links(jkey, urls)``, one row a key, below ``path``; one file for each
    bucket of a range."""
    spark = links.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = LinkTable(spark, f"annolink_links_{uuid.uuid4().hex}", span, buckets)
    rows = links.where("jkey is not null").select(F.col("jkey").cast("bigint").alias("jkey"), "urls", table.part(F.col("jkey")).alias("part"))
    (rows.repartition("part", F.pmod(F.hash("jkey"), F.lit(buckets))).write.partitionBy("part").bucketBy(buckets, "jkey").sortBy("jkey")
     .option("path", path).saveAsTable(table.name))
    return table


def open_links(spark: SparkSession, path: str, span: int, buckets: int) -> LinkTable:
    """A table that ``write_links`` left at ``path`` in an earlier session."""
    table = LinkTable(spark, f"annolink_links_{uuid.uuid4().hex}", span, buckets)
    urls = spark.read.parquet(path).schema["urls"].dataType.simpleString()
    spark.sql(f"CREATE TABLE {table.name} (jkey BIGINT, urls {urls}, part BIGINT) USING parquet PARTITIONED BY (part) "
              f"CLUSTERED BY (jkey) SORTED BY (jkey) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.recoverPartitions(table.name)
    return table
