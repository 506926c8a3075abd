"""Input parallelism.

A table stored as one file with one row group is read by a single task; the
CPU-heavy steps after it (JSON parsing, tokenising, edit distance) would then
run on one core.  ``spread`` round-robins such inputs over the session's
parallelism.  On a cluster reading many files the scan already has at least
that many splits and ``spread`` is a no-op (no extra shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
