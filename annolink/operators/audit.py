"""Audit queries over delivered results (the reference's test checks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def delivery_audit(results: DataFrame, key: str = "id", expected_copies: int = 2) -> DataFrame:
    """Per post: copies delivered, copies enriched, and whether the post was
    delivered exactly ``expected_copies`` times, all enriched."""
    g = results.groupBy(key).agg(F.count(F.lit(1)).alias("n_copies"),
                                 F.count_if(F.col("entities").isNotNull()).alias("n_enriched"))
    ok = (F.col("n_copies") == expected_copies) & (F.col("n_enriched") == F.col("n_copies"))
    return g.withColumn("complete", ok)


def unknown_ids(results: DataFrame, inputs: DataFrame, key: str = "id") -> DataFrame:
    """Results whose id is not among the inputs (should be empty)."""
    return results.join(inputs.select(key), key, "left_anti")


def positional_link_diff(actual: DataFrame, expected: DataFrame, key: str = "id",
                         urls: str = "urls") -> DataFrame:
    """Per post: link counts and the number of positions whose url, display
    text or span differ; sizes are compared first (no padding compare)."""
    a = actual.select(key, F.col(urls).alias("a"))
    e = expected.select(key, F.col(urls).alias("e"))
    j = a.join(e, key, "full_outer")
    same = lambda x, y: (x["url"].eqNullSafe(y["url"]) & x["display_url"].eqNullSafe(y["display_url"])
                         & x["indices"].eqNullSafe(y["indices"]))
    mism = F.when(F.size("a") == F.size("e"),
                  F.size(F.filter(F.zip_with("a", "e", lambda x, y: same(x, y)), lambda b: ~b)))
    return j.select(key, F.coalesce(F.size("a"), F.lit(-1)).alias("n_actual"),
                    F.coalesce(F.size("e"), F.lit(-1)).alias("n_expected"),
                    F.coalesce(mism, F.lit(-1)).alias("n_mismatch"))
