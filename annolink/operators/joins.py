"""Join helpers: a 128-bit key for long texts and salting of hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from annolink._util import col_of


def text_key(text) -> Column:
    """128-bit key of a text, so that long texts are not carried as join or
    grouping keys: two 64-bit hashes of the whole text with different seeds (the
    second starts from the hash of a constant), so that texts which agree in one
    agree in the other by chance only."""
    t = col_of(text)
    return F.struct(F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"))


def distinct_texts(posts: DataFrame, text: str = "text") -> DataFrame:
    """One row per distinct text with its 128-bit key.  Copies collapse in the
    map-side partial aggregation, so a text repeated in a third of all rows
    costs one row per map task before the shuffle."""
    keyed = posts.where(F.col(text).isNotNull()).select(text_key(text).alias("tkey"), F.col(text).alias("text"))
    return keyed.groupBy("tkey").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("copies"))


# ---------------------------------------------------------------- hot keys
ROWS_PER_SALT = 1_000_000    # rows of one hot key handled by one task


def hot_keys(counts: DataFrame, key: str = "tkey", count: str = "copies",
             rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Every key with more than ``rows_per_salt`` rows and the number of sub-keys
    it is split into.  There is at most one such key per ``rows_per_salt`` rows."""
    salts = F.ceil(F.col(count) / F.lit(rows_per_salt)).cast("int")
    return counts.where(F.col(count) > rows_per_salt).select(key, salts.alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: DataFrame, spread_by: list[str],
                how: str = "inner") -> DataFrame:
    """Equi-join where ``big`` may repeat a key in a third of its rows and
    ``small`` holds a few rows per key.  Rows of hot keys on the big side are
    spread over ``_salts`` sub-keys by a deterministic hash of ``spread_by``
    (stable across task retries); the small side's rows of those keys are
    replicated once per sub-key.  Every row is kept; nothing is sampled.  ``hot`` is sent
    to the workers (one key in ``ROWS_PER_SALT`` rows at most), so ``big`` is shuffled once."""
    hot = F.broadcast(hot)
    b = big.join(hot, key, "left")
    b = b.withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.col("_salts")).cast("int"))).drop("_salts")
    s = small.join(hot, key, "left")
    s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
    return b.join(s.drop("_salts"), [key, "_salt"], how).drop("_salt")
