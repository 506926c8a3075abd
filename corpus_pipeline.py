"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, benchmark
decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``docs``.  Between stages the rows are written as Parquet and read back.  Stages
decide by row: null and repeated doc_ids are rows of their own (``_keyed``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from annolink.llm import decontaminate, jaccard, langid, lines, packing
from annolink.llm.common import read_table, stored, unused

#: Near-duplicate documents: shingles of five words, a similarity of 0.8.
SHINGLE, PERCENT = 5, 80


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a long key of each row, and its name: the doc_id where that names
    one row.  Of the rows that repeat a doc_id one keeps it; the others, and rows
    without one, get keys above all doc_ids.  Only such rows are written anew."""
    key, of, nth = unused(docs, "row_key"), unused(docs, "row_of"), unused(docs, "row_nth")
    own = docs["doc_id"].cast("long")
    ids = docs.select(own.alias(of))
    again = stored(ids.groupBy(of).agg(F.count("*").alias("c")).where((F.col("c") > 1) | F.col(of).isNull()).select(of), "repeated-ids")
    if again.isEmpty():
        return docs.withColumn(key, own), key
    top = ids.agg(F.max(of)).first()[0]
    same = own.eqNullSafe(again[of])
    rows = stored(docs.join(again, same).withColumn(nth, F.monotonically_increasing_id()), "repeated-rows")
    first = rows.where(F.col(of).isNotNull()).groupBy(F.col(of).alias("first_of")).agg(F.min(nth).alias("first_nth"))
    after = F.lit(-1 if top is None else top).cast("long") + 1 + F.col(nth)
    rows = rows.join(first, rows[of] == first["first_of"], "left").select(
        *[rows[c] for c in docs.columns], F.when(F.col(nth) == F.col("first_nth"), F.col(of)).otherwise(after).alias(key))
    return docs.join(again, same, "left_anti").withColumn(key, own).union(rows), key


def _without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows of the keyed ``docs`` whose key is not a doc_id of ``gone``, without the key."""
    of = unused(docs, "gone_id")
    gone = gone.select(F.col("doc_id").alias(of)).distinct()
    return docs.join(gone, docs[key] == gone[of], "left_anti").drop(key)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on their own labels, does not reject."""
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    names = [unused(docs, n) for n in ("lang_pred", "lang_score", "lang_rejected")]
    return langid.predict(docs, model, "text", *names).where(~F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of near-equal lines stays, the first; documents
    left without a line go."""
    keyed, key = _keyed(docs)
    given = unused(keyed, "given_id")
    return (lines.dedup_lines(keyed.withColumnRenamed("doc_id", given).withColumnRenamed(key, "doc_id"))
            .drop("doc_id").withColumnRenamed(given, "doc_id"))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    keyed, key = _keyed(docs)
    groups = jaccard.jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"), SHINGLE, PERCENT)
    return _without(keyed, key, groups.where("doc_id <> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a twentieth of the words stand in windows of a benchmark item go."""
    keyed, key = _keyed(docs)
    found = decontaminate.matches(keyed.select(F.col(key).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    return _without(keyed, key, found.where("n_hit > 0 and 20 * n_hit >= n_words"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.harmonic_pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("ngram_join", ngram_join),
          ("decontamination", decontamination), ("packing", pack)]

#: SQL can't express the trained language model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
