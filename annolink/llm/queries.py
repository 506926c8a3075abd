"""Registered queries ``opN_<name>``: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from annolink.llm import chat, covertree, decontaminate, idcodec, jaccard, langid, lines, packing, pii, repair, spelling, toxicity, urls
from annolink.llm.common import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those left, and the numbers of the dropped ones."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = lines.dropped_lines(docs)
    feeds = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = F.when(F.length("text") > 0, feeds + 1).otherwise(0).cast("long")
    joined = docs.select("doc_id", n_lines.alias("n_lines")).join(gone.withColumnRenamed("doc_id", "of"), F.expr("doc_id <=> of"), "left")
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", (F.col("n_lines") - F.size(dropped)).alias("n_kept"), dropped.alias("dropped"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.analyse(read_table(spark, sf_dir, "documents"))
    return spans.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.span_list(), 256).alias("base_sha256"),
        pii.span_list((*pii.KINDS, "generalised", "removed")).alias("spans"),
        F.size("generalised").cast("long").alias("n_generalised"), F.size("removed").cast("long").alias("n_removed"))


#: Documents whose crc32 remainder is the first number (modulo the second) are never learned from.
LANG_FOLD, TOXIC_FOLD = (2, 4), (0, 5)


def held_out(doc_id, fold: tuple[int, int]):
    return langid.remainder(doc_id, fold[1]) == fold[0]


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), LANG_FOLD)
    model = langid.fit(docs.where(~out).select("doc_id", "text", "lang"))
    return langid.predict(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idcodec.round_trip(read_table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_pack(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), TOXIC_FOLD)
    model = toxicity.fit(docs.where(~out).select("doc_id", "text"), labels.where(~out).select("doc_id", "toxic"))
    scored = toxicity.score(docs.select("doc_id", out.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_spans")


#: Host and path rules of the URL query.
URL_RULES = [urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"), urls.rule("block", "example.org/en/1"),
             urls.rule("allow", "com/fr/"), urls.rule("block", "com/de/")]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs that more than one page carries."""
    pages = read_table(spark, sf_dir, "pages")
    return urls.url_filter(pages, urls.repeated_pages(pages), URL_RULES)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    names = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<long>")), lambda i: i.cast("string")))
    return decontaminate.matches(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged conversations; every original conv_id, also those with no rows left."""
    rows = read_table(spark, sf_dir, "conversations")
    plans, turns = repair.repair(repair.damaged(rows))
    of = rows.select(F.col("conv_id").cast("long")).distinct()
    found = plans.withColumnRenamed("conv_id", "plan_id").join(
        repair.digests(turns).withColumnRenamed("conv_id", "turn_id"), F.expr("plan_id <=> turn_id"), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return of.join(found, F.expr("conv_id <=> plan_id"), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


#: A conversation whose texts hold control strings.
PLANTED_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED_CHAT, "conv_id long, turn long, role string, text string")
    chunks = chat.written(chat.format_chat(rows.unionByName(planted)))
    order = chat.turn_order(chunks).withColumnRenamed("conv_id", "of")
    return chat.read_back(chunks).join(order, F.expr("conv_id <=> of")).drop("of")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variant_groups(spelling.damaged_counts(docs))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_pii, op3_language_id, op4_token_ids, op5_ngram_join, op6_embedding_dedup, op7_packing, op8_toxicity, op9_url_filters, op10_decontamination,
                                op11_conversation_repair, op12_chat_format, op13_spelling_variants)}
QUERIES["pipeline"] = corpus_pipeline.run
