"""Model inputs derived by Spark from the given tables (so work grows with them).

* posts / envelopes from ``documents`` (each cut into consecutive posts, nothing
  lost; a few stay whole and meet the model's 280-unit limit);
* a stored annotation table from the words of those posts;
* annotation service responses (JSON) rebuilt from that table;
* a gazetteer (surface forms -> pages) from the words of ``benchmark``.
The recipes are deterministic arithmetic so DuckDB can compute the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from annolink import config
from annolink.functions.text import comma_list
from annolink.functions.tokens import letter_spans
from annolink.operators.codec import post_json
from annolink.sources.scan import spread

RESOURCE_PREFIX = "http://dbpedia.org/resource/"
BASE_TIME_MS = 1700000000000


def table(spark: SparkSession, sf_dir: str, name: str, parallel: bool = True) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if parallel else df


#: Post ids: a document's id times this, plus the number of the piece.
PIECES = 1000003


def post_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, doc_id, piece, text, lang, source, n_chars)``: every document, without
    loss, as consecutive posts of at most 260 or 280 (every fifth document) UTF-16
    units.  One document in 25 stays whole, so that long posts occur too."""
    d = table(spark, sf_dir, "documents")
    whole = F.col("text").isNull() | (F.col("text") == "") | (F.col("doc_id") % 25 == 7)

    def cut(width: int):
        return F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % width), F.lit(0))

    pieces = (F.when(whole, F.array("text")).when(F.col("text").rlike(r"[\x{10000}-\x{10FFFF}]"), cut(130))
              .when(F.col("doc_id") % 5 == 0, cut(280)).otherwise(cut(260)))
    p = d.select("doc_id", "lang", "source", "n_chars", F.posexplode(pieces).alias("piece", "text"))
    return p.select((F.col("doc_id") * PIECES + F.col("piece")).alias("id"), "doc_id", "piece", "text", "lang", "source", "n_chars")


def posts_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.struct((F.col("id") % 97).alias("id"), F.col("source").alias("name"),
                    F.lit(None).cast("string").alias("screenName"),
                    F.lit(None).cast("string").alias("location"),
                    F.col("n_chars").cast("int").alias("followersCount"))
    return post_texts(spark, sf_dir).select(
        "id", "text", "lang", user.alias("user"),
        (F.col("id") % 10000).cast("int").alias("retweet_count"),
        (F.col("n_chars") % 100000).cast("int").alias("favorite_count"),
        (F.lit(BASE_TIME_MS) + F.col("doc_id") * 1000 + F.col("piece")).alias("timestamp_ms"),
        F.lit(None).cast("struct<hashtags:array<struct<indices:array<int>,text:string>>,"
                         "urls:array<struct<url:string,expanded_url:string,display_url:string,"
                         "indices:array<int>>>>").alias("entities"))


def max_post_id(spark: SparkSession, sf_dir: str) -> int:
    """An upper bound of the post ids, from the documents' ids alone."""
    return ((table(spark, sf_dir, "documents", parallel=False).agg(F.max("doc_id")).first()[0] or 0) + 1) * PIECES


def envelopes_from_documents(spark: SparkSession, sf_dir: str,
                             topic: str = config.RAW_TOPIC) -> DataFrame:
    """``(topic, key, value, offset)``; every tenth value is the plain text (not
    JSON) to exercise the guard.  ``offset`` is the arrival order."""
    p = posts_from_documents(spark, sf_dir)
    value = F.when(F.col("id") % 10 == 0, F.col("text")).otherwise(post_json())
    return p.select(F.lit(topic).alias("topic"), F.col("id").alias("key"), value.alias("value"),
                    F.col("id").alias("offset"))


def _types_csv(pos):
    m = pos % 4
    return (F.when(m == 0, F.lit("Schema:Place,DBpedia:Place"))
            .when(m == 1, F.lit("DBpedia:Person, Schema:Person,"))
            .when(m == 2, F.lit(""))
            .otherwise(F.lit(",")))


def _words(shortest: int) -> Column:
    """A text's ASCII letter runs as ``(pos, w, o)``."""
    s = letter_spans("text", shortest)
    return F.arrays_zip(s["pos"].alias("pos"), s["words"].alias("w"), s["starts"].alias("o"))


def post_words(spark: SparkSession, sf_dir: str, shortest: int = 1) -> DataFrame:
    """``(id, pos, word, offset)`` for every ASCII letter run of every post (those of
    ``shortest`` letters or more, numbered among all)."""
    d = post_texts(spark, sf_dir).select("id", "text")
    z = d.select("id", F.explode(_words(shortest)).alias("z"))
    return z.select("id", F.coalesce("z.pos", F.lit(0)).alias("pos"), F.col("z.w").alias("word"), F.col("z.o").alias("offset"))


def _annotation(id: Column, pos: Column, word: Column) -> dict[str, Column]:
    """The columns of a word's stored annotation that don't come from the text."""
    m3 = pos % 3
    uri = F.concat(F.lit(RESOURCE_PREFIX),
                   F.when(m3 == 0, word).when(m3 == 1, F.reverse(word))
                   .otherwise(F.concat(word, F.lit("_"), F.lower(word))))
    return {"uri": uri, "support": ((id * 11 + pos * 7) % 60).cast("int"),
            "similarity_score": ((id * 7 + pos * 13) % 100) / F.lit(100.0),
            "percentage_of_second_rank": ((id * 3 + pos * 5) % 40) / F.lit(100.0)}


#: A word of this many letters is a candidate entity.
MIN_LETTERS = 5


def stored_annotations(spark: SparkSession, sf_dir: str, with_types_csv: bool = False) -> DataFrame:
    """Stored annotation table: every word of >= 5 letters is a candidate entity."""
    w = post_words(spark, sf_dir, MIN_LETTERS)
    pos = F.col("pos")
    a = _annotation(F.col("id"), pos, F.col("word"))
    return w.select(
        "id", "pos", a["uri"].alias("uri"), a["support"].alias("support"),
        comma_list(_types_csv(pos)).alias("types"), F.col("word").alias("surface_form"), "offset",
        a["similarity_score"].alias("similarity_score"),
        a["percentage_of_second_rank"].alias("percentage_of_second_rank"),
        *([_types_csv(pos).alias("types_csv")] if with_types_csv else []))


def _resource_json(id: Column, pos: Column, word: Column, offset: Column) -> Column:
    """Numbers quoted on even positions, bare on odd ones: both must decode alike.  The
    texts are letters, ``_`` and the constants here, so none needs escaping."""
    a = _annotation(id, pos, word)

    def res_json(q: str):
        return F.concat(
            F.lit('{"@URI":"'), a["uri"], F.lit(f'","@support":{q}'), a["support"].cast("string"), F.lit(f'{q},"@types":"'), _types_csv(pos),
            F.lit('","@surfaceForm":"'), word, F.lit(f'","@offset":{q}'), offset.cast("string"),
            F.lit(f'{q},"@similarityScore":{q}'), a["similarity_score"].cast("string"),
            F.lit(f'{q},"@percentageOfSecondRank":{q}'), a["percentage_of_second_rank"].cast("string"), F.lit(q + "}"))
    return F.when(pos % 2 == 0, res_json('"')).otherwise(res_json(""))


def _with_resources(posts: DataFrame) -> DataFrame:
    """Adds ``rs``: a post's resources ``(pos, j)`` in order, made inside its row."""
    rs = F.transform(_words(MIN_LETTERS), lambda x: F.struct(x["pos"].alias("pos"), _resource_json(F.col("id"), x["pos"], x["w"], x["o"]).alias("j")))
    return posts.withColumn("rs", F.when(F.col("id").isNotNull(), rs))


def _response(rs: Column) -> Column:
    head = F.to_json(F.struct(F.col("text").alias("@text"), F.lit("0.7").alias("@confidence"),
                              F.lit(20).alias("@support"), F.lit("").alias("@types"),
                              F.lit("").alias("@sparql"), F.lit("whitelist").alias("@policy")))
    body = F.array_join(F.transform(rs, lambda x: x["j"]), ",")
    open_head = F.substring(head, F.lit(1), F.length(head) - 1)
    return F.when(F.size(rs) > 0, F.concat(open_head, F.lit(',"Resources":['), body, F.lit("]}"))).otherwise(head)


def repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that several documents have."""
    d = table(spark, sf_dir, "documents", parallel=False).where("doc_id is not null")
    return d.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")


def annotation_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, response)``: one annotation-service JSON response per post,
    rebuilt from the stored table's columns (numbers quoted every other row; posts
    without candidates get no ``Resources`` key at all).

    A post's resources lie in its own row, so nothing is shuffled for them.  Only where
    documents share an id are they those of all posts of that id, gathered by id."""
    posts = post_texts(spark, sf_dir).select("id", "doc_id", "text")
    shared = repeated_documents(spark, sf_dir)
    out = ("id", _response(F.col("rs")).alias("response"))
    if shared.isEmpty():
        return _with_resources(posts).select(*out)
    own = _with_resources(posts.join(shared, "doc_id", "left_anti"))
    several = posts.join(shared, "doc_id", "left_semi")
    grouped = (_with_resources(several).where("rs is not null").groupBy("id")
               .agg(F.array_sort(F.flatten(F.collect_list("rs"))).alias("rs")))
    return own.select(*out).unionByName(several.join(grouped, "id", "left").select(*out))


def gazetteer_from_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surface forms: words of >= 6 letters, and adjacent space-separated pairs of
    alphabetic tokens of >= 4 letters; one entry per surface form."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    uni = b.select(F.explode(F.split("text", "[^A-Za-z]+")).alias("sf")).where(F.length("sf") >= 6)
    toks = b.select(F.split("text", " ").alias("t"))
    pairs = toks.select(F.explode(F.zip_with(F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))),
                                             F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0))),
                                             lambda a, c: F.when(a.rlike("^[A-Za-z]{4,}$")
                                                                 & c.rlike("^[A-Za-z]{4,}$"),
                                                                 F.concat(a, F.lit(" "), c))))
                        .alias("sf")).where(F.col("sf").isNotNull())
    sf = uni.union(pairs).distinct()
    s = F.col("sf")
    page = F.when(F.instr(s, " ") > 0, F.replace(s, F.lit(" "), F.lit("_"))).otherwise(
        F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 30)))
    return sf.select(
        s.alias("surface_form"), F.concat(F.lit(RESOURCE_PREFIX), page).alias("uri"),
        (F.length(s) * 10).cast("int").alias("support"),
        F.array(F.lit("Schema:Thing"), F.lit("DBpedia:Concept")).alias("types"),
        (((F.length(s) * 7 + F.ascii(s)) % 50 + 50) / F.lit(100.0)).alias("similarity_score"),
        ((F.ascii(F.substring(s, 2, 1)) % 20) / F.lit(100.0)).alias("percentage_of_second_rank"))
