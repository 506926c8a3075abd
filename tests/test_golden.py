"""The reference's only golden values: three posts, four links."""

from pyspark.sql import functions as F

from annolink import schema
from annolink.operators import annotate, codec, enrich, link
from annolink.operators.gate import gate_reason

TEXTS = [
    (1, "Hamburg is a marvelous city!"),
    (2, "Dude, I can only say Hamburg harbour under the skyline of the Elbphilharmonie."),
    (3, "I will be there tomorrow, now I will have a look on the Alster."),
]
R = "http://dbpedia.org/resource/"
# hand-written annotations with passing scores (the service's scores are not recorded)
ANNOTATIONS = [
    (1, 0, R + "Hamburg", 100, ["Schema:Place"], "Hamburg", 0, 0.99, 0.0),
    (2, 0, R + "Port_of_Hamburg", 50, ["Schema:Place"], "Hamburg harbour", 21, 0.99, 0.0),
    (2, 1, R + "Elbphilharmonie", 40, [], "Elbphilharmonie", 62, 0.99, 0.0),
    (3, 0, R + "Alster", 30, ["DBpedia:River"], "Alster", 56, 0.99, 0.0),
]
EXPECTED = {
    1: [("https://en.wikipedia.org/wiki/Hamburg", "Hamburg", [0, 7])],
    2: [("https://en.wikipedia.org/wiki/Port_of_Hamburg", "Hamburg harbour", [21, 36]),
        ("https://en.wikipedia.org/wiki/Elbphilharmonie", "Elbphilharmonie", [62, 77])],
    3: [("https://en.wikipedia.org/wiki/Alster", "Alster", [56, 62])],
}


def _posts(spark):
    return spark.createDataFrame(
        [(i, t, "en", (7, "User A", "user_a", "Somewhere", 3), 1, 2, 1700000000000, None) for i, t in TEXTS],
        schema.POST)


def _links_of(df):
    return {r["id"]: [(u["url"], u["display_url"], list(u["indices"])) for u in r["entities"]["urls"]]
            for r in df.collect()}


def test_offsets_agree_with_texts():
    for i, t in TEXTS:
        for url, display, (a, b) in EXPECTED[i]:
            assert t[a:b] == display


def test_stored_lookup_golden(spark):
    ann = spark.createDataFrame(ANNOTATIONS, schema.STORED_ANNOTATION)
    out = annotate.stored_lookup(_posts(spark), ann)
    assert _links_of(out) == EXPECTED
    assert all(len(r["entities"]["hashtags"]) == 0 for r in out.collect())


def test_near_threshold_row_is_kept(spark):
    # "Port of Hamburg" vs "Hamburg harbour": distance 11 of 15 = 0.733 <= 0.75
    df = spark.createDataFrame([(R + "Port_of_Hamburg", "Hamburg harbour", 0.99, 0.0)],
                               "uri string, surface_form string, similarity_score double, "
                               "percentage_of_second_rank double")
    r = df.select(F.levenshtein(F.lit("Port of Hamburg"), "surface_form").alias("d"),
                  gate_reason().alias("reason")).first()
    assert r["d"] == 11 and r["reason"] == "keep"


def test_array_form_equals_exploded_form(spark):
    ann = spark.createDataFrame(ANNOTATIONS, schema.STORED_ANNOTATION)
    arr = ann.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(
        *[F.col(c) for c in schema.ANNOTATION_COLUMNS]).alias("a")))).alias("s"))
    arr = arr.select("id", link.links_from_array(F.transform("s", lambda x: x["a"])).alias("urls"))
    got = {r["id"]: [(u["url"], u["display_url"], list(u["indices"])) for u in r["urls"]] for r in arr.collect()}
    assert got == EXPECTED


def test_enrichment_json_to_json(spark):
    posts = _posts(spark)
    env = codec.encode_posts(posts).withColumn("topic", F.lit("raw"))
    env = env.unionByName(spark.createDataFrame([("raw", 99, "not json"), ("raw", 98, None)],
                                                "topic string, key long, value string"))
    ann = spark.createDataFrame(ANNOTATIONS, schema.STORED_ANNOTATION)
    links = link.group_links(link.kept_links(ann)).withColumnRenamed("id", "jkey")
    out = enrich.enrich_with_links(env, links, lambda p: p["id"])
    rows = {r["key"]: r for r in out.collect()}
    assert len(rows) == 5  # row count preserved
    assert rows[99]["route"] == "passthrough" and rows[99]["value"] == "not json"
    assert rows[98]["route"] == "passthrough" and rows[98]["value"] is None
    dec = codec.decode_posts(out.where("route = 'enriched'"))
    assert _links_of(codec.valid_posts(dec)) == EXPECTED
