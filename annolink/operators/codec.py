"""JSON codec for posts and annotation responses (decode with reasons, encode).

Decoding never fails a job: every row gets either a typed record or a stable
``reason`` (first failing check wins).  ``strict=True`` turns a reason into a
task error instead, which mirrors the reference's fail-the-stream behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from annolink import config, schema
from annolink._util import bind_once, col_of
from annolink.functions.text import comma_list, trimmed_longer_than

# Lenient reader, as the reference's parser accepts unquoted names and comments.
JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
    "allowUnquotedFieldNames": "true",
    "allowComments": "true",
    "allowSingleQuotes": "true",
    "allowNonNumericNumbers": "true",
}

POST_REQUIRED = [("id", "bigint"), ("text", None), ("lang", None),
                 ("retweet_count", "int"), ("favorite_count", "int"),
                 ("timestamp_ms", "bigint")]


def _num(c: Column, typ: str) -> Column:
    """A JSON number of that type; integers drop a fraction (``1.0`` is 1)."""
    return F.coalesce(c.try_cast(typ), F.split_part(c.try_cast("decimal(38,6)").cast("string"), F.lit("."),
                                                    F.lit(1)).try_cast(typ))


def _bad_num(c: Column, typ: str) -> Column:
    """Present but not a number of that type."""
    return c.isNotNull() & _num(c, typ).isNull()


def _first_reason(checks: list[tuple[Column, str]]) -> Column:
    expr = None
    for cond, reason in checks:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr.otherwise(F.lit(None).cast("string"))


def _pair(arr: Column) -> Column:
    """First two indices as INT (extra elements ignored)."""
    return F.array(_num(F.get(arr, 0), "int"), _num(F.get(arr, 1), "int"))


def _bad_pair(arr: Column) -> Column:
    return (arr.isNull() | (F.size(arr) < 2)
            | _num(F.get(arr, 0), "int").isNull() | _num(F.get(arr, 1), "int").isNull())


def _typed_entities(e: Column) -> Column:
    hashtags = F.transform(e["hashtags"], lambda h: F.struct(_pair(h["indices"]).alias("indices"),
                                                             h["text"].alias("text")))
    urls = F.transform(e["urls"], lambda u: F.struct(
        u["url"].alias("url"), u["expanded_url"].alias("expanded_url"),
        u["display_url"].alias("display_url"), _pair(u["indices"]).alias("indices")))
    return F.when(e.isNull(), F.lit(None).cast(schema.ENTITIES)).otherwise(
        F.struct(hashtags.alias("hashtags"), urls.alias("urls")))


def _typed_user(u: Column) -> Column:
    return F.when(u.isNull(), F.lit(None).cast(schema.USER)).otherwise(F.struct(
        F.coalesce(_num(u["id"], "bigint"), F.lit(0).cast("bigint")).alias("id"),
        u["name"].alias("name"), u["screenName"].alias("screenName"),
        u["location"].alias("location"),
        F.coalesce(_num(u["followersCount"], "int"), F.lit(0)).alias("followersCount")))


def post_checks(value: Column, w: Column, e: Column, require_user: bool,
                max_units: int = config.MAX_TEXT_UNITS) -> list[tuple[Column, str]]:
    """``w`` is the parsed record, ``e`` its entities in their wire shape."""
    checks: list[tuple[Column, str]] = [
        (value.isNull(), "null_value"),
        (w.isNull() | w["_corrupt_record"].isNotNull(), "malformed_json"),
    ]
    for name, typ in POST_REQUIRED:
        checks.append((w[name].isNull(), f"missing_{name}"))
        if typ:
            checks.append((_bad_num(w[name], typ), f"invalid_{name}"))
    u = w["user"]
    if require_user:
        checks.append((u.isNull(), "missing_user"))
    checks.append((u.isNotNull() & (_bad_num(u["id"], "bigint")
                                    | _bad_num(u["followersCount"], "int")), "invalid_user"))
    # absent entities is fine; an explicit JSON null is not
    checks.append((F.is_variant_null(w["entities"]), "null_entities"))
    checks.append((w["entities"].isNotNull() & (e.isNull() | e["hashtags"].isNull() | e["urls"].isNull()),
                   "invalid_entities"))
    checks.append((e.isNotNull() & F.exists(e["hashtags"], lambda h: h.isNull()
                                            | h["text"].isNull() | _bad_pair(h["indices"])),
                   "invalid_hashtag"))
    checks.append((e.isNotNull() & F.exists(e["urls"], lambda x: x.isNull()
                                            | x["url"].isNull() | x["expanded_url"].isNull()
                                            | x["display_url"].isNull()
                                            | _bad_pair(x["indices"])),
                   "invalid_url"))
    checks.append((trimmed_longer_than(w["text"], max_units), "text_too_long"))
    return checks


def post_struct(w: Column, e: Column) -> Column:
    return F.struct(
        _num(w["id"], "bigint").alias("id"), w["text"].alias("text"), w["lang"].alias("lang"),
        _typed_user(w["user"]).alias("user"),
        _num(w["retweet_count"], "int").alias("retweet_count"),
        _num(w["favorite_count"], "int").alias("favorite_count"),
        _num(w["timestamp_ms"], "bigint").alias("timestamp_ms"),
        _typed_entities(e).alias("entities"))


def _bind_once(parsed, body):
    """Evaluate ``body`` over ``parsed`` bound to one lambda variable.

    The decode checks reference the parsed record ~25 times; written as plain
    columns, the optimizer's filter pushdown and projection merging inline the
    JSON parse into every reference, and stacked decode/encode stages multiply
    the plan size.  A lambda variable cannot be inlined, so each stage refers to
    its input exactly once and the parse runs once per row."""
    return bind_once(parsed, body)


def _computed_once(df: DataFrame, name: str, struct: Column) -> DataFrame:
    """Adds a struct column that no later filter or projection can compute again: it
    comes out of a one-element generator, which the optimizer doesn't look through."""
    return df.select("*", F.explode(F.array(struct)).alias(name))


#: The shape of entities on the wire, for reading them out of the parsed value.
_WIRE_ENTITIES = schema.WIRE_ENTITIES.simpleString()


def decode_posts(df: DataFrame, value: str = "value", *, require_user: bool = False,
                 strict: bool = False, max_units: int = config.MAX_TEXT_UNITS) -> DataFrame:
    """Adds ``post`` (typed struct, null when rejected) and ``reason``.

    A value is parsed once, whatever filters follow: the same parse gives the fields
    and, as a semi-structured value, the entities, of which absent and JSON null are
    told apart."""
    v = F.col(value)

    def body(x):
        w, e = x["w"], x["e"]
        reason = _first_reason(post_checks(v, w, e, require_user, max_units))
        if strict:
            reason = F.when(reason.isNotNull(), F.raise_error(
                F.concat(F.lit("post rejected: "), reason))).otherwise(reason)
        return F.struct(reason.alias("reason"), F.when(reason.isNull(), post_struct(w, e)).alias("post"))

    def with_entities(w):
        return F.struct(w.alias("w"), F.try_variant_get(w["entities"], "$", _WIRE_ENTITIES).alias("e"))

    parsed = _bind_once(F.from_json(v, schema.WIRE_POST, JSON_OPTIONS), with_entities)
    out = _computed_once(df, "_d", _bind_once(parsed, body))
    return out.withColumn("reason", F.col("_d.reason")).withColumn("post", F.col("_d.post")).drop("_d")


def valid_posts(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return decoded.where(F.col("reason").isNull()).select(*keep, "post.*")


def rejected(decoded: DataFrame, keep: list[str] | None = None, value: str = "value") -> DataFrame:
    keep = keep or []
    return decoded.where(F.col("reason").isNotNull()).select(*keep, value, "reason")


def user_json_struct(u: Column) -> Column:
    return F.struct(F.coalesce(u["id"], F.lit(0).cast("bigint")).alias("id"), u["name"].alias("name"),
                    u["screenName"].alias("screenName"), u["location"].alias("location"),
                    F.coalesce(u["followersCount"], F.lit(0)).alias("followersCount"))


def post_json(id=None, text=None, lang=None, user=None, retweet_count=None, timestamp_ms=None,
              favorite_count=None, entities=None) -> Column:
    """Encode one post as JSON: ``typ`` first, then the model's field order; null
    fields (and absent entities) are omitted; link arrays are always written."""
    c = lambda x, d: col_of(x if x is not None else d)
    return F.to_json(F.struct(
        F.lit(config.POST_TYP).alias("typ"), c(id, "id").alias("id"), c(text, "text").alias("text"),
        c(lang, "lang").alias("lang"), user_json_struct(c(user, "user")).alias("user"),
        c(retweet_count, "retweet_count").alias("retweet_count"),
        c(timestamp_ms, "timestamp_ms").alias("timestamp_ms"),
        c(favorite_count, "favorite_count").alias("favorite_count"),
        c(entities, "entities").alias("entities")))


def encode_posts(df: DataFrame, out: str = "value") -> DataFrame:
    """Typed post columns -> ``key`` (post id) and JSON ``value``."""
    return df.select(F.col("id").alias("key"), post_json().alias(out))


# ------------------------------------------------------------- annotations

RESPONSE_REQUIRED = ["@text", "@confidence", "@support", "@types", "@sparql", "@policy"]


def _annotation_bad(a: Column) -> Column:
    """A typed annotation lacks a field: its resource is null, or the field absent or no number."""
    bad = F.lit(False)
    for name in schema.ANNOTATION_COLUMNS:
        bad = bad | a[name].isNull()
    return bad


def annotation_struct(r: Column) -> Column:
    return F.struct(
        r["@URI"].alias("uri"), _num(r["@support"], "int").alias("support"),
        comma_list(r["@types"]).alias("types"), r["@surfaceForm"].alias("surface_form"),
        _num(r["@offset"], "int").alias("offset"),
        _num(r["@similarityScore"], "double").alias("similarity_score"),
        _num(r["@percentageOfSecondRank"], "double").alias("percentage_of_second_rank"))


def decode_annotation_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Annotation service response JSON -> ``annotations`` struct + ``reason``.

    Missing ``Resources`` decodes to an empty list (kept in response order)."""
    v = F.col(response)

    def typed(w):
        wire = F.coalesce(w["Resources"], F.array().cast(schema.WIRE_RESPONSE["Resources"].dataType))
        return F.struct(w.alias("w"), F.transform(wire, annotation_struct).alias("resources"))

    def body(x):
        w, resources = x["w"], x["resources"]
        checks = [(v.isNull(), "null_value"),
                  (w.isNull() | w["_corrupt_record"].isNotNull(), "malformed_json")]
        for name in RESPONSE_REQUIRED:
            checks.append((w[name].isNull(), f"missing_{name.lstrip('@')}"))
        checks.append((_bad_num(w["@confidence"], "float"), "invalid_confidence"))
        checks.append((_bad_num(w["@support"], "int"), "invalid_support"))
        checks.append((F.exists(resources, _annotation_bad), "invalid_resource"))
        reason = _first_reason(checks)
        wrapper = F.struct(
            w["@text"].alias("text"), _num(w["@confidence"], "float").alias("confidence"),
            _num(w["@support"], "int").alias("support"), comma_list(w["@types"]).alias("types"),
            w["@sparql"].alias("sparql"), w["@policy"].alias("policy"), resources.alias("resources"))
        return F.struct(reason.alias("reason"), F.when(reason.isNull(), wrapper).alias("annotations"))

    parsed = _bind_once(F.from_json(v, schema.WIRE_RESPONSE, JSON_OPTIONS), typed)
    out = _computed_once(df, "_d", _bind_once(parsed, body))
    return (out.withColumn("reason", F.col("_d.reason"))
            .withColumn("annotations", F.col("_d.annotations")).drop("_d"))


def response_to_rows(decoded: DataFrame, key: str = "id") -> DataFrame:
    """Annotation responses -> stored annotation rows ``(key, pos, ...)``."""
    return (decoded.where(F.col("reason").isNull())
            .select(key, F.posexplode("annotations.resources").alias("pos", "a"))
            .select(key, F.col("pos").cast("int").alias("pos"), "a.*"))
