"""Record model: wire schemas (what ``from_json`` reads) and typed schemas.

Wire schemas read every scalar as STRING so that numbers sent either bare or
quoted decode the same way (a typed field gives NULL for a quoted number); the
codec then ``try_cast``s them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, F = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------- wire (input)
WIRE_HASHTAG = _struct(("indices", T.ArrayType(S)), ("text", S))
WIRE_URL = _struct(("url", S), ("expanded_url", S), ("display_url", S),
                   ("indices", T.ArrayType(S)))
WIRE_ENTITIES = _struct(("hashtags", T.ArrayType(WIRE_HASHTAG)),
                        ("urls", T.ArrayType(WIRE_URL)))
WIRE_USER = _struct(("id", S), ("name", S), ("screenName", S), ("location", S),
                    ("followersCount", S))
WIRE_POST = _struct(("id", S), ("text", S), ("lang", S), ("user", WIRE_USER),
                    ("retweet_count", S), ("favorite_count", S), ("timestamp_ms", S),
                    ("entities", T.VariantType()), ("_corrupt_record", S))   # tells absent from JSON null

WIRE_RESOURCE = _struct(("@URI", S), ("@support", S), ("@types", S), ("@surfaceForm", S),
                        ("@offset", S), ("@similarityScore", S),
                        ("@percentageOfSecondRank", S))
WIRE_RESPONSE = _struct(("@text", S), ("@confidence", S), ("@support", S), ("@types", S),
                        ("@sparql", S), ("@policy", S),
                        ("Resources", T.ArrayType(WIRE_RESOURCE)), ("_corrupt_record", S))

# ---------------------------------------------------------------- typed model
HASHTAG = _struct(("indices", T.ArrayType(I)), ("text", S))
URL = _struct(("url", S), ("expanded_url", S), ("display_url", S), ("indices", T.ArrayType(I)))
ENTITIES = _struct(("hashtags", T.ArrayType(HASHTAG)), ("urls", T.ArrayType(URL)))
USER = _struct(("id", L), ("name", S), ("screenName", S), ("location", S),
               ("followersCount", I))
POST = _struct(("id", L), ("text", S), ("lang", S), ("user", USER), ("retweet_count", I),
               ("favorite_count", I), ("timestamp_ms", L), ("entities", ENTITIES))

POST_COLUMNS = [f.name for f in POST.fields]

ANNOTATION = _struct(("uri", S), ("support", I), ("types", T.ArrayType(S)),
                     ("surface_form", S), ("offset", I), ("similarity_score", D),
                     ("percentage_of_second_rank", D))
ANNOTATION_COLUMNS = [f.name for f in ANNOTATION.fields]

# stored annotation table: one row per (post id, position in the response)
STORED_ANNOTATION = T.StructType([T.StructField("id", L), T.StructField("pos", I)]
                                 + list(ANNOTATION.fields))

# gazetteer for the dictionary annotator
GAZETTEER = _struct(("surface_form", S), ("uri", S), ("support", I), ("types", T.ArrayType(S)),
                    ("similarity_score", D), ("percentage_of_second_rank", D))

# topic envelope
ENVELOPE = _struct(("topic", S), ("key", L), ("value", S))
