"""Annotations -> positioned links, and links -> post entities.

Two equivalent forms:
* array form: ``filter`` + ``transform`` over a post's annotation array, no shuffle;
* exploded form: one row per annotation, gate as a plain filter (whole-stage
  codegen), regrouped per post only when an array is needed, ordered by the
  original position (never by ``collect_list`` arrival order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from annolink import config, schema
from annolink._util import col_of
from annolink.functions.text import page_name, utf16_length
from annolink.operators.gate import gate_passes, gate_struct_reason


def link_struct(uri="uri", surface_form="surface_form", offset="offset",
                lang: str = config.LINK_LANG) -> Column:
    """url = expanded url = wiki prefix + page; display = surface form;
    indices = [offset, offset + UTF-16 length of the surface form)."""
    u, sf, off = col_of(uri), col_of(surface_form), col_of(offset)
    url = F.concat(F.lit(config.wiki_prefix(lang)), page_name(u))
    return F.struct(url.alias("url"), url.alias("expanded_url"), sf.alias("display_url"),
                    F.array(off, off + utf16_length(sf)).alias("indices"))


def type_class(types="types", prefix: str = config.TYPE_PREFIX) -> Column:
    """First type starting with the ontology prefix, prefix removed; ``""`` if none."""
    first = F.get(F.filter(col_of(types), lambda t: F.startswith(t, F.lit(prefix))), 0)
    return F.coalesce(F.substring(first, len(prefix) + 1, 1 << 30), F.lit(""))


def links_from_array(annotations: Column, **gate_kw) -> Column:
    """Array form: kept annotations -> links, in response order."""
    kept = F.filter(annotations, lambda a: gate_struct_reason(a, **gate_kw) == "keep")
    return F.transform(kept, lambda a: link_struct(a["uri"], a["surface_form"], a["offset"]))


def kept_links(annotations: DataFrame, key: str = "id", pos: str = "pos", **gate_kw) -> DataFrame:
    """Exploded form: ``(key, pos, link)`` for every kept annotation of a key."""
    return (annotations.where(F.col(key).isNotNull() & gate_passes(**gate_kw))
            .select(key, pos, link_struct().alias("link")))


def group_links(links: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """``(key, pos, link)`` rows -> ``(key, urls)`` ordered by position.  The
    partial ``collect_list`` runs map-side before the shuffle on ``key``."""
    agg = links.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"),
                                                                       F.col("link").alias("l")))).alias("_s"))
    return agg.select(key, F.transform("_s", lambda x: x["l"]).alias("urls"))


def entities_with_links(urls) -> Column:
    """New entities: hashtags emptied, urls replaced (never null)."""
    empty_urls = F.array().cast(schema.ENTITIES["urls"].dataType)
    return F.struct(F.array().cast(schema.ENTITIES["hashtags"].dataType).alias("hashtags"),
                    F.coalesce(col_of(urls), empty_urls).alias("urls"))


def replace_entities(posts: DataFrame, urls="urls") -> DataFrame:
    return posts.withColumn("entities", entities_with_links(urls))
