"""Consumer-side projections: the annotation report and the post date-time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from annolink import config
from annolink._util import col_of
from annolink.functions.text import pad_right_keep
from annolink.functions.time import epoch_ms_to_iso


def has_links(entities="entities") -> Column:
    return F.coalesce(F.size(col_of(entities)["urls"]) > 0, F.lit(False))


def report_line(u: Column) -> Column:
    return F.concat(F.lit("\t"), pad_right_keep(u["display_url"], config.REPORT_PAD), F.lit("at "),
                    F.get(u["indices"], 0).cast("string"), F.lit(":\t"), u["url"], F.lit("\n"))


def annotation_report(id="id", entities="entities") -> Column:
    """Header with the post id, then one line per link; ``""`` for posts
    without links (never null)."""
    e = col_of(entities)
    body = F.array_join(F.transform(e["urls"], report_line), "")
    return F.when(has_links(e), F.concat(F.lit(config.REPORT_HEADER), col_of(id).cast("string"),
                                         F.lit("\n"), body)).otherwise(F.lit(""))


def post_datetime(timestamp_ms="timestamp_ms") -> Column:
    return epoch_ms_to_iso(timestamp_ms)
