"""Annotation quality gate: similarity, second rank, normalised edit distance.

Checks run cheap-first and the first failure names the ``reason``:
``invalid_annotation`` (a needed field is null), ``low_similarity``,
``close_second_rank``, ``far_edit_distance``; otherwise ``keep``.

Boundaries follow the reference model exactly: similarity 0.7 is kept, second
rank 0.1 is kept and NaN is kept (NaN compares false on the JVM, true in Spark,
hence the ``isnan`` guard), an edit ratio of exactly 3/4 is kept and two empty
strings (0/0) are kept.  The ratio test is integer cross-multiplication, so it
is exact and cannot hit ANSI divide-by-zero.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from annolink import config
from annolink._util import bind_once, col_of
from annolink.functions.text import page_label, page_name, utf16_chars, utf16_length

REASONS = ["invalid_annotation", "low_similarity", "close_second_rank", "far_edit_distance", "keep"]


def _ratio(x) -> Fraction:
    return x if isinstance(x, Fraction) else Fraction(str(x))


def edit_ratio_exceeds(label, surface, ratio=config.EDIT_RATIO_MAX) -> Column:
    """``levenshtein(label, surface) / max(len) > ratio`` without dividing."""
    r = _ratio(ratio)

    def body(x):
        lab, sf = x["label"], x["surface"]
        # characters are UTF-16 units unless a text has four-byte characters; no text of plain ASCII has
        plain = (F.octet_length(lab) == F.length(lab)) & (F.octet_length(sf) == F.length(sf))
        longest = F.when(plain, F.greatest(F.length(lab), F.length(sf))).otherwise(F.greatest(utf16_length(lab), utf16_length(sf)))
        edits = F.when(plain, F.levenshtein(lab, sf)).otherwise(F.levenshtein(utf16_chars(lab), utf16_chars(sf)))
        return edits.cast("long") * r.denominator > longest.cast("long") * r.numerator

    # bound once: the two texts may be computed columns, which the optimizer would copy into every reference
    return bind_once(F.struct(col_of(label).alias("label"), col_of(surface).alias("surface")), body)


def gate_reason(similarity="similarity_score", second_rank="percentage_of_second_rank",
                uri="uri", surface_form="surface_form", *,
                similarity_min: float = config.SIMILARITY_MIN,
                second_rank_max: float = config.SECOND_RANK_MAX,
                edit_ratio_max=config.EDIT_RATIO_MAX) -> Column:
    sim, sr, u, sf = col_of(similarity), col_of(second_rank), col_of(uri), col_of(surface_form)
    label = page_label(page_name(u))
    return (F.when(sim.isNull() | sr.isNull() | u.isNull() | sf.isNull(), F.lit("invalid_annotation"))
            .when(sim < F.lit(float(similarity_min)), F.lit("low_similarity"))
            .when((sr > F.lit(float(second_rank_max))) & ~F.isnan(sr), F.lit("close_second_rank"))
            .when(edit_ratio_exceeds(label, sf, edit_ratio_max), F.lit("far_edit_distance"))
            .otherwise(F.lit("keep")))


def gate_struct_reason(a: Column, **kw) -> Column:
    """Same gate on an annotation struct (array form)."""
    return gate_reason(a["similarity_score"], a["percentage_of_second_rank"], a["uri"],
                       a["surface_form"], **kw)


def gate_passes(similarity="similarity_score", second_rank="percentage_of_second_rank",
                uri="uri", surface_form="surface_form", *,
                similarity_min: float = config.SIMILARITY_MIN,
                second_rank_max: float = config.SECOND_RANK_MAX,
                edit_ratio_max=config.EDIT_RATIO_MAX) -> Column:
    """The gate as a conjunction of plain comparisons, which reach the scan; the
    same rows as ``gate_reason(...) == "keep"`` (NaN is above every number)."""
    sim, sr, u, sf = col_of(similarity), col_of(second_rank), col_of(uri), col_of(surface_form)
    near = ~edit_ratio_exceeds(page_label(page_name(u)), sf, edit_ratio_max)
    return ((sim >= F.lit(float(similarity_min))) & ((sr <= F.lit(float(second_rank_max))) | (sr == F.lit(float("nan"))))
            & u.isNotNull() & sf.isNotNull() & near)


def with_gate_reason(annotations: DataFrame, **kw) -> DataFrame:
    return annotations.withColumn("reason", gate_reason(**kw))


def gate(annotations: DataFrame, **kw) -> DataFrame:
    """Keep only annotations that pass every check."""
    return annotations.where(gate_passes(**kw))


def gate_counts(annotations: DataFrame, **kw) -> DataFrame:
    """Audit: annotations per gate reason (partial aggregation, 5 groups)."""
    return (with_gate_reason(annotations, **kw).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n")))


def service_minima(annotations: DataFrame, min_support: int = config.SERVICE_SUPPORT_MIN,
                   min_confidence: float | None = config.SERVICE_CONFIDENCE_MIN,
                   support: str = "support", confidence: str | None = None) -> DataFrame:
    """The annotation service's request minima applied to a stored table:
    ``support >= min_support`` and, when a confidence column exists,
    ``confidence >= min_confidence``.  A typed parquet column pushes to the scan."""
    cond = F.col(support) >= F.lit(min_support)
    if confidence is not None and min_confidence is not None:
        cond = cond & (F.col(confidence) >= F.lit(float(min_confidence)))
    return annotations.where(cond)
