"""String semantics of the reference model expressed with built-in functions.

The model counts text in UTF-16 units and trims every character <= U+0020 (the
JVM string rules); Spark counts code points and ``trim`` removes spaces only, so
both are spelled out here.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from annolink._util import bind_once, col_of


#: ``$`` in a pattern also matches before one of these at the end.
_LINE_ENDS = ("\n", "\r", "\u0085", "\u2028", "\u2029")


def java_trim(c) -> Column:
    """Strip every leading/trailing character <= U+0020 (tab, newline, ...)."""
    return F.regexp_replace(col_of(c), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def utf16_length(c) -> Column:
    """Length in UTF-16 code units (a character outside the BMP counts 2)."""
    return (F.octet_length(F.encode(col_of(c), "UTF-16BE")) / 2).cast("int")


def trimmed_longer_than(c, units: int) -> Column:
    """Whether the trimmed text has more than ``units`` UTF-16 units.  A text has at least
    as many bytes as units, and trimming only shortens it, so most texts need no trim."""
    s = col_of(c)
    return (F.octet_length(s) > units) & (utf16_length(s) > units) & (utf16_length(java_trim(s)) > units)


def comma_list(c) -> Column:
    """Comma list -> trimmed array with the JVM ``split(",")`` rule: trailing
    empty items are dropped, ``""`` gives ``[""]`` and ``","`` gives ``[]``."""
    def trim(x):        # the pattern can only match where one of these holds
        last = F.right(x, F.lit(1))
        return F.when((F.left(x, F.lit(1)) <= " ") | (last <= " ") | last.isin(*_LINE_ENDS), java_trim(x)).otherwise(x)

    def parts(stripped):
        return F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(stripped, ","), trim))

    def body(s):
        end = F.right(s, F.lit(1))
        stripped = F.when((end == ",") | end.isin(*_LINE_ENDS), F.regexp_replace(s, ",+$", "")).otherwise(s)
        return F.when(s.isNull(), F.lit(None)).when(s == "", F.array(F.lit(""))).otherwise(bind_once(stripped, parts))

    return bind_once(col_of(c), body)


def pad_right_keep(c, width: int) -> Column:
    """Right-pad with spaces to ``width`` UTF-16 units, never cutting (``rpad``
    would cut longer strings)."""
    s = col_of(c)
    return F.concat(s, F.repeat(F.lit(" "), F.greatest(F.lit(width) - utf16_length(s), F.lit(0))))


def page_name(uri) -> Column:
    """Text after the last ``/`` (whole string without a slash, empty after a
    trailing slash); no percent-decoding."""
    return F.substring_index(col_of(uri), "/", -1)


def page_label(page) -> Column:
    return F.replace(col_of(page), F.lit("_"), F.lit(" "))


def starts_with_brace(value) -> Column:
    """The JSON-object guard: the value starts with ``{`` (no trimming)."""
    return F.startswith(col_of(value), F.lit("{"))


def split_terms(terms: str | list[str]) -> list[str]:
    """Comma list of terms/topics -> trimmed, non-empty items (argument side)."""
    if isinstance(terms, str):
        terms = terms.split(",")
    return [t.strip() for t in terms if t and t.strip()]


def utf16_chars(c) -> Column:
    """The text with one character per UTF-16 unit: both halves of a surrogate
    pair become private-use characters.  For functions that count characters."""
    s = col_of(c)
    units = F.regexp_replace(F.hex(F.encode(s, "UTF-16BE")), "(.{4})", "0000$1")
    # eight digits a unit; \\G keeps the match on unit boundaries
    units = F.regexp_replace(units, r"\G((?:.{8})*?)0000(D[89A-F]..)", "$1000F$2")
    return F.when(s.rlike(r"[\x{10000}-\x{10FFFF}]"), F.decode(F.unhex(units), "UTF-32")).otherwise(s)
