"""URL filter: host/path rules first, then a list of canonical URLs.

The list is looked up in two steps.  A blocked Bloom filter (``bloom``)
passes the possible hits; an exact hash join with the list removes its false
positives.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from annolink.llm.bloom import blocks_of, with_possible


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "example.org/es/")``: host up to the first slash, path from it."""
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, verdict)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling per page: no scheme, query or fragment, no leading ``www.``
    or ``m.``, no ``.html`` and no slash at the end.  Null without a host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    page = F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.html?$", "")
    return F.when(host != "", F.concat(bare, page))


def first_fit(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule whose host is the url's or a parent
    domain of it and whose path starts the url's; ties go to the longer host."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (),
               listed_verdict: str = "block", other_verdict: str = "allow") -> DataFrame:
    """``pages(page_id, url)`` and ``listed(canonical)`` -> ``page_id, host, path,
    rule, verdict, listed``.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is never listed.  Null or repeated entries of the list count once or not
    at all; repeated pages are judged one by one; other columns are ignored.
    """
    url = F.col("url").cast("string")
    host, path = F.col("host"), F.col("path")
    name, verdict = first_fit(host, path, rules)
    base = (pages.select(F.col("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
            .select("*", name.alias("rule"), verdict.alias("rule_verdict"), canonical(host, path).alias("canonical")))
    listed = listed.select("canonical").where(F.col("canonical").isNotNull()).distinct()
    probed = with_possible(base, "canonical", blocks_of(listed, "canonical"), "maybe")
    hits = (probed.where("maybe").drop("maybe")
            .join(listed.withColumn("listed", F.lit(True)), "canonical", "left"))
    rest = probed.where("not maybe").drop("maybe").withColumn("listed", F.lit(False))
    every = hits.unionByName(rest)
    on_list = F.coalesce(F.col("listed"), F.lit(False))
    return every.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(on_list, listed_verdict).otherwise(other_verdict)).alias("verdict"),
        on_list.alias("listed"))


def repeated_pages(pages: DataFrame, least: int = 2) -> DataFrame:
    """A list from the table itself: canonical URLs that at least ``least`` pages carry."""
    url = F.col("url").cast("string")
    return (pages.select(host_of(url).alias("host"), path_of(url).alias("path"))
            .select(canonical(F.col("host"), F.col("path")).alias("canonical")).where("canonical is not null")
            .groupBy("canonical").count().where(F.col("count") >= least).select("canonical"))
