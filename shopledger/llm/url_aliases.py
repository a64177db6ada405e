"""URL filter whose block decisions also reach the aliases of a page.

A rule names a host and a path prefix; it fits the host and all its subdomains, and the longest fitting rule decides. Pages
that redirect (meta refresh, or a given table of redirects) or name a canonical address form a graph of addresses; its
connected components are found by a distributed contraction. An address without a rule of its own is blocked if its
component holds a blocked one; an address with a rule keeps that rule's verdict, so an explicit allow stands. The rest is
allowed.

An address is known by host (A-Z lower-cased), path and query; scheme and fragment don't count. Relative targets are resolved
against the page's address, without removing dot segments; targets of other schemes than those with `//` are ignored.

Defined cases: a null url, or one without `://`, has empty host and path and no aliases; null html names none; equal rows
get equal results; of equally long rules an allow comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.components import components
from shopledger.llm.scratch import saved

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def address_of(url: Column) -> Column:
    """Null where there is no `://`."""
    whole = F.concat(host_of(url), path_of(url), F.regexp_extract(url, _ADDRESS, 3))
    return F.when(F.contains(url, F.lit("://")), whole)


def decision(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.verdict != ALLOW, r.text))
    fits = [
        F.when(
            ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)),
            F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def _targets(html: Column) -> Column:
    """Addresses named by canonical links and meta refreshes, as they are written."""
    def attribute(tag: Column, name: str) -> Column:
        value = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("([^"]*)"|'([^']*)'|([^\s"'>]+))""", 1)
        return F.replace(F.regexp_replace(value, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&"))

    def has(tag: Column, name: str, value: str) -> Column:
        return F.lower(F.trim(attribute(tag, name))) == value

    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)), lambda t: has(t, "rel", "canonical"))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), lambda t: has(t, "http-equiv", "refresh"))
    return F.concat(
        F.transform(links, lambda t: F.trim(attribute(t, "href"))),
        F.transform(metas, lambda t: F.regexp_extract(attribute(t, "content"), r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)),
    )


def _resolved(url: Column, target: Column) -> Column:
    base = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    return (
        F.when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target))
        .when(F.rlike(target, F.lit(r"(?i)^[a-z][a-z0-9+.-]*://")), target)
        .when(F.rlike(target, F.lit(r"(?i)^[a-z][a-z0-9+.-]*:")), F.lit(None))
        .when(F.startswith(target, F.lit("/")), F.concat(base, target))
        .when(F.startswith(target, F.lit("?")), F.concat(base, path_of(url), target))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), target))
    )


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None, *, url_column: str = "url",
                html_column: str = "html") -> DataFrame:
    """Pairs of addresses (a, b) from the pages and from `redirects` (from_url, to_url)."""
    url, html = F.col(url_column), F.col(html_column)
    low = F.lower(html)
    named = pages.where(F.contains(low, F.lit("canonical")) | F.contains(low, F.lit("refresh"))).select(
        url.alias("url"), F.explode(_targets(html)).alias("target")
    )
    pairs = named.select("url", _resolved(F.col("url"), F.col("target")).alias("target"))
    if redirects is not None:
        pairs = pairs.unionByName(redirects.select(F.col("from_url").alias("url"), F.col("to_url").alias("target")))
    return pairs.select(address_of(F.col("url")).alias("a"), address_of(F.col("target")).alias("b")).where("a <> b").distinct()


def judge(pages: DataFrame, rules: Sequence[Rule], *, redirects: DataFrame | None = None, id_column: str = "page_id",
          url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: page_id, host, path, rule (null: none of its own), verdict."""
    edges = saved(alias_edges(pages, redirects, url_column=url_column, html_column=html_column))
    nodes = components(edges)
    site = F.concat(F.lit("x://"), F.col("node"))
    verdict = decision(host_of(site), path_of(site), rules)["verdict"]
    blocked = nodes.where(verdict == BLOCK).select("component").distinct()
    reached = saved(nodes.join(blocked, "component", "left_semi").select("node"))
    url = F.col(url_column)
    judged = pages.select(
        F.col(id_column).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), address_of(url).alias("node")
    ).withColumn("own", F.when(F.col("node").isNotNull(), decision(F.col("host"), F.col("path"), rules)))
    return judged.join(reached.withColumn("reached", F.lit(True)), "node", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(F.col("reached"), BLOCK), F.lit(ALLOW)).alias("verdict"),
    )
