"""URL filters: rules by host and path, and decisions that pass to aliases of a page."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import staged
from martkeep.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: So many rules are a literal in the plan and tried on every row; more are joined.
LITERAL_RULES = 64
BEST = "struct<size:int,rule:string,verdict:string>"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""
BASE = r"""(?is)<base\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and a beginning of the path."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct(size, rule, verdict); NULL if none does."""
    if not rules:
        return F.lit(None).cast(BEST)
    known = F.array(*[
        F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"),
                 F.lit(r.host).alias("host"), F.lit(r.path).alias("path"))
        for r in rules
    ])
    fitting = F.filter(
        known,
        lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]),
    )
    best = F.array_max(fitting)
    return F.struct(best["size"].alias("size"), best["rule"].alias("rule"), best["verdict"].alias("verdict"))


def host_endings(host: Column) -> Column:
    """A host and what follows each of its dots: the hosts of rules that fit it."""
    labels = F.split(host, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host != "", ends).otherwise(F.array(F.lit("")))


def with_best_rule(urls: DataFrame, rules: list[Rule] | DataFrame) -> DataFrame:
    """``urls`` (with host and path) and ``best``, the longest rule that fits each; see :func:`best_rule`.

    Few rules are tried one by one. More, or a table of them (verdict, host, path), are
    joined: a rule fits if its host is one of the host's endings and its path one of the
    beginnings of the path, of the lengths that rules have. Both are equalities, so no url
    meets a rule that does not fit, however many rules one host has. Distinct hosts and
    paths are joined, reduced to the best rule, and joined back.
    """
    if isinstance(rules, list) and len(rules) <= LITERAL_RULES:
        return urls.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    if isinstance(rules, list):
        rows = [(r.verdict, r.host, r.path) for r in rules]
        rules = urls.sparkSession.createDataFrame(rows, "verdict string, host string, path string")
    known = staged(
        rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict")),
        "url-rules",
    )
    lengths = sorted(r[0] for r in known.select(F.length("rule_path")).distinct().collect())
    distinct = staged(urls.select("host", "path").distinct(), "url-hosts")
    starts = F.transform(
        F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path")),
        lambda n: F.substr(F.col("path"), F.lit(1), n),
    )
    tried = distinct.select("host", "path", F.explode(host_endings(F.col("host"))).alias("rule_host"))
    tried = tried.select("host", "path", "rule_host", F.explode(starts).alias("rule_path"))
    rule = F.concat("rule_host", "rule_path")
    fitting = tried.join(known, ["rule_host", "rule_path"]).select(
        "host", "path", F.struct(F.length(rule).alias("size"), rule.alias("rule"), "verdict").alias("best")
    )
    best = staged(fitting.groupBy("host", "path").agg(F.max("best").alias("best")), "url-best")
    best = best.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), F.col("best").cast(BEST).alias("best"))
    met = (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path"))
    return urls.join(best, met, "left").drop("of_host", "of_path")


def bare(url: Column) -> Column:
    """A url without its fragment: what is fetched."""
    return F.regexp_extract(url, r"(?s)^([^#]*)", 1)


def same_form(url: Column) -> Column:
    """A url without its fragment, the A-Z of scheme and host lower-cased: how urls are compared."""
    head = F.regexp_extract(url, r"(?s)^([^/?#]*://[^/?#]*)", 1)
    return F.concat(F.translate(head, UPPER, LOWER), F.substr(bare(url), F.length(head) + 1))


def resolve(base: str, link: str) -> str | None:
    """An absolute url for a link (RFC 3986, 5.2); NULL for schemes without ``://``."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", link):
        return link if "://" in link else None
    scheme, host, path, query = re.match(r"(?s)(.*?:)//([^/?#]*)([^?#]*)(\?[^#]*)?", base).groups()
    if link.startswith("//"):
        return scheme + link
    own, rest = re.match(r"(?s)([^?#]*)(.*)", link).groups()
    if not own:
        return f"{scheme}//{host}{path}{rest if rest.startswith('?') else (query or '') + rest}"
    if not own.startswith("/"):
        own = (path.rpartition("/")[0] if path else "") + "/" + own
    out: list[str] = []
    parts = own.split("/")[1:]
    for part in parts:
        if part == "..":
            del out[-1:]
        elif part != ".":
            out.append(part)
    end = "/" if parts[-1] in (".", "..") and out else ""
    return f"{scheme}//{host}/{'/'.join(out)}{end}{rest}"


@F.arrow_udf(T.StringType())
def _resolved(urls: pa.Array, bases: pa.Array, links: pa.Array) -> pa.Array:
    out = []
    for url, base, link in zip(urls.to_pylist(), bases.to_pylist(), links.to_pylist()):
        if base:
            found = resolve(url, unescape(base))
            url = found if found and "://" in found else url
        out.append(resolve(url, unescape(link)))
    return pa.array(out, pa.string())


def page_links(pages: DataFrame) -> DataFrame:
    """(url, other): all canonical links and refresh redirects that the html of pages states.

    Entities are decoded and relative links resolved against the page's base, or its url.
    Links of schemes without ``://`` and links of urls without it are left out.
    """
    html = F.col("html").cast("string")
    every = F.concat(*[F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH)])
    found = pages.select(F.col("url").cast("string").alias("url"), F.regexp_extract(html, BASE, 1).alias("base"), F.explode(every).alias("link"))
    found = found.where("url LIKE '%://%' AND link <> ''")
    return found.select("url", _resolved("url", "base", "link").alias("other")).where("other IS NOT NULL")


def judge_urls(pages: DataFrame, rules: list[Rule] | DataFrame, links: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict.

    The longest fitting rule decides, by its number of characters; there may be any number
    of them, as a list or a table. Urls that ``links``
    (url, other: redirects and canonical links) tie together, over any number of steps, are
    one page: if a rule blocks one of them, those without a rule of their own are blocked
    too, except where a rule explicitly allows another of them. All else is allowed. Urls
    are compared without fragment, scheme and host in lower case; linked urls count also if they are no row of ``pages``.

    Components and decisions are joins on hashes of urls. A NULL url, or one without
    ``://``, has empty host and path and no rule, and is allowed. Repeated rows are all
    returned; of rules of equal length that fit one url the last in the order of their text
    holds, and of equal rules block.
    An empty table gives none. Other columns are not looked at.
    """
    links = staged(links.select(same_form(F.col("url")).alias("url"), same_form(F.col("other")).alias("other")).distinct(), "url-links")
    ends = links.select("url").unionByName(links.select(F.col("other").alias("url"))).distinct()
    ends = with_best_rule(ends.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules)
    nodes = ends.select(F.xxhash64("url").alias("node"), F.col("best.verdict").alias("verdict"))
    parts = connected_components(links.select(F.xxhash64("url").alias("a"), F.xxhash64("other").alias("b")), "url-components")
    tied = nodes.join(parts, "node")
    decided = tied.groupBy("component").agg(
        F.max(F.col("verdict") == "block").alias("blocks"), F.coalesce(F.max(F.col("verdict") == "allow"), F.lit(False)).alias("allows")
    ).where("blocks AND NOT allows")
    blocked = staged(parts.join(decided.select("component"), "component").select("node"), "url-blocked")
    url = F.col("url").cast("string")
    judged = pages.select("page_id", url.alias("url")).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    judged = with_best_rule(judged, rules)
    ruled = judged.where("best.rule IS NOT NULL").select("page_id", "host", "path", "best.rule", "best.verdict")
    free = judged.where("best.rule IS NULL").withColumn("own", F.xxhash64(same_form(F.col("url"))))
    free = free.join(blocked, F.col("own") == F.col("node"), "left").select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("node").isNotNull(), "block").otherwise("allow").alias("verdict"),
    )
    return ruled.unionByName(free)
