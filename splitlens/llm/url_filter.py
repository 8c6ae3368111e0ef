"""URL verdicts by rules, carried over to aliases by connected components.

A rule (host, path, action) fits a URL of its host or a subdomain whose path starts
with the rule's path; the longest fitting rule decides.  URLs that redirect
to each other or name each other as canonical are one resource: where no rule
fits a URL, a block of any alias in its component holds for it too.  An explicit
allow rule keeps its own URL allowed, also among blocked aliases; a component
without a block is allowed.

Links are taken from the page itself: ``<link rel="canonical" href=...>`` and
``<meta http-equiv="refresh" content="...url=...">``, absolute or relative in any form (``//host/x``,
``/x``, ``x``, ``../x``, ``?q``); relative ones are resolved against the page's URL or its first
``<base href>``, without dot segments.  A quoted value ends at its own closing quote.  A fragment never
reaches the server, so nodes are URLs without it.

Defined results: a NULL URL, or one without ``://``, has an empty host and
path, fits no rule and has no alias; it is allowed.  Repeated pages are judged
alike.  NULL html has no links.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import attach, written
from splitlens.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A ">" inside a quoted value does not end a tag.
_INSIDE = r"""\b(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+>"""
_TAG, _BASE = rf"(?is)<(?:link|meta){_INSIDE}", rf"(?is)<base{_INSIDE}"
_QUOTED = r"""\s*=\s*["']?"""


def url_host(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def url_node(url: Column) -> Column:
    """The URL without fragment and with a lower-case host; NULL where the URL
    is NULL or has no ``://``."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    scheme = F.translate(F.regexp_extract(bare, r"(?s)^(.*?://)", 1), _UPPER, _LOWER)
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?]*(.*)$", 1)
    return F.when(F.contains(bare, F.lit("://")), F.concat(scheme, url_host(bare), rest))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, action) of the longest rule that fits; NULL if none does.
    Among rules of one length the first listed wins."""
    out = F.lit(None).cast("struct<rule: string, action: string>")
    for rule_host, rule_path, action in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = (((host == rule_host) | F.endswith(host, F.lit("." + rule_host)))
                & F.startswith(path, F.lit(rule_path)))
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def _once(x: Column, of: Callable[[Column], Column]) -> Column:
    """``of(x)`` with ``x`` as a variable: what refers to it often does not copy its expression."""
    return F.element_at(F.transform(F.array(x), of), 1)


def _attribute(tag: Column, name: str) -> Column:
    """The attribute's value, in quotes of either kind or bare; empty where there is none."""
    pattern = rf"""(?is)(?<![\w-]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|["']?([^"'\s>]+))"""
    return _once(tag, lambda t: F.concat(*[F.regexp_extract(t, pattern, k) for k in (1, 2, 3)]))


def _without_dots(path: Column) -> Column:
    """``path``, which starts with ``/``, without ``.`` and ``..`` segments."""
    segments = F.slice(F.split(path, "/", -1), 2, F.length(path) + 1)
    one, two = r"(?i)^(\.|%2e)\z", r"(?i)^(\.|%2e){2}\z"
    stack = F.aggregate(segments, F.array().cast("array<string>"), lambda acc, x: F.when(x.rlike(one), acc).when(
        x.rlike(two), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
    last = F.element_at(segments, -1)
    # A dot segment at the end leaves the folder's slash.
    whole = F.when(last.rlike(one) | last.rlike(two), F.concat(stack, F.array(F.lit("")))).otherwise(stack)
    return F.when(path.rlike(r"(?i)/(\.|%2e)"), F.concat(F.lit("/"), F.array_join(whole, "/"))).otherwise(path)


def resolved(base: Column, target: Column) -> Column:
    """``target`` as a full URL, seen from the page ``base`` (RFC 3986, 5.2)."""
    return _once(F.struct(base.alias("base"), target.alias("target")), lambda v: _resolved(v["base"], v["target"]))


def _resolved(base: Column, target: Column) -> Column:
    site, path = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1), url_path(base)
    to_path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.substring(target, F.length(to_path) + 1, F.length(target))
    folder = F.coalesce(F.nullif(F.regexp_extract(path, r"(?s)^(.*/)", 1), F.lit("")), F.lit("/"))
    joined = F.when(F.startswith(to_path, F.lit("/")), to_path).otherwise(F.concat(folder, to_path))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
            .when(F.startswith(target, F.lit("//")), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), target))
            .when(to_path != "", F.concat(site, _once(joined, _without_dots), rest))
            .when(F.startswith(rest, F.lit("?")), F.concat(site, path, rest))
            .otherwise(base))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b) URL pairs: a page's own node and the target of each of its
    canonical and refresh links."""
    def target(found: Column) -> Column:
        return F.nullif(F.replace(F.regexp_replace(found, r"^\s+|\s+\z", ""), F.lit("&amp;"), F.lit("&")), F.lit(""))

    url, html = F.col(url_col), F.col(html_col)
    tags = pages.select(url.alias("url"), target(_attribute(F.regexp_extract(html, _BASE, 0), "href")).alias("base"),
                        F.explode(F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))).alias("tag"))
    # Behind "url=" a refresh names its target up to the closing quote, or to the end of the value.
    to = F.regexp_extract(_attribute(F.col("tag"), "content"), r"(?is)^[\s0-9.;,]*url\s*=\s*(.*)\z", 1)
    to = F.regexp_replace(to, r"""(?s)^(["'])((?:(?!\1).)*+).*\z""", "$2")
    found = (F.when(F.col("tag").rlike(rf"(?is)^<link\b.*\brel{_QUOTED}[^\"'>]*\bcanonical\b"), _attribute(F.col("tag"), "href"))
             .when(F.col("tag").rlike(rf"(?is)^<meta\b.*\bhttp-equiv{_QUOTED}refresh\b"), to))
    links = tags.select("url", "base", target(found).alias("target")).where("url IS NOT NULL AND target IS NOT NULL")
    links = links.withColumn("base", F.coalesce(resolved(F.col("url"), F.col("base")), F.col("url")))
    return links.select(url_node(F.col("url")).alias("a"), _once(resolved(F.col("base"), F.col("target")), url_node).alias("b")).where(
        "a IS NOT NULL AND b IS NOT NULL AND a <> b")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
                url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id, ``host``, ``path``, ``rule`` and
    ``verdict``."""
    edges = written(link_edges(pages, url_col, html_col).distinct(), "url-links")
    comp = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # A component is blocked when the rules block any of its URLs, crawled or only linked to.
    hit = fitting_rule(url_host(F.col("node")), url_path(F.col("node")), rules)
    members = written(comp.withColumn("blocked", (F.coalesce(hit["action"], F.lit("")) == "block").cast("int")), "url-members")
    roots = written(members.groupBy("root").agg(F.max("blocked").alias("bad"), F.count("*").alias("n")), "url-roots")
    n_members = int(roots.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    aliases = attach(members, roots, "root", "n", ["node"], n_members, ["bad"]).where("bad = 1").select(
        F.col("node").alias("_alias"))

    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    judged = pages.select(F.col(id_col), F.col(url_col).alias("_url"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("_hit", fitting_rule(F.col("host"), F.col("path"), rules))
    # Only pages that no rule decides look for a blocked alias; the others get a key of their own.
    node = F.when(F.col("_hit").isNull(), url_node(F.col("_url")))
    judged = judged.withColumn("_node", F.coalesce(node, F.concat(F.lit("#"), F.xxhash64(F.col(id_col), F.col("_url")))))
    per_node = judged.groupBy(F.col("_node").alias("_alias")).agg(F.count("*").alias("_n"))
    blocked = written(aliases.join(per_node, "_alias").select(
        F.col("_alias").alias("_node"), "_n", F.lit(1).alias("_bad")), "url-blocked")
    total = int(blocked.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
    out = attach(judged, blocked, "_node", "_n", [id_col, "_url"], total, ["_bad"])
    verdict = F.coalesce(F.col("_hit.action"), F.when(F.col("_bad") == 1, "block").otherwise("allow"))
    return out.select(F.col(id_col), "host", "path", F.col("_hit.rule").alias("rule"), verdict.alias("verdict"))
