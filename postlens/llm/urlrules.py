"""URL filter with redirect equivalence.

Rules allow or block hosts and path prefixes; a url's own rule is the longest that fits it. Urls
that lead to the same page are aliases: a page's canonical link, a refresh redirect in its markup,
and spellings that only differ in scheme, ``www.``/``m.`` host, tracking parameters, fragment,
``.html`` or a last slash. Links may be relative in any form (to the page's url, or its ``<base>``),
their character references are decoded, and a refresh target may stand in quotes of its own.
Connected components over these edges carry a block decision from any blocked member to the
aliases that have no rule of their own; a member with its own allow rule stays allowed, and an
allow rule anywhere among the aliases outweighs a block among them.

Results for odd input: a null url, or one without ``://``, has empty host and path, no rule and
no aliases, and is allowed. A link to no host (``mailto:``) is none. Repeated rows and rows that
share a url get the same verdict. Markup may be null. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import cut
from postlens.llm.components import connected_components

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
#: The first tag of a kind, up to its end. A tag ends at < too, so that no tag is read into by another.
_CANONICAL = r"""(?is)<link\b(?=[^<>]*(?<![\w-])rel\s*=\s*["']?canonical\b)(?=[^<>]*(?<![\w-])href\s*=)[^<>]*+"""
_REFRESH = r"""(?is)<meta\b(?=[^<>]*(?<![\w-])http-equiv\s*=\s*["']?refresh\b)(?=[^<>]*(?<![\w-])content\s*=)[^<>]*+"""
_BASE = r"""(?is)<base\b(?=[^<>]*(?<![\w-])href\s*=)[^<>]*+"""
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);")
#: Seconds and target of a refresh; the target may stand in quotes of its own.
_TARGET = re.compile(r"""(?:\s*+[\d.]++(?:\s*+[;,]|\s)\s*+(?:url\s*+=)?|\s*+[;,]?\s*+url\s*+=)\s*+(?:"([^"]*)|'([^']*)|(.*))""", re.I | re.S)
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def own_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null; of equally long ones an allow rule."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow", r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        chosen = F.when(fits, F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def canonical_form(url: Column) -> Column:
    """One spelling for urls that differ only in ways that don't change the page; null without ``://``."""
    rest = F.regexp_replace(after_scheme(url), r"(?s)#.*$", "")
    query = F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{_TRACKING}$"))), "&")
    host = F.regexp_replace(host_of(url), r"^(www\.|m\.)+", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"(?i)\.html?$", ""), r"/+$", "")
    return F.when(after_scheme(url).isNotNull(), F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))))


def attribute(tag: str, name: str) -> str:
    """The value of a tag's attribute, character references decoded; empty if it has none."""
    for found, *value in _ATTRIBUTE.findall(tag):
        if found.lower() == name:
            return _ENTITY.sub(lambda m: unescape(m[0]), value[0] or value[1] or value[2].strip("\"'"))
    return ""


def absolute(page: str, link: str) -> str | None:
    """``link`` as it reads on ``page`` (RFC 3986, 5.2); null if it leads to no host. The scheme may change, as no rule or spelling knows it."""
    link = re.sub(r"[\t\r\n]", "", link.strip())
    if _SCHEME.match(link):
        return link if link[link.index(":") :].startswith("://") else None
    if link.startswith("//"):
        return "http:" + link
    host, path, query = re.match(r"([^/?#]*)([^?#]*)(\??[^#]*)", page.split("://", 1)[1], re.S).groups()
    target, tail = re.match(r"([^?#]*)(.*)", link, re.S).groups()
    if not target:
        return f"http://{host}{path}{tail if tail.startswith('?') else query}"
    if not target.startswith("/"):
        target = (path[: path.rfind("/") + 1] or "/") + target
    kept: list[str] = []
    parts = target.split("/")[1:]
    for part in parts:
        if part == "..":
            del kept[-1:]
        elif part != ".":
            kept.append(part)
    if parts[-1] in (".", ".."):
        kept.append("")
    return f"http://{host}/{'/'.join(kept)}{tail}"


def tag_links(page: str | None, canonical: str | None, refresh: str | None, base: str | None) -> list[str]:
    """Absolute urls that the tags of a page lead to."""
    if not page or "://" not in page or not (canonical or refresh):
        return []
    target = _TARGET.match(attribute(refresh or "", "content"))
    links = [attribute(canonical or "", "href").strip(), next(filter(None, target.groups()), "").strip() if target else ""]
    start = attribute(base or "", "href").strip()
    start = (absolute(page, start) if start else None) or page
    return [found for link in links if link for found in [absolute(start, link)] if found]


def page_tags(html: Column) -> Column:
    """The tags of a page that may lead elsewhere, and its base; null for a page without any."""
    tags = [F.regexp_extract(html, pattern, 0) for pattern in (_CANONICAL, _REFRESH, _BASE)]
    return F.when((tags[0] != "") | (tags[1] != ""), F.struct(*[t.alias(n) for t, n in zip(tags, ("canonical", "refresh", "base"))]))


def linked_urls(url: Column, tags: Column) -> Column:
    """Urls that a page names as its canonical place or redirects to, absolute. Only the tags leave the JVM."""
    resolve = F.udf(tag_links, "array<string>", useArrow=True)
    return resolve(url, tags["canonical"], tags["refresh"], tags["base"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html") -> DataFrame:
    """(id, host, path, rule, verdict, decided_by) for every row of ``pages``.

    ``decided_by`` is ``rule``, ``alias`` or ``default``.
    """
    url = F.col(f"`{url_col}`").cast("string")
    html = F.col(f"`{html_col}`").cast("string") if html_col else F.lit(None).cast("string")
    # 64-bit numbers stand for the spellings in the graph; a page's node is its canonical form.
    node = lambda u: F.xxhash64(canonical_form(u))
    judged = cut(
        pages.select(
            F.col(f"`{id_col}`").alias("_id"),
            host_of(url).alias("host"),
            path_of(url).alias("path"),
            F.when(after_scheme(url).isNotNull(), node(url)).alias("node"),
            url.alias("_url"),
            page_tags(html).alias("tags"),
        )
        .withColumn("own", own_rule(F.col("host"), F.col("path"), rules))
        .withColumn("_url", F.when(F.col("tags").isNotNull(), F.col("_url"))),
        "urls",
    )
    # Python sees pages with such tags only.
    targets = judged.where("node is not null and tags is not null").select(F.col("node").alias("u"), F.explode(linked_urls(F.col("_url"), F.col("tags"))).alias("l"))
    to = F.col("l")
    links = cut(targets.select("u", node(to).alias("v"), own_rule(host_of(to), path_of(to), rules)["verdict"].alias("verdict")), "url-links")
    members = connected_components(links.select("u", "v"))
    # What the rules say about any spelling of a node, pages and link targets alike, pre-aggregated.
    said = (
        judged.where("node is not null").select("node", F.col("own.verdict").alias("verdict"))
        .union(links.select(F.col("v").alias("node"), "verdict"))
        .groupBy("node")
        .agg(F.max(F.col("verdict").eqNullSafe("allow")).alias("allow"), F.max(F.col("verdict").eqNullSafe("block")).alias("block"))
    )
    placed = said.join(members, "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = placed.groupBy("component").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    alias = placed.select("node", "component").join(whole, "component").where("block and not allow").select("node", F.lit(True).alias("blocked"))
    out = judged.join(alias, "node", "left")
    inherited = F.coalesce("blocked", F.lit(False))
    return out.select(
        F.col("_id").alias(id_col),
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(inherited, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(inherited, "alias").otherwise("default").alias("decided_by"),
    )
