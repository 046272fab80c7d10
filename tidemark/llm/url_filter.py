"""URL filters with redirect equivalence.

A URL is judged by the longest rule (host and path prefix) that fits it. Canonical links and redirects, from
the pages' HTML and from an optional table, are edges between addresses; distributed connected components over
them make classes of aliases. A class that holds a blocked address, whether a page or only the target of a
link, blocks every member that has no rule of its own: an explicit rule, allowing or blocking, has precedence
over what the class says. Allow rules are not passed on. Everything is DataFrame expressions.

An address is host, path and query; scheme and fragment don't tell pages apart. A link is resolved against the
page's URL: with a scheme, from ``//``, ``/`` or ``?``, else relative to the page's folder; dot segments stay.
Links to other than ``scheme://`` addresses and links inside comments or scripts don't count.

Defined results: a null URL, or one without ``://``, has empty host and path, no rule and no links of its own,
and is allowed; a null HTML has no links; repeated rows repeat their result; several rows of one address share
its links; other columns are ignored by :func:`judge`, kept by :func:`drop_blocked`.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.session import settle

MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # with its leading slash

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

TAG = r"(?is)<(?:link|meta)\b[^>]*>"
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
CANONICAL = r"""(?is)\srel\s*=\s*(?:"[^"]*\bcanonical\b[^"]*"|'[^']*\bcanonical\b[^']*'|canonical\b)"""
HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFRESH = r"""(?is)\shttp-equiv\s*=\s*["']?refresh\b"""
TARGET = r"""(?is)\scontent\s*=\s*(?:"[^"]*?\burl\s*=\s*'?([^"']+)|'[^']*?\burl\s*=\s*"?([^"']+))"""


def host_of(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column) -> Column:
    """Host, path and query; null where the URL has no host."""
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as (verdict, name), or null; of equally long ones the first of the list."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules travel with a plan, got {len(rules)}")
    by_length = sorted(rules, key=lambda r: -len(r.name))
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(r.verdict).alias("verdict"), F.lit(r.name).alias("name")),
        )
        for r in by_length
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,name:string>"))


def resolved(link: Column, host: Column, path: Column) -> Column:
    """A link of a page as a URL, or null."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    here = F.concat(F.lit("http://"), host)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)?", 0))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(host == "", F.lit(None))
        .when(link.startswith("/"), F.concat(here, link))
        .when(link.startswith("?"), F.concat(here, path, link))
        .when((link == "") | link.startswith("#"), F.lit(None))
        .otherwise(F.concat(here, folder, link))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) URLs of canonical links and of refreshing redirects in the pages' HTML."""
    body = F.col(html).cast("string")
    seen = pages.where(body.rlike("(?i)canonical|http-equiv")).select(
        F.col(url).cast("string").alias("source"),
        F.explode(F.regexp_extract_all(F.regexp_replace(body, HIDDEN, " "), F.lit(TAG), F.lit(0))).alias("tag"),
    )
    tag = F.col("tag")
    href = F.concat(*[F.regexp_extract(tag, HREF, g) for g in (1, 2, 3)])
    target = F.concat(*[F.regexp_extract(tag, TARGET, g) for g in (1, 2)])
    link = F.when(tag.rlike(r"(?i)^<link") & tag.rlike(CANONICAL), href).when(tag.rlike(r"(?i)^<meta") & tag.rlike(REFRESH), target)
    linked = seen.select("source", link.alias("link")).where("link <> ''")
    return linked.select("source", resolved(F.col("link"), host_of(F.col("source")), path_of(F.col("source"))).alias("target"))


def blocked_aliases(links: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Addresses (``address``, distinct) without a rule of their own whose class of aliases holds a blocked one.

    Classes are found on 128-bit digests of the addresses. A hub that many pages link to is the key of one side
    only of the component joins, so its rows are partly summed before they travel, or split by the skew join."""
    ends = links.select(address_of(F.col("source")).alias("x"), address_of(F.col("target")).alias("y"))
    ends = settle(ends.where("x IS NOT NULL AND y IS NOT NULL AND x <> y").distinct(), "url-links")
    labels = components(ends.select(F.md5("x").alias("a"), F.md5("y").alias("b")))
    nodes = ends.select(F.explode(F.array("x", "y")).alias("address")).distinct()
    url = F.concat(F.lit("http://"), F.col("address"))
    nodes = nodes.select("address", F.md5("address").alias("node"), rule_of(host_of(url), path_of(url), rules).alias("rule"))
    nodes = settle(nodes.join(labels, "node").select("address", "label", F.col("rule.verdict").alias("verdict")), "url-classes")
    bad = nodes.where("verdict = 'block'").select("label").distinct()
    return nodes.where("verdict IS NULL").join(bad, "label", "left_semi").select("address")


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str | None = "html", redirects: DataFrame | None = None,
          rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the columns named in ``keep``.

    ``redirects`` holds further edges as URLs (``source``, ``target``)."""
    links = None if html is None else page_links(pages, url, html)
    if redirects is not None:
        more = redirects.select(F.col("source").cast("string"), F.col("target").cast("string"))
        links = more if links is None else links.unionByName(more)
    text = F.col(url).cast("string")
    judged = pages.select(
        F.struct(F.col(page_id).alias("page_id"), *keep).alias("page"),
        host_of(text).alias("host"), path_of(text).alias("path"), address_of(text).alias("address"),
    )
    judged = judged.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    said = F.col("own.verdict")
    if links is not None:
        bad = blocked_aliases(links, rules).withColumn("passed_on", F.lit("block"))
        judged = judged.join(bad, "address", "left")
        said = F.coalesce(said, "passed_on")
    verdict = F.coalesce(said, F.lit("allow")).alias("verdict")
    return judged.select("page.page_id", "host", "path", F.col("own.name").alias("rule"), verdict, *[F.col("page")[c].alias(c) for c in keep])


def drop_blocked(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str | None = "html",
                 redirects: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The pages whose verdict is allow, with their columns."""
    named = {"page_id": page_id, "url": url} | ({"html": html} if html else {})
    boxed = pages.select(F.struct(*pages.columns).alias("whole"), *[F.col(c).alias(n) for n, c in named.items()])
    judged = judge(boxed, html="html" if html else None, redirects=redirects, rules=rules, keep=("whole",))
    return judged.where("verdict = 'allow'").select("whole.*")
