"""URL verdicts: explicit rules first, then what redirects and canonical links make equivalent.

A rule is a host and a path prefix with a verdict; it fits its host and all subdomains, the longest
fitting rule decides. Addresses that name the same page (one canonical form, a redirect, a canonical
link, a refresh) form a component. An address without a rule takes the decision of its component:
allowed if any member is explicitly allowed, else blocked if any is explicitly blocked, else the
default. So a block reaches every alias, and an explicit allow is stronger than an inherited block.

Components are found over row numbers: every row that names an address links to the smallest row
that names it, so an address with very many rows is a star and never a set of pairs.

A null address, or one without ``://``, has an empty host and path, fits no rule and has no aliases.
Rows are judged each for itself, repeated ids included; extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.batches import kept
from tidemark.llm.graph import components
from tidemark.llm.licenses import lower_ascii

ALLOW, BLOCK = "allow", "block"
TRACKING = r"^(?:utm_[^=]*|fbclid|gclid|ref)(?:=|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(after_scheme(url), F.lit("")), r"^[^?#]*(?:\?([^#]*))?", 1)


def canonical(url: Column) -> Column:
    """One spelling per page; null without a host.

    No scheme, default port, ``www.``, fragment, final slash or tracking parameters; the other
    parameters in order.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(?:80|443)?$", ""), r"^www\.(?=.)", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    parts = F.filter(F.split(query_of(url), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(parts), "&")
    whole = F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host != "", whole)


def resolved(href: Column, url: Column) -> Column:
    """An address as it stands in a page, made whole with the page's own."""
    return (
        F.when(href == "", None)
        .when(F.contains(href, F.lit("://")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit("http:"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit("http://"), host_of(url), href))
        .otherwise(
            F.concat(F.lit("http://"), host_of(url), F.regexp_replace(path_of(url), r"[^/]*$", ""), href)
        )
    )


def linked_addresses(html: Column, url: Column) -> list[Column]:
    """The canonical link and the refresh target of a page, null where it has none."""
    link = F.regexp_extract(html, r"""(?i)<link\s(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    refresh = F.regexp_extract(html, r"""(?i)<meta\s(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)""", 1)
    low = lambda word: F.contains(F.lower(html), F.lit(word))
    return [
        F.when(low("canonical"), resolved(link, url)),
        F.when(low("http-equiv"), resolved(refresh, url)),
    ]


def ordered(rules: tuple[Rule, ...]) -> list[Rule]:
    """Longest first; of equal length, allow first."""
    return sorted(rules, key=lambda r: (-len(r.name), r.verdict, r.name))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    own = (host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))
    return own & F.startswith(path, F.lit(rule.path))


def first_fit(rules: tuple[Rule, ...], value: str) -> Column:
    return reduce(
        lambda rest, r: F.when(fits(r, F.col("host"), F.col("path")), getattr(r, value)).otherwise(rest),
        reversed(ordered(rules)), F.lit(None).cast("string"),
    )


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None,
    default: str = ALLOW, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, inherited) of every page.

    ``redirects`` has rows (from, to) of addresses; it only adds links.
    """
    url = F.col(url_col)
    html = F.col(html_col) if html_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.lit(True).alias("page"), F.col(id_col).cast("bigint").alias("page_id"), url.alias("url"),
        F.array_compact(F.array(url, *linked_addresses(html, url))).alias("names"),
    )
    if redirects is not None:
        a, b = redirects.columns[:2]
        rows = rows.unionByName(
            redirects.select(
                F.lit(False).alias("page"), F.lit(None).cast("bigint").alias("page_id"),
                F.lit(None).cast("string").alias("url"), F.array_compact(F.array(a, b)).alias("names"),
            )
        )
    split = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = kept(
        split.select(
            F.monotonically_increasing_id().alias("uid"), "page", "page_id", "host", "path",
            first_fit(rules, "name").alias("rule"), first_fit(rules, "verdict").alias("own"),
            F.array_distinct(F.array_compact(F.transform("names", canonical))).alias("names"),
        ),
        "judged",
    )
    named = judged.select("uid", F.explode("names").alias("name"))
    hubs = named.groupBy("name").agg(F.min("uid").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    links = named.join(hubs, "name").filter("uid <> hub").select("uid", "hub")
    members = components(links)
    decided = (
        members.join(judged.filter("own IS NOT NULL").select("uid", "own"), F.col("node") == F.col("uid"))
        .groupBy("root")
        .agg(F.bool_or(F.col("own") == ALLOW).alias("allowed"), F.bool_or(F.col("own") == BLOCK).alias("blocked"))
        .select("root", F.when(F.col("allowed"), ALLOW).when(F.col("blocked"), BLOCK).alias("inherited"))
    )
    handed = members.join(decided, "root").select("node", "inherited")
    found = judged.filter("page").join(handed, F.col("uid") == F.col("node"), "left")
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", "inherited", F.lit(default)).alias("verdict"),
        F.when(F.col("own").isNull(), F.col("inherited")).alias("inherited"),
    )
