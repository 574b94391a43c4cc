"""URL filters with redirect equivalence.

Every url is split into host and path and judged by explicit rules: a rule
names a host and the start of a path, fits that host and its subdomains,
and the longest fitting rule wins.

Pages that are the same resource share a decision.  Nodes are urls without
scheme and fragment (host, path and query); edges go from a page to the
targets of all its canonical links and refresh redirects, and of any
redirects given as a table.  Distributed connected components over these edges carry
a block to every alias: a page without a rule of its own is blocked if any
url of its component is blocked by a rule, and else allowed.  An explicit
allow takes precedence for the page it fits.

Defined cases: a null url, or one without ``://``, has an empty host and
path, fits no rule and is allowed, and so is one with nothing behind it: they
are no nodes; null html has no links, tags in comments are none; ``rel`` may
hold several names; the common
character references of targets are decoded and relative targets (of host,
path or query) resolved against the page's url, targets of schemes without
``://`` are ignored; repeated rows
each give a row; other columns are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Where a page names its canonical url or redirects at once
CANONICAL_TAG = (r"""(?i)<link\s(?:[^>]*\s)?rel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"[^>]*>"""
                 r"""|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'[^>]*>|canonical(?:[\s/][^>]*)?>)""")
REFRESH_TAG = r"""(?i)<meta\s(?:[^>]*\s)?http-equiv\s*=\s*(?:["']\s*refresh\s*["'][^>]*>|refresh(?:[\s/][^>]*)?>)"""
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
HREF = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?i)url\s*=\s*[\"']?([^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def resource(url: Column) -> Column:
    """Host, path and query: what names a resource besides scheme and fragment."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.concat(host_of(url), rest)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of the text and verdict of the longest fitting rule, or null."""
    answer = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        answer = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(answer)
    return answer


def _decoded(target: Column) -> Column:
    """Without the character references and quotes that may stand in a target."""
    for reference, char in (("lt|#0*60|#x0*3c", "<"), ("gt|#0*62|#x0*3e", ">"), ("quot|#0*34|#x0*22", '"'),
                            ("apos|#0*39|#x0*27", "'"), ("#0*47|#x0*2f|sol", "/"), ("amp|#0*38|#x0*26", "&")):
        target = F.regexp_replace(target, f"(?i)&({reference});", char)
    return F.regexp_replace(target, "^[\"']+|[\"']+$", "")


def _without_dots(path: Column) -> Column:
    """The path with its ``.`` and ``..`` parts carried out."""
    ended = F.when(path.rlike(r"/\.\.?$"), F.concat(path, F.lit("/"))).otherwise(path)
    parts = F.aggregate(F.split(F.substring(ended, F.lit(2), F.length(ended)), "/"), F.array().cast("array<string>"), lambda up, x: (
        F.when(x == ".", up).when(x == "..", F.slice(up, F.lit(1), F.greatest(F.size(up) - 1, F.lit(0))))
        .otherwise(F.concat(up, F.array(x)))))
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def targets(url: Column, html: Column) -> Column:
    """Array of the urls that a page's canonical links and refresh redirects name."""
    base = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*", 0)
    scheme = F.regexp_extract(url, r"^[^:/?#]*:", 0)
    folder = F.concat(F.lit("/"), F.regexp_extract(path_of(url), r"^/(.*/)?", 1))

    def resolved(t: Column) -> Column:
        path, rest = F.regexp_extract(t, r"^[^?#]*", 0), F.regexp_extract(t, r"[?#].*$", 0)
        return (F.when((t == "") | t.startswith("#"), F.lit(None)).when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), t)
                .when(t.startswith("//"), F.concat(scheme, t)).when(t.startswith("?"), F.concat(base, path_of(url), t))
                .when(t.startswith("/"), F.concat(base, _without_dots(path), rest))
                .when(~t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.concat(base, _without_dots(F.concat(folder, path)), rest)))

    shown = F.regexp_replace(html, COMMENT, "")

    def named(tag: str, link: str) -> Column:
        return F.transform(F.regexp_extract_all(shown, F.lit(tag), F.lit(0)),
                           lambda t: resolved(_decoded(F.regexp_extract(t, link, 1))))

    return F.array_compact(F.concat(named(CANONICAL_TAG, HREF), named(REFRESH_TAG, REFRESH_URL)))


def judge(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """Columns ``id_col``, ``url_col``, ``host``, ``path``, ``rule`` and
    ``verdict``.  ``redirects`` may add edges as columns ``source`` and
    ``target`` (urls)."""
    url, html = F.col("url"), F.col("html")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    links = rows.where(html.rlike(r"(?i)canonical|refresh")).select(
        url.alias("source"), F.explode(targets(url, html)).alias("target"))
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    ends = (links.where("instr(source, '://') > 0 and instr(target, '://') > 0")
            .select(resource(F.col("source")).alias("a"), resource(F.col("target")).alias("b"))
            .where("a != '' and b != ''").distinct())
    parts = materialize(connected_components(ends))
    node_host = F.regexp_extract("node", r"^[^/?]*", 0)
    node_path = F.regexp_extract("node", r"^[^/?]*([^?]*)", 1)
    blocked = (parts.where(rule_of(node_host, node_path, rules)["verdict"] == "block")
               .select("component").distinct())
    aliases = parts.join(blocked, "component", "left_semi").select(F.col("node").alias("key"), F.lit(True).alias("hit"))
    judged = rows.select("id", "url", host_of(F.coalesce(url, F.lit(""))).alias("host"),
                         path_of(F.coalesce(url, F.lit(""))).alias("path"),
                         resource(F.coalesce(url, F.lit(""))).alias("key"))
    judged = judged.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).join(aliases, "key", "left")
    return judged.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("hit"), F.lit("block")), F.lit("allow")).alias("verdict"))
