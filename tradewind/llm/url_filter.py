"""Allow and block decisions for urls, carried over to their aliases.

A rule names a host and the start of a path; it fits the host and its subdomains, and of the rules that
fit the longest wins. Pages also name other urls for themselves: canonical links and redirects in their
HTML. Urls joined by such edges, in either direction and over any number of steps, are one
resource. A url without a rule of its own is decided by its resource: allowed if a member is
explicitly allowed, else blocked if a member is blocked, else allowed. A url's own rule always stands.

Everything is joins and groupings over distinct urls, without Python on the executors. Host suffixes meet
the rules in an equi-join that Spark may broadcast by size or split by skew; components are found by
distributed star steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.components import connected_components
from tradewind.llm.names import quoted, unused
from tradewind.session import materialize

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Character references by name that an address may be spelled with, and all forms of one.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "sol": "/", "colon": ":", "period": "."}
_PIECES = rf"&#[xX][0-9a-fA-F]{{1,6}};?|&#[0-9]{{1,7}};?|(?i:&(?:{'|'.join(_NAMED)});)|[^&]+|&"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(action, rule_host, rule_path)`` from tuples (action, host, path)."""
    return spark.createDataFrame(rules, "action string, rule_host string, rule_path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path without query and fragment; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def resource(url: Column) -> Column:
    """Host and path in one string; the path starts with a slash or is empty, so this is unique."""
    return F.concat(*host_and_path(url))


# --- edges ----------------------------------------------------------------------------------------


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)[\s\"']{name}{_VALUE}"
    return F.concat(*(F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)))


def _decoded(text: Column) -> Column:
    """Text with its character references decoded; one without a meaning is U+FFFD, other ``&`` stay."""

    def piece(p: Column) -> Column:
        digits = F.rtrim(F.substr(p, F.lit(3)), F.lit(";"))
        hexed = p.rlike("^&#[xX]")
        code = F.when(hexed, F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(digits).cast("int")
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        names = F.create_map(*(F.lit(x) for pair in _NAMED.items() for x in pair))
        named = F.try_element_at(names, F.lower(F.regexp_extract(p, "^&([A-Za-z]+);$", 1)))
        return (
            F.when(p.rlike("^&#[0-9xX]"), F.when(known, char).otherwise("\ufffd"))
            .when(p.rlike("^&[A-Za-z]"), F.coalesce(named, p))
            .otherwise(p)
        )

    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def _resolved(rows: DataFrame, into: str, link: Column, base: Column) -> DataFrame:
    """``rows`` with the absolute url that a link means on a page or under a base; null for other things
    than pages. Its path has no segments ``.`` and ``..``.

    Each step is a column of its own, since an expression that names a long one often grows very large.
    """
    rows = rows.withColumns({"_link": link, "_base": base})
    link, base = F.col("_link"), F.col("_base")
    rows = rows.withColumns(
        {
            "_origin": F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*", 0),
            "_folder": F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*([^?#]*/)", 1),
        }
    )
    origin, folder = F.col("_origin"), F.col("_folder")
    rows = rows.withColumn(
        "_url",
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.substring_index(origin, "/", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.rlike(r"^[?#]"), F.concat(F.regexp_extract(base, "^[^?#]*", 0), link))
        .when(folder != "", F.concat(origin, folder, link))
        .otherwise(F.concat(origin, F.lit("/"), link)),
    )
    split = r"^([^:/?#]*://[^/?#]*)([^?#]*)((?s:.*))$"
    rows = rows.withColumns({f"_{n}": F.regexp_extract("_url", split, i) for i, n in enumerate(("all", "origin", "path", "rest"))})
    rows = rows.withColumn("_segments", F.split(F.substr(F.col("_path"), F.lit(2)), "/"))
    kept = F.aggregate(
        "_segments",
        F.array().cast("array<string>"),
        lambda out, s: F.when(s == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))))
        .when(s == ".", out)
        .otherwise(F.concat(out, F.array(s))),
    )
    dotted = F.col("_path").rlike(r"/\.\.?(?:/|\z)")
    rows = rows.withColumn("_kept", F.when(dotted, kept))
    folder = F.element_at("_segments", -1).isin(".", "..") & (F.size("_kept") > 0)
    clean = F.concat("_origin", F.lit("/"), F.array_join("_kept", "/"), F.when(folder, "/").otherwise(""), "_rest")
    rows = rows.withColumn(into, F.when(dotted, clean).otherwise(F.col("_url")))
    return rows.drop(*(c for c in rows.columns if c.startswith("_")))


def html_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(source, target)`` urls of canonical links and of redirects by ``http-equiv="refresh"``.

    Comments are no tags. Character references are decoded, and links relative to the page, or to the first
    ``<base>`` with an address, keep its scheme, host or folder; segments ``.`` and ``..`` are resolved.
    Links to the page itself (empty, or without a base only a query or fragment) and to other things than
    pages (``mailto:``) are no edges.
    """
    text = F.regexp_replace(F.col(html), r"(?s)<!--.*?(?:-->|\z)", "")
    tags = F.regexp_extract_all(text, F.lit(r"(?is)<(?:link|meta|base)\b[^>]*>"), F.lit(0))
    canonical = lambda t: t.rlike(r"""(?is)^<link\b.*[\s"']rel\s*=\s*["']?[^"'>]*\bcanonical\b""")
    refresh = lambda t: t.rlike(r"""(?is)^<meta\b.*[\s"']http-equiv\s*=\s*["']?\s*refresh\b""")
    based = F.filter(F.col("tags"), lambda t: t.rlike(r"(?i)^<base\b") & (_attribute(t, "href") != ""))
    named = F.filter(F.col("tags"), lambda t: canonical(t) | refresh(t))
    tag = F.col("tag")
    found = (
        pages.where(F.col(html).contains("<"))
        .select(F.col(url).alias("source"), tags.alias("tags"))
        .select("source", F.get(based, F.lit(0)).alias("base"), F.explode(named).alias("tag"))
        .withColumn("named", canonical(tag))
        .withColumn("value", F.when(F.col("named"), _attribute(tag, "href")).otherwise(_attribute(tag, "content")))
        .withColumn("value", _decoded(F.col("value")))
        .withColumn("base", _attribute(F.col("base"), "href"))
        .withColumn("base", F.trim(_decoded(F.col("base"))))
    )
    redirect = F.regexp_extract("value", r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1)
    found = found.withColumn("link", F.trim(F.when(F.col("named"), F.col("value")).otherwise(redirect)))
    # Stored before each step that filters, since a filter moved below these columns would spell them out.
    found = materialize(found.select("source", "base", "link"), "named").where("link <> ''")
    found = _resolved(found, "under", F.col("base"), F.col("source"))
    found = materialize(found.select("source", "under", "link"), "based")
    found = found.where(F.col("under").isNotNull() | ~F.col("link").rlike("^[?#]"))
    found = _resolved(found, "target", F.col("link"), F.coalesce("under", "source"))
    return materialize(found.select("source", "target"), "edges").dropna()


# --- decisions ------------------------------------------------------------------------------------


def fitting_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct ``resource``, ``host``, ``path``) with the ``rule`` that wins and its ``action``.

    Of two equal rules a block gives way to an allow. Urls without a rule have nulls.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    wanted = rules.select("action", "rule_host", "rule_path").dropna()
    fits = (
        urls.where("host <> ''")
        .select("resource", "path", F.explode(suffixes).alias("rule_host"))
        .join(wanted, "rule_host")
        .where(F.startswith("path", "rule_path"))
    )
    name = F.concat("rule_host", "rule_path")
    best = fits.groupBy("resource").agg(
        F.max(F.struct(F.length(name), F.col("action") == ALLOW, name.alias("rule"), "action")).alias("b")
    )
    return urls.join(best.select("resource", "b.rule", "b.action"), "resource", "left")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    edges: DataFrame | None = None,
    url: str = "url",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``, replacing columns of these names.

    ``edges`` has ``source`` and ``target`` urls. Null urls and such without ``://`` have empty host and
    path, no rule and no aliases, and are allowed. Repeated rows keep their number.
    """
    made = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in made]
    host, path = host_and_path(F.col(url))
    key = unused(pages, "resource")
    pages = pages.select(*quoted(kept), host.alias("host"), path.alias("path"))
    pages = pages.withColumn(key, F.concat("host", "path"))
    if edges is None:
        edges = pages.sparkSession.createDataFrame([], "source string, target string")
    links = edges.select(
        resource(F.col("source")).alias("a"), resource(F.col("target")).alias("b")
    ).where("a <> '' AND b <> ''")
    links = materialize(links.distinct(), "aliases")
    own = pages.select(F.col(key).alias("resource"), "host", "path")
    ends = links.select(F.explode(F.array("a", "b")).alias("resource"))
    ends = ends.select(
        "resource",
        F.regexp_extract("resource", "^[^/]*", 0).alias("host"),
        F.regexp_extract("resource", "/(?s:.*)$", 0).alias("path"),
    )
    ruled = materialize(fitting_rule(own.union(ends).distinct(), rules), "ruled")
    members = connected_components(links, "a", "b").withColumnRenamed("node", "resource")
    placed = ruled.join(members, "resource", "left").withColumn(
        "component", F.coalesce("component", "resource")
    )
    inherited = placed.groupBy("component").agg(
        F.max(F.col("action") == ALLOW).alias("allowed"), F.max(F.col("action") == BLOCK).alias("blocked")
    )
    # Stored, so that the join below can be split where one resource has very many urls.
    inherited = materialize(inherited, "inherited")
    verdict = F.coalesce(
        "action",
        F.when(F.coalesce("allowed", F.lit(False)), F.lit(ALLOW))
        .when(F.coalesce("blocked", F.lit(False)), F.lit(BLOCK))
        .otherwise(F.lit(ALLOW)),
    )
    decided = placed.join(inherited, "component").select(
        F.col("resource").alias(key), "rule", verdict.alias("verdict")
    )
    return pages.join(decided, key).drop(key)
