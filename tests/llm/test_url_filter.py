from __future__ import annotations

import random
import re

import pytest

from tradewind.llm import url_filter as U
from tradewind.llm.queries import URL_RULES, llm_sql, op7_url_filter

duckdb = pytest.importorskip("duckdb")


def split(url):
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(url, rules):
    host, path = split(url)
    fits = [(len(h + p), a == "allow", h + p, a) for a, h, p in rules if (host == h or host.endswith(f".{h}")) and path.startswith(p)]
    return max(fits)[2:] if fits and host else (None, None)


def by_hand(urls, edges, rules):
    nodes = {"".join(split(u)) for u in urls} | {"".join(split(u)) for e in edges for u in e}
    group = {n: {n} for n in nodes}
    for a, b in edges:
        a, b = "".join(split(a)), "".join(split(b))
        if a and b and group[a] is not group[b]:
            merged = group[a] | group[b]
            for n in merged:
                group[n] = merged
    actions = {n: rule_of("x://" + n, rules)[1] for n in nodes}
    out = []
    for u in urls:
        rule, action = rule_of(u, rules)
        others = {actions[n] for n in group["".join(split(u))]} if any(split(u)) else set()
        verdict = action or ("allow" if "allow" in others else "block" if "block" in others else "allow")
        out.append((u, *split(u), rule, verdict))
    return out


def test_query_equals_brute_force_and_sql(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = op7_url_filter(spark, folder).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(pages)
    want = by_hand([p.url for p in pages], [], URL_RULES)
    for p, w in zip(pages, want, strict=True):
        r = by[p.page_id]
        assert (p.url, r.host, r.path, r.rule, r.verdict) == w
    assert {r.verdict for r in got} == {"allow", "block"}


HTML = [
    '<link rel="canonical" href="https://b.net/es/2">', "<LINK HREF='/x/y' REL=canonical>", "<link rel=stylesheet href=z.css>",
    '<meta http-equiv="refresh" content="0; URL=http://example.org/es/9?a=1&amp;b=2">', "<link rel=canonical href=rel/two#f>",
    '<meta name=refresh content="0;url=http://no.net/">', '<link rel="canonical" href="//D.com/de/1">', "plain", None,
    "<link rel=canonical href='mailto:x@y.z'>", "<link rel=canonical>", '<link rel="canonical" href="">',
    "<meta http-equiv=refresh content='5'>", "<link rel='alternate canonical' href=http://e.net>",
    "<link rel=canonical href=../z.html>", "<link rel=canonical href='https:&#x2F;&#47;d.com/de/./u/../../es/&period;'>",
    "<base href=//d.com/de/q/?x><link rel=canonical href=../k?a=../b>", "<!-- <link rel=canonical href=http://no.net/1> -->x",
    "<base><base href='/fr/'><meta http-equiv=refresh content='0;url=#t'><!-- <base href=/no/>",
    "<link rel=canonical href='/w/&#xD800;&#0;&amp;#47;&copy;&unknown;'>", "<link rel=canonical href=/a//../../../b/..>",
]


def pages_with_edges(spark, seed, n):
    rng = random.Random(seed)
    hosts = ["example.org", "www.Example.ORG", "a.com", "com", "b.net", "c.b.net", "example.org.net", "xorg", "d.com"]
    paths = ["/es/2", "/en/1", "/en/17", "/fr/3", "/de/1", "/x", "/", "", "/es/9", "/x/y", "/en/2"]
    make = lambda: f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#t', '?a#b'])}"
    rows = [(i, make(), rng.choice(HTML) if rng.random() < 0.4 else f'<link rel="canonical" href="{make()}">') for i in range(n)]
    rows += [(n, None, HTML[0]), (n + 1, "no scheme", HTML[0]), (n + 2, "", HTML[3]), (n + 3, "x://", HTML[1]), (None, rows[0][1], None), rows[0]]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_edges_equal_brute_force_and_sql(spark, seed):
    pages = pages_with_edges(spark, seed, 25 * seed)
    edges = U.html_edges(pages)
    pairs = [tuple(r) for r in edges.collect()]
    rows = pages.collect()
    got = U.judge(pages.withColumns({c: pages["url"] for c in ("rule", "resource", "action", "a.b")}), U.rules_table(spark, URL_RULES), edges).collect()
    key = lambda t: tuple(map(str, t))
    want = by_hand([p.url for p in rows], pairs, URL_RULES)
    assert sorted(((r.url, r.host, r.path, r.rule, r.verdict) for r in got), key=key) == sorted(want, key=key)
    connection = duckdb.connect()
    connection.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    theirs = connection.execute(llm_sql()["op7_url_filter"]).fetchall()
    names = [c[0] for c in connection.description]
    ours = sorted((tuple(r[c] for c in names) for r in got), key=key)
    assert ours == sorted(theirs, key=key)


def test_links(spark):
    base = "https://h.net/a/b?c"
    rows = [(i, base, h) for i, h in enumerate(HTML)]
    got = {r.target for r in U.html_edges(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {
        "https://b.net/es/2", "https://h.net/x/y", "http://example.org/es/9?a=1&b=2", "https://h.net/a/rel/two#f",
        "https://D.com/de/1", "http://e.net",
        "https://h.net/z.html", "https://d.com/es/", "https://d.com/de/k?a=../b", "https://h.net/fr/#t",
        "https://h.net/w/\ufffd\ufffd&#47;&copy;&unknown;", "https://h.net/",
    }


def test_chains_of_aliases_and_explicit_allows(spark):
    chain = [(f"http://n{i}.net/", f"http://n{i + 1}.net/") for i in range(40)]
    edges = spark.createDataFrame([*chain, ("http://n40.net/", "http://example.org/es/1")], "source string, target string")
    rules = U.rules_table(spark, URL_RULES)
    pages = spark.createDataFrame([(f"http://n{i}.net/?{i}",) for i in range(41)] + [("http://z.com/fr/",)], "url string")
    assert [r.verdict for r in U.judge(pages, rules, edges).orderBy("url").collect()].count("block") == 41
    more = edges.union(spark.createDataFrame([("http://n3.net/", "http://z.com/fr/")], "a string, b string"))
    got = {r.url: r.verdict for r in U.judge(pages.union(spark.createDataFrame([("http://example.org/es/1",)], "u string")), rules, more).collect()}
    assert got.pop("http://example.org/es/1") == "block" and set(got.values()) == {"allow"}


def test_no_python(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    df = U.judge(pages, U.rules_table(spark, URL_RULES), U.html_edges(pages))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(pages, U.rules_table(spark, URL_RULES), U.html_edges(pages)).count() == 0
    one = spark.createDataFrame([("http://example.org/es/1",)], "url string")
    none = U.rules_table(spark, [])
    assert [r.verdict for r in U.judge(one, none).collect()] == ["allow"]
