import random
import re
from collections import defaultdict

import pytest

from compare import compare
from tidemark.llm import oracles, url_filter as U

SCHEMA = "page_id long, url string, html string, address string, label string, whole string, verdict string"


def brute(rows, redirects=()):
    """Verdicts by plain loops; links are given, not parsed."""

    def split(url):
        if url is None or "://" not in url:
            return "", "", ""
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split("[?#]", rest[len(host) :])[0], rest[len(host) :].split("#")[0]

    def rule(host, path):
        fit = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fit, key=lambda r: len(r.name), default=None)

    near = defaultdict(set)
    for a, b in redirects:
        x, y = (split(u)[0] + split(u)[2] for u in (a, b))
        if split(a)[0] and split(b)[0]:
            near[x].add(y)
            near[y].add(x)
    out = []
    for page, url in rows:
        host, path, rest = split(url)
        mine = rule(host, path)
        seen, todo = set(), [host + rest] if host else []
        while todo:
            if (n := todo.pop()) not in seen:
                seen.add(n)
                todo += near[n]
        other = [rule(*split("x://" + n)[:2]) for n in seen]
        verdict = mine.verdict if mine else "block" if any(r and r.verdict == "block" for r in other) else "allow"
        out.append((page, host, path, mine.name if mine else None, verdict))
    return sorted(out, key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("page_id", "host", "path", "rule", "verdict").collect()), key=str)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", "allow") for i, u, h in rows], SCHEMA)


def link(url, how=0):
    return [
        f'<head><link rel="canonical" href="{url}"></head>',
        f"<LINK href='{url}' REL='shortlink Canonical'>",
        f"<link\nrel=canonical href={url}>",
        f'<meta http-equiv="refresh" content="0; url={url}">',
        f"<META content='5;URL=\"{url}\"' http-equiv=Refresh>",
    ][how]


URLS = [
    None, "", "no address", "http://a.net", "HTTP://A.Net?x=/es/", "http://w.example.org/es/1", "http://example.org/es", "http://example.org/en/10#t",
    "http://example.org/en/2", "http://badexample.org/es/", "https://x.com/fr/1?q", "x://com/de/", "http://x.com/de/9", "http://x.com/en/9",
    "http://y.net/a/b", "http://y.net/a/b?c=1", "http://y.net/a/b#c", "http://u@y.net:80/", "http://é.net/É", "http://org/", "http://org.net/", "http://x.org?/",
    "http://d.net/1 2", "a://b://c.com/de/", "http://y.net/\nnew", "http:///empty/host",
]


def test_rules_and_places(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[5], "<p>"), (5, URLS[5], ""), (5, URLS[5], "")]
    assert shown(U.judge(pages(spark, rows))) == brute([r[:2] for r in rows])


@pytest.mark.parametrize("how", range(5))
def test_links_pass_blocks_on(spark, how):
    rows = [
        (1, "http://a.net/x", link("http://m.com/de/1", how)),  # target blocked, not itself a page
        (2, "https://a.net/x#part", None),  # the same address
        (3, "http://b.net/", link("http://a.net/x", how)),  # two links away
        (4, "http://c.com/fr/1", link("//b.net/", how)),  # an allow rule of its own
        (5, "http://d.net/", link("http://c.com/fr/1", how)),  # through the allowed one
        (6, "http://e.net/", link("http://f.org/", how)),
        (7, "http://e.net/?q", None),
        (8, "http://g.net/q/r?s=1", link("t", how)),
        (9, "http://g.net/q/t", link("/q/u", how)),
        (10, "http://g.net/q/u", link("http://g.com/de/", how)),
        (11, "http://h.net", link("x/y", how)),
        (12, "http://h.net/x/y", link("http://g.com/de/?a=1&amp;b=2", how)),
        (13, "http://i.net/", "<!-- " + link("http://g.com/de/", how) + " --><script>" + link("http://g.com/de/", how) + "</script>"),
        (14, "http://j.net/", link("mailto:x@com/de/", how)),
        (15, None, link("http://g.com/de/", how)),
    ]
    got = {r.page_id: r.verdict for r in U.judge(pages(spark, rows)).collect()}
    blocked = {1, 2, 3, 5, 8, 9, 10, 11, 12}
    assert got == {i: "block" if i in blocked else "allow" for i, *_ in rows}


def test_redirects_by_brute_force(spark):
    rng = random.Random(5)
    names = [f"http://{h}.{t}/{p}" for h in "abcdefghij" for t in ("net", "org", "com") for p in ("de/1", "fr/", "x", "y?z=1")]
    rows = [(i, rng.choice(names), None) for i in range(300)]
    moves = [(rng.choice(names), rng.choice(names)) for _ in range(60)] + [("http://hub.net/", n) for n in names[::7]] + [(None, names[0]), ("x", names[1])]
    table = spark.createDataFrame(moves, "source string, target string")
    assert shown(U.judge(pages(spark, rows), redirects=table)) == brute([r[:2] for r in rows], [m for m in moves if m[0] not in (None, "x")])


def test_long_chain_and_hub(spark):
    chain = [(f"http://c{i}.net/", f"http://c{i + 1}.net/") for i in range(60)] + [("http://c60.net/", "http://x.com/de/")]
    hub = [(f"http://h{i}.net/", "http://hub.net/") for i in range(500)] + [("http://hub.net/", "http://x.com/fr/")]
    rows = [(i, u, None) for i, (u, _) in enumerate(chain + hub)]
    got = U.judge(pages(spark, rows), redirects=spark.createDataFrame(chain + hub, "source string, target string"))
    assert {r.page_id for r in got.where("verdict = 'block'").collect()} == set(range(61))


def test_drop_blocked_keeps_columns(spark):
    rows = [(1, "http://x.com/de/", None), (2, "http://a.net/", link("http://x.com/de/")), (3, "http://b.net/", None), (3, "http://b.net/", None)]
    given = pages(spark, rows)
    kept = U.drop_blocked(given)
    assert kept.schema == given.schema and sorted(r.page_id for r in kept.collect()) == [3, 3]


def test_empty_and_long(spark):
    assert U.judge(pages(spark, [])).count() == 0
    long = "http://a.net/" + "p" * 100_000
    html = "<p>" + "word " * 400_000 + link("http://x.com/de/")
    (row,) = U.judge(pages(spark, [(1, long, html)])).collect()
    assert row.verdict == "block" and len(row.path) == 100_001


def test_rule_list_is_bounded(spark):
    many = tuple(U.Rule("block", f"h{i}.net", "/") for i in range(U.MOST_RULES + 1))
    with pytest.raises(ValueError):
        U.judge(pages(spark, []), rules=many)


def test_sql_on_links(spark, tmp_path):
    import duckdb

    rows = [(i, u, link(rng, i % 5)) for i, (u, rng) in enumerate(zip([u for u in URLS if u and "\n" not in u], ["http://x.com/de/1", "z", "/en/1", "?q", "//example.org/es/", "#", "http://y.net/a/b", "tel:1"] * 4))]
    pages(spark, rows).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    df = U.judge(spark.read.parquet(str(tmp_path / "pages.parquet")))
    assert compare(df, con, oracles.STATEMENTS["op12_url_filter"]) == []


def test_no_python_in_the_plan(spark):
    df = U.judge(pages(spark, [(1, "http://a.net/", link("http://b.net/"))]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
