import pytest

from lodestat.llm import hostrank
from lodestat.llm.queries import ORACLES


def page(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute_ranks(seeds, edges, steps=300):
    ranks = dict(seeds)
    for _ in range(steps):
        moved = dict(seeds)
        for (a, b), n in edges.items():
            out = sum(m for (x, _), m in edges.items() if x == a)
            moved[b] = moved.get(b, 0) + hostrank.DAMPING * ranks.get(a, 0) * n / out
        ranks = moved
    return ranks


def test_hosts_and_paths(spark):
    urls = ["http://A.B.com/x?y#z", "https://a.com", "x://u@h:80?q/r", "nothing", None, "a://b://c/d", "http:///p", "http://É.com/É?", "http://a\n.com/p\nq"]
    out = [(r["host"], r["path"]) for r in hostrank.judge_urls(page(spark, [(i, u, None) for i, u in enumerate(urls)])).orderBy("page_id").collect()]
    assert out == [("a.b.com", "/x"), ("a.com", ""), ("u@h:80", ""), ("", ""), ("", ""), ("b:", "//c/d"), ("", "/p"), ("É.com", "/É"), ("a\n.com", "/p\nq")]


def test_rules(spark):
    urls = {"http://x.com/": ("com/", "allow"), "http://x.com": (None, "allow"), "http://a.example.com/en/1": ("example.com/en/", "block"),
            "http://www.example.com/en/1": ("www.example.com/en/", "allow"), "http://a.www.example.com/en/1": ("www.example.com/en/", "allow"),
            "http://wwwexample.com/en/": ("com/", "allow"), "http://example.com/en": ("com/", "allow"), "http://q.net/es/": ("net/es/", "block"),
            "http://net/fr/x": ("net/fr/", "block"), "http://r.net/de/": (None, "allow"), "http://notnet/es/": (None, "allow")}
    rows = page(spark, [(i, u, "") for i, u in enumerate(urls)])
    out = {r["page_id"]: (r["rule"], r["verdict"]) for r in hostrank.judge_urls(rows).collect()}
    assert [out[i] for i in range(len(urls))] == list(urls.values())


def test_ranks_equal_brute_force(spark):
    edges = {("a", "b"): 3, ("b", "c"): 1, ("a", "c"): 1, ("c", "a"): 2, ("d", "a"): 1, ("c", "e"): 5}
    seeds = {"a": 1.0, "d": 0.25}
    found = hostrank.propagate(spark.createDataFrame(list(seeds.items()), "host string, seed double"),
                               spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "a string, b string, links long"))
    assert {r["host"]: r["rank"] for r in found.collect()} == pytest.approx(brute_ranks(seeds, edges), rel=1e-5)


def test_a_long_chain_is_followed_to_its_end(spark):
    chain = spark.createDataFrame([(f"h{i:02d}", f"h{i + 1:02d}", 1) for i in range(40)], "a string, b string, links long")
    ranks = {r["host"]: r["rank"] for r in hostrank.propagate(spark.createDataFrame([("h00", 1.0)], "host string, seed double"), chain).collect()}
    assert ranks == {f"h{i:02d}": pytest.approx(hostrank.DAMPING**i) for i in range(41)}


def test_equals_sql_where_pages_link(spark, db):
    """A ring, a chain and a blocked host at its end; the given pages link to no other hosts."""
    hosts = [f"{c}.org" for c in "abcdefgh"]
    rows = [(i, f"http://{h}/", f'<a href="http://{n}/">x</a> <a href=http://bad.net/>y</a>') for i, (h, n) in enumerate(zip(hosts, hosts[1:] + hosts[:1]))]
    rows += [(100 + i, f"http://bad.net/{'es' if i else 'de'}/{i}", f"<a href='//{hosts[i]}/'>z</a>") for i in range(4)] + [(200, "http://fine.com/", "<a href='http://a.org'>")]
    pages = page(spark, rows)
    db.register("pages", pages.toPandas())
    expected = sorted(db.execute(ORACLES["op3_url_verdicts"]).fetchall())
    found = hostrank.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, found)) == expected and {r[4] for r in expected} == {"allow", "block"}


def test_a_very_long_page(spark):
    html = "<p>text</p>" * 400_000 + "<a href='http://bad.net/'>x</a>"
    out = hostrank.judge_urls(page(spark, [(1, "http://s.org/", html), (2, "http://bad.net/es/", "")])).collect()
    assert {r["page_id"]: r["verdict"] for r in out} == {1: "block", 2: "block"}


def test_links_to_blocked_hosts_spread_distrust(spark):
    bad = "<a href='http://bad.net/es/1'>x</a><A HREF = //BAD.net/q>y</A><a href=/own>z</a>"
    good = '<a href="https://friend.org/a">f</a>'
    rows = [(1, "http://bad.net/es/1", None), (2, "http://bad.net/es/2", ""), (3, "http://suspect.org/a", bad), (4, "http://suspect.org/b", None),
            (5, "http://fine.com/", good), (6, "http://friend.org/a", ""), (7, "http://bad.net/de/", None), (8, "http://other.org/", "")]
    out = {r["page_id"]: r for r in hostrank.judge_urls(page(spark, rows)).collect()}
    assert out[7]["verdict"] == "block" and out[3]["verdict"] == out[4]["verdict"] == "block"
    assert out[6]["verdict"] == out[8]["verdict"] == "allow" and out[6]["trust"] > 0 and out[8]["trust"] == 0


def test_edges(spark):
    rows = page(spark, [(1, "http://a.net/es/", "x"), (1, "http://a.net/es/", "x"), (None, None, None), (2, "", "")]).selectExpr("*", "'q' host", "'q' path", "'q' rule", "'q' a")
    out = hostrank.judge_urls(rows).collect()
    assert len(out) == 4 and all(r["verdict"] in ("allow", "block") for r in out)
    assert hostrank.judge_urls(rows.where("1 = 0")).count() == 0
