"""URL filters against the rules by hand and a dense power iteration."""

import numpy as np
import pytest

from compare import duck_rows, spark_rows
from millrace import Workspace
from millrace.llm import queries, url_filters
from llm.conftest import bag

RULES = {"com/": "allow", "bad.com/": "block", "bad.com/ok/": "allow"}


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, rule int")


@pytest.fixture
def pages(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">x</a> <IMG SRC=//{h}>' for h in hosts)
    rows = [
        (1, "https://A.com/x?q#f", link("n.org", "m.org"), None, 1),
        (2, "http://www.bad.com/y", link("n.org"), "x", 2),
        (3, "http://bad.com/ok/1", None, None, None),
        (4, "http://spam.org/", link("bad.com", "www.bad.com", "bad.com"), None, None),
        (5, "http://n.org/a/b", link("m.org") + '<a href="/self">', None, None),
        (6, "http://m.org", link("bad.com", "n.org"), None, None),
        (7, None, link("bad.com"), None, None),
        (8, "no scheme", "", None, None),
        (9, "http://bad.com/", "", None, None),
        (9, "http://bad.com/", "", None, None),
        (None, "http://notbad.com", "", None, None),
        (11, "x://e.com#p/q", "", None, None),
    ]
    return frame(spark, rows)


def test_hosts_paths_rules(pages):
    got = {(r.page_id, r.host, r.path, r.rule) for r in url_filters.parsed(pages, RULES).collect()}
    assert got == {
        (1, "a.com", "/x", "com/"), (2, "www.bad.com", "/y", "bad.com/"), (3, "bad.com", "/ok/1", "bad.com/ok/"),
        (4, "spam.org", "/", None), (5, "n.org", "/a/b", None), (6, "m.org", "", None), (7, "", "", None), (8, "", "", None),
        (9, "bad.com", "/", "bad.com/"), (None, "notbad.com", "", None), (11, "e.com", "", None),
    }


def dense(edges, start, way):
    """Power iteration with a matrix."""
    hosts = sorted({h for w, a, b, _ in edges for h in (a, b)} | {h for w, h in start})
    at = {h: i for i, h in enumerate(hosts)}
    m, s = np.zeros((len(hosts),) * 2), np.zeros(len(hosts))
    for w, a, b, share in edges:
        if w == way:
            m[at[b], at[a]] = share
    for w, h in start:
        if w == way:
            s[at[h]] = 0.15
    r = s.copy()
    for _ in range(url_filters.ROUNDS):
        r = s + 0.85 * m @ r
    return {h: r[i] for h, i in at.items() if r[i] > 0}


def test_ranks(pages, space):
    judged = url_filters.parsed(pages, RULES)
    start = url_filters.seeds(judged, RULES)
    edges = url_filters.host_edges(pages)
    links = [(r["way"], r["from"], r["to"], r["share"]) for r in edges.collect()]
    # Links with a null source do not count: the two of spam.org and the two of m.org do.
    assert {b: s for w, a, b, s in links if (w, a) == (1, "bad.com")} == {"spam.org": pytest.approx(4 / 6), "m.org": pytest.approx(2 / 6)}
    seeds = [(r.way, r.host) for r in start.collect()]
    assert sorted(seeds) == [(0, "a.com"), (1, "bad.com"), (1, "www.bad.com")]
    got = url_filters.ranks(start, edges, space).collect()
    for way in (0, 1):
        assert {r.host: pytest.approx(r.mass) for r in got if r.way == way} == dense(links, seeds, way)


def test_verdicts(pages, space):
    got = {(r.page_id, r.verdict) for r in url_filters.judge(pages, RULES, space).collect()}
    assert {(1, "allow"), (2, "block"), (3, "allow"), (4, "block"), (7, "block"), (8, "block"), (9, "block"), (None, "allow")} <= got
    assert url_filters.judge(pages, RULES, space).count() == 12


def test_empty(spark):
    empty = frame(spark, [])
    assert url_filters.judge(empty, RULES, Workspace(spark)).collect() == []


def test_query_and_sql_on_links(spark, pages, tmp_path):
    """The registered query and its SQL agree where hosts do link to each other."""
    import duckdb

    pages.select("page_id", "url", "html").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names, want = duck_rows(con, queries.CHECKS["op10_link_trust"])
    got_names, got = spark_rows(queries.QUERIES["op10_link_trust"](spark, str(tmp_path)))
    assert sorted(names) == sorted(got_names) and got == want


def test_chain_beyond_eight_links(spark, space):
    """Verdicts are those of the converged spread, solved exactly, on a chain of 12 hosts before a blocked seed."""
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">x</a>' for h in hosts)
    after = {f"c{i:02d}.org": f"c{i + 1:02d}.org" for i in range(11)} | {"c11.org": "bad.com"}
    hosts = [*sorted(after), "bad.com"]
    pages = frame(spark, [(i, f"http://{h}/", link(after[h]) if h in after else "", None, None) for i, h in enumerate(hosts)])
    back = np.array([[float(after.get(b) == a) for a in hosts] for b in hosts])  # distrust goes against the links
    want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * back, 0.15 * np.array([h == "bad.com" for h in hosts]))
    edges, start = url_filters.host_edges(pages), url_filters.seeds(url_filters.parsed(pages, RULES), RULES)
    got = {r.host: r.mass for r in url_filters.settled(start, edges, space).collect() if r.way == 1}
    assert got == {h: pytest.approx(m, rel=1e-5) for h, m in zip(hosts, want, strict=True)}
    assert {r.verdict for r in url_filters.judge(pages, RULES, space).collect()} == {"block"}


def test_kept_columns_of_clashing_names(pages, space):
    rows = pages.selectExpr("*", "'p' AS path", "1 AS bad", "2 AS mass", "3 AS way", "4 AS verdict")
    kept = ("page_id", "host", "path", "rule", "verdict", "bad", "mass", "way")
    got = url_filters.judge(rows, RULES, space, kept)
    assert got.columns == ["page_id", "bad", "mass", "way", "host", "path", "rule", "verdict"]
    plain = url_filters.judge(pages, RULES, space)
    assert bag(map(tuple, got.drop("bad", "mass", "way").collect())) == bag(map(tuple, plain.collect()))
