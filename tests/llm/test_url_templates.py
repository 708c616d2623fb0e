"""Operator 11: rules, templates and verdicts; the SQL on a table with every edge."""

import random

import duckdb
import pytest

from bellwether.llm import url_templates as U
from bellwether.llm.oracle import OP11

SCHEMA = "page_id long, url string, host string"
EDGES = [None, "nourl", "", "x://", "x://h.com", "x://h.com/", "x://h.com/?a/b", "https://example.com/en/" + "a/" * 50,
         "http://EXAMPLE.com/en/x", "http://www.example.com/en/x", "http://notexample.com/en/x", "http://h.com:80/p q\n/z",
         "http://é.org/ü/1", "a://b://c/d", "http://h.org/*/~/**", "http://a.net/es", "http://net/es/1", "http://xnet/es/1"]


def corpus():
    rng = random.Random(0)
    urls = []
    for i in range(400):
        slug = "".join(rng.choice(x) for x in ("abcdefgh", "ijklmnop", "qrstuv"))
        urls += [f"https://news.example.net/{rng.choice(['es', 'fr', 'de', 'en'])}/story-{slug}x/{rng.choice(['', 'comments', 'print'])}?q={i}",
                 f"http://A.org/u/{i}/{rng.choice(['a', 'b'])}",
                 f"https://spam.net/{rng.choice(['es', 'es', 'fr', 'zz'])}/{i}.html#x"]
    urls += [None] * 30 + EDGES + EDGES
    return [(k, u, "clash") for k, u in enumerate(urls)]


def sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, host VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    out = con.execute(OP11)
    names = [d[0] for d in out.description]
    return sorted((dict(zip(names, r)) for r in out.fetchall()), key=str)


@pytest.fixture(scope="module")
def judged(spark):
    rows = corpus()
    return rows, [r.asDict() for r in U.query(spark, spark.createDataFrame(rows, SCHEMA)).collect()]


def test_equals_the_sql(judged):
    rows, got = judged
    assert sorted(got, key=str) == sql(rows)


def test_templates(judged):
    by = {}
    for r in judged[1]:
        by.setdefault(r["host"], set()).add(r["template"])
    assert by["news.example.net"] == {"~*", "~*~", "/en*", "/en*~", "/de*", "/de*~"}     # slugs are one wildcard, es is like fr
    assert by["a.org"] == {"/u*~"} and by["spam.net"] == {"~*", "/zz*"}
    assert "/en/a/a/a/a/a**" in by["example.com"] or "/en~/a/a/a/a**" in by["example.com"]


def test_rules(judged):
    rows, got = judged
    url = {k: u for k, u, _ in rows}
    said = {url[r["page_id"]]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert said["x://h.com"][:3] == ("h.com", "", None) and said["x://h.com/?a/b"] == ("h.com", "/", "com/", "allow")
    assert said["http://EXAMPLE.com/en/x"] == ("example.com", "/en/x", "example.com/en/", "block")
    assert said["http://www.example.com/en/x"][2:] == ("www.example.com/en/", "allow")
    assert said["http://notexample.com/en/x"][2:] == ("com/", "allow") and said["a://b://c/d"][:2] == ("b:", "//c/d")
    assert said["http://net/es/1"][2] == "net/es/" and said["http://xnet/es/1"][2] is None and said["http://a.net/es"][2] is None
    assert said[None][:3] == ("", "", None) and said[None][3] == "allow"
    assert sum(u is None for u in url.values()) == sum(r["host"] == "" and url[r["page_id"]] is None for r in got) == 32


def test_urls_of_a_rejected_template_go(spark):
    """Labelled and other urls share a template: its purity decides those that no rule fits."""
    rules = (("bad.org/p/1", "block"), ("ok.org/p/1", "allow"))
    rows = [(k, f"http://{h}.org/p/{k}", "") for h in ("bad", "ok") for k in range(1, 200)]
    got = U.judge(spark.createDataFrame(rows, SCHEMA), rules).collect()
    free = {(r["host"], r["verdict"]) for r in got if r["rule"] is None}
    assert free == {("bad.org", "block"), ("ok.org", "allow")}


def test_empty_and_native(spark):
    empty = U.query(spark, spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    plan = empty._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
