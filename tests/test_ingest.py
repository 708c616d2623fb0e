"""S2, U1, D1, P4, P5, P8, F2, A4 on the edge rows of FIXTURES.md."""

import pytest

from bellwether import schemas
from bellwether.operators import ingest


def art(title, url="u", published="2025-01-02T03:04:05Z", source=("src",), drop=()):
    src = None if source is None else {"name": source[0]}
    a = {"title": title, "url": url, "publishedAt": published, "source": src}
    for k in drop:
        a[k] = None
    return a


@pytest.fixture(scope="module")
def envelopes(spark):
    rows = [
        ("us", 0, "ok", [art("A"), art("B"), art(None)]),
        ("cn", 1, "ok", [art("B", url="other"), art(None, url="second-null")]),
        ("jp", 2, "error", [art("C")]),
        ("kr", 3, "ok", None),
        ("gb", 4, "ok", []),
        ("de", 5, "ok", [
            art("missing-pub", published=None),
            art("bad-format", published="2025-01-01"),
            art("no-source", source=None),
            art("no-name", source=(None,)),
            art("no-url", url=None),
        ]),
    ]
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def test_flatten_keeps_ok_and_positions(envelopes):
    flat = ingest.flatten_envelopes(envelopes)
    got = sorted((r["country"], r["pos"]) for r in flat.collect())
    assert ("jp", 0) not in got                    # status error dropped
    assert not [g for g in got if g[0] in ("kr", "gb")]  # missing / empty articles
    assert len(got) == 3 + 2 + 5


def test_first_title_wins_null_is_one_key(envelopes):
    flat = ingest.flatten_envelopes(envelopes)
    d = {r["title"]: r for r in ingest.dedupe_first_title(flat).collect()}
    assert d["B"]["country"] == "us" and d["B"]["url"] == "u"
    assert d[None]["country"] == "us"
    assert len(d) == 3 + 5


def test_normalise_and_quarantine(envelopes):
    flat = ingest.dedupe_first_title(ingest.flatten_envelopes(envelopes))
    norm = ingest.normalise_articles(flat, 1700000000.25)
    rows = {r["title"]: r for r in norm.collect()}
    assert rows["A"]["publishedAt"] == "2025-01-02 03:04:05"
    assert rows["A"]["fetched_at"] == 1700000000.25
    assert rows["missing-pub"]["reject_reason"] == "missing publishedAt"
    assert rows["bad-format"]["reject_reason"] == "unparsable publishedAt"
    assert rows["no-source"]["reject_reason"] == "missing source"
    assert rows["no-name"]["source"] == "Unknown Source" and rows["no-name"]["reject_reason"] is None
    assert rows["no-url"]["link"] == "" and rows["no-url"]["reject_reason"] is None
    valid = ingest.valid_messages(norm)
    assert valid.columns == [f.name for f in schemas.NEWS.fields]
    assert valid.count() == 3 + 2
    assert ingest.quarantined(norm).count() == 3


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([("x", 1)], "title string, n int")
    b = spark.createDataFrame([(2, "x")], "n int, title string")
    assert ingest.union_batches(a, b, a).count() == 3


def test_fetch_metrics(envelopes):
    flat = ingest.flatten_envelopes(envelopes)
    m = ingest.fetch_metrics(flat).collect()[0]
    assert (m["n_fetched"], m["n_unique"], m["n_sent"], m["n_rejected"]) == (10, 8, 5, 3)


def test_country_rank_from_fetch_order(spark):
    schema = "country string, status string, articles array<struct<title:string,url:string," \
             "publishedAt:string,source:struct<name:string>>>"
    rows = [("gb", "ok", [art("same")]), ("us", "ok", [art("same", url="from-us")])]
    flat = ingest.flatten_envelopes(spark.createDataFrame(rows, schema))
    first = ingest.dedupe_first_title(flat).collect()
    assert [(r["country"], r["url"]) for r in first] == [("us", "from-us")]
