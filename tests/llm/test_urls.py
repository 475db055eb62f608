"""op8: hosts, paths and rules against plain string code."""

import numpy as np
from conftest import SF001
from plain_urls import plain_judge

from sparkfold.llm import queries, urls

ODD = ["http://A.Example.NET/en/x?q=1#f", "https://net/", "http://net", "http://xnet/", "http://a.net?x", "http://example.com/de/", "HTTP://EXAMPLE.com/de", "http://sub.example.com/de/x",
       "http://example.org/fr/é", "http://org/fr/", "http://example.org/FR/", "no scheme", "", None, "://", ":///p", "a://b://c/d", "http://ÄÖ.net/p", "http://h/a\nb?c",
       "http://example.net/en", "http://deep.example.net/en/", "http://x.example.net/", "x" * 5000, "http://" + "y" * 5000 + ".org/fr/" + "z" * 5000]


def test_rules(spark):
    df = spark.createDataFrame([(i, u, "r", "v", 1) for i, u in enumerate(ODD)] + [(None, "http://a.net/", "r", "v", 1), (0, ODD[0], "r", "v", 1)],
                               "page_id long, url string, rule string, verdict string, host int")
    got = urls.judge(df, queries.URL_RULES).collect()
    threshold = urls.fit(urls.labelled_table())[2]
    assert len(got) == df.count()
    for r in got:
        if r.page_id is not None:
            host, path, rule, verdict = plain_judge(ODD[r.page_id], queries.URL_RULES)
            assert (r.host, r.path, r.rule) == (host, path, rule), (ODD[r.page_id], r)
            assert r.verdict == (verdict or ("block" if r.score >= threshold else "allow"))
    assert urls.judge(df.limit(0), queries.URL_RULES).count() == 0
    assert {r.verdict for r in urls.judge(df, [], labelled=[]).collect()} == {"allow"}


#: Names on the pages that a reader would block; the labelled table holds none of their hosts.
BAD = ("casino-win.", "free-bets.", "cheap-pills.", "ads-track.", "spam-farm.", "adult-x.")


def test_held_out_hosts():
    """On hosts that a model has not seen: of the table, and of all pages."""
    table = urls.labelled_table()
    assert len(table) == len(set(table)) and not any(name in u for u, _ in table for name in BAD)
    threshold = urls.fit(table)[2]
    z = urls.held_out_logits(table)
    blocked = 1 / (1 + np.exp(-z)) >= threshold
    label = np.array([v for _, v in table], dtype=bool)
    assert blocked[label].mean() >= 0.65 and blocked[~label].mean() <= 0.05


def test_pages_of_unseen_hosts(spark):
    got = urls.judge(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), []).select("host", "verdict").collect()
    bad = [r.verdict == "block" for r in got if any(name in f"{r.host}." for name in BAD)]
    good = [r.verdict == "block" for r in got if r.host and not any(name in f"{r.host}." for name in BAD)]
    assert len(bad) > 100 and sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.01 * len(good)


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url").collect()}
    got = queries.op8_url_filter(spark, SF001).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = plain_judge(pages[r.page_id], queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and verdict in (None, r.verdict)
