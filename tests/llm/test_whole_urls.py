"""Paths that differ in their fourth segment or later."""

import pytest

from listingflow.llm.urls import PRIOR, Rule, judge


def test_deep_segments_have_places(spark):
    # The first three segments vary; of the fourth, `ads` is blocked by rules and `news` allowed.
    rules = tuple(Rule(v, f"h.com/v{'abcdefghijklmnopqrstuvwxyz'[k]}/a/b/{w}/") for k in range(26) for v, w in (("block", "ads"), ("allow", "news")))
    rows = [(f"v{c}", w, n) for c in "abcdefghijklmnopqrstuvwxyz" for w in ("ads", "news") for n in range(3)]
    urls = [f"http://h.com/{v}/a/b/{w}/{n}" for v, w, n in rows] + ["http://h.com/new/a/b/ads/7/8/9", "http://h.com/new/a/b/news/7/8/9"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judge(frame, rules).collect()}
    ads, news = got[len(rows)], got[len(rows) + 1]
    assert len(got) == len(urls) and ads.rule is None and news.rule is None
    assert (ads.verdict, news.verdict) == ("block", "allow")
    assert (ads.template, news.template) == ("/*/*/*/ads/*/*/*", "/*/*/*/news/*/*/*")


def test_purity_of_settled_places(spark):
    urls = ["http://h.com/a/b", "http://h.com/a/b/c/d", "http://h.com/x/y/z/u/v", "http://h.com/" + "q/" * 4000]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in judge(frame, (Rule("block", "h.com/a/"),)).collect()}
    # All labels are blocked: the share is 1 from the top, and every level keeps it.
    assert [got[k].template for k in range(3)] == ["/*/*", "/*/*/*/*", "/*/*/*/*/*"] and got[3].template == "/*" * 4000
    assert {r.purity for r in got.values()} == {1.0}
    more = urls + ["http://g.com/a", "http://g.com/b"]
    frame = spark.createDataFrame(list(enumerate(more)), "page_id long, url string")
    rules = (Rule("block", "h.com/a/"), Rule("allow", "g.com/"))
    got = {r.page_id: r.purity for r in judge(frame, rules).collect()}
    # Domain and host, then levels 1 and 2 have both labels, 3 and 4 one.
    purity = 0.5
    by_level = []
    for labelled in (2, 2, 2, 2, 1, 1):
        purity = (labelled + PRIOR * purity) / (labelled + PRIOR)
        by_level.append(purity)
    want = {0: by_level[3], 1: by_level[5], 2: by_level[5], 3: by_level[5]}
    assert {k: round(got[k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}
