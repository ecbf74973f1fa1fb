from __future__ import annotations

import datetime as dt
import itertools
import json
import random
from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from logweir.functions import (
    date_from_link,
    file_name,
    index_page,
    is_blocked,
    normalize_url,
    swap_suffix,
    year_of,
)
from logweir.functions.anchors import absolute
from logweir.operators.blocklist import mark_blocked
from logweir.operators.catalogue import (
    day_range,
    latest_link,
    link_catalogue,
    link_of_day,
    page_links,
    pending_days,
)
from logweir.operators.traffic import transferred_mb

DAY = dt.date(2024, 3, 20)


def links(spark, *values):
    return spark.createDataFrame(list(zip(values, range(len(values)))), "link string, pos bigint")


def test_last_link_of_a_day_wins(spark):
    table = link_catalogue(
        links(
            spark,
            "https://a/log20240320.zip",
            "https://b/log20240320.zip",
            "https://b/log20240319.zip",
            "https://b/log20240321.txt",
            "https://b/about.zip",
            None,
        )
    )
    found = {row.log_date: row.link for row in table.collect()}
    assert found == {DAY: "https://b/log20240320.zip", dt.date(2024, 3, 19): "https://b/log20240319.zip"}
    assert link_of_day(table, DAY) == "https://b/log20240320.zip"
    assert tuple(latest_link(table).first()) == (DAY, "https://b/log20240320.zip")
    with pytest.raises(ValueError, match="2024-03-21"):
        link_of_day(table, dt.date(2024, 3, 21))


def test_dates_of_links(spark):
    cases = {
        "https://h/files/log20240320.zip": DAY,
        "log20240320.csv.gz": DAY,
        "file:/x/log20241399.zip": None,
        "log2024032.zip": None,
        "https://h/log120240320.zip": None,
        "https://h/log2024-03-20.zip": DAY,
        "20240320": DAY,
        "weblog20240320.zip": None,
        "https://h/log20240320/x.zip": None,
    }
    data = spark.createDataFrame(list(cases.items()), "link string, day date")
    assert data.where(~date_from_link(F.col("link")).eqNullSafe(F.col("day"))).collect() == []


def test_names(spark):
    row = spark.range(1).select(
        file_name(F.lit(DAY)).alias("zip"),
        swap_suffix(file_name(F.lit(DAY)), ".zip", ".csv").alias("csv"),
        index_page(F.lit(DAY), "https://host.example/y%d.html").alias("page"),
        year_of(F.lit(None).cast("date")).alias("this_year"),
    ).first()
    assert (row.zip, row.csv) == ("log20240320.zip", "log20240320.csv")
    assert row.page == "https://host.example/y2024.html"
    assert row.this_year == dt.date.today().year


def days_of(df):
    return [row.log_date for row in df.collect()]


def test_day_ranges(spark):
    later = DAY + dt.timedelta(2)
    up = [DAY, DAY + dt.timedelta(1), later]
    assert days_of(day_range(spark, DAY, later)) == up
    assert days_of(day_range(spark, later, DAY)) == up[::-1]
    assert days_of(day_range(spark, DAY)) == [DAY]
    present = spark.createDataFrame([(DAY,)], "log_date date")
    wanted = day_range(spark, DAY, later)
    assert days_of(pending_days(wanted, present)) == up[1:]
    assert days_of(pending_days(wanted, present, force=True)) == up


def python_normalised(url):
    if not url:
        return None
    parts = urlparse(url)
    return urlunparse(parts._replace(path=parts.path or "/"))


def test_normalised_urls_equal_the_standard_library(spark):
    pieces = (
        ["", "http:", "HTTP:", "foo:", "mailto:", "file:", "1x:", "svn+ssh:"],
        ["", "//", "//h.com", "//H:80", "////"],
        ["", "/", "/a", "a", "/a/b;p", "/a;", "/a;;", ";", ";x", "/a;b/c;", "//x"],
        ["", "?", "?q", "?q?r;"],
        ["", "#", "#f", "##", "#a?b;"],
    )
    urls = ["".join(parts) for parts in itertools.product(*pieces)]
    urls += [" http://x", "\thttp://x\n/y", " ", "http://h\n/a?\n", None]
    data = spark.createDataFrame([(u, python_normalised(u)) for u in urls], "u string, want string")
    wrong = data.withColumn("got", normalize_url(F.col("u"))).where("NOT got <=> want")
    assert wrong.collect() == []


def blocked(spark, patterns, urls, **options):
    data = spark.createDataFrame([(u,) for u in urls], "u string")
    return [r.b for r in data.select(is_blocked(F.col("u"), patterns, **options).alias("b")).collect()]


def test_block_lists(spark):
    urls = ["http://h/a.png", "http://h/a.png?x=1", "http://h/apng", "http://h/a.png/b", None]
    assert blocked(spark, ["*.png", "*.png?*"], urls, match="whole") == [True, True, False, False, False]
    assert blocked(spark, ["*_%\\*"], ["a_%\\b", "axyb"]) == [True, False]
    assert blocked(spark, [], ["x"]) == [False]
    site = ["https://www.facebook.com", "https://www.facebook.com/tr?id=1"]
    assert blocked(spark, ["https://www.facebook.com"], site, match="whole") == [True, False]
    assert blocked(spark, ["https://www.facebook.com"], site) == [True, True]
    with pytest.raises(ValueError):
        is_blocked(F.col("u"), match="some")


def test_block_list_needs_no_regex(spark):
    data = spark.createDataFrame([("x",)], "u string")
    for match, test in (("whole", "EndsWith(u"), ("part", "Contains(u")):
        kept = data.where(~is_blocked(F.col("u"), match=match))
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "RLIKE" not in plan and test in plan and "Join" not in plan


def line(method, **params):
    inner = {"message": {"method": method, "params": params}, "webview": "x"}
    return json.dumps({"level": "INFO", "message": json.dumps(inner)})


def test_transferred_volume(spark):
    lines = [
        line("Network.loadingFinished", encodedDataLength=1048576),
        line("Network.loadingFinished", encodedDataLength=524288),
        line("Network.dataReceived", encodedDataLength=99),
        line("Page.loaded"),
    ]
    log = spark.createDataFrame([(text,) for text in lines], "line string")
    assert transferred_mb(log).first().total_mb == 1.5
    assert transferred_mb(log.where("false")).first().total_mb == 0.0


def test_links_in_full(spark):
    bases = ["https://h.example/a/b/c?x=1#y", "https://h.example", "https://h.example/", "http://h.example:80/a/"]
    links = ["d", "./d", "../d", "../../../d", "/e/./f/../g", "?q=2", "#z", "//o.example/k", "mailto:a@b", "https://q.example/z/../y",
             "d/..", "d/.", "..", ".", "d?x=/../y", "g;x=1/../y", "a:b", "/", "é/ü"]
    rows = spark.createDataFrame([(b, x) for b in bases for x in links], "base string, link string")
    for row in rows.select("*", absolute(F.col("link"), F.col("base")).alias("full")).collect():
        assert row.full == urljoin(row.base, row.link), (row.base, row.link)


def test_anchors(spark):
    html = """<A class='x>y' HREF = " /p&amp;q " >x</a><a href=/u&#x2F;v>y</a><!-- <a href="no"> --><a name=z>
        <a data-href="no" title='href="no"' href='/w&#8364;&lt;&nope;&copy'><script>"<a href='no'>"</script>
        <abbr href="no"><base target=_top href='../x/'><a href="">self</a><a href=k&#xD800;&#1114112;>"""
    pages = [(1, "http://s.example/a/b/", html, 0), (2, "http://s.example", None, 0), (3, None, "", 0), (4, None, '<a href="x">', 0), (1, "http://s.example/", '<a href="y">' * 3, 0)]
    found = page_links(spark.createDataFrame(pages, "page_id int, url string, html string, pos int"), "page_id").collect()
    assert sorted((r.page_id, r.pos, r.link) for r in found if r.link) == [
        (1, 0, "http://s.example/p&q"), (1, 0, "http://s.example/y"), (1, 1, "http://s.example/u/v"), (1, 1, "http://s.example/y"),
        (1, 2, "http://s.example/w€<&nope;&copy"), (1, 2, "http://s.example/y"),
        (1, 3, "http://s.example/a/x/"), (1, 4, "http://s.example/a/x/k��"),
    ]
    assert [(r.page_id, r.link) for r in found if not r.link] == [(4, None)]


def test_very_long_source(spark):
    html = "<a href='/x'>" * 20_000 + "<a " + "b='>' " * 2_000 + "href=/y>" + "<!-- " + "<a href='/n'>" * 50_000
    pages = spark.createDataFrame([("http://s.example/", html)], "url string, html string")
    # A comment that is never closed is none.
    assert page_links(pages).groupBy("link").count().orderBy("link").collect() == [
        ("http://s.example/n", 50_000), ("http://s.example/x", 20_000), ("http://s.example/y", 1)
    ]


def test_catalogue_of_a_page(spark):
    html = "".join(f'<a href="log2024031{i}.zip">{i}</a>' for i in (3, 4, 3)) + '<a href="log20240315.txt">'
    links = page_links(spark.createDataFrame([("https://s.example/dir/logs.html", html)], "url string, html string"))
    assert sorted(tuple(r) for r in link_catalogue(links).collect()) == [
        (dt.date(2024, 3, d), f"https://s.example/dir/log202403{d}.zip") for d in (13, 14)
    ]


def _random_urls(seed, n=120):
    rng = random.Random(seed)
    words = ["ads", "a", "b", "img", ".png", "/", "?", "%", "_", "\\", "x.y", "track", "é", "\n"]
    def text(k):
        return "".join(rng.choice(words) for _ in range(rng.randrange(k)))
    urls = [(i, f"http://{text(4)}/{text(6)}") for i in range(n)] + [(n, None), (n + 1, ""), (n, None)]
    patterns = ["*".join(text(3) for _ in range(rng.randrange(1, 4))) for _ in range(25)]
    return urls, [*patterns, "http://*", "track*png", "x.y"], rng


@pytest.mark.parametrize("match, limit", [("part", 0), ("whole", 10**8)])
def test_block_list_as_a_table_equals_the_plan(spark, match, limit):
    urls, patterns, rng = _random_urls(limit + len(match))
    table = spark.createDataFrame(urls, "id int, url string")
    for some in (patterns, rng.sample(patterns, 3), [""], []):
        rows = spark.createDataFrame([(p,) for p in [*some, None, *some[:1]]], "pattern string")
        marked = mark_blocked(table, rows, match=match, limit=limit)
        expected = table.withColumn("blocked", is_blocked(F.col("url"), some, match=match))
        assert sorted(map(str, marked.collect())) == sorted(map(str, expected.collect()))


def test_long_block_list(spark):
    patterns = spark.range(100_000).selectExpr("concat('*/banner', id * 7, '/*.js') as pattern")
    urls = spark.range(2_000).selectExpr("id", "concat('https://s.example/banner', id, '/lib/', id % 3, '.js') as url")
    marked = mark_blocked(urls, patterns)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 20_000 and "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.id for r in marked.where("blocked").collect()} == set(range(0, 2_000, 7))
