import re

from rillstone.llm import url_filter as U

URLS = [
    "http://Example.COM/de/x", "https://a.example.com/de/", "http://example.com/en/", "http://example.net/en/q?x#y", "http://b.example.net/fr/", "http://x.org/fr/1", "http://org/fr/", "http://spam-farm.example.org/en/1",
    "http://www.spam-farm.example.org/fr/1", "HTTP://WWW.CHEAP-PILLS.EXAMPLE.COM/EN/", "http://user@casino-win.example.com:80//a/../b", "http://notspam-farm.example.org/", "nothing", "", None, "://", "http://", "a://b://c/d",
    "http://listed.test/dir/page.html", "http://listed.test/dir/", "http://listed.test/other", "http://sub.listed.test/dir/x/y", "http://deep.test/1/2/3/4/5/6/7/8", "http://deep.test/1/2/3/4/5/6/7/8/9",
]
LISTED = [*U.LISTED, "https://listed.test/dir", "deep.test/1/2/3/4/5/6/7/8/"]


def host_path(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.split("[/?#]", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split("[?#]", rest[len(host) :])[0]


def run(spark, urls=URLS, listed=LISTED):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    return {r.page_id: r for r in U.judge(pages, spark.createDataFrame([(u,) for u in listed], "url string")).collect()}


def test_rules_and_hosts(spark):
    out = run(spark)
    for i, u in enumerate(URLS):
        host, path = host_path(u)
        assert (out[i].host, out[i].path) == (host, path), u
        fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want = max(fits) if fits else None
        assert out[i].rule == (want[1] if want else None), u
        if want:
            assert out[i].verdict == want[2]


def test_listed_urls_cover_what_lies_below(spark):
    out = run(spark)
    blocked = {URLS[i] for i, r in out.items() if r.rule is None and r.verdict == "block"}
    assert blocked == {
        "http://spam-farm.example.org/en/1", "HTTP://WWW.CHEAP-PILLS.EXAMPLE.COM/EN/", "http://user@casino-win.example.com:80//a/../b", "http://listed.test/dir/page.html", "http://listed.test/dir/",
        "http://sub.listed.test/dir/x/y", "http://deep.test/1/2/3/4/5/6/7/8", "http://deep.test/1/2/3/4/5/6/7/8/9",
    }
    assert all((r.listed is None) or r.rule or r.verdict == "block" for r in out.values())


def test_listed_hosts_of_any_length_cover_what_lies_below(spark):
    urls = ["http://x.a.b.spam.example.test/", "http://y.x.a.b.c.spam.example.test/p", "http://x.b.spam.example.test/", "http://z.y.a.b.spam.example.test/p/q", "http://1.2.3.4.5.6.7.8.test/"]
    out = run(spark, urls, ["a.b.spam.example.test/", "x.a.b.c.spam.example.test"])
    assert [out[i].listed for i in range(len(urls))] == ["a.b.spam.example.test/", "x.a.b.c.spam.example.test/", None, "a.b.spam.example.test/", None]


def test_paths_of_any_length_cover_what_lies_below(spark):
    deep = "/".join(map(str, range(40)))
    urls = [f"http://x.test/{deep}/more", f"http://x.test/{deep}", f"http://x.test/{deep[:-1]}", "http://a.x.test/a/b/c/d/e/f/g/h/i/j", "http://x.test/a/b/c/d/e/f", "http://x.test/"]
    out = run(spark, urls, [f"x.test/{deep}", "http://x.test/a/b/c/d/e/f/g"])
    assert [bool(out[i].listed) for i in range(len(urls))] == [True, True, False, True, False, False]


def test_the_filter_is_asked_before_a_shuffle(spark):
    pages = spark.createDataFrame([("h.test", "/p")], "host string, path string")
    entries = U.materialize(spark.createDataFrame([("h.test/",)], "form string"), "entries")
    plan = U.covered(pages, entries)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") > plan.index("getbit")  # plans are printed from their top
    assert U.covered(pages, entries).collect()[0].listed == "h.test/"


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    forms = spark.range(3000).selectExpr("concat('h', id, '.test/') AS form")
    blocks, n = U.bloom(forms)
    assert U.possible(forms, blocks, n).count() == 3000
    others = spark.range(20_000).selectExpr("concat('o', id, '.test/') AS form")
    assert U.possible(others, blocks, n).count() < 200


def test_large_list_is_joined_by_block(spark, monkeypatch):
    want = run(spark)
    monkeypatch.setattr(U, "BROADCAST_BLOCKS", 0)
    monkeypatch.setattr(U, "BROADCAST_ROWS", 0)
    assert run(spark) == want


def test_empty_tables(spark):
    assert run(spark, []) == {}
    assert all(r.listed is None for r in run(spark, URLS, []).values())
