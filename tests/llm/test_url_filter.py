from pyspark.sql import functions as F

from quern.llm import url_filter as uf

URLS = ["https://a.example.org/es/x", "http://example.org/en/12?q#f", "http://EXAMPLE.org/EN/1", "https://org/", "https://xorg/a", "ftp://b.com/fr/",
        "http://b.com/de/1", "http://b.com/de", "http://org?x=/", "x://y://z.org/q", "no scheme.org/", "", None, "://", "http://u@c.com:80/de/",
        "http://.org/", "http://org./", "http://É.ORG/é?", "http://a.b.c.d.e.example.org/en/1/2", "http://example.org#/es/", "http://example.org/es/", "http://example.org/es/",
        "http://example.org/" + "a/" * 50_000, "http://" + "a." * 30_000 + "org/"]


def slow(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in uf.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_matches_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[0])], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit(1), "rule": F.lit(2), "verdict": F.lit(3), "html": F.lit(None).cast("string")})
    got = sorted((tuple(r) for r in uf.filter_urls(pages).collect()), key=repr)
    assert got == sorted(((i, *slow(u)) for i, u in [*enumerate(URLS), (None, URLS[0])]), key=repr)


def test_no_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert tuple(uf.filter_urls(pages, rules=[]).first()) == (1, "a.org", "/", None, "allow")
    assert uf.filter_urls(pages.where("page_id = 0")).collect() == []


def test_equal_length_block_wins_and_deep_rules(spark):
    rules = [("allow", "a.org", "/x"), ("block", "b.a.org", ""), ("block", "c.org", "/aa"), ("allow", "c.org", "/a")]
    pages = spark.createDataFrame([(1, "http://b.a.org/x"), (2, "http://c.org/aab"), (3, "http://c.org/ab")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in uf.filter_urls(pages, rules).collect()} == {1: "block", 2: "block", 3: "allow"}
