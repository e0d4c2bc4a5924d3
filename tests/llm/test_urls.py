import random

from slotwise.llm.queries import URL_RULES
from slotwise.llm.urls import filter_urls


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h.split(".")) if h else 0, len(p), v == "block", h + p, v) for v, h, p in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


def check(spark, urls, rules, **kw):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in filter_urls(df, rules, **kw).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_given_rules(spark):
    check(spark, [None, "", "no scheme", "http://Example.COM/en/1", "http://www.example.com/en/", "http://www.example.com/en",
                  "http://a.www.example.com/en/x?q#f", "https://x.net/es/1", "https://net/fr/", "https://x.netx/fr/", "http://example.com",
                  "http://example.com?x=/en/", "a://b://c/d", "http://É.com/", "http://com/\nx"], URL_RULES)


def test_random_rules_and_blocks(spark):
    rng = random.Random(2)
    hosts = ["", "com", "a.com", "b.a.com", "net", "x.net", "a"]
    paths = ["", "/", "/en", "/en/", "/en/a", "/e"]
    rules = list({(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(25)})
    urls = [f"http://{rng.choice(hosts + ['q.b.a.com', 'COM'])}{rng.choice(paths + ['/en/abc', '//', '/en?x'])}" for _ in range(200)]
    check(spark, urls, rules)
    check(spark, urls, rules, block_bytes=8000)     # several broadcast tries


def test_a_block_is_as_large_as_counted():
    import tracemalloc
    from slotwise.llm.urls import build_trie, rule_blocks
    rules = [("block", f"h{i % 900}.d{i}.example{i % 7}.com", f"/a{i % 50}/b{i}/") for i in range(20_000)]
    block = next(rule_blocks(rules, 4 << 20))
    tracemalloc.start()
    trie = build_trie(block)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert trie and len(block) > 1000 and held < 4 << 20


def test_no_rules_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "http://a/b", "x"), (1, "http://a/b", "x")], "page_id long, url string, host string")
    assert [tuple(r) for r in filter_urls(df, []).collect()] == [(1, "a", "/b", None, "allow")] * 2
    assert filter_urls(df.limit(0), URL_RULES).count() == 0
