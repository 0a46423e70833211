"""Url judgement on repeated rows, null ids and very long urls, rules against a plain search."""

from sigscore.llm import url_filter

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def parts(url):
    """Host and path as the contract states them."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    return host, rest[:min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]


def rule(host, path):
    fits = [r for r in RULES if (host == (h := r.split("/", 1)[0]) or host.endswith("." + h))
            and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


def test_repeated_null_and_long(spark):
    long = "http://a.example.net/en/" + "x" * 200_000
    urls = [(1, "http://EXAMPLE.com/de/1"), (1, "http://EXAMPLE.com/de/1"), (None, "http://b.org/fr/z"),
            (None, None), (2, long), (3, "http://" + "sub." * 20_000 + "net/q?" + "k=v&" * 20_000),
            (4, "ftp://o.example.com/en/?://net/"), (5, "http://notexample.net.example.com/de/#"),
            (6, ""), (7, "http://?"), (7, "http://org/fr"), (8, "HTTP://Ä.NET/x")]
    docs = spark.createDataFrame([(*u, "clash", "clash") for u in urls],
                                 "page_id long, url string, host string, verdict string")
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
                  for r in url_filter.judge_urls(docs).collect()), key=repr)
    want = sorted(((i, *parts(u), rule(*parts(u))) for i, u in urls), key=repr)
    assert [g[:4] for g in got] == want
    assert all(v == RULES[r] for *_, r, v in got if r) and {g[4] for g in got} <= {"allow", "block"}
