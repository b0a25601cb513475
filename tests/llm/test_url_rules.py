import random

from hearthstream.llm.url_rules import judge_urls, rules_frame

PAGE = "page_id bigint, url string, html string, host string, path string, rule string, short bigint, salt int"


def pages(spark, urls):
    rows = [(i, u, None, "h", "p", "r", 1, 2) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, PAGE).repartition(3)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, default="allow"):
    """Every rule against the URL, without expressions or digests."""
    host, path = split(url)
    fits = [
        (len(h) + len(p), len(h), v == "block", v, h + p)
        for v, h, p in rules
        if None not in (v, h, p) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fits)[4], max(fits)[3]) if fits else (host, path, None, default)


def check(spark, urls, rules, **options):
    got = judge_urls(pages(spark, urls), rules_frame(spark, rules), ["page_id"], **options)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    found = {r.page_id: tuple(r)[1:] for r in got.collect()}
    assert found == {i: brute(u, rules, options.get("default", "allow")) for i, u in enumerate(urls)}
    assert got.count() == len(urls)
    return found


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]


def test_given_rules(spark):
    found = check(spark, [
        "http://a.example.net/en/1", "http://a.example.net/de/1", "https://EXAMPLE.com/de/x?y#z",
        "https://notexample.com/de/", "http://x.org/fr/", "http://x.org/en/", "http://a.net", "http://a.net?q=/",
        None, "", "no scheme.net/", "ftp://u@h.net:80/a", "x://net/#/en/", "://net/", "http:///en/", "a://b://c.net/",
    ], RULES)
    assert found[0] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert found[6] == ("a.net", "", None, "allow")


def test_other_rules(spark):
    rules = [*RULES, ("block", "b.net", ""), ("allow", "c.b.net", "/d"), ("block", "c.b.net", "/de/f.html"),
             ("allow", "c.b.net", "/de/f.html"), ("block", "x", "/a/b/c/"), ("allow", None, "/"), ("block", "y", None),
             ("allow", "a.b", "/cc"), ("block", "b", "/cc/d")]
    rng = random.Random(2)
    urls = [
        "h://" + ".".join(rng.choices(["a", "b", "c", "net", "x", "", "É"], k=rng.randrange(1, 5)))
        + "".join(rng.choices(["/", "d", "de", "/f.html", "/a", "/b", "/c/", "/cc", "?", "\n"], k=rng.randrange(5)))
        for _ in range(600)
    ]
    check(spark, urls, rules, salts=3)
    check(spark, urls, rules, default="block", salts=1)


def test_repeats_long_urls_and_empty_tables(spark):
    urls = ["http://a.net/x"] * 50 + ["http://" + "a." * 100_000 + "net" + "/" * 100_000]
    check(spark, urls, RULES)
    check(spark, [], RULES)
    assert check(spark, ["http://a.net/"], [])[0] == ("a.net", "/", None, "allow")


def test_rows_without_id_stay(spark):
    df = spark.createDataFrame([(None, "http://a.net/"), (None, None)], "page_id bigint, url string")
    got = judge_urls(df, rules_frame(spark, RULES), ["page_id"]).collect()
    assert sorted(r.verdict for r in got) == ["allow", "block"]
