import random

from cardwatch.llm import sql, url_filter
from tests.compare import connect, differences

PAGES, RULES = "page_id long, url string", "host string, path string, verdict string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def brute(pages, rules):
    out = []
    for page, url in pages:
        host, path = split(url)
        fit = [
            (len(h + p), len(h), [-ord(c) for c in h + p], v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fit) if fit else None
        out.append((page, host, path, best and best[4], best[5] if best else "allow"))
    return sorted(out, key=str)


def got(spark, pages, rules):
    df = spark.createDataFrame([(*p, "h", 1) for p in pages], PAGES + ", host string, copies int")
    found = url_filter.judge(df, spark.createDataFrame(rules, RULES))
    return sorted(map(tuple, found.collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    hosts = ["a.example.net", "EXAMPLE.net", "net", "xnet", "example.com", "x.y.example.com", "é.org", "org.", "a.org:80"]
    paths = ["", "/", "/en/", "/en/x", "/de/7?q=/fr/", "/fr/#x", "/fr", "?a://b", "#/de/", "/EN/", "/en/\nx"]
    pages = [(i, f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(400)]
    pages += [(1, None), (2, ""), (3, "no scheme.net/"), (4, "http:/x.net/"), (None, "http://a.net/"), (5, "://net/"),
              (6, "http://" + "a." * 5000 + "net/" + "en/" * 20_000), pages[0], pages[0], (7, "x://?://net/")]
    rules = [*url_filter.RULES, ("example.net", "/en", "block"), ("org", "/fr/", "allow"), ("org", "", "block")]
    assert got(spark, pages, rules) == brute(pages, rules)


def test_conflicting_and_odd_rules(spark):
    rules = [("Net", "/", "allow"), ("net", "/", "block"), ("b", "/aa", "allow"), (None, "/", "block"), ("c", None, "block"),
             ("d", "/", "other")]
    pages = [(1, "s://x.net/"), (2, "s://b/aab"), (3, "s://c/"), (4, "s://d/")]
    assert got(spark, pages, rules) == [
        (1, "x.net", "/", "net/", "block"), (2, "b", "/aab", "b/aa", "allow"), (3, "c", "/", None, "allow"),
        (4, "d", "/", None, "allow"),
    ]


def test_no_rules_no_pages_and_the_shuffle_join(spark, monkeypatch):
    pages = [(1, "s://x.net/")]
    assert got(spark, pages, []) == [(1, "x.net", "/", None, "allow")]
    assert got(spark, [], url_filter.RULES) == []
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", 0)
    assert got(spark, pages, url_filter.RULES) == brute(pages, url_filter.RULES)


def test_equals_sql(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    rules = spark.createDataFrame(url_filter.RULES, RULES)
    with connect(folder) as con:
        assert differences(url_filter.judge(spark.read.parquet(f"{folder}/pages.parquet"), rules), con, sql.OP8) == []
