import pytest
from pyspark.sql import functions as F

from shelfmark.llm import hosts


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string")


URLS = [
    ("https://A.Example.ORG/en/12?x=1", "a.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://example.org/es/1#y", "example.org", "/es/1", "example.org/es/", "block"),
    ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/fr/1/a://b", "x.com", "/fr/1/a://b", "com/fr/", "allow"),
    ("http://x.com?q=/de/", "x.com", "", None, "allow"),
    ("http://y.org", "y.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("://Ärger.COM/", "Ärger.com", "/", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_hosts_paths_and_rules(spark):
    none = spark.createDataFrame([], "page_id long, bad int")
    found = {r["page_id"]: r for r in hosts.judge_urls(pages(spark, [(i, u[0]) for i, u in enumerate(URLS)]), none).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (found[i]["host"], found[i]["path"], found[i]["rule"], found[i]["verdict"]) == (host, path, rule, verdict)


def test_shrinkage(spark):
    """A bad host with much evidence is blocked, and so its domain; one bad page of a good domain is not."""
    rows, bad = [], []
    for host, n, k in (("bad.net", 60, 58), ("a.good.net", 1, 1), ("b.good.net", 200, 2), ("c.fine.com", 100, 1), ("new.bad.net", 0, 0)):
        for i in range(max(n, 1)):
            rows.append((len(rows), f"http://{host}/{i}"))
            if n:
                bad.append((len(rows) - 1, int(i < k)))
    split = pages(spark, rows).select("page_id", hosts.url_host(F.col("url")).alias("host"))
    outcomes = spark.createDataFrame([*bad, (None, 1), (0, None), (10**9, 1)], "page_id long, bad int")
    found = {r["host"]: r for r in hosts.host_reputation(split, outcomes).collect()}
    assert {h for h, r in found.items() if r["blocked"]} == {"bad.net", "new.bad.net"}
    assert found["b.good.net"]["bad_rate"] < found["a.good.net"]["bad_rate"] < 1
    assert found["new.bad.net"]["bad_rate"] > found["c.fine.com"]["bad_rate"]
    assert (found["new.bad.net"]["n"], found["bad.net"]["k"]) == (0, 58)
    p, m = hosts.prior_of(spark.createDataFrame([(60, 58), (1, 1), (200, 2), (100, 1)], "n long, k long"))
    alike = ((58 * 57 + 2) / (60 * 59 + 200 * 199 + 100 * 99) - p * p) / (p * (1 - p))
    assert p == 62 / 361 and m == pytest.approx(max(1.0, 1 / alike - 1))


def test_registered_domains(spark):
    names = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.y.com",), ("com",), ("",)], "host string")
    found = names.select(hosts.registered_domain(F.col("host")).alias("domain"), "host").select("domain", hosts.suffix(F.col("domain")).alias("s"))
    assert [tuple(r) for r in found.collect()] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("y.com", "com"), ("com", "com"), ("", "")]


def test_edges(spark):
    outcomes = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "page_id long, bad int")
    repeated = spark.createDataFrame([(1, "http://a.b/", "h"), (1, "http://a.b/", "h"), (None, None, None)], "page_id long, url string, host string")
    assert hosts.judge_urls(repeated, outcomes).count() == 3
    assert hosts.judge_urls(repeated.limit(0), outcomes).count() == 0
