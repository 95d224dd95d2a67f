import datetime as dt

from pyspark.sql import functions as F

from tidepool.llm import url_filter as U
from tests.llm.harness import matches

D = lambda n: dt.date(2024, 1, n)


def test_host(spark):
    urls = {"http://A.b.Com:80/x": "a.b.com", "https://u:p@h.org?q": "h.org", "ftp://x.y./": "x.y", "nothing": None, "": None, None: None, "http:///p": None, "HTTP://É.de#f": "é.de"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.h for r in df.select("u", U.host_of(F.col("u")).alias("h")).collect()} == urls
    assert spark.range(1).select(U.parents(F.lit("a.b.c.d"))).first()[0] == ["a.b.c.d", "b.c.d", "c.d"]
    assert spark.range(1).select(U.parents(F.lit("localhost"))).first()[0] == ["localhost"]


def test_as_of(spark):
    events = spark.createDataFrame([
        ("l", "Bad.com", D(5), "add"), ("l", "bad.com", D(10), "remove"), ("l", "bad.com", D(20), "add"), ("l", "bad.com", D(22), "add"),
        ("m", "x.bad.com", D(8), "add"), ("l", "tie.com", D(5), "add"), ("l", "tie.com", D(5), "remove"), (None, "ok.com", D(1), "add"),
        ("l", None, D(1), "add"), ("l", "ok.com", None, "add"), ("l", "bad.com", D(5), "add")], "list string, host string, day date, action string")
    cases = [("http://bad.com/", 4, []), ("http://bad.com/", 5, ["l"]), ("http://bad.com/", 9, ["l"]), ("http://bad.com/", 10, []), ("http://bad.com/", 25, ["l"]),
             ("http://x.bad.com/", 9, ["l", "m"]), ("http://x.bad.com/", 12, ["m"]), ("http://notbad.com/", 9, []), ("http://tie.com", 6, []), ("http://ok.com", 6, []),
             (None, 6, []), ("http://bad.com/", None, []), ("http://bad.com/", 9, ["l"])]
    df = spark.createDataFrame([(u, n and D(n), ",".join(w)) for u, n, w in cases], "url string, fetched date, host string")
    got = U.filter_urls(df, events).collect()
    assert len(got) == len(cases)
    for r in got:
        assert ",".join(r.lists) == r.row.host and r.blocked == bool(r.lists)
    assert U.filter_urls(df.limit(0), events).collect() == []
    assert not any(r.blocked for r in U.filter_urls(df, events.limit(0)).collect())


def test_query(spark):
    assert matches(spark, "op8_url_filter", "/root/testdata/sf0.001")
