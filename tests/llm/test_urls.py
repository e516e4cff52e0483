import random
import re

from pyspark.sql import Row
from screenmeld.llm import urls as U
from screenmeld.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
    best = None
    for verdict, rule in U.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def check(rows, urls):
    assert len(rows) == len(urls)
    for r in rows:
        host, path, best = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, best[1] if best else None)
        assert r.verdict in ("allow", "block") and (not best or r.verdict == best[0])


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    rows = QUERIES["op8_url_filter"](spark, sf).collect()
    check(rows, urls)
    free = [r for r in rows if r.rule is None]
    spam = [r for r in free if re.search("spam|pills|casino", r.host)]
    assert spam and all(r.verdict == "block" for r in spam)
    assert sum(r.verdict == "block" for r in free if r not in spam) <= 0.02 * len(free)


def test_odd_urls(spark):
    rng = random.Random(1)
    hosts = ["net", "a.net", "xnet", "example.net", "EXAMPLE.com", "b.example.com", "org", "w.org", "é.org", "net.com", "user:p@a.net", ""]
    paths = ["", "/", "/en/x", "/de/", "/de", "/fr/1?x=1&y=2", "?q=/en/", "#/fr/", "/en/a b\nc", "/FR/"]
    urls = dict(enumerate([None, "", "no scheme", "://", "http://", "a://b://net/", "x" * 50_000]
                          + [f"{s}://{rng.choice(hosts)}{rng.choice(paths)}" for s in ("http", "HTTPS", "") for _ in range(60)]))
    df = spark.createDataFrame([Row(page_id=k, url=u, host="h", rule="r", label=1.0) for k, u in urls.items()],
                               "page_id long, url string, host string, rule string, label double")
    check(U.filter_urls(df).collect(), urls)
    assert U.filter_urls(df.limit(0)).count() == 0
    one = U.filter_urls(df.filter("page_id = 0")).collect()
    assert one[0].verdict == "allow"
