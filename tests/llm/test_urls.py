import re

from gleanery.llm import common as C
from gleanery.llm import urls as U

SF = "/root/testdata/sf0.01"
URLS = [
    "http://a.b.example.org/es/1", "https://EXAMPLE.org/en/12?x=/en/1", "http://x.org", "http://x.org/", "http://xorg/", "HTTP://Sub.X.COM/fr/9#f", "http://x.com/de/", "http://x.com/d",
    "x.com/de/1", "", None, "http://", "ftp://notexample.org/es/", "http://example.org?q/es/", "http://ÄB.com/FR/", "http://a.org:80/es/", "://y.net/de/", "http://free-bets.net/a.html?page=2&ref=x",
]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, *best


def test_stated_rules_by_brute_force(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, rule int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for r in U.judge(pages, none).collect():
        host, path, rule, verdict = plain(URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_query(spark):
    urls = {r.page_id: r.url for r in C.table(spark, SF, "pages").collect()}
    rows = U.op10_url_filters(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        host, path, rule, verdict = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert verdict is None or r.verdict == verdict
        assert verdict is not None or r.verdict == ("allow" if r.confidence is None else "block")


def test_combinations_are_mined_and_matched(spark):
    """Neither the host nor the section is bad; both together are."""
    rows, labels = [], []
    for i in range(600):
        host, part = ("a.net", "b.net", "c.net")[i % 3], ("news", "ads")[i // 3 % 2]
        rows.append((i, f"http://{host}/{part}/{i}"))
        labels.append((i, 0 if (host, part) == ("b.net", "ads") and i % 30 else 1, 0))
    rows += [(1000, "http://b.net/ads/none"), (1001, "http://b.net/news/none"), (1002, None), (1003, "http://c.net/ads/x"), (1000, "http://b.net/ads/none")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = U.judge(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    verdict = {r.page_id: r.verdict for r in got}
    assert [verdict[i] for i in (1000, 1001, 1002, 1003)] == ["block", "allow", "allow", "allow"]
    for i, u in rows[:600]:
        assert (verdict[i] == "block") == ("b.net/ads" in u)
    assert U.judge(pages.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_rare_hosts_get_the_same_verdict_in_a_table_of_any_size(spark):
    """A host with six bad URLs is blocked among two hundred labelled URLs and among eight thousand."""
    for n in (200, 8000):
        rows = [(i, f"http://good{i % 7}.net/a/{i}") for i in range(n)] + [(n + i, f"http://seldom.net/a/{n + i}") for i in range(6)]
        labels = spark.createDataFrame([(i, int(i < n), 0) for i in range(n + 6)], "doc_id long, quality int, toxic int")
        got = U.judge(spark.createDataFrame(rows, "page_id long, url string"), labels)
        assert {r.page_id for r in got.filter("verdict = 'block'").collect()} == set(range(n, n + 6))


def test_mined_rules_by_brute_force(spark):
    """Every set of tokens that is frequent and confident enough, found by going through all subsets."""
    import itertools
    import random

    rng = random.Random(4)
    rows = [([f"h:{rng.choice('abc')}", f"p:{rng.choice('xyz')}", f"x:{rng.choice('uv')}", f"q:{rng.choice('mn')}"], 0) for _ in range(400)]
    rows = [(t, int(("h:a" in t and "p:x" in t) or (rng.random() < 0.1))) for t, _ in rows]
    sets = [(frozenset(t), b) for t, b in rows]
    want = {}
    for size in range(1, 5):
        for combo in {frozenset(c) for t, _ in rows for c in itertools.combinations(t, size)}:
            n, bad = sum(combo <= t for t, _ in sets), sum(b for t, b in sets if combo <= t)
            if bad / n >= 0.6 and bad >= 5 and (size < 3 or bad >= 0.02 * 400):
                want[tuple(sorted(combo))] = (bad, round(bad / n, 9))
    got = U.mine(spark.createDataFrame(rows, "tokens array<string>, block int"), support=0.02).collect()
    assert {tuple(r.antecedent): (r.support, round(r.confidence, 9)) for r in got} == want and len(got) == len(want)
    assert all(r.key in r.antecedent for r in got)
