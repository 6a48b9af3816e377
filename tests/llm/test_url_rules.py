import random

from gapledger.llm import url_rules

PAGES = "page_id bigint, url string, verdict string"
RULES = "action string, host string, path string"


def brute(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else default


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "net", "x.net", "acom", "Ünder.com", "a..com"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/a", "/en/a/b", "/es/", "/e~"]
    rules = sorted({(h, p): (rng.choice(["allow", "block"]), h, p) for h in hosts[:6] for p in paths if rng.random() < 0.5}.values())
    urls = [None, "", "no scheme", "http://", "://", "http://A.COM", "ftp://a.com?x=/en/", "http://a.com#/en/", "http://com/en/"]
    urls += [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'x', '/q', '?a=1', '#f'])}" for _ in range(800)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(1, "http://a.com/en/", "again")] * 2, PAGES)
    got = url_rules.judge(pages, spark.createDataFrame(rules, RULES), rows_per_group=16).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url, rules, "allow"), r


def test_empty_tables_and_null_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", None), (None, None, None)], PAGES)
    none = spark.createDataFrame([], RULES)
    assert {(r.rule, r.verdict) for r in url_rules.judge(pages, none, default="block").collect()} == {(None, "block")}
    odd = spark.createDataFrame([(None, "a.com", "/"), ("block", None, "/"), ("block", "A.com", None), ("allow", "a.com", "")], RULES)
    assert [(r.rule, r.verdict) for r in url_rules.judge(pages.limit(1), odd).collect()] == [("a.com", "allow")]
    assert url_rules.judge(spark.createDataFrame([], PAGES), odd).collect() == []


def test_very_long_hosts(spark):
    pages = spark.createDataFrame([(1, "http://" + "a." * 5000 + "com/en", None), (2, "http://x.com/" + "y" * 100_000, None)], PAGES)
    got = url_rules.judge(pages, spark.createDataFrame([("block", "com", "/")], RULES)).collect()
    assert {r.verdict for r in got} == {"block"}
    rules = [("block", "com", "/"), ("allow", "a." * 300 + "com", "/en")]
    got = url_rules.judge(pages, spark.createDataFrame(rules, RULES)).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "allow", 2: "block"}


def test_urls_of_one_suffix_are_dealt_to_many_tasks(spark):
    pages = spark.range(20_000).selectExpr("id AS page_id", "concat('http://h', id % 7, '.com/', id) AS url", "'' AS verdict")
    judged = url_rules.judge(pages, spark.createDataFrame([("block", "com", "/1"), ("block", "h3.com", "/")], RULES))
    assert judged.where("verdict = 'block'").count() == sum(str(i)[0] == "1" or i % 7 == 3 for i in range(20_000))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" not in plan and "hashpartitioning(key#" in plan and ", share#" in plan
