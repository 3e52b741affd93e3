import random
import re

from folkmoot.llm import registry, urls

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (host, path, best[3], best[4]) if best else (host, path, None, default)


def judged(spark, rows, rules, **more):
    frame = spark.createDataFrame(rows, "page_id long, url string, host int, rule int, n int, _u int, point int")
    return [(r.page_id, (r.host, r.path, r.rule, r.verdict)) for r in urls.judge(frame, spark.createDataFrame(rules, RULES), **more).collect()]


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(11)
    host = lambda: ".".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    path = lambda: "".join("/" + rng.choice(["", "x", "xy", "xyz", "é"]) for _ in range(rng.randint(0, 4)))
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(120)]
    given = [f"{rng.choice(['http', 'a:// b'])}://{host()}{path()}{rng.choice(['', '?q=/x', '#://x'])}" for _ in range(600)]
    given += ["HTTPS://A.b.C/X", "http://x.a./", "http://.a/", "http://", "a.b/x", "", None, "http://a?x://b", "http://c,b/x", "http://A\u00c9.a/"] * 2
    given += ["http://c.b.a/x/xy"] * 400  # a hot url
    rows = [(i % 1000, u, 0, 0, 0, 0, 0) for i, u in enumerate(given)]
    got = judged(spark, rows, rules)
    assert sorted(got, key=repr) == sorted(((i, brute(u, rules)) for i, u, *_ in rows), key=repr)


def test_rules_that_fit_nothing_or_disagree(spark):
    rules = [("a", "/", "allow"), ("a", "/", "block"), (None, "/", "block"), ("a", None, "block"), ("a.b", "", "block"), ("b", "/12", "allow"), ("b", "x", "block"), ("b/", "/", "block"), ("", "/e", "block")]
    rows = [(None, u, 0, 0, 0, 0, 0) for u in ("s://a/", "s://b/12", "s://a.b/12", "s://x.a.b", "s:///e", "s://b/x")]
    assert [v for _, v in sorted(judged(spark, rows, rules, default="block"), key=lambda x: x[1][:2])] == [
        ("", "/e", "/e", "block"), ("a", "/", "a/", "block"), ("a.b", "/12", "b/12", "allow"), ("b", "/12", "b/12", "allow"), ("b", "/x", None, "block"), ("x.a.b", "", "a.b", "block"),
    ]


def test_no_rules_no_rows(spark):
    assert judged(spark, [(1, "s://a/b", 0, 0, 0, 0, 0), (2, None, 0, 0, 0, 0, 0)], []) in ([(1, ("a", "/b", None, "allow")), (2, ("", "", None, "allow"))], [(2, ("", "", None, "allow")), (1, ("a", "/b", None, "allow"))])
    assert judged(spark, [], [("a", "/", "block")]) == []


def test_the_stack_is_carried_over_ranges(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")  # most ranges begin within open rules
    try:
        rules = [("com", "/", "allow"), ("b.com", "/", "block"), ("b.com", "/k/", "allow"), ("a.b.com", "/k/5", "block")]
        rows = [(i, f"http://{'a.' * (i % 3)}b.com/k/{i}", 0, 0, 0, 0, 0) for i in range(3000)]
        assert sorted(judged(spark, rows, rules)) == [(i, brute(u, rules)) for i, u, *_ in rows]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_no_python_on_the_executors(spark):
    plan = registry.op11_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
