"""Rules, and the filter cascade against plain sets."""

import pytest

from hemeroteca.llm import queries, urls

CASES = [
    ("http://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x"),
    ("no scheme", "", ""),
    (None, "", ""),
    ("", "", ""),
    ("http://x.com", "x.com", ""),
    ("http://x.com?q=/a", "x.com", ""),
    ("://h#f", "h", ""),
    ("a://b://c/d", "b:", "//c/d"),
    ("http://É.com/É?", "É.com", "/É"),
]


def test_parts(spark):
    rows = spark.createDataFrame([(u,) for u, _, _ in CASES], "url string")
    got = rows.select(urls.host(rows.url), urls.path(rows.url)).collect()
    assert [tuple(r) for r in got] == [(h, p) for _, h, p in CASES]


def plain_rule(rules, host, path):
    fits = [
        (len(rule), rule, verdict)
        for verdict, rule in rules
        if (host == rule.partition("/")[0] or host.endswith("." + rule.partition("/")[0])) and path.startswith("/" + rule.partition("/")[2])
    ]
    return max(fits)[1:] if fits else (None, None)


def test_judge(spark):
    hosts = ["example.org", "a.example.org", "badexample.org", "org", "x.com", "com", "listed.net", "free.net"]
    paths = ["", "/", "/es", "/es/", "/en/1", "/en/12", "/en/2", "/fr/", "/de/x"]
    rows = [(i, f"http://{h}{p}", 1, "r") for i, (h, p) in enumerate((h, p) for h in hosts for p in paths)]
    rows += [(900, None, 1, "r"), (901, "odd", 1, "r"), (901, "odd", 1, "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, fit int, rule string")
    listed = spark.createDataFrame([("listed.net",), (None,), ("listed.net",), ("elsewhere.net",)], "key string")
    got = urls.judge(pages, queries.RULES, listed).collect()
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in rows) and "fit" in got[0]
    for r in got:
        rule, verdict = plain_rule(queries.RULES, r.host, r.path)
        assert r.rule == rule
        assert r.verdict == (verdict or ("block" if r.host == "listed.net" else "allow"))
    assert urls.judge(pages.limit(0), queries.RULES, listed).collect() == []
    assert {r.verdict for r in urls.judge(pages, [], listed.limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize("most", [urls.MOST_FILTER_BYTES, 2_000])
def test_cascade_is_exact(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_FILTER_BYTES", most)
    universe = spark.range(60_000).selectExpr("concat('k', id) key")
    listed = universe.where("crc32(key) % 7 < 2").union(spark.range(500).selectExpr("concat('elsewhere', id) key"))
    cascade = urls.Cascade(listed, universe, bits_per_key=2, hashes=2)
    assert all(len(levels) > 2 for levels in cascade.levels)
    assert (cascade.groups > 1) == (most == 2_000)
    # A level's share of passing keys is planned for 12 bits a key; with 2 bits, more pass.
    assert all(sum(len(level.bytes) for level in levels) < 12 * max(most, 4096) for levels in cascade.levels)
    marked = cascade.mark(universe, universe.key, "in_list")
    assert marked.where("in_list != (crc32(key) % 7 < 2)").isEmpty()
    assert marked.count() == 60_000
    nothing = universe.limit(3).selectExpr("cast(null as string) key")
    assert [r.in_list for r in cascade.mark(nothing, nothing.key, "in_list").collect()] == [False] * 3
    plan = marked._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in marked._jdf.queryExecution().executedPlan().toString().replace("RoundRobin", "")


def test_levels_and_verdicts_of_the_method(spark, monkeypatch):
    """The list isn't empty at any scale: a level or more, and both verdicts where no rule fits."""
    made = []
    whole = urls.Cascade.__init__

    def noted(self, *args, **options):
        whole(self, *args, **options)
        made.append(self)

    monkeypatch.setattr(urls.Cascade, "__init__", noted)
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        found = queries.op9_urls(spark, f"/root/testdata/{sf}").where("rule is null")
        assert {r.verdict for r in found.select("verdict").distinct().collect()} == {"allow", "block"}
        assert made[-1].levels[0]


def test_main_path_is_native(spark, sf):
    plan = queries.op9_urls(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
