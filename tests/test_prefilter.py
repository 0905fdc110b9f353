"""Filters over key sets: none lost, few strangers, any number of keys, nothing read or moved that needn't be."""

import re

import pytest
from pyspark.sql import functions as F

from hemeroteca.operators import prefilter
from hemeroteca.plans import workflows


def urls(spark, host, n):
    return spark.range(n).select(F.concat(F.lit(f"https://{host}/"), F.col("id").cast("string")).alias("url"))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Pages in 40 files: 24,000 wanted ones and as many strangers."""
    path = str(tmp_path_factory.mktemp("pages") / "pages")
    both = urls(spark, "h", 24_000).union(urls(spark, "k", 24_000))
    both.withColumn("html", F.concat(F.lit("<article><p>"), F.repeat("url", F.lit(2)), F.lit("</p></article>"))).repartition(40, "url").write.parquet(path)
    return path


def pages(spark, path):
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))


def test_a_filter_loses_no_key(spark):
    keys = urls(spark, "h", 20_000)
    known = prefilter.KeyFilter(keys, "url")
    assert keys.where(~known.may_hold(F.col("url"))).isEmpty()
    assert urls(spark, "k", 20_000).where(known.may_hold(F.col("url"))).count() < 400
    nothing = prefilter.KeyFilter(keys.limit(0), "url")
    assert keys.where(nothing.may_hold(F.col("url"))).isEmpty()
    missing = spark.createDataFrame([(None,), ("https://h/1",)], "url string")
    assert [r.url for r in missing.where(known.may_hold(F.col("url"))).collect()] == ["https://h/1"]


def leaves(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("by", ["file", None])
def test_many_keys_are_met_in_groups(spark, stored, monkeypatch, by):
    monkeypatch.setattr(prefilter, "MOST_BITMAPS", 1)  # 2,730 keys a filter
    keys = urls(spark, "h", 24_000).union(urls(spark, "z", 10_000))
    kept = prefilter.kept_by_keys(pages(spark, stored), keys, "url", by)
    found = kept.select(F.contains("url", F.lit("//h/")).alias("wanted")).groupBy("wanted").count().collect()
    found = {r["wanted"]: r["count"] for r in found}
    assert found[True] == 24_000
    assert found.get(False, 0) < 0.05 * 24_000
    rows = kept.collect()
    assert len(rows) == sum(found.values()) and len({r.url for r in rows}) == len(rows)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    groups = len(re.findall("FileScan", text))
    assert groups > 10
    kept.write.format("noop").mode("overwrite").save()
    sizes = [len(lit) for lit in re.findall("0x([0-9A-F]+)", kept._jdf.queryExecution().optimizedPlan().toString())]
    assert all(size <= 2 * 4096 for size in sizes)


def test_groups_by_file_read_each_file_once(spark, stored, monkeypatch):
    monkeypatch.setattr(prefilter, "MOST_BITMAPS", 1)
    keys = urls(spark, "h", 24_000)
    kept = prefilter.kept_by_keys(pages(spark, stored), keys, "url", "file")
    files = [f.split("/")[-1] for part in leaves(kept) for f in selected(part)]
    assert len(files) == len(set(files)) == 40


def selected(scan):
    chosen = scan.relation().location().listFiles(scan.partitionFilters(), scan.dataFilters())
    out = []
    for i in range(chosen.size()):
        files = chosen.apply(i).files()
        out += [files.apply(k).getPath().toString() for k in range(files.size())]
    return out


def test_harvest_in_groups(spark, stored, monkeypatch):
    listed = urls(spark, "h", 24_000)
    want = workflows.harvest_articles(listed, pages(spark, stored)).drop("scraped_at")
    monkeypatch.setattr(prefilter, "MOST_BITMAPS", 1)
    got = workflows.harvest_articles(listed, pages(spark, stored)).drop("scraped_at")
    assert got.count() == want.count() == 24_000
    assert got.exceptAll(want).isEmpty()
    text = got._jdf.queryExecution().executedPlan().toString()
    below = [line for line in text.splitlines() if "Exchange" in line and "html" in line]
    assert not below


def test_no_keys(spark, stored):
    none = urls(spark, "h", 0)
    assert prefilter.kept_by_keys(pages(spark, stored), none, "url", "file").isEmpty()
