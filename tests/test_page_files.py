"""The data source: what is pushed, which files are opened, odd lines."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, StringStartsWith

from docgraph.sources import page_files

PAGES = [("http://a.org/x", "one"), ("http://a.org/y/z", "two\nlines"), ("https://b.org:80/x", "three"), ("http://ab.org/", None), ("no address", "four"), ("http://é.org/ü", "five")]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pages") / "by host")
    page_files.write_pages(spark.createDataFrame(PAGES, "url string, html string"), at)
    return at


def test_all_rows(spark, root):
    assert sorted((r.url, r.html) for r in page_files.load(spark, root).collect()) == sorted(PAGES, key=str) or {(r.url, r.html) for r in page_files.load(spark, root).collect()} == set(PAGES)


@pytest.mark.parametrize("where, count", [("host = 'a.org'", 2), ("host in ('b.org', 'ab.org')", 2), ("host like 'a%'", 3), ("url like 'http://a%'", 3), ("url like 'http://a.org/y%'", 1), ("url = 'https://b.org:80/x'", 1), ("url = 'none'", 0), ("html = 'one' and host = 'a.org'", 1), ("url like 'http%' and url like '%x'", 2)])
def test_filters_are_pushed_and_exact(spark, root, where, count):
    df = page_files.load(spark, root).where(where)
    assert df.count() == count
    assert {r.url for r in df.collect()} == {r.url for r in spark.createDataFrame([(*p, h) for p, h in zip(PAGES, ("a.org", "a.org", "b.org", "ab.org", "", "é.org"), strict=True)], "url string, html string, host string").where(where).collect()}


def test_the_plan_shows_the_filter_and_pruned_files_are_not_opened(spark, root, tmp_path):
    import shutil

    at = f"{tmp_path}/copy"
    shutil.copytree(root, at)
    for folder in os.listdir(at):
        if folder.startswith("host=") and folder != "host=a.org":
            for name in os.listdir(f"{at}/{folder}"):
                os.remove(f"{at}/{folder}/{name}")
                os.mkdir(f"{at}/{folder}/{name}")  # whoever opens it fails
    df = page_files.load(spark, at).where(F.col("host") == "a.org")
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "a.org" in plan.split("BatchScan")[-1] and "Filter" not in plan.split("== Physical Plan ==")[1].split("(1)")[0]
    assert df.count() == 2
    with pytest.raises(Exception, match="directory"):
        page_files.load(spark, at).count()


def test_reader_alone(root, tmp_path):
    os.makedirs(f"{tmp_path}/odd/host=h")
    with open(f"{tmp_path}/odd/host=h/part-0.json", "w") as f:
        f.write('{"url":"http://h/1","html":"x"}\nnot json\n[1]\n{"html":"only"}\n')
    r = page_files.Reader(f"{tmp_path}/odd")
    assert list(r.pushFilters([])) == [] and [x for p in r.partitions() for x in r.read(p)] == [("h", "http://h/1", "x"), ("h", None, "not json"), ("h", None, "[1]"), ("h", None, "only")]
    r = page_files.Reader(f"{tmp_path}/odd")
    kept = EqualTo(("html",), "x")
    assert list(r.pushFilters([StringStartsWith(("url",), "http://h/"), In(("host",), ("h", "g")), kept])) == [kept]
    assert [x for p in r.partitions() for x in r.read(p)] == [("h", "http://h/1", "x")]
    r = page_files.Reader(f"{tmp_path}/odd")
    list(r.pushFilters([EqualTo(("host",), "other")]))
    assert [x for p in r.partitions() for x in r.read(p)] == []
