"""The stateful stream against the batch operators, over batches in any order, failures and restarts."""

import random

import pytest

from docgraph.streaming import crawl, frontier

R = random.Random(21)


def folders(tmp_path):
    return f"{tmp_path}/inbox", f"{tmp_path}/checkpoint", f"{tmp_path}/events"


def test_three_batches_equal_the_batch_operators(spark, tmp_path):
    inbox, checkpoint, events = folders(tmp_path)
    links = [(f"p{R.randint(0, 30)}", f"p{R.randint(0, 30)}") for _ in range(45)]
    seeds = ["p0", "p1"]
    hints = [(f"p{R.randint(0, 12)}", R.choice("abc"), k) for k in range(60)]
    visits = [(f"p{R.randint(0, 12)}", R.randint(0, 60)) for _ in range(8)]
    rows = [(u, "link", v, None, None) for u, v in links] + [(u, "reach", None, None, None) for u in seeds] + [(u, "hint", None, h, k) for u, h, k in hints] + [(u, "reach", None, None, k) for u, k in visits]
    R.shuffle(rows)
    for k in range(3):  # messages come again, too
        frontier.put(spark.createDataFrame(rows[k::3] + rows[:5], frontier.MESSAGE), inbox)
        frontier.run(spark, inbox, checkpoint, events)
    graph = spark.createDataFrame(links, "url string, to string")
    start = spark.createDataFrame([(u,) for u in seeds + [u for u, _ in visits]], "url string")
    assert sorted(r.url for r in frontier.reached(spark, events).collect()) == sorted(r.url for r in crawl.frontier(start, graph).collect())
    first = {}
    for u, k in visits:
        first[u] = min(k, first.get(u, k))
    want = crawl.corrected_hints(spark.createDataFrame(hints, "url string, hint string, seq long"), spark.createDataFrame(list(first.items()), "url string, seq long"))
    assert sorted(map(tuple, frontier.hints(spark, events).collect())) == sorted(map(tuple, want.collect()))


def test_restart_after_a_failed_batch(spark, tmp_path, monkeypatch):
    inbox, checkpoint, events = folders(tmp_path)
    frontier.put(spark.createDataFrame([("a", "link", "b", None, None), ("b", "link", "c", None, None), ("a", "reach", None, None, None)], frontier.MESSAGE), inbox)
    parquet = type(spark.range(1).write).parquet
    calls = []

    def failing(self, path, *args, **kwargs):
        calls.append(path)
        if "sent-" in path and len([c for c in calls if "sent-" in c]) == 1:
            raise OSError("lost")
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1).write), "parquet", failing)
    with pytest.raises(Exception, match="lost"):
        frontier.run(spark, inbox, checkpoint, events)
    frontier.run(spark, inbox, checkpoint, events)
    assert sorted(r.url for r in frontier.reached(spark, events).collect()) == ["a", "b", "c"]


def test_hints_of_urls_that_are_never_reached_are_given_up(spark, tmp_path):
    inbox, checkpoint, events = folders(tmp_path)
    frontier.put(spark.createDataFrame([("x", "hint", None, "h", 1), ("y", "hint", None, "h", 1), ("y", "reach", None, None, 5)], frontier.MESSAGE), inbox)
    frontier.run(spark, inbox, checkpoint, events, patience=1)
    frontier.put(spark.createDataFrame([("z", "hint", None, "h", 1)], frontier.MESSAGE), inbox)  # a later batch, in which timers are due
    frontier.run(spark, inbox, checkpoint, events, patience=1)
    got = {(r.url, r.event) for r in spark.read.schema(frontier.EVENT).parquet(events).collect()}
    assert ("x", "given_up") in got and ("y", "given_up") not in got
