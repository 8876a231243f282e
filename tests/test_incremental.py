"""Signed deltas against a full run, batch by batch, with names that become known, ambiguous and unknown again."""

import random
from collections import Counter

from docgraph.operators import incremental

R = random.Random(17)


def whole(nodes, edges):
    """The result of all nodes and edges (with counts) so far, by definition."""
    known = Counter()
    for f, s, n in nodes:
        known[f, s] += n
    known = {k: n for k, n in known.items() if n > 0}
    full, short = {f for f, _ in known}, Counter()
    for (_, s), n in known.items():
        short[s] += n
    out = Counter()
    for source, q, tier, n in edges:
        s = (q or "").rsplit(".", 1)[-1]
        if not q:
            end = None, "none"
        elif q in full:
            end = q, "exact"
        elif short[s] == 1:
            end = next(f for f, x in known if x == s), "short_name_fallback"
        else:
            end = q, "external"
        out[source, end[0], tier, end[1]] += n
    return {k: n for k, n in out.items() if n}


def frames(spark, nodes, edges):
    return spark.createDataFrame(nodes, "full string, short string, n long"), spark.createDataFrame(edges, "source string, target string, tier string, n long")


def state(kept):
    return {(r.source, r.target, r.tier, r.how): r.n for r in kept.result().collect()}


def test_batches_equal_a_full_run(spark, tmp_path):
    kept = incremental.Maintained(spark, f"{tmp_path}/a", 8)
    nodes, edges = [], []
    for epoch in range(4):
        n = [(f"M{R.randint(0, 2)}.T{k}", f"T{k}", 1) for k in (R.randint(0, 14) for _ in range(5))]
        e = [(f"M0.T{R.randint(0, 14)}", R.choice([f"M{R.randint(0, 3)}.T{R.randint(0, 14)}", f"T{R.randint(0, 14)}", "", None]), R.choice(["core", "likely"]), 1) for _ in range(25)]
        if epoch == 3:  # something goes
            n += [(*nodes[0][:2], -1)]
            e += [(*edges[0][:3], -1), (*edges[1][:3], -1)]
        kept.apply(*frames(spark, n, e), epoch)
        if epoch == 2:  # a batch that is repeated replaces itself
            kept.apply(*frames(spark, n, e), epoch)
        nodes, edges = nodes + n, edges + e
        assert state(kept) == whole(nodes, edges)
    pairs = Counter()
    for (s, t, _, _), n in whole(nodes, edges).items():
        if t and s != t:
            pairs[min(s, t), max(s, t)] += n
    assert {(r.a, r.b): r.weight for r in kept.projection().collect()} == dict(pairs)
    known = {f for f in {x[0] for x in nodes} if sum(n for g, _, n in nodes if g == f) > 0}
    assert {r.id for r in kept.stubs().collect()} == {x for s, t, *_ in whole(nodes, edges) for x in (s, t) if x} - known


def test_a_small_batch_reads_little_and_changes_what_it_must(spark, tmp_path, monkeypatch):
    kept = incremental.Maintained(spark, f"{tmp_path}/b", 64)
    nodes = [(f"M.T{k}", f"T{k}", 1) for k in range(600)]
    edges = [(f"M.T{k}", f"Q.T{k}", "core", 1) for k in range(600)]
    kept.apply(*frames(spark, nodes, edges), 0)
    seen, read = [], kept.read

    def counting(*args):
        df = read(*args)
        seen.append(df.count())
        return df

    monkeypatch.setattr(kept, "read", counting)
    changes = kept.apply(*frames(spark, [("N.T7", "T7", 1)], [("x", "T9", "core", 1)]), 1)
    assert {(r.source, r.target, r.how, r.n) for r in changes.collect()} == {("M.T7", "M.T7", "short_name_fallback", -1), ("M.T7", "Q.T7", "external", 1), ("x", "M.T9", "short_name_fallback", 1)}
    assert sum(seen) < 100
