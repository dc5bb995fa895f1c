from __future__ import annotations

import numpy as np

from tillroll.llm import permutation
from llm_fixtures import docs, edge, empty, llm  # noqa: F401

SCHEMA = "vec_id long, embedding array<float>"


def nearest(ids, x, q, k):
    d = np.sqrt(((x.astype(float) - x[ids == q][0].astype(float)) ** 2).sum(axis=1))
    d[ids == q] = np.inf
    at = np.lexsort((ids, d))[:k]
    return ids[at], d[at]


def test_recall_and_scores(docs, monkeypatch):
    monkeypatch.setattr(permutation, "SHARD", 700)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    ids = np.arange(3000)
    df = docs([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    got = permutation.search(df, df.where("vec_id % 100 = 0")).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert g["rank"].tolist() == list(range(1, 11))
        want, _ = nearest(ids, x, q, 10)
        exact = np.sqrt(((x[g["vec_id"]].astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        assert (g["score"].to_numpy() == exact).all() and (np.diff(exact) >= 0).all()
        hit += len(set(want) & set(g["vec_id"]))
    assert got["query_id"].nunique() == 30 and hit / 300 >= 0.9


def test_copies_give_their_smallest_ids(docs):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2400, 8)).astype(np.float32)
    x[rng.permutation(2400)[:1100]] = x[0]  # more than the part of a shard that is ranked again
    ids = rng.permutation(2400)
    df = docs([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    same = np.sort(ids[(x == x[0]).all(axis=1)])
    asked = [int(same[0]), int(same[7]), int(same[-1])]
    got = permutation.search(df, df.where(f"vec_id in ({asked[0]}, {asked[1]}, {asked[2]})")).toPandas()
    for q, g in got.groupby("query_id"):
        assert g.sort_values("rank")["vec_id"].tolist() == same[same != q][:10].tolist() and (g["score"] == 0).all()
    assert got["query_id"].nunique() == 3


def test_blocks_of_queries_are_not_broadcast(docs, monkeypatch):
    """A block stands once for each shard, so no estimate of the query set bounds them all."""
    monkeypatch.setattr(permutation, "SHARD", 40)
    monkeypatch.setattr(permutation, "BLOCK", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)).astype(np.float32)
    df = docs([(int(i), v.tolist()) for i, v in enumerate(x)], SCHEMA)
    found = permutation.search(df, df.where("vec_id % 10 = 0"), k=3)
    assert found.count() == 40 * 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [part" in plan and "Broadcast" not in plan


def test_edges(docs):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, []), (100, [1.0, 2.0, 3.0])]
    df = docs(rows, SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in permutation.search(df, df.where("vec_id in (0, 4, 100)")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 2, 2.0)]
    assert permutation.search(docs([], SCHEMA), docs([], SCHEMA)).count() == 0
