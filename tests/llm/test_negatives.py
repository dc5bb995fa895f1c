"""Hard negatives against reading every row."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import negatives
from llm_fixtures import llm  # noqa: F401

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors, k=5):
    held = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows if None not in (i, v, lab) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, v in sorted(held):
        if not anchors(i):
            continue
        score = lambda w: sum(a * b for a, b in zip(v, w))
        near = sorted((-score(w), j) for j, other, w in held if other == lab and j != i)[:k]
        for s, p in near:
            window = sorted((-score(w), j) for j, other, w in held if other != lab and j != i and 80 * -s <= 100 * score(w) <= 100 * -s)[:k]
            out += [(i, p, n + 1, j, -s, -t) for n, (t, j) in enumerate(window)]
    return sorted(out)


def corpus(n=600, d=8, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=d)).tolist(), int(rng.integers(4))) for i in range(n)]
    common = rows[7][1]
    rows += [(1000 + i, common, i % 3) for i in range(200)]  # copies, ties
    return rows + [(2000, None, 1), (2010, [None] * d, 1), (2020, [float("nan")] * d, 1), (2030, [float("inf")] * d, 1), (2040, [0.0] * d, 1), (2050, [1.0] * d, None), (None, [1.0] * d, 1), (2060, [], 2), (2070, [1.0] * (d - 1), 2)]


@pytest.mark.parametrize("codes, probe", [(None, 4), (5, 1), (1, 1), (40, 2)])
def test_against_brute_force(llm, monkeypatch, codes, probe):
    monkeypatch.setattr(negatives, "CHUNK", 64)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rows = corpus()
    valid = negatives.valid(llm.createDataFrame(rows, SCHEMA))
    got = negatives.mine(valid, valid.where("vec_id % 10 = 0"), codes=codes, probe=probe)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    # a vector of another length than most takes no part
    assert sorted(tuple(r) for r in got.collect()) == brute([r for r in rows if r[0] != 2070], lambda i: i % 10 == 0)


def test_cells_come_in_order_and_bound_their_rows():
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, size=(500, 10))
    books = tuple(negatives.codebook(p.astype(float), 7) for p in (x[:, :5], x[:, 5:]))
    own = [negatives._nearest(p.astype(float), c) for p, c in zip((x[:, :5], x[:, 5:]), books)]
    radii = tuple(np.array([np.sqrt(((p[o == k] - c[k]) ** 2).sum(axis=1)).max(initial=0) for k in range(len(c))]) for p, c, o in zip((x[:, :5], x[:, 5:]), books, own))
    cells = set(zip(*(o.tolist() for o in own)))
    directory = negatives.Directory(books, radii, dict.fromkeys(cells, 1))
    for q in x[:20]:
        seen = list(directory.visit(q))
        assert {c for _, c in seen} == cells and len(seen) == len(cells)
        assert all(a[0] >= b[0] for a, b in zip(seen, seen[1:]))
        for bound, (i, j) in seen:
            assert (x[(own[0] == i) & (own[1] == j)] @ q).max() <= bound


def test_cells_are_pruned(llm):
    """Of well-parted vectors, most cells are never read, and nothing is lost."""
    rng = np.random.default_rng(2)
    rows = [(i, (np.eye(8)[i % 8] * 4 + 0.05 * rng.normal(size=8)).tolist(), i % 5) for i in range(800)]
    valid = negatives.valid(llm.createDataFrame(rows, SCHEMA))
    chunks, directory = negatives.build(valid, 8)
    q = [math.floor(256 * x) for x in rows[0][1]]
    near = sorted((sum(a * math.floor(256 * float(np.float32(b))) for a, b in zip(q, v)) for _, v, lab in rows if lab == 0), reverse=True)[5]
    read = [c for bound, c in directory.visit(np.array(q)) if bound >= 0.8 * near]
    assert len(read) < len(directory.chunks) / 2
    got = negatives.mine(valid, valid.where("vec_id % 100 = 0"), codes=8, probe=1)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 100 == 0)


def test_visits_are_not_broadcast(llm, monkeypatch):
    """Visits repeat an anchor for each chunk it reads, which their size in files hardly shows."""
    written = {}
    kept = negatives.materialize

    def materialize(df, label):
        written.setdefault(label, []).append(df)
        return kept(df, label)

    monkeypatch.setattr(negatives, "materialize", materialize)
    valid = negatives.valid(llm.createDataFrame(corpus(), SCHEMA))
    got = negatives.mine(valid, valid.where("vec_id % 10 = 0"), codes=5)
    for df in (*written["negatives-near"], *written["negatives-hard"], got):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [i#" in plan and "SortMergeJoin [anchor_id#" in plan
        assert "BroadcastHashJoin [i#" not in plan
    # a visit holds no vector
    assert all("v" not in df.columns for df in written["negatives-visits"])


def test_edges(llm):
    empty = negatives.valid(llm.createDataFrame([], SCHEMA))
    assert negatives.mine(empty, empty).count() == 0
    one = negatives.valid(llm.createDataFrame([(100, [1.0, 2.0], 3)], SCHEMA).selectExpr("*", "'q' as anchor_id", "1 as i"))
    assert negatives.mine(one, one).count() == 0
    # repeated ids: the row of another label and the same id is no negative
    twice = negatives.valid(llm.createDataFrame([(100, [1.0], 0), (100, [1.0], 1), (1, [1.0], 0), (1, [1.0], 0), (2, [0.9], 1)], SCHEMA))
    got = negatives.mine(twice, twice.where("vec_id = 100"))
    assert {(r.positive_id, r.negative_id) for r in got.collect()} == {(1, 2)}
    big = negatives.valid(llm.createDataFrame([(100, [1e30], 0)], SCHEMA))
    with pytest.raises(Exception, match="too large"):
        big.collect()
    exact = negatives.scores(np.array([[1 << 30, 3]]), np.array([[(1 << 30) + 1, 5]]))
    assert exact.tolist() == [[(1 << 30) * ((1 << 30) + 1) + 15]]
    assert llm.createDataFrame([([-0.001, 0.5],)], "e array<float>").select(negatives.quantised(F.col("e"))).first()[0] == [-1, 128]
