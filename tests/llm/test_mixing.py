from __future__ import annotations

import re
from collections import defaultdict

import duckdb
import pytest

from tillroll.llm import mixing
from tillroll.llm.queries import QUERIES
from llm_fixtures import docs, edge, empty, llm  # noqa: F401


def fill(sizes, weights, share=1.5, most=2.0):
    """Reshare the excess by weight until none is above."""
    left, free, target = share * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] >= most * sizes[s]}
        if not over:
            target.update({s: level * weights[s] for s in free})
            break
        target.update({s: most * sizes[s] for s in over})
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target


def test_targets_and_copies(docs):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(4000)] + [(9000 + i, "z " * 3, None) for i in range(30)] + [(9100, None, "s1"), (9101, "", "hollow"), (None, "a b", "s2")]
    df = docs(rows, "doc_id long, text string, source string").withColumn("size", mixing.words())
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s))
    target = fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)})
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(14, 0.02 * target[s])
    again = {(r.doc_id, r.copies) for r in mixing.mix(df).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}


def test_against_sql(llm):
    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    want = sorted(c.execute(mixing.ORACLE_SQL).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op2_systematic_mixing"](llm, d).select(names).collect()) == want


def test_edges(docs, empty):
    assert mixing.mix(docs([], "doc_id long, source string, size long")).count() == 0
    rows = mixing.mix(docs([(1, "a", 0, "x"), (1, "a", 0, "x"), (2, None, 5, "y")], "doc_id long, source string, size long, copies string")).collect()
    assert sorted((r.doc_id, r.copies * r.size) for r in rows) == [(1, 0), (1, 0), (2, 5)] or sum(r.copies * r.size for r in rows) in (5, 10)


def test_names_that_clash_and_null_sizes(docs):
    names = ["doc_id", "source", "size", "_source", "_row", "row", "part", "end", "rate", "start", "copies"]
    rows = [(i, "ab"[i % 2], None if i == 7 else i % 5, "kept", *["x"] * 7) for i in range(40)]
    got = mixing.mix(docs(rows, ", ".join(f"{n} {'long' if n in ('doc_id', 'size') else 'string'}" for n in names)))
    assert got.columns == [*names[:-1], "source_size", "target", "copies"]
    kept = {r.doc_id: r for r in got.collect()}
    assert len(kept) == 40 and all(r["_source"] == "kept" and r["rate"] == "x" for r in kept.values()) and kept[7]["size"] is None
