from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import suffix
from llm_fixtures import docs, edge, empty, llm  # noqa: F401


def brute(rows, length, keep="none"):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[s : s + length] for b in texts for s in range(len(b) - length + 1))
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    met, out = set(), {}
    for k in order:
        b = texts[k]
        mark = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            g = b[s : s + length]
            if seen[g] > 1 and (keep == "none" or g in met):
                mark[s] += 1
                mark[s + length] -= 1
            met.add(g)
        gone = np.cumsum(mark)[:-1] > 0
        out[k] = (len(b), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    passage = [" ".join(word() for _ in range(30)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 25)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passage)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(10, len(p))], word()]
        rows.append((i, " ".join(parts)))
    return rows + [(500, None), (501, ""), (502, "ab" * 2000), (503, passage[0] * 2), (504, rows[3][1])]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("many", [1, 2000])
def test_against_brute_force(docs, keep, many, monkeypatch):
    monkeypatch.setattr(suffix, "MANY", many)
    rows = corpus()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(docs(rows), 60, keep).collect()}
    want = brute(rows, 60, keep)
    assert got == {rows[k][0]: v for k, v in want.items()}


def test_production_length(docs):
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    rows = [(0, "x" + shared[:399] + "y"), (1, shared), (2, "z" * 50 + shared[200:700]), (3, shared[100:499])]
    got = {r.doc_id: r.n_removed for r in suffix.remove_repeats(docs(rows)).collect()}
    assert got == {0: 0, 1: 500, 2: 500, 3: 0}


def test_edges(edge, empty, docs):
    got = suffix.remove_repeats(edge).collect()
    assert len(got) == edge.count() and empty.transform(suffix.remove_repeats).count() == 0
    same = suffix.remove_repeats(docs([(1, "q" * 10 + "r" * 600)] * 2 + [(None, "q" * 10 + "r" * 600)])).collect()
    assert all(r.n_removed == r.n_bytes for r in same)


def test_previous_factors():
    a, b = b"0123456789" * 2 + b"x", b"9012345678yy"
    which, start, earlier, other = suffix.previous_factors([a, b], 9)
    got = {(int(w), int(s)): (bool(e), bool(o)) for w, s, e, o in zip(which, start, earlier, other)}
    text = [a, b]
    for (w, s), (e, o) in got.items():
        g = text[w][s : s + 9]
        places = [(k, p) for k, t in enumerate(text) for p in range(len(t) - 8) if t[p : p + 9] == g]
        assert e == any(p < (w, s) for p in places) and o == (len(places) > 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=12, max_size=60), min_size=1, max_size=6), st.integers(1, 12))
def test_factor_lengths(texts, length):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    size = [len(t) for t in texts]
    base = np.cumsum([0, *size])
    places = np.concatenate([np.arange(base[k], base[k + 1] - length + 1) for k in range(len(texts))])
    factor, source = suffix.factor_lengths(data, places, length)
    raw = data.tobytes()
    common = lambda a, b: next((k for k in range(length) if raw[a + k] != raw[b + k]), length)
    for i, p in enumerate(places.tolist()):
        want = max((common(p, q) for q in places[:i].tolist()), default=0)
        assert factor[i] == want
        assert source[i] < i and (source[i] == -1) == (want == 0) and (want == 0 or common(p, int(places[source[i]])) == want)


def test_previous_smaller_past_its_rounds():
    rng = np.random.default_rng(3)
    for values in (np.append(np.arange(1, 500), [0, 700, -1]), rng.permutation(400), np.arange(300)[::-1]):
        step = rng.integers(0, 50, len(values))
        for rounds in (0, 1, 64):
            to, least = suffix.previous_smaller(values, step, rounds)
            for i in range(len(values)):
                j = max((k for k in range(i) if values[k] < values[i]), default=-1)
                assert to[i] == j and least[i] == step[max(j + 1, 0) : i + 1].min()


def test_oracle_sql(docs):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgé ") for _ in range(1500))
    rows = [(0, shared), (1, "x" + shared[:700] + "y" + shared[600:]), (2, "q" * 900), (3, None), (4, ""), (5, shared[:399]), (6, "z" * 400), (None, shared[200:900]), (7, shared[200:900])]
    c = duckdb.connect()
    c.execute("create table documents (doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", rows)
    want = c.execute(suffix.ORACLE_SQL).fetchall()
    got = [tuple(r) for r in suffix.remove_repeats(docs(rows)).drop("kept").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
