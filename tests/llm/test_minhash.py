from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import minhash
from tillroll.llm.common import mix64, utf8
from llm_fixtures import docs, edge, empty, llm  # noqa: F401


def bag(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    x, y = bag(a), bag(b)
    both = sum((x | y).values())
    return sum((x & y).values()) / both if both else 0.0


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 60, 300)
    b = np.maximum(1, a + rng.integers(-25, 25, 300))
    element = mix64(np.arange(300, dtype=np.uint64))
    sig = minhash.bag_minhash(np.repeat([0, 1], 300), np.tile(element, 2), np.concatenate([a, b]), 2, 4096)
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / 4096)


def test_equal_multisets_get_equal_bands_whatever_shares_the_step():
    rng = np.random.default_rng(4)
    for size in (5, 40, 300):
        element, weight = mix64(np.arange(size, dtype=np.uint64) + np.uint64(size)), rng.integers(1, 30, size)
        alone = minhash.band_keys(minhash.bag_minhash(np.zeros(size, np.int64), element, weight, 1))
        for others in (1, 300, 100_000):
            row = np.append(np.zeros(size, np.int64), 1 + np.arange(others) // 100)
            shared = minhash.bag_minhash(row, np.append(element, mix64(np.arange(others, dtype=np.uint64) << np.uint64(32))), np.append(weight, np.ones(others, np.int64)), row[-1] + 1)
            assert (minhash.band_keys(shared)[0] == alone[0]).all()


def test_jaccard_against_counters():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    other = texts[1:] + texts[:1]
    got = minhash.jaccard(*utf8(pa.array(texts)), *utf8(pa.array(other)))
    assert np.allclose(got, [similarity(a, b) for a, b in zip(texts, other)])


def family(seed, n, most, words=120):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        w = list(base)
        for k in rng.sample(range(words), rng.randint(0, most)):
            w[k] = f"e{rng.randint(0, 10**9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("most", [3, 8])
def test_classes_are_the_components_of_all_links(docs, most):
    texts = family(3, 60, most) + family(4, 40, 6) + [" ".join(f"u{i}_{k}" for k in range(80)) for i in range(20)]
    random.Random(5).shuffle(texts)
    got = {r.doc_id: r.class_id for r in minhash.classes(docs(list(enumerate(texts)))).collect()}
    links = [(i, j) for i in range(len(texts)) for j in range(i) if similarity(texts[i], texts[j]) >= 0.8]
    assert got == components(range(len(texts)), links)


def test_copies_and_edges(edge, docs, empty):
    rows = minhash.classes(edge).collect()
    assert len(rows) == edge.count()
    one = {(r.doc_id, r.n_shingles): r.class_id for r in rows}
    assert one[(1, 0)] == 1 and one[(2, 0)] == 2 and one[(3, 0)] == 3
    assert one[(4, 1)] == 4
    assert minhash.classes(empty).count() == 0
    copies = minhash.classes(docs([(i, "one two three four five six seven") for i in range(50)])).collect()
    assert {r.class_id for r in copies} == {0} and sum(r.is_first for r in copies) == 1


def test_keep_one_keeps_columns(docs):
    rows = [(2, "a b c d e f", "x", 1), (1, "a b c d e f", "y", 2), (3, None, "z", 3), (3, None, "z", 3), (None, "q r s", "n", 4)]
    kept = minhash.keep_one(docs(rows, "doc_id long, text string, node string, class_id int"))
    assert sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)) == [(1, "a b c d e f", "y", 2), (3, None, "z", 3), (None, "q r s", "n", 4)]


def test_oracle_sql(docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(5)]
    rows = [(i, t) for i, t in enumerate(base + base[:2])]
    for i in range(20, 50):
        w = rng.choice(base).split()
        w[rng.randrange(40)] = "new"
        rows.append((i, " ".join(w)))
    rows += [(60, None), (61, ""), (62, " \t"), (63, "one two"), (64, "one  two"), (65, "two one"), (66, "a a a a a a a"), (67, "a a a a a a")]
    c = duckdb.connect()
    c.execute("create table documents (doc_id bigint, text varchar)")
    c.executemany("insert into documents values (?, ?)", rows)
    names = [col[0] for col in c.execute(minhash.ORACLE_SQL).description]
    want = [dict(zip(names, r)) for r in c.fetchall()]
    got = [r.asDict() for r in minhash.classes(docs(rows)).drop("th").collect()]
    key = lambda r: sorted(r.items(), key=str)
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)
