from __future__ import annotations

import hashlib

import numpy as np
import pytest

from tillroll.llm import digest
from llm_fixtures import docs, edge, empty, llm  # noqa: F401

SF = "/root/testdata/sf0.01"


def check(rows, got):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    by = {}
    for k, (i, t) in enumerate(ordered):
        t, following = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        by.setdefault((i, len(t)), []).append(hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest())
    assert len(got) == len(rows)
    for r in got:
        assert r.edited_sha256 in by[(r.doc_id, r.n_chars)]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


@pytest.mark.parametrize("ranges", [1, 5, 300])
def test_next_and_edit(docs, edge, ranges):
    rows = [(i * 3, f"text {i} " * (i % 9)) for i in range(200)]
    check(rows, digest.with_next(docs(rows), ranges).collect())
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    check(rows, digest.with_next(edge, ranges).collect())


def test_table(llm):
    df = llm.read.parquet(f"{SF}/documents.parquet")
    got = digest.with_next(df).toPandas()
    check([(r.doc_id, r.text) for r in df.collect()], list(got.itertuples()))
    assert (got["near_edited"] > got["near_next"]).mean() > 0.97


def test_digest_of_equal_texts_and_bounds():
    d = digest.digest_all(["abc def ghi " * 9, "abc def ghi " * 9, "", "", "zz", "\x00" * 50_000])
    assert (d[0] == d[1]).all() and (d[2] == d[3]).all()
    like = digest.likeness(d[[0, 2, 0, 4]], d[[1, 3, 5, 5]])
    assert like[0] == 1 and like[1] == 1 and (like >= 0).all()
    assert {len(x) for x in digest.to_hex(d)} == {132}


def test_counts_against_loop():
    texts = ["abcabc", "ab", "", "hello world"]
    from tillroll.llm.common import utf8
    import pyarrow as pa

    counts = digest.bucket_counts(*utf8(pa.array(texts)))
    assert counts.sum(axis=1).tolist() == [max(0, len(t) - 2) for t in texts]
    assert np.sort(counts[0])[-1] >= 2  # abc twice


def test_empty_and_single(empty, docs):
    assert digest.with_next(empty).count() == 0
    one = digest.with_next(docs([(1, "abcd")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1
