"""Quality classifier, language identification, language-model scoring."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import bloomlm, langid, ordinal
from tillroll.llm.queries import QUERIES, graded_labels
from llm_fixtures import docs, edge, empty, llm  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_ordinal_orders_unseen_texts(llm):
    rows = []
    rng = np.random.default_rng(0)
    for i in range(900):
        grade = i % 3
        words = ["common" + "abcdefghij"[rng.integers(10)] + "abcdefghij"[rng.integers(10)] for _ in range(rng.integers(5, 60))] + ["sign" + "xyz"[grade] + "abcd"[rng.integers(4)]] * (rng.random() < 0.97)
        rows.append((i, " ".join(words), grade))
    df = llm.createDataFrame(rows, "doc_id long, text string, grade int")
    model = ordinal.fit(df.where("doc_id < 600"))
    assert (np.diff(model.thresholds) > 0).all()
    got = ordinal.score(df.where("doc_id >= 600"), model).toPandas()
    mean = got.groupby("grade")["expected_grade"].mean()
    assert mean[0] + 0.3 < mean[1] < mean[2] - 0.3
    assert ((got["p_top"] >= 0.5) == (got["grade"] == 2)).mean() > 0.85


def test_ordinal_edges(llm, edge, empty):
    for rows in ([], [(1, "a", 1)], [(1, "a", None), (2, "b", 2)]):
        model = ordinal.fit(llm.createDataFrame(rows, "doc_id long, text string, grade int"))
        assert ordinal.score(edge, model).count() == edge.count()
    assert ordinal.score(empty, model).count() == 0
    assert ordinal.score(edge.selectExpr("*", "1 as p_top"), model).columns == ["doc_id", "text", "expected_grade", "p_top"]


def test_ordinal_query_held_out(llm):
    d = "/root/testdata/sf0.1"  # sf0.01 has 37 toxic texts to learn from
    got = QUERIES["op7_ordinal_quality"](llm, d).toPandas().merge(graded_labels(llm, d).toPandas(), on="doc_id")
    known = got[~got["held_out"]].groupby("grade")["expected_grade"].mean()
    assert known[0] < known[1] < known[2]
    unseen = got[got["held_out"]].groupby("grade")["selected"].mean()
    assert unseen[2] > 0.6 and unseen[0] < 0.35


def test_language_held_out_accuracy(llm):
    got = QUERIES["op9_language_id"](llm, SF).join(llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    unseen = got[got["held_out"]]
    assert (unseen["lang_pred"] == unseen["lang"]).mean() > 0.98
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()


def test_language_matrix_against_counting(llm):
    rows = [("x", "abab"), ("x", "ba"), ("y", "cde 1"), (None, "zz"), ("y", None)]
    langs, log_p, prior = langid.train(llm.createDataFrame(rows, "lang string, text string"), bits=10)
    assert langs == ["x", "y"] and np.allclose(np.exp(prior), [0.5, 0.5])
    for k, texts in enumerate((["abab", "ba"], ["cde 1", ""])):
        _, bucket, _ = langid.ngrams(texts, 10)
        counts = np.bincount(bucket, minlength=1024) + 0.5
        assert np.allclose(log_p[:, k], np.log(counts / counts.sum()))


def test_language_edges(llm, edge, empty):
    model = langid.train(llm.createDataFrame([("x", "abc"), ("y", "xyz")], "lang string, text string"))
    got = langid.predict(edge.selectExpr("*", "'k' as score"), model).collect()
    assert len(got) == edge.count() and all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in got)
    nothing = langid.train(llm.createDataFrame([], "lang string, text string"))
    assert {(r.lang_pred, r.score) for r in langid.predict(edge, nothing).collect()} == {("und", 0.0)}
    assert langid.predict(empty, model).count() == 0


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def check_base(rows, got):
    train = [words(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in rows:
        w = words(t)
        want[(i, len(w), sum(x in count for x in w), round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 5))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert {r.train_tokens for r in got} <= {n}


@pytest.mark.parametrize("most", [50, 1 << 20])
def test_base_score_is_exact(docs, edge, empty, llm, monkeypatch, most):
    monkeypatch.setattr(bloomlm, "TABLE", most)
    rows = [(i, " ".join(f"W{(i * k * k) % 90}" for k in range(i % 40))) for i in range(400)] + [(r.doc_id, r.text) for r in edge.collect()]
    df = docs(rows).withColumn("held_out", bloomlm.held_out())
    model, rare = bloomlm.train(df.where("not held_out"))
    check_base(rows, bloomlm.score(df, model, rare).collect())
    none = empty.withColumn("held_out", bloomlm.held_out())
    model, rare = bloomlm.train(none)
    assert bloomlm.score(none, model, rare).count() == 0
    assert all(r.n_known == 0 for r in bloomlm.score(df, model, rare).collect())


def test_filter_holds_quantised_counts(docs):
    rows = [(i, "often " * 50 + f"rare{i}") for i in range(64)]
    model, _ = bloomlm.train(docs(rows))
    low = lambda w: bloomlm.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][:1]
    assert model.levels(bloomlm.filter_keys(low("often"), model.segment_bits))[0] >= int(math.log2(3200)) + 1
    assert model.levels(bloomlm.filter_keys(low("rare5"), model.segment_bits))[0] >= 1
    unseen = np.concatenate([low(f"unseen{k}") for k in range(500)])
    assert (model.levels(bloomlm.filter_keys(unseen, model.segment_bits)) == 0).mean() > 0.9


def test_score_prefers_text_like_the_corpus(docs):
    rows = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(50)] + [(100, "the cat sat on the rug"), (101, "rug the on sat cat the"), (102, "qq ww ee rr tt yy")]
    df = docs(rows).selectExpr("*", "doc_id >= 100 as held_out")
    model, rare = bloomlm.train(df.where("not held_out"))
    got = {r.doc_id: r.score for r in bloomlm.score(df, model, rare).collect()}
    assert got[100] > got[101] > got[102]


def test_filter_grows_and_scores_follow_the_counts(docs, monkeypatch):
    monkeypatch.setattr(bloomlm, "MOST_BITS", 1 << 16, raising=False)  # the size bound there once was
    for name, value in (("SEGMENT_BYTES", 1 << 15), ("CHUNK_BYTES", 1 << 13), ("ASK_BYTES", 1 << 13), ("TABLE", 400)):
        monkeypatch.setattr(bloomlm, name, value, raising=False)
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 60) % 20_000)) for i in range(900)] + [(900, None), (901, "")]
    df = docs(rows).withColumn("held_out", bloomlm.held_out())
    model, rare = bloomlm.train(df.where("not held_out"))
    got = {r.doc_id: r.score for r in bloomlm.score(df, model, rare).collect()}
    train = [words(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    single, pair = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["", *t], t))
    mid = lambda n: n if n < 2 else 1.5 * 2 ** math.floor(math.log2(n))
    total = sum(single.values()) + len(single) + 1
    near = 0
    for i, t in rows:
        want = 0.0
        for b, w in zip(["", *words(t)], words(t)):
            context = mid(single[b]) if b != "" else len(train)
            p = min(mid(pair[b, w]), context, max(mid(single[w]), 1))
            want += math.log10(min((p + bloomlm.PRIOR * (mid(single[w]) + 1) / total) / (context + bloomlm.PRIOR), 1.0))
        near += abs(got[i] - want) <= 0.03 * abs(want)
    assert len(got) == len(rows) and near > 0.9 * len(rows)
