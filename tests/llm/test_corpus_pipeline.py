from __future__ import annotations

import re

import corpus_pipeline as cp
from tillroll.llm import langid, mixing
from test_minhash import components, similarity
from test_pii import BASE, base
from llm_fixtures import docs, edge, empty, llm  # noqa: F401

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    docs = docs.union(llm.createDataFrame([(90001, "1234 --", "en", "src0", 7), (90002, None, None, None, 0)], docs.schema))
    names = [n for n, _ in cp.STAGES]
    stage = dict(cp.STAGES)
    known = cp.materialize(stage[names[0]](llm, docs, SF), "t")
    kept = {r.doc_id: r.text for r in known.collect()}
    assert known.columns == COLUMNS
    assert set(kept) == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}

    first = cp.materialize(stage[names[1]](llm, known, SF), "t")
    ids = sorted(kept)
    links = [(a, b) for a in ids for b in ids if b < a and similarity(kept[a], kept[b]) >= 0.8]
    assert first.columns == COLUMNS and {r.doc_id for r in first.collect()} == set(components(ids, links).values())

    clean = cp.materialize(stage[names[2]](llm, first, SF), "t")
    assert clean.columns == COLUMNS
    for r in clean.collect():
        assert not base(r.text) and r.n_chars == len(r.text)
        assert len(base(kept[r.doc_id])) <= len(re.findall("|".join(rf"\[{k.upper()}\]" for k, _, _ in BASE), r.text)) or not base(kept[r.doc_id])

    mixed = cp.materialize(stage[names[3]](llm, clean, SF), "t")
    want = {r.doc_id: r.copies for r in mixing.mix(clean.withColumn("size", mixing.words())).collect()}
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == COLUMNS and got == {i: c for i, c in want.items() if c}

    encoded = stage[names[4]](llm, mixed, SF)
    assert encoded.count() == mixed.count() and encoded.where("not round_trip").count() == mixed.where("text like '%▁%'").count()


def test_rejects_are_marked_und(llm):
    assert langid.UNKNOWN == "und" and 4 <= len(cp.STAGES) <= 5


def test_empty_and_odd_documents(llm):
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, copies int, _row int"
    rows = [(1, "a b c", "en", "s", 5, "q", 1, 2), (1, "a b c", "en", "s", 5, "q", 1, 2), (None, "d e f", None, None, 5, None, None, None), (2, None, "en", None, None, None, None, None)]
    for data in ([], rows):
        docs = llm.createDataFrame(data, schema)
        for name, stage in cp.STAGES[:-1]:
            docs = cp.materialize(stage(llm, docs, SF), "t")
            assert docs.columns == [c.split()[0] for c in schema.split(", ")], name
        assert cp.STAGES[-1][1](llm, docs, SF).count() == docs.count()
