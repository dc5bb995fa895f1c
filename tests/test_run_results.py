"""The run as rows: its reports are submitted side by side."""

from __future__ import annotations

from conftest import SF_SMALL

from tillroll import catalog, pipeline


def test_reports_of_the_run_overlap(spark, monkeypatch):
    seen = []
    run_results = pipeline.run_results
    monkeypatch.setattr(pipeline, "run_results", lambda spark, cfg, sink=None: seen.append(cfg) or run_results(spark, cfg, sink))
    got = {r["report"]: r["status"] for r in catalog.QUERIES["sink_run_results"](spark, SF_SMALL).collect()}
    assert got == {n: "failed" if n == "customer_retention" else "succeeded" for n in seen[0].reports}
    assert seen[0].parallelism == len(seen[0].reports)
