"""Raw tables as compressed CSV: whole, in small files, and what the round trip writes."""

from __future__ import annotations

import glob
import os

import pytest

from conftest import SF_SMALL

from tillroll import catalog, session
from tillroll.schemas import RAW_COLUMNS
from tillroll.sources import csv


@pytest.mark.parametrize("infer", [False, True])
def test_compressed_files_read_back_whole(spark, tmp_path, monkeypatch, infer):
    monkeypatch.setattr(csv, "PACKED_ROWS", 100)
    columns = RAW_COLUMNS["order_items"]
    df = spark.range(0, 1050, 1, 2).selectExpr("concat('I', id) a", "concat('O', id % 7) b", "if(id % 5 = 0, null, ' P,\"x\" ') c", "cast(id as string) d", "'1.5' e").toDF(*columns)
    plain, packed = str(tmp_path / "plain.csv"), str(tmp_path / "packed.csv")
    csv.write_raw_csv(df, plain)
    csv.write_raw_csv(df, packed, compression="snappy")
    files = glob.glob(f"{packed}/part-*")
    assert len(files) == 12 and all(f.endswith(".csv.snappy") for f in files)
    read = [sorted(map(repr, csv.read_raw_csv(spark, path, "order_items", infer).collect())) for path in (plain, packed)]
    assert read[0] == read[1] and len(read[1]) == 1050
    assert sum(map(os.path.getsize, files)) < sum(map(os.path.getsize, glob.glob(f"{plain}/part-*")))


@pytest.mark.parametrize("name", ["csv_roundtrip", "csv_roundtrip_inferred"])
def test_round_trip_writes_compressed(spark, tmp_path, monkeypatch, name):
    base = str(tmp_path / name)
    monkeypatch.setattr(session, "scratch_path", lambda spark, label: base)
    assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    for table in RAW_COLUMNS:
        files = glob.glob(f"{base}/{table}.csv/part-*")
        assert files and all(f.endswith(".snappy") for f in files)
