import datetime as dt

import pytest
from pyspark.sql import types as T

from strata.sources import fs, snapshot
from strata.sources.io import read_batch, read_or_empty, read_table, table_format, write_batch
from strata.sources.paths import Lake, render_path
from strata.sources.schemas import LANDING_CUSTOMERS, SALES_SUMMARY, LANDING_SALES


def test_render_path_placeholders():
    tpl = "s3://{{ group }}/sales_erp/dt={{ execution_date }}/{{ name }}{{ extension }}"
    assert render_path(tpl, "2024-01-01", name="stg", group="bronze", format="parquet") == \
        "s3://bronze/sales_erp/dt=2024-01-01/stg.parquet"
    assert render_path(tpl, "2024-01-01", name="t", group="silver", format="delta").endswith("/t")
    assert render_path("{{ root }}/x/{{ extension }}", "d", root="/r", format="csv") == "/r/x/.csv"


def test_lake_catalog_names_nine_paths():
    paths = Lake("/lake").paths("2024-01-01")
    assert len(paths) == 9
    assert paths["sales_landing"] == "/lake/landing/sales_erp/dt=2024-01-01"
    assert paths["sales_silver"] == "/lake/silver/sales/dt=2024-01-01"
    assert Lake("/lake").quarantine_path("2024-01-01", "bad batch") == \
        "/lake/quarantine/dt=2024-01-01/reason=bad_batch"


def test_unknown_format_raises(spark):
    with pytest.raises(ValueError):
        table_format(spark, "avro2")


def test_delta_falls_back_to_snapshot_without_the_jar(spark):
    assert table_format(spark, "delta") in ("delta", "snapshot")


def test_json_layouts(spark, tmp_path):
    nl = tmp_path / "nl.json"
    nl.write_text('{"id": 1, "name": "a"}\n{"id": 2, "name": "b"}\n')
    arr = tmp_path / "arr.json"
    arr.write_text('[\n  {"id": 1, "name": "a"},\n  {"id": 2, "name": "b"}\n]\n')
    assert read_batch(spark, str(nl), "json", LANDING_CUSTOMERS).count() == 2
    assert read_batch(spark, str(arr), "json", LANDING_CUSTOMERS, {"multiLine": "true"}).count() == 2


def test_csv_fails_on_non_integral_id_text(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("id,customer_id,price,product,date\nabc,1,1.0,x,2024-01-01\n")
    from strata.sources.schemas import LANDING_SALES
    with pytest.raises(Exception):
        read_batch(spark, str(p), "csv", LANDING_SALES).collect()


def test_csv_empty_field_is_null(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("id,customer_id,price,product,date\n,1,1.0,x,2024-01-01\n")
    from strata.sources.schemas import LANDING_SALES
    assert read_batch(spark, str(p), "csv", LANDING_SALES).collect()[0]["id"] is None


def test_roundtrips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5, dt.date(2024, 1, 1)), (None, None, None, None)],
                               "id long, s string, x double, d date")
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / fmt)
        write_batch(df, path, fmt)
        back = read_batch(spark, path, fmt, df.schema)
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_snapshot_versions_and_pointer(spark, tmp_path):
    table = str(tmp_path / "t")
    a = spark.createDataFrame([(1,)], "v long")
    b = spark.createDataFrame([(2,), (3,)], "v long")
    write_batch(a, snapshot.version_path(table, "r1"), "parquet")
    snapshot.publish(spark, table, "r1")
    write_batch(b, snapshot.version_path(table, "r2"), "parquet")
    assert read_batch(spark, table, "snapshot").count() == 1  # r2 written, not yet live
    snapshot.publish(spark, table, "r2")
    assert read_batch(spark, table, "snapshot").count() == 2
    # older versions and pointers stay: a reader of one is never cut off
    assert fs.exists(spark, snapshot.version_path(table, "r1"))
    assert snapshot.current_version(spark, table) == "r2"


def test_readers_see_a_version_at_every_step_of_a_publish(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    write_batch(spark.range(1), snapshot.version_path(table, "r1"), "parquet")
    snapshot.publish(spark, table, "r1")
    write_batch(spark.range(2), snapshot.version_path(table, "r2"), "parquet")
    seen = []
    for name in ("delete", "rename", "write_text"):
        real = getattr(fs, name)

        def watched(spark_, *args, real=real):
            seen.append(read_batch(spark, table, "snapshot").count())
            out = real(spark_, *args)
            seen.append(read_batch(spark, table, "snapshot").count())
            return out

        monkeypatch.setattr(fs, name, watched)
    snapshot.publish(spark, table, "r2")
    assert seen and set(seen) <= {1, 2} and seen[-1] == 2


def test_read_or_empty(spark, tmp_path):
    df = read_or_empty(spark, str(tmp_path / "missing"), SALES_SUMMARY)
    assert df.count() == 0 and df.schema == SALES_SUMMARY


def test_partition_pruning_and_dt_column(spark, tmp_path):
    root = str(tmp_path / "tbl")
    df = spark.createDataFrame([(1,), (2,)], "v long")
    for d in ("2024-01-01", "2024-01-02"):
        write_batch(df, f"{root}/dt={d}", "parquet")
    one = read_table(spark, root, "parquet", execution_date="2024-01-02")
    assert one.count() == 2 and one.schema["dt"].dataType == T.DateType()
    assert one.inputFiles() and all("/dt=2024-01-02/" in f for f in one.inputFiles())  # no other date is listed
    assert read_table(spark, root, "parquet", execution_date="2024-01-03").count() == 0


def test_publish_batch_replaces_whole_partition(spark, tmp_path):
    from strata.plans.steps import publish_batch

    target = str(tmp_path / "t" / "dt=2024-01-01")
    df = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    assert publish_batch(spark, df, target) == 3
    assert publish_batch(spark, df.where("v > 5"), target) == 0  # empty batch still replaces
    assert spark.read.parquet(target).count() == 0
    assert publish_batch(spark, df, str(tmp_path / "s"), "snapshot") == 3
    assert read_batch(spark, str(tmp_path / "s"), "snapshot").count() == 3


def test_whole_number_ids_written_as_floats_are_accepted(spark, tmp_path):
    from strata.sources.schemas import LANDING_SALES

    j = tmp_path / "c.json"
    j.write_text('{"id": 1011.0, "name": "a"}\n{"id": null, "name": "b"}\n{"id": 7, "name": "c"}\n')
    ids = [r["id"] for r in read_batch(spark, str(j), "json", LANDING_CUSTOMERS).collect()]
    assert ids == [1011, None, 7]
    c = tmp_path / "s.csv"
    c.write_text("id,customer_id,price,product,date\n52.0,1,1.5,x,2024-01-01\n,2.0,1.5,x,2024-01-01\n")
    rows = read_batch(spark, str(c), "csv", LANDING_SALES).collect()
    assert [(r["id"], r["customer_id"]) for r in rows] == [(52, 1), (None, 2)]
    bad = tmp_path / "b.csv"
    bad.write_text("id,customer_id,price,product,date\n52.5,1,1.5,x,2024-01-01\n")
    with pytest.raises(Exception):
        read_batch(spark, str(bad), "csv", LANDING_SALES).collect()


def test_csv_files_with_another_column_order_fail(spark, tmp_path):
    from strata.sources.schemas import LANDING_SALES

    d = tmp_path / "batch"
    d.mkdir()
    (d / "a.csv").write_text("id,customer_id,price,product,date\n1,5,1.5,x,2024-01-01\n")
    (d / "b.csv").write_text("id,price,date,customer_id,product\n2,2.5,2024-01-01,6,y\n")
    with pytest.raises(Exception):
        read_batch(spark, str(d), "csv", LANDING_SALES).collect()
    (d / "b.csv").write_text("id,customer_id,price,product,date\n2,6,2.5,y,2024-01-01\n")
    assert read_batch(spark, str(d), "csv", LANDING_SALES).count() == 2


def test_execution_dates_are_checked():
    from strata.sources.paths import check_date

    assert check_date("2026-04-19") == "2026-04-19"
    for bad in ("2026-4-19", "today", "2026-02-30", "20260419"):
        with pytest.raises(ValueError):
            check_date(bad)


def test_json_layout_is_detected(spark, tmp_path):
    d = tmp_path / "arr"
    d.mkdir()
    (d / "part-0.json").write_text('﻿[\n  {"id": 1, "name": "a"},\n  {"id": 2, "name": "b"}\n]\n')
    assert read_batch(spark, str(d), "json", LANDING_CUSTOMERS).count() == 2
    nl = tmp_path / "nl"
    nl.mkdir()
    (nl / "part-0.json").write_text('{"id": 1, "name": "a"}\n{"id": 2, "name": "b"}\n{"id": 3}\n')
    assert read_batch(spark, str(nl), "json", LANDING_CUSTOMERS).count() == 3
    # blanks before the array, both layouts in one batch, a wrong declaration
    (nl / "part-1.json").write_text(" \n" * 200 + '[{"id": 4}, {"id": 5}]')
    assert read_batch(spark, str(nl), "json", LANDING_CUSTOMERS).count() == 5
    with pytest.raises(ValueError, match="lose records"):
        read_batch(spark, str(nl), "json", LANDING_CUSTOMERS, {"multiLine": "true"})


def test_text_tables_are_read_with_headers(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        (tmp_path / f"dt={day}").mkdir()
        (tmp_path / f"dt={day}" / "a.csv").write_text("id,customer_id,price,product,date\n1,5,1.5,x,2024-01-01\n")
    rows = read_table(spark, str(tmp_path), "csv", schema=LANDING_SALES).collect()
    assert sorted(str(r["dt"]) for r in rows) == ["2024-01-01", "2024-01-02"] and rows[0]["id"] == 1
    one = read_table(spark, str(tmp_path), "csv", "2024-01-02", LANDING_SALES)
    assert len(one.inputFiles()) == 1 and one.count() == 1


def test_snapshot_table_across_dates(spark, tmp_path):
    from strata.plans.steps import publish_batch

    root = str(tmp_path / "silver")
    for d, n in (("2024-01-01", 2), ("2024-01-02", 3)):
        publish_batch(spark, spark.range(n).withColumnRenamed("id", "v"), f"{root}/dt={d}", "snapshot")
    publish_batch(spark, spark.range(5).withColumnRenamed("id", "v"), f"{root}/dt=2024-01-02", "snapshot")
    every = read_table(spark, root, "snapshot")
    counts = {str(r["dt"]): r["count"] for r in every.groupBy("dt").count().collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 5}  # the live version of each date only
    assert read_table(spark, root, "delta", execution_date="2024-01-01").count() == 2
