import gzip
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import fs, snapshot
from strata.sources.catalog import SourceCatalog, SourceMismatch, UnknownSource
from strata.sources.io import json_layouts, read_batch, write_batch
from strata.sources.sniff import CsvConflict, MixedDialect, conflicts, read_sniffed, sniff_csv, sniff_lines

DIALECTS = {
    "comma": ("id,name,x,day\n", '{0},"a, ""b"" {0}",{0}.5,2024-01-0{1}\n', ",", '"', True),
    "semicolon": ("id;name;x;day\n", "{0};'it, {0}';{0}.5;2024-01-0{1}\n", ";", "'", True),
    "tab": ("id\tname\tx\tday\n", "{0}\tname {0}\t{0}.5\t2024-01-0{1}\n", "\t", '"', True),
    "pipe": ("", "{0}|name {0}|{0}.5|2024-01-0{1}\n", "|", '"', False),
}


def write_dialect(folder, name, files=3, rows=40):
    head, row, *_ = DIALECTS[name]
    folder.mkdir(parents=True)
    for k in range(files):
        (folder / f"part-{k}.csv").write_text(head + "".join(row.format(k * rows + i, i % 9 + 1) for i in range(rows)))
    return str(folder)


@pytest.mark.parametrize("name", DIALECTS)
def test_dialects(spark, tmp_path, name):
    path = write_dialect(tmp_path / name, name)
    _, _, delimiter, quote, header = DIALECTS[name]
    d = sniff_csv(spark, path)
    assert (d.delimiter, d.quote, d.header) == (delimiter, quote, header)
    assert [t for _, t in d.columns] == [T.LongType(), T.StringType(), T.DoubleType(), T.DateType()]
    df = read_sniffed(spark, path)
    assert df.columns == (["id", "name", "x", "day"] if header else ["column0", "column1", "column2", "column3"])
    assert df.count() == 120 and df.agg(F.sum(df.columns[2])).first()[0] == sum(i + 0.5 for i in range(120))
    if name == "comma":
        assert df.orderBy("id").first()["name"] == 'a, "b" 0'
    plain = read_batch(spark, path, "csv")  # the reader without a schema sees the same dialect
    assert plain.columns == df.columns if header else len(plain.columns) == 4
    assert plain.count() == 120


def test_mixed_dialects_fail_by_name(spark, tmp_path):
    for name in DIALECTS:
        write_dialect(tmp_path / "all" / name, name, files=2 if name == "comma" else 1)
    with pytest.raises(MixedDialect, match="part-0.csv"):
        sniff_csv(spark, str(tmp_path / "all"), {"recursiveFileLookup": "true"})


def test_heads_that_leave_the_dialect_open_follow_the_others(spark, tmp_path):
    """A header alone (Spark's file of an empty first partition) and a file
    that quotes nothing are no files of another dialect."""
    path = write_dialect(tmp_path / "s", "semicolon")
    (tmp_path / "s" / "part-.csv").write_text("id;name;x;day\n")  # the first by name
    for k in range(5):
        (tmp_path / "s" / f"part-plain-{k}.csv").write_text("id;name;x;day\n500;none;1.5;2024-01-01\n501;it;2.5;2024-01-01\n")
    d = sniff_csv(spark, path)
    assert (d.delimiter, d.quote, d.header) == (";", "'", True)
    assert [t for _, t in d.columns] == [T.LongType(), T.StringType(), T.DoubleType(), T.DateType()]
    df = read_sniffed(spark, path)
    assert df.count() == 130 and df.where("name = 'it, 0'").count() == 1
    (tmp_path / "s" / "part-9.csv").write_text("id;name;x;date\n")  # another header is another batch
    with pytest.raises(MixedDialect, match="part-9.csv"):
        sniff_csv(spark, path)


def test_an_empty_first_partition_is_read_back(spark, tmp_path):
    df = spark.range(0, 40, numPartitions=2).where("id >= 20").selectExpr("id", "concat('a;b ', id) AS name", "id + 0.5D AS x")
    write_batch(df, str(tmp_path / "t"), "csv", options={"sep": ";", "quote": "'"})
    assert len(list((tmp_path / "t").glob("part-*"))) == 2
    got = read_sniffed(spark, str(tmp_path / "t"))
    assert got.dtypes == df.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_one_line_of_texts_is_a_row_where_the_others_have_no_header(spark, tmp_path):
    path = write_dialect(tmp_path / "p", "pipe")
    (tmp_path / "p" / "part-7.csv").write_text("x7|name 7|none|never\n")
    assert not sniff_csv(spark, path).header and read_sniffed(spark, path).count() == 121


def test_the_first_conflict_is_named(spark, tmp_path):
    path = write_dialect(tmp_path / "c", "comma")
    more = "".join(f'{i},"n",1.5,2024-01-01\n' for i in range(300))
    (tmp_path / "c" / "part-1.csv").write_text("id,name,x,day\n" + more + '7,"n",oops,2024-01-01\n' + more)
    (tmp_path / "c" / "part-2.csv").write_text("id,name,x,day\n" + more + "1,2\n")
    d = sniff_csv(spark, path)
    found = sorted((r["file"].rsplit("/", 1)[1], r["column_name"], r["value"]) for r in conflicts(spark, path, d).collect())
    assert found == [("part-1.csv", "x", "oops"), ("part-2.csv", None, "1,2")]
    with pytest.raises(CsvConflict, match="part-1.csv.*'oops' in x"):
        read_sniffed(spark, path)
    with pytest.raises(Exception):
        read_sniffed(spark, path, check=False).collect()  # the cast is strict anyway


def test_heads_widen_types_and_empty_fields_are_null(spark, tmp_path):
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.csv").write_text("k,v\n1,\n2,3\n")
    (folder / "b.csv").write_text("k,v\n1.5,4\n2,\n")
    with gzip.open(folder / "c.csv.gz", "wt") as f:
        f.write("k,v\n9,9\n")
    df = read_sniffed(spark, str(folder))
    assert [f.dataType for f in df.schema] == [T.DoubleType(), T.LongType()]
    assert df.where("v is null").count() == 2 and df.count() == 5


@pytest.mark.parametrize("lines, header, width", [
    (["a,b", "c,d"], True, 2), (["1,2", "3,4"], False, 2), (["x"], True, 1), ([], None, 0), (["a,a", "1,2"], False, 2), (["a;b", "1,5;2,5"], True, 2),
])
def test_headers(lines, header, width):
    d = sniff_lines(lines)
    assert (d is None) if header is None else (d.header, len(d.columns)) == (header, width)


def test_json_layouts_read_heads(spark, tmp_path):
    (tmp_path / "blank.json").write_text("\n \t" * 4000 + '[{"id": 1}]')
    (tmp_path / "line s.json").write_text('﻿\n{"id": 2}\n{"id": 3}\n')
    (tmp_path / "empty.json").write_text("")
    with gzip.open(tmp_path / "z.json.gz", "wt") as f:
        f.write(' [{"id": 4}]')
    arrays, others = json_layouts(spark, str(tmp_path))
    assert sorted(f.rsplit("/", 1)[1] for f in arrays) == ["blank.json", "z.json.gz"]
    assert sorted(f.rsplit("/", 1)[1] for f in others) in (["empty.json", "line s.json"], ["line s.json"])
    df = read_batch(spark, str(tmp_path), "json", T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(r["id"] for r in df.collect()) == [1, 2, 3, 4]


def test_of_two_publishers_of_a_number_one_fails(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    for k in range(2):
        write_batch(spark.range(k + 1), snapshot.version_path(table, f"r{k}"), "parquet")
    snapshot.publish(spark, table, "r0")
    seen = snapshot._pointers(spark, table)
    monkeypatch.setattr(snapshot, "_pointers", lambda *a: seen)
    snapshot.publish(spark, table, "r1")
    with pytest.raises(snapshot.PublishConflict):
        snapshot.publish(spark, table, "r2")
    monkeypatch.undo()
    assert snapshot.current_version(spark, table) == "r1"
    fs.write_text(spark, f"{table}/{snapshot.POINTER}-{9:012d}", "")  # a pointer being written
    assert snapshot.current_version(spark, table) == "r1"


def test_publishers_at_once(spark, tmp_path):
    table = str(tmp_path / "t")

    def run(k):
        try:
            snapshot.publish(spark, table, f"r{k}")
            return True
        except snapshot.PublishConflict:
            return False

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(run, range(8)))
    assert 1 <= sum(won) and len(snapshot._pointers(spark, table)) == sum(won)


def test_one_of_many_writers_creates_a_file(spark, tmp_path):
    def run(path):
        try:
            fs.write_text(spark, path, "mine", False)
            return True
        except FileExistsError:
            return False

    with ThreadPoolExecutor(8) as pool:
        for k in range(40):
            path = str(tmp_path / "new" / f"f{k}")
            assert sum(pool.map(run, [path] * 8)) == 1 and fs.read_text(spark, path) == "mine"


DATE = "2026-04-19"


@pytest.fixture()
def sources(spark, tmp_path):
    root = str(tmp_path)
    sales = spark.createDataFrame([(1, 10.0), (2, 5.0)], "id long, price double")
    write_batch(sales, snapshot.version_path(f"{root}/silver/sales/dt={DATE}", "v1"), "parquet")
    snapshot.publish(spark, f"{root}/silver/sales/dt={DATE}", "v1")
    write_batch(sales, f"{root}/bronze/sales/dt={DATE}", "parquet")
    write_batch(sales, f"{root}/bronze/sales/dt=2026-04-20", "parquet")
    write_batch(sales, f"{root}/landing/sales.csv", "csv")
    tables = lambda *t: {"schema": t[0], "tables": [{"name": n, "external_location": "{{ root }}/" + loc, **more} for n, loc, more in t[1:]]}
    text = json.dumps({"sources": [
        tables("silver", ("sales", "silver/sales/dt={{ execution_date }}", {"columns": [{"name": "price", "data_type": "double"}]}),
               ("all_sales", "silver/sales", {})),
        tables("bronze", ("sales", "bronze/sales", {}), ("day", "bronze/sales/dt={{ var('execution_date') }}", {}),
               ("gone", "bronze/nothing", {}), ("wrong", "bronze/sales", {"columns": [{"name": "id", "data_type": "string"}, {"name": "tax"}]})),
        tables("landing", ("sales", "landing/sales.csv", {})),
    ]})
    path = f"{root}/sources.json"
    fs.write_text(spark, path, text)
    return SourceCatalog.from_file(spark, path, root=root)


def test_sources_resolve_by_location(spark, sources):
    assert sources.read(spark, "silver.sales", DATE).count() == 2
    assert sources.read(spark, "silver.all_sales", DATE).columns == ["id", "price", "dt"]
    both = sources.read(spark, "bronze.sales", DATE)
    assert both.count() == 4 and "dt" in both.columns
    assert sources.read(spark, "bronze.day", DATE).count() == 2
    assert sources.read(spark, "landing.sales", DATE).agg(F.sum("price")).first()[0] == 15.0


def test_sources_are_bound_lazily_and_checked(spark, sources):
    with pytest.raises(SourceMismatch, match="id is bigint, declared string; tax is missing"):
        sources.read(spark, "bronze.wrong", DATE)
    with pytest.raises(UnknownSource, match="silver.nothing"):
        sources.read(spark, "silver.nothing", DATE)
    text = "SELECT s.id, b.price FROM silver.sales s JOIN bronze.day b ON s.id = b.id WHERE s.price >= :least"
    assert [t.full_name for t in sources.used_in(text)] == ["silver.sales", "bronze.day"]
    assert sources.sql(spark, text, DATE, {"least": 6}).collect()[0]["price"] == 10.0  # bronze.gone is never read


def test_bad_declarations(spark):
    with pytest.raises(ValueError, match="no external_location"):
        SourceCatalog.from_json(json.dumps({"sources": [{"name": "a", "tables": [{"name": "t"}]}]}))
    t = {"name": "t", "external_location": "x"}
    with pytest.raises(ValueError, match="declared twice: a.t"):
        SourceCatalog.from_json(json.dumps({"sources": [{"name": "a", "tables": [t, t]}]}))
