"""Many files with uneven headers as one table."""

import re
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.plans import merge
from careflow.sources import headers, tables


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)


def scans(df):
    return len(re.findall(r"Scan (?:csv|parquet)", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def folder(tmp_path):
    files = {
        "a 一[1].csv": "pid,name,age\n1,ann,30\n", "b.csv": '\n﻿name,pid,city\nbob,2,Rome\n"x, y",030,\n',
        "c+d%20.csv": "pid,name,age\n7,zoe,9\n", "e.csv": "", "f.csv": "PID,,PID\n5,6,7\n", "g.csv": "pid,name,age\n",
        "h.csv": "\n  \n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return tmp_path


def test_values_stay_under_their_names(spark, folder):
    found = headers.read_files(spark, str(folder), "csv")
    assert rows_of(found.rows, "pid", "name", "age", "city", "_c1", "PID_2") == sorted([
        ("1", "ann", "30", None, None, None), ("2", "bob", None, "Rome", None, None), ("030", "x, y", None, None, None, None),
        ("7", "zoe", "9", None, None, None), ("5", None, None, None, "6", "7")], key=repr)
    assert [(f.rsplit("/", 1)[-1], reason) for f, reason, _ in found.skipped] == [("e.csv", "empty"), ("h.csv", "empty")]
    # Four files of one header, one of another, one with a repeated name: three scans.
    assert scans(found.rows) == 3
    named = found.rows.where("name = 'ann'").select(headers.plain_path(F.col("_source_file"))).first()[0]
    assert named.endswith("/a 一[1].csv")


def test_columns_and_filters_reach_each_scan(spark, folder):
    plan = headers.read_files(spark, str(folder), "csv").rows.where("pid = '1'").select("name")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "age" not in text and "PushedFilters: [IsNotNull(pid), EqualTo(pid,1)]" in text


def test_a_header_costs_one_line(spark, tmp_path):
    """Finding headers does not read the files."""
    for i in range(3):
        with open(tmp_path / f"{i}.csv", "w") as f:
            f.write("pid,big\n")
            f.writelines(f"{n},{'x' * 200}\n" for n in range(200_000))
    headers.text_headers(spark, [str(tmp_path)])
    begun = time.time()
    found = headers.text_headers(spark, [str(tmp_path)])
    whole = time.time() - begun
    assert [h for _, h in found] == [["pid", "big"]] * 3 and whole < 5


def test_schema_by_name(spark, folder):
    schema = T.StructType([T.StructField("age", T.IntegerType()), T.StructField("pid", T.StringType()), T.StructField("none", T.DateType())])
    df = tables.read_table(spark, str(folder), "csv", schema)
    assert df.columns == ["age", "pid", "none", "_source_file"] and df.schema["age"].dataType == T.IntegerType()
    assert rows_of(df, "age", "pid", "none") == sorted(
        [(30, "1", None), (None, "2", None), (None, "030", None), (9, "7", None), (None, "5", None)], key=repr)


def test_names_that_cleaning_makes_one(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pid!,x\n1,a\n")
    (tmp_path / "b.csv").write_text("x, pid\nb,2\n")
    df = tables.read_table(spark, str(tmp_path), "csv", clean=True)
    assert rows_of(df, "pid", "x") == [("1", "a"), ("2", "b")]


def test_parquet_columns_are_not_lost(spark, tmp_path):
    one, two, text = (str(tmp_path / n) for n in ("one", "two", "text"))
    spark.createDataFrame([(1, "a")], "pid long, name string").write.parquet(one)
    spark.createDataFrame([(2, "Rome")], "pid long, city string").write.parquet(two)
    spark.createDataFrame([("030", "x")], "`pid` string, `name` string").write.parquet(text)
    df = tables.read_table(spark, [one, two])
    assert rows_of(df, "pid", "name", "city") == [(1, "a", None), (2, None, "Rome")] and scans(df) == 1
    mixed = tables.read_table(spark, [one, two, text])
    assert rows_of(mixed, "pid", "name", "city") == [("030", "x", None), ("1", "a", None), ("2", None, "Rome")]
    assert scans(mixed) == 3 and rows_of(mixed, "_row_idx") == [(0,), (0,), (0,)]
    spelled = str(tmp_path / "spelled")
    spark.createDataFrame([(3, "Oslo")], "`pid!` long, city string").write.parquet(spelled)
    assert rows_of(tables.read_table(spark, [one, two, spelled], clean=True), "pid", "city") == [
        (1, None), (2, "Rome"), (3, "Oslo")]


def test_what_cannot_be_read_is_named(spark, tmp_path):
    good, bad, none = str(tmp_path / "good"), str(tmp_path / "bad.parquet"), str(tmp_path / "none")
    spark.createDataFrame([(1,)], "pid long").write.parquet(good)
    (tmp_path / "bad.parquet").write_text("nothing like it")
    found = headers.read_files(spark, [good, bad, none])
    assert rows_of(found.rows, "pid") == [(1,)]
    assert [(f.rsplit("/", 1)[-1], reason) for f, reason, _ in found.skipped] == [("none", "missing file"), ("bad.parquet", "unreadable")]
    assert "not a Parquet file" in found.skipped[1][2]
    with pytest.raises(ValueError, match="none: missing file"):
        tables.read_table(spark, [good, none])
    assert headers.read_files(spark, none).rows.count() == 0


def test_merge_of_uneven_files(spark, folder):
    merged, skipped = merge.merge_files(spark, [str(folder), str(folder / "no.csv")], "t", "csv", keys=["pid"])
    assert rows_of(merged, "pid", "name", "数据更新时间") == sorted([
        ("1", "ann", "t"), ("2", "bob", "t"), ("030", "x, y", "t"), ("7", "zoe", "t"), ("5", None, "t")], key=repr)
    assert sorted((r.file.rsplit("/", 1)[-1], r.reason) for r in skipped.collect()) == [
        ("e.csv", "empty"), ("g.csv", "empty"), ("h.csv", "empty"), ("no.csv", "missing file")]


def test_many_headers_stay_together(spark, tmp_path):
    """Any mix of columns: every value is found again under its name and file."""
    want = []
    for i in range(40):
        names = [f"c{(i * k) % 7}" for k in range(1, 4)]
        names = list(dict.fromkeys(names)) + ["id"]
        (tmp_path / f"{i:02}.csv").write_text(",".join(names) + "\n" + ",".join(f"{n}-{i}" for n in names) + "\n")
        want += [(f"id-{i}", n, f"{n}-{i}") for n in names if n != "id"]
    df = tables.read_table(spark, str(tmp_path), "csv")
    values = [c for c in df.columns if c.startswith("c")]
    found = df.select("id", F.explode(F.create_map(*[x for c in values for x in (F.lit(c), F.col(c))]))).where("value is not null")
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert scans(df) <= 14
