"""Typed CSV with an account of faults, types read off the text, and files whose headers differ."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from marigold.plans import jobs
from marigold.plans.jobs import Layout
from marigold.sources import schemas
from marigold.sources.families import headers, names_in, read_family
from marigold.sources.tables import read_csv, read_parquet
from marigold.sources.typed import fault_account, infer_on_the_way, infer_schema, joined_kind, read_typed_csv, typed, write_typed
from marigold.staging import Staging


def text_file(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def one(spark, kind, *values, **options):
    """The converted values of one column, with their faults."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    scan = typed(rows, {"v": T.DataType.fromDDL(kind)}, **options)
    got = [r.v for r in scan.visible.orderBy("i").collect()]
    faults = {r.i: r.faults[0].fault for r in scan.faults().collect()}
    return got, [faults.get(i) for i in range(len(values))]


@pytest.mark.parametrize(
    "kind,text,value,fault",
    [
        ("decimal(18,2)", "10.505", Decimal("10.51"), "rounded"),
        ("decimal(18,2)", "3.0", Decimal("3.00"), None),
        ("decimal(18,2)", "1e20", None, "failed"),
        ("decimal(18,2)", "x", None, "failed"),
        ("decimal(18,2)", "-0.004", Decimal("0.00"), "rounded"),
        ("decimal(18,2)", " 4.1000 ", Decimal("4.10"), None),
        ("decimal(18,2)", "1.5e1", Decimal("15.00"), None),
        ("decimal(18,2)", "1.255e0", Decimal("1.26"), "rounded"),
        ("decimal(18,2)", "9999999999999999.994", Decimal("9999999999999999.99"), "rounded"),
        ("decimal(18,2)", "9999999999999999.995", None, "failed"),
        ("int", "3.0", 3, None),
        ("int", "3.7", 4, "rounded"),
        ("int", "2147483648", None, "failed"),
        ("int", "-2147483648", -(2**31), None),
        ("bigint", "9223372036854775807", 2**63 - 1, None),
        ("double", "1e400", None, "failed"),
        ("double", "1d", None, "failed"),
        ("double", "-Infinity", float("-inf"), None),
        ("double", ".5", 0.5, None),
        ("date", "2024-02-30", None, "failed"),
        ("date", "2024-02-29", dt.date(2024, 2, 29), None),
        ("boolean", "true", True, None),
        ("boolean", "maybe", None, "failed"),
        ("timestamp", "nonsense", None, "failed"),
    ],
)
def test_values_that_fit_are_rounded_or_fail(spark, kind, text, value, fault):
    assert one(spark, kind, text, "", "  ", None) == ([value, None, None, None], [fault, None, None, None])


def test_days_of_a_stated_format(spark):
    rows = spark.createDataFrame([("21-08-2025",), ("2025-08-21",)], "v string")
    scan = typed(rows, {"v": T.DateType()}, formats={"v": "dd-MM-yyyy"})
    assert {r.v for r in scan.visible.collect()} == {dt.date(2025, 8, 21), None}
    assert [r.faults[0].text for r in scan.faults().collect()] == ["2025-08-21"]


@pytest.mark.parametrize("text", ["10.505", "1e20", "x"])
def test_strict_makes_the_first_fault_an_error(spark, tmp_path, text):
    path = text_file(tmp_path / "p.csv", f"price\n1.00\n{text}\n")
    schema = T.StructType([T.StructField("price", schemas.MONEY)])
    with pytest.raises(Exception, match=f"price: no decimal.*{text}"):
        read_typed_csv(spark, path, schema, strict=True).visible.collect()
    assert read_typed_csv(spark, path, schema).visible.count() == 2


def test_write_counts_faults_and_fills_the_quarantine(spark, tmp_path):
    path = text_file(tmp_path / "p.csv", "price,n,note\n10.505,3.0,a\n3.0,x,b\n1e20,x,c\nx,1,d\n5,5,e\n")
    schema = T.StructType([T.StructField("price", schemas.MONEY), T.StructField("n", T.IntegerType())])
    made = write_typed(read_typed_csv(spark, path, schema), str(tmp_path / "out"), str(tmp_path / "bad"))
    assert made.faults == {"price": {"failed": 2, "rounded": 1}, "n": {"failed": 2}}
    assert read_parquet(spark, str(tmp_path / "out")).dtypes == [("price", "decimal(18,2)"), ("n", "int"), ("note", "string")]
    bad = {r.note: [(f.column, f.text, f.fault) for f in r.faults] for r in read_parquet(spark, str(tmp_path / "bad")).collect()}
    assert bad == {
        "a": [("price", "10.505", "rounded")], "b": [("n", "x", "failed")], "c": [("price", "1e20", "failed"), ("n", "x", "failed")], "d": [("price", "x", "failed")],
    }
    clean = read_typed_csv(spark, text_file(tmp_path / "q.csv", "price,n\n1,2\n"), schema)
    made = write_typed(clean, str(tmp_path / "out2"), str(tmp_path / "bad2"))
    assert (made.faults, made.quarantine) == ({}, None) and not (tmp_path / "bad2").exists()


def test_text_is_scanned_once_for_values_and_counts(spark, tmp_path):
    path = text_file(tmp_path / "p.csv", "price,n\n10.505,3.0\n")
    scan = read_typed_csv(spark, path, schemas.products())
    plan = scan.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_products_job_tells_what_did_not_fit(spark, tmp_path):
    names = schemas.products().names
    row = dict.fromkeys(names, "a") | {"festival_date": "21-08-2025", "units_sold": "3", "discount_pct": "1", "seller_rating": "4", "latitude": "1", "longitude": "2", "price_INR": "1"}
    prices = ["10.505", "3.0", "1e20", "x"]
    lines = [",".join({**row, "revenue_INR": p, "festival_date": "2025/08/21" if p == "x" else row["festival_date"]}[n] for n in names) for p in prices]
    text_file(tmp_path / "products.csv", ",".join(names) + "\n" + "\n".join(lines) + "\n")
    layout = Layout(str(tmp_path))
    report = jobs.build_products(spark, layout)
    assert report.findings == {"unparsed_days": 1, "faults": {"revenue_INR": {"failed": 2, "rounded": 1}}}
    assert report.input_rows == 4 and report.quarantine.rows == 3
    kept = [str(r.revenue_INR) for r in read_parquet(spark, layout.master("products")).orderBy("revenue_INR").collect()]
    assert kept == ["None", "None", "3.00", "10.51"]
    bad = {f.text for r in read_parquet(spark, layout.debug("quarantine/products")).collect() for f in r.faults}
    assert bad == {"10.505", "1e20", "x", "2025/08/21"}
    with pytest.raises(Exception, match="revenue_INR|festival_date|parse"):
        jobs.build_products(spark, layout, strict=True)


def test_weather_job_counts_bad_times_and_makes_no_row_of_them(spark, tmp_path):
    text_file(tmp_path / "raw" / "Agra.csv", "date,temperature_2m,relative_humidity_2m,precipitation\n2024-01-01 00:00:00,1,50,0\nnonsense,2,50,0\n,3,50,0\n2024-01-01 05:00:00,warm,50,1\n")
    layout = Layout(str(tmp_path))
    report = jobs.build_weather_daily(spark, layout)
    assert (report.input_rows, report.output.rows) == (4, 1)
    assert report.findings == {"unparsed_times": 1, "faults": {"temperature_2m": {"failed": 1}}}
    rows = read_parquet(spark, layout.master("weather_daily")).collect()
    assert [(r.city, str(r.date), r.avg_temp_C, r.total_precip_mm) for r in rows] == [("Agra", "2024-01-01", 1.0, 1.0)]
    bad = {(r.city, f.column, f.text) for r in read_parquet(spark, layout.debug("quarantine/weather_daily")).collect() for f in r.faults}
    assert bad == {("Agra", "date", "nonsense"), ("Agra", "temperature_2m", "warm")}
    with pytest.raises(Exception, match="no time: nonsense|no double: warm"):
        jobs.build_weather_daily(spark, layout, strict=True)


def test_account_names_columns_with_faults_only():
    assert fault_account({"failed a b": 2, "rounded a b": 0, "failed c": 0, "rows": 7}) == {"a b": {"failed": 2}}


# --- inference ---------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "values,kind,decimal",
    [
        (["1", "-20", "+3", ""], "int", "int"),
        (["1", "99999999999"], "bigint", "bigint"),
        (["1", "2.50", "-100.125"], "double", "decimal(6,3)"),
        (["1.5", "1e5"], "double", "double"),
        (["99999999999999999999999999999999999999999", "1"], "double", "double"),
        (["007", "12"], "string", "string"),
        (["0", "0.5"], "double", "decimal(2,1)"),
        (["2024-01-01", "2024-02-29"], "date", "date"),
        (["2024-01-01", "2024-02-30"], "string", "string"),
        (["2024-01-01", "2024-01-01 10:00"], "timestamp", "timestamp"),
        (["2024-01-01", "3"], "string", "string"),
        (["true", "FALSE"], "boolean", "boolean"),
        (["true", "1"], "string", "string"),
        (["", " ", None], "string", "string"),
        (["1d", "2"], "string", "string"),
        (["1.", ".5"], "double", "decimal(2,1)"),
        ([".", "1"], "string", "string"),
    ],
)
def test_least_type_of_all_values(spark, values, kind, decimal):
    rows = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    assert infer_schema(rows)[0].dataType.simpleString() == kind
    assert infer_schema(rows, decimals=True)[0].dataType.simpleString() == decimal


@given(st.lists(st.integers(0, 255), max_size=6))
@settings(max_examples=200, deadline=None)
def test_the_lattice_does_not_depend_on_the_order(kinds):
    whole = 0
    for k in kinds:
        whole |= k
    again = 0
    for k in reversed(kinds):
        again |= k
    assert joined_kind(whole, 3, 2) == joined_kind(again, 3, 2)
    # A type that takes more kinds takes each part of them: text is reached from any, and never left.
    if joined_kind(whole, 3, 2) != T.StringType() and kinds and whole:
        assert all(joined_kind(k, 3, 2) != T.StringType() for k in kinds if k)


def test_inference_is_one_scan_and_conversion_reads_what_it_staged(spark, tmp_path):
    path = text_file(tmp_path / "i.csv", "a,b,c\n1,x,2.5\n2,y,3\n")
    raw = read_csv(spark, path)
    with Staging(spark) as share:
        staged, schema = infer_on_the_way(raw, share)
        assert schema.simpleString() == "struct<a:int,b:string,c:double>" == infer_schema(raw).simpleString()
        plan = typed(staged, schema).visible._jdf.queryExecution().executedPlan().toString()
        assert "parquet" in plan.lower() and "csv" not in plan.lower()
    report = jobs.csv_to_parquet(spark, Layout(str(tmp_path)), "i.csv", "out")
    assert report.output.schema == "struct<a:int,b:string,c:double>" and report.output.rows == 2


def test_inferred_types_equal_the_types_that_were_written(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 2**40, 1.5, Decimal("3.25"), dt.date(2024, 1, 1), True, "x"), (None, None, None, None, None, None, None)],
        "i int, l bigint, d double, m decimal(3,2), day date, f boolean, s string",
    )
    rows.write.option("header", True).csv(str(tmp_path / "t.csv"))
    found = infer_schema(read_csv(spark, str(tmp_path / "t.csv")), decimals=True)
    assert [f.dataType.simpleString() for f in found] == ["int", "bigint", "decimal(2,1)", "decimal(3,2)", "date", "boolean", "string"]


# --- families ----------------------------------------------------------------------------------------


@pytest.fixture
def family(tmp_path):
    text_file(tmp_path / "x y" / "a [b]+%.csv", "date,t,h\n1,2,3\n4,5,6\n")
    text_file(tmp_path / "c.csv", "﻿h, t ,extra\n3,2,e\n")
    text_file(tmp_path / "d.csv", '\n\nt,"date"\n7,8\n')
    text_file(tmp_path / "e.csv", "")
    text_file(tmp_path / "f.csv", "date,t,h\n")
    return [f"{tmp_path}/*.csv", f"{tmp_path}/*/*.csv"]


@pytest.mark.parametrize("most_paths", [100, 1])
def test_files_meet_by_the_names_in_their_headers(spark, family, most_paths):
    rows = read_family(spark, family, ["date", "t", "h", "p"], key="city", most_paths=most_paths)
    assert rows.columns == ["date", "t", "h", "p", "extra", "city"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("1", "2", "3", None, None, "a [b]+%"), ("4", "5", "6", None, None, "a [b]+%"), (None, "2", "3", None, "e", "c"), ("8", "7", None, None, None, "d")], key=str
    )


def test_one_scan_per_header(spark, family):
    plan = read_family(spark, family, ["date", "t", "h"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3 == headers(spark, family).select("header").distinct().count()
    assert "Exchange" not in plan


def test_header_that_names_a_column_twice_is_refused(spark, tmp_path):
    text_file(tmp_path / "g.csv", "a,a\n1,2\n")
    with pytest.raises(ValueError, match="every column once"):
        read_family(spark, str(tmp_path / "g.csv"), ["a"])
    assert names_in(' a ;"b;c"', ";") == ["a", "b;c"]


def test_family_of_nothing(spark, tmp_path):
    text_file(tmp_path / "e.csv", "")
    empty = read_family(spark, str(tmp_path / "e.csv"), ["a"], key="k")
    assert empty.columns == ["a", "k"] and empty.count() == 0


def test_weather_of_files_with_any_header(spark, tmp_path):
    text_file(tmp_path / "raw" / "Agra.csv", "date,temperature_2m,relative_humidity_2m,precipitation\n2024-01-01,1,50,0\n")
    text_file(tmp_path / "raw" / "New_Delhi.csv", "relative_humidity_2m,date,note,temperature_2m\n60,2024-01-01,n,2\n")
    layout = Layout(str(tmp_path))
    with pytest.raises(Exception, match="(?i)header"):
        jobs.build_weather_daily(spark, layout)
    jobs.build_weather_daily(spark, layout, headers="any", underscore_as_space=True)
    rows = {r.city: (r.avg_temp_C, r.avg_humidity_pct, r.total_precip_mm) for r in read_parquet(spark, layout.master("weather_daily")).collect()}
    assert rows == {"Agra": (1.0, 50.0, 0.0), "New Delhi": (2.0, 60.0, None)}
    with pytest.raises(ValueError):
        jobs.build_weather_daily(spark, layout, headers="some")
