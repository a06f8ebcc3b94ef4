"""Readers, file families, writers, and the jobs end to end on files in a temporary folder."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from marigold import staging
from marigold.plans import jobs
from marigold.plans.jobs import Layout
from marigold.sources import schemas
from marigold.sources.files import choose_files, chosen_paths, keep_listed, list_files, with_file_key
from marigold.sources.sinks import export_csv, write_parquet, write_table
from marigold.sources.tables import if_exists, read_csv, read_parquet, read_table, uri

WEATHER_HEADER = "date,temperature_2m,relative_humidity_2m,precipitation\n"


def text_file(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def files_below(folder, suffix):
    return sorted(p for p in folder.rglob(f"*{suffix}") if not p.name.startswith((".", "_")))


# --- scans -------------------------------------------------------------------------------------------


def test_uri_joins_without_doubled_slashes():
    assert uri("s3a://bucket/", "/raw/a.csv") == "s3a://bucket/raw/a.csv"
    assert uri("file:/x", "a", "/b") == "file:/x/a/b"


def test_types_follow_the_header_not_the_position(spark, tmp_path):
    path = text_file(tmp_path / "p.csv", "units_sold,extra,revenue_INR,product\n3,e,10.50,kite\nmany,e,1.25,ball\n")
    df = read_csv(spark, path, schemas.products())
    assert df.dtypes == [("units_sold", "int"), ("extra", "string"), ("revenue_INR", "decimal(18,2)"), ("product", "string")]
    assert [(r.units_sold, float(r.revenue_INR)) for r in df.collect()] == [(3, 10.5), (None, 1.25)]


def test_ambiguous_header_is_read_by_position(spark, tmp_path):
    path = text_file(tmp_path / "f.csv", "Date,date\n03-11-2015,ignored\n")
    schema = schemas.T.StructType([schemas.T.StructField("Date", schemas.T.StringType()), schemas.T.StructField("other", schemas.T.StringType())])
    assert read_csv(spark, path, schema, by="position").columns == ["Date", "other"]
    with pytest.raises(ValueError):
        read_csv(spark, path, schema, by="guess")


def test_inference_is_available(spark, tmp_path):
    path = text_file(tmp_path / "i.csv", "a,b\n1,x\n2,y\n")
    assert read_csv(spark, path, infer=True).dtypes == [("a", "int"), ("b", "string")]
    assert read_csv(spark, path).dtypes == [("a", "string"), ("b", "string")]


def test_file_name_gives_the_key_for_glob_and_list(spark, tmp_path):
    names = ["Akbarpur 2", "Akbarpur_2", "A+B", "Zürich"]
    paths = [text_file(tmp_path / f"{name}.csv", WEATHER_HEADER + f"2015-01-01 00:00:00,{i},1,0\n") for i, name in enumerate(names)]
    by_glob = with_file_key(read_csv(spark, str(tmp_path / "*.csv"), schemas.weather()), "city")
    by_list = with_file_key(read_csv(spark, paths, schemas.weather()), "city")
    expected = {name: float(i) for i, name in enumerate(names)}
    for df in (by_glob, by_list):
        assert {r.city: r.temperature_2m for r in df.collect()} == expected


def test_files_chosen_by_names(spark, tmp_path):
    for name in ("Akbarpur_2", "New Delhi", "New_Delhi", "Unlisted"):
        text_file(tmp_path / "Cities" / f"{name}.csv", WEATHER_HEADER)
    text_file(tmp_path / "Cities" / "notes.txt", "x")
    names = read_csv(spark, text_file(tmp_path / "names.csv", "City Name\n Akbarpur 2 \n\nNew Delhi\nNowhere\nNew Delhi\n"), schemas.city_list())
    chosen = choose_files(spark, str(tmp_path / "Cities"), names, "City Name")
    found = {r.name: r.key for r in chosen.collect()}
    assert found == {"Akbarpur 2": "Akbarpur_2", "New Delhi": "New_Delhi", "Nowhere": None}
    assert [p.rsplit("/", 1)[1] for p in chosen_paths(chosen)] == ["Akbarpur_2.csv", "New_Delhi.csv"]


def test_exact_name_is_the_fallback(spark, tmp_path):
    text_file(tmp_path / "New Delhi.csv", WEATHER_HEADER)
    names = spark.createDataFrame([("New Delhi",)], "city string")
    chosen = choose_files(spark, str(tmp_path), names, "city")
    assert [(r.name, r.key) for r in chosen.collect()] == [("New Delhi", "New Delhi")]
    assert read_csv(spark, chosen_paths(chosen), schemas.weather()).count() == 0


def test_rows_on_and_off_the_list(spark):
    names = spark.createDataFrame([(" Akbarpur 2 ",), ("",), ("Agra",)], "n string")
    rows = spark.createDataFrame([("Akbarpur_2",), ("Akbarpur 2",), ("Agra",), ("Bhuj",), (None,)], "city string")
    assert sorted(r.city for r in keep_listed(rows, "city", names, "n").collect()) == ["Agra", "Akbarpur 2", "Akbarpur_2"]
    assert {r.city for r in keep_listed(rows, "city", names, "n", listed=False).collect()} == {"Bhuj", None}


def test_listing_shows_data_files_only(spark, tmp_path):
    text_file(tmp_path / "a" / "x.csv", "h\n1\n")
    text_file(tmp_path / "y.txt", "no")
    write_parquet(spark.range(3).toDF("n"), str(tmp_path / "b"))
    names = [r.path.rsplit("/", 1)[1] for r in list_files(spark, str(tmp_path)).collect()]
    assert len(names) >= 2 and all(n.endswith((".csv", ".parquet")) for n in names)


def test_missing_source_is_none_and_other_errors_are_raised(spark, tmp_path):
    assert if_exists(lambda: read_csv(spark, str(tmp_path / "none.csv"))) is None
    assert if_exists(lambda: read_parquet(spark, str(tmp_path / "none"))) is None
    with pytest.raises(AnalysisException):
        if_exists(lambda: spark.range(1).select("nope"))


def test_load_by_extension(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 2024)], "a int, b string, year int")
    write_parquet(df, str(tmp_path / "t"), ["year"])
    export_csv(df, str(tmp_path / "t.csv"))
    assert read_table(spark, str(tmp_path / "t")).select("a", "b", "year").collect() == df.collect()
    assert read_table(spark, str(tmp_path / "t.csv"), schema=df.schema).collect() == df.collect()


# --- sinks -------------------------------------------------------------------------------------------


def test_partition_values_keep_their_stated_type(spark, tmp_path):
    df = spark.createDataFrame([("007", 1), ("", 2), (None, 3)], "state string, n int")
    path = str(tmp_path / "s")
    write_parquet(df, path, ["state"])
    assert {r.state for r in read_parquet(spark, path).collect()} == {7, None}
    assert {r.state for r in read_parquet(spark, path, {"state": "string"}).collect()} == {"007", None}


def test_overwrite_replaces_all_unless_dynamic(spark, tmp_path):
    path = str(tmp_path / "o")
    both = spark.createDataFrame([(1, 2024), (2, 2025)], "n int, year int")
    later = spark.createDataFrame([(9, 2025)], "n int, year int")
    write_parquet(both, path, ["year"])
    write_parquet(later, path, ["year"], dynamic=True)
    assert sorted(r.n for r in read_parquet(spark, path).collect()) == [1, 9]
    write_parquet(later, path, ["year"])
    assert [r.n for r in read_parquet(spark, path).collect()] == [9]


def test_write_reports_rows_schema_and_metrics(spark, tmp_path):
    df = spark.range(100).withColumn("year", (F.col("id") % 3).cast("int")).withColumn("w", F.lit(2))
    written = write_table(df, str(tmp_path / "w"), partition_by=["year"], metrics={"weight": F.sum("w")}, hidden=["w"])
    assert (written.rows, written.metrics, written.schema) == (100, {"weight": 200}, "struct<id:bigint,year:int>")
    assert set(read_parquet(spark, written.path).columns) == {"id", "year"}


def test_csv_header_is_optional(spark, tmp_path):
    df = spark.createDataFrame([("Agra", date(2025, 1, 1))], "city string, day date")
    export_csv(df, str(tmp_path / "h"), header=False)
    assert "".join(f.read_text() for f in files_below(tmp_path / "h", ".csv")) == "Agra,2025-01-01\n"


def test_hot_partition_is_written_by_many_tasks_and_small_ones_by_few(spark, tmp_path):
    # Nine tenths of all rows fall in one month; each of 40 map tasks holds rows of every month.
    rows = spark.range(0, 400_000, 1, 40).select(
        F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id") % 12 + 1).cast("int").alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        write_parquet(rows, str(tmp_path / "m"), ["month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {folder.name: len(files_below(folder, ".parquet")) for folder in (tmp_path / "m").iterdir() if folder.is_dir()}
    hot = files.pop("month=1")
    assert 1 < hot < 40
    # A small month has one file, or one per split where its hash shares a shuffle partition with the hot one.
    assert set(files.values()) <= {1, hot}
    assert 1 in files.values()
    assert read_parquet(spark, str(tmp_path / "m")).count() == 400_000


# --- staging -----------------------------------------------------------------------------------------


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = staging.shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder
    assert staging.scratch_path(spark, "x") != staging.scratch_path(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master = "yarn"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


# --- jobs --------------------------------------------------------------------------------------------


PRODUCTS_HEADER = ("product_id,product,product_category,festival,festival_date,revenue_INR,units_sold,price_INR,discount_pct,"
                   "seller_rating,state,city,latitude,longitude,vendor_type,payment_methods\n")


@pytest.fixture(scope="module")
def raw_base(tmp_path_factory):
    base = tmp_path_factory.mktemp("base")
    text_file(base / "Festival_Sales.csv",
              "ProductID,ProductName,Category,Sales,State,Region,City,Latitude,Longitude,Date,Festival\n"
              "P1,Kite,Toys,10.5,UP,North,Agra,27.1,78.0,03-11-2015,Diwali\nP2,Ball,Toys,1,UP,North,Agra,27.1,78.0,2015/11/03,Diwali\n")
    lines = [
        f"{i},item{i % 7},cat{i % 3},fest{i % 2},{1 + i % 28:02d}-0{1 + i % 3}-2025,{i}.25,{1 + i % 4},{5 + i % 2}.50,{i % 30},4.{i % 10},"
        f"state{i % 2},{'Agra' if i % 4 else 'Bhuj'},1.0,2.0,{'Online' if i % 2 else 'Shop'},UPI"
        for i in range(200)
    ]
    text_file(base / "products.csv", PRODUCTS_HEADER + "\n".join(lines) + "\n")
    for city, warm in (("Agra", 20), ("Akbarpur_2", 30)):
        hours = [f"2025-0{m}-{d:02d} {h:02d}:00:00+00:00,{warm + h / 10},{50 + h},{0.1 if d % 2 else 0}" for m in (1, 2, 3) for d in range(1, 29) for h in range(0, 24, 6)]
        text_file(base / "raw" / f"{city}.csv", WEATHER_HEADER + "\n".join(hours) + "\n")
    text_file(base / "names.csv", "City Name\nAgra\nAkbarpur 2\nNowhere\n")
    return base


def test_all_jobs_end_to_end(spark, raw_base):
    layout = Layout(str(raw_base))
    festival, products, weather = jobs.build_masters(spark, layout)
    assert (festival.status, festival.input_rows, festival.findings) == ("done", 2, {"unparsed_days": 1})
    assert (products.input_rows, products.output.rows, products.findings) == (200, 200, {"unparsed_days": 0})
    assert (weather.input_rows, weather.output.rows) == (2 * 84 * 4, 2 * 84)
    master = read_parquet(spark, layout.master("products"))
    assert {"festival_date", "year", "month", "day"} <= set(master.columns)
    assert master.select(F.sum("revenue_INR")).first()[0] == sum(range(200)) + 50

    reports = {name: jobs.JOBS[name](spark, layout) for name in jobs.JOBS if name in jobs.PARTITIONS and name not in ("festival_sales", "products", "weather_daily")}
    assert set(reports) == {"overall_kpis", "festival_category_summary", "geo_summary", "weather_sales_summary", "payment_vendor_summary"}
    for name, report in reports.items():
        assert report.input_rows == 200
        back = read_parquet(spark, layout.summary(name))
        assert back.count() == report.output.rows > 0
        assert back.select(F.sum("total_revenue")).first()[0] == sum(range(200)) + 50, name
    findings = reports["weather_sales_summary"].findings
    assert (findings["total_rows"], findings["no_key"], findings["no_measure"], findings["alarm"]) == (200, 50, 50, True)
    sample = read_csv(spark, findings["sample"] + "/*.csv", header=False).collect()
    assert len(sample) == 10 and {row[0] for row in sample} == {"Bhuj"}


def test_weather_of_listed_cities_only(spark, raw_base, tmp_path):
    layout = Layout(str(raw_base))
    report = jobs.build_weather_daily(spark, layout, source="raw", names="names.csv", underscore_as_space=True)
    assert report.findings == {"files": 2, "names_without_file": 1}
    cities = {r.city for r in read_parquet(spark, layout.master("weather_daily")).select("city").distinct().collect()}
    assert cities == {"Agra", "Akbarpur 2"}


def test_missing_sources_are_reported(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert [r.status for r in jobs.build_masters(spark, layout)] == ["missing"] * 3
    assert jobs.build_weather_daily(spark, layout, source="raw", names="none.csv").status == "missing"
    assert jobs.csv_to_parquet(spark, layout, "none.csv", "out").status == "missing"
    with pytest.raises(AnalysisException):
        jobs.run_overall_kpis(spark, layout)


def test_csv_to_parquet_and_inspect(spark, raw_base):
    layout = Layout(str(raw_base))
    report = jobs.csv_to_parquet(spark, layout, "/products.csv", "converted")
    assert report.output.rows == 200 and len(report.findings["first_rows"]) == 5
    assert read_parquet(spark, layout.raw("converted")).count() == 200
    found, missing = jobs.inspect(spark, layout, "names.csv", "none.csv")
    assert found.findings["columns"] == [(0, "City Name", "string")] and len(found.findings["first_rows"]) == 3
    assert missing.status == "missing"


def test_command_line(spark, raw_base, capsys, monkeypatch):
    from marigold.__main__ import main

    main(["festival_sales", "--base", str(raw_base)])
    printed = json.loads(capsys.readouterr().out)
    assert printed[0]["status"] == "done" and printed[0]["output"]["rows"] == 2
    main(["inspect", "--base", str(raw_base), "--source", "names.csv"])
    assert json.loads(capsys.readouterr().out)[0]["findings"]["source"] == "names.csv"


def test_files_with_different_headers_are_not_mixed_up(spark, tmp_path):
    text_file(tmp_path / "cities" / "a.csv", "date,temperature_2m,relative_humidity_2m,precipitation\n2024-01-01,1,50,0\n")
    text_file(tmp_path / "cities" / "b.csv", "date,relative_humidity_2m,temperature_2m,precipitation\n2024-01-01,50,1,0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "cities" / "*.csv"), schemas.weather()).collect()


def test_festival_columns_follow_their_names(spark, tmp_path):
    names = schemas.festival_sales().names
    row = dict(zip(names, ("p1", "kite", "toys", "10.5", "s", "r", "c", "1", "2", "03-11-2015", "f")))
    order = ["Date", *[n for n in names if n != "Date"], "Extra"]
    text_file(tmp_path / "Festival_Sales.csv", ",".join(order) + "\n" + ",".join({**row, "Extra": "e"}[n] for n in order) + "\n")
    layout = jobs.Layout(str(tmp_path))
    jobs.build_festival_sales(spark, layout)
    got = read_parquet(spark, layout.master("festival_sales")).first()
    assert (got.ProductID, got.Sales, str(got.date), got.Extra) == ("p1", 10.5, "2015-11-03", "e")
    text_file(tmp_path / "Other.csv", "Date,ProductID\n03-11-2015,p1\n")
    with pytest.raises(Exception, match="does not hold the columns"):
        jobs.build_festival_sales(spark, layout, source="Other.csv")


def test_chosen_files_lie_in_the_folder_itself(spark, tmp_path):
    for folder in ("Cities", "Cities/old"):
        text_file(tmp_path / folder / "Agra.csv", "date,temperature_2m,relative_humidity_2m,precipitation\n2024-01-01,1,50,1\n")
    names = spark.createDataFrame([("Agra",)], ["City Name"])
    assert len(chosen_paths(choose_files(spark, str(tmp_path / "Cities"), names, "City Name"))) == 1


@pytest.mark.parametrize("argv", [["overall_kpis", "--source", "x"], ["masters", "--zone", "UTC"], ["csv_to_parquet", "--source", "x"]])
def test_options_that_a_job_does_not_take_are_usage_errors(argv):
    from marigold.__main__ import main

    with pytest.raises(SystemExit) as stopped:
        main([*argv, "--base", "/nowhere"])
    assert stopped.value.code == 2
