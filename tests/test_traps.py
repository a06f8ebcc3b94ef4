"""Hand-made rows for the cases where a naive rewrite gives different answers."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marigold.functions.bands import HUMIDITY, TEMPERATURE, band, positive_flag
from marigold.functions.calendar import day_in_zone, parse_day
from marigold.functions.text import items_as_text, key_in_path, label_of, two_decimals
from marigold.operators import explore
from marigold.operators.checks import MissingColumns, require
from marigold.operators.enrich import enrich, match_report, unmatched_sample
from marigold.operators.ranking import collect_top, top_items, top_label
from marigold.operators.summarize import Measures, preaggregate, reported, roll_up, summarize, totals
from marigold.plans import masters, summaries

SALES = (
    "festival string, product_category string, product string, year int, state string, city string, "
    "latitude double, longitude double, festival_date date, revenue_INR decimal(18,2), units_sold int, "
    "price_INR decimal(18,2), discount_pct double, seller_rating double, vendor_type string, payment_methods string"
)


def sale(festival="Holi", category="Toys", product="kite", revenue=10, units=1, price=5, city="Agra", state="UP",
         lat=1.0, lon=2.0, day=date(2025, 8, 21), year=2025, discount=10.0, rating=4.0, vendor="Online", pay="UPI"):
    return (festival, category, product, year, state, city, lat, lon, day, Decimal(revenue), units, Decimal(price),
            discount, rating, vendor, pay)


def sales_of(spark, *rows):
    return spark.createDataFrame(list(rows), SALES)


def values(df, column):
    return [row[column] for row in df.collect()]


# --- join of tables that share names; bands of missing weather ----------------------------------------


WEATHER = "city string, date date, avg_temp_C double, avg_humidity_pct double, total_precip_mm double, year int, month int, day int, state string, latitude double, longitude double"


def reading(city, day, temp, humid, rain):
    return (city, day, temp, humid, rain, day.year, day.month, day.day, "Unknown", 0.0, 0.0)


def test_shared_names_do_not_make_the_weather_join_ambiguous(spark):
    sales = sales_of(spark, sale(revenue=10), sale(revenue=15, price=7))
    weather = spark.createDataFrame([reading("Agra", date(2025, 8, 21), 20.0, 50.0, 0.5)], WEATHER)
    row = summaries.weather_sales_summary(sales, weather).collect()[0]
    assert (row.city, row.date, row.year, row.month) == ("Agra", date(2025, 8, 21), 2025, 8)
    assert (row.temp_bucket, row.humidity_bucket, row.rain_flag) == ("15-25", "40-70", True)
    assert (row.total_revenue, row.total_units, row.avg_price) == (25.0, 2, 6.0)


def test_bands_of_edges_null_and_nan(spark):
    rows = [(None, ">35"), (float("nan"), ">35"), (14.9, "<15"), (15.0, "15-25"), (25.0, "15-25"), (25.1, "25-35"), (35.0, "25-35"), (35.1, ">35")]
    df = spark.createDataFrame(rows, "t double, expected string")
    assert df.filter(band(F.col("t"), TEMPERATURE) != F.col("expected")).count() == 0
    rows = [(None, ">70"), (39.9, "<40"), (40.0, "40-70"), (70.0, "40-70"), (70.1, ">70")]
    df = spark.createDataFrame(rows, "h double, expected string")
    assert df.filter(band(F.col("h"), HUMIDITY) != F.col("expected")).count() == 0


def test_unknown_band_is_optional(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (36.0,)], "t double")
    assert values(df.select(band(F.col("t"), TEMPERATURE, "unknown").alias("b")), "b") == ["unknown", "unknown", ">35"]


def test_rain_flag_is_never_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.1,)], "p double")
    assert values(df.select(positive_flag(F.col("p")).alias("f")), "f") == [False, False, True]


# --- ties and order ----------------------------------------------------------------------------------


def test_ties_at_the_cut_are_kept_and_listed_highest_first(spark):
    amounts = {"a": 10, "b": 20, "c": 30, "d": 40, "e": 50, "g": 10, "f": 5}
    sales = sales_of(spark, *[sale(product=p, revenue=r) for p, r in amounts.items()])
    row = summaries.festival_category_summary(sales).collect()[0]
    assert [(x.product, x.revenue) for x in row.top_products] == [
        ("e", 50.0), ("d", 40.0), ("c", 30.0), ("b", 20.0), ("a", 10.0), ("g", 10.0)]
    row = summaries.festival_category_summary(sales, ties="first").collect()[0]
    assert [x.product for x in row.top_products] == ["e", "d", "c", "b", "a"]


def test_product_totals_span_categories(spark):
    sales = sales_of(spark, sale(category="A", product="x", revenue=6), sale(category="B", product="x", revenue=6), sale(category="B", product="y", revenue=10))
    rows = summaries.festival_category_summary(sales).collect()
    assert len(rows) == 2
    for row in rows:
        assert [(x.product, x.revenue) for x in row.top_products] == [("x", 12.0), ("y", 10.0)]


def test_two_best_categories_give_two_rows(spark):
    sales = sales_of(spark, sale(category="A", revenue=10), sale(category="B", revenue=10), sale(category="C", revenue=1))
    rows = summaries.geo_summary(sales).collect()
    assert sorted(r.top_category for r in rows) == ["A", "B"]
    assert {r.total_revenue for r in rows} == {21.0}
    assert values(summaries.geo_summary(sales, ties="first"), "top_category") == ["A"]


def test_city_with_two_coordinates_repeats_its_label(spark):
    sales = sales_of(spark, sale(category="A", revenue=10, lat=1.0), sale(category="B", revenue=30, lat=9.0))
    rows = {r.latitude: r for r in summaries.geo_summary(sales).collect()}
    assert {lat: r.top_category for lat, r in rows.items()} == {1.0: "B", 9.0: "B"}
    assert (rows[1.0].total_revenue, rows[9.0].total_revenue) == (10.0, 30.0)


def test_null_group_has_totals_but_no_list(spark):
    sales = sales_of(spark, sale(festival=None), sale(city=None, festival="Onam"))
    rows = {r.festival: r for r in summaries.festival_category_summary(sales).collect()}
    assert rows[None].total_revenue == 10.0 and rows[None].top_products is None
    geo = {r.city: r for r in summaries.geo_summary(sales).collect()}
    assert geo[None].total_revenue == 10.0 and geo[None].top_category is None
    assert geo["Agra"].top_category == "Toys"


def test_unknown_ties_rule_is_refused(spark):
    with pytest.raises(ValueError):
        top_items(sales_of(spark, sale()), ["festival"], "product", "revenue_INR", 5, ties="some")


def test_null_measures_rank_last(spark):
    df = spark.createDataFrame([("g", "a", None), ("g", "b", 1)], "g string, i string, m int")
    assert values(top_items(df, ["g"], "i", "m", 1), "i") == ["b"]
    nested = collect_top(top_items(df, ["g"], "i", "m", 5), ["g"], "i", "total", "top", "m").first()
    assert [(x.i, x.m) for x in nested.top] == [("b", 1), ("a", None)]
    assert values(top_label(totals(df, ["g", "i"], "m", "total"), ["g"], "i", "total", "best"), "best") == ["b"]


# --- days, zones and keys ----------------------------------------------------------------------------


def test_bad_days_become_null_or_raise(spark):
    df = spark.createDataFrame([("21-08-2025",), ("2025-08-21",), ("",), ("31-02-2025",), (None,)], "festival_date string")
    assert values(masters.products(df), "festival_date") == [date(2025, 8, 21), None, None, None, None]
    assert values(masters.products(df), "month") == [8, None, None, None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        masters.products(df, strict=True).collect()


def test_days_that_inference_typed_are_left_alone(spark):
    df = spark.createDataFrame([(date(2025, 8, 21), datetime(2025, 8, 21, 5))], "d date, t timestamp")
    assert df.select(parse_day(df, "d"), parse_day(df, "t")).first() == (date(2025, 8, 21), date(2025, 8, 21))


def test_festival_day_replaces_the_text_column(spark):
    df = spark.createDataFrame([("P1", "03-11-2015")], "ProductID string, Date string")
    typed = masters.festival_sales(df)
    assert typed.dtypes == [("ProductID", "string"), ("date", "date")]
    assert typed.first().date == date(2015, 11, 3)


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_days_are_cut_in_the_given_zone(spark, session_zone):
    texts = ["2015-01-01 23:30:00+00:00", "2015-01-02 00:30:00+05:30", "2015-01-01 23:30:00", "2015-01-01T23:30:00", "2015-01-01", "bad"]
    df = spark.createDataFrame([(t,) for t in texts], "at string")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        in_utc = values(df.select(day_in_zone(df, "at").alias("d")), "d")
        in_india = values(df.select(day_in_zone(df, "at", "Asia/Kolkata").alias("d")), "d")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    first, second = date(2015, 1, 1), date(2015, 1, 2)
    assert in_utc == [first, first, first, first, first, None]
    assert in_india == [second, second, first, first, first, None]


def test_days_before_the_epoch(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:59",), ("1970-01-01 00:00:00",)], "at string")
    assert values(df.select(day_in_zone(df, "at").alias("d")), "d") == [date(1969, 12, 31), date(1970, 1, 1)]


def test_keys_in_paths(spark):
    paths = {
        "file:/x/Akbarpur%202.csv": "Akbarpur 2", "file:/x/Akbarpur_2.csv": "Akbarpur_2", "file:/x/A+B.csv": "A+B",
        "file:/x/B.CSV": None, "file:/x/Z%C3%BCrich.csv": "Zürich", "file:/x/plain.parquet": None,
    }
    df = spark.createDataFrame(list(paths.items()), "p string, k string")
    assert df.filter(~key_in_path(F.col("p")).eqNullSafe(F.col("k"))).count() == 0
    spaced = df.select("p", key_in_path(F.col("p"), underscore_as_space=True).alias("k"))
    assert dict(spaced.collect())["file:/x/Akbarpur_2.csv"] == "Akbarpur 2"


# --- aggregates --------------------------------------------------------------------------------------


def test_roll_up_equals_direct_summary(spark):
    rows = [("a", i % 3, Decimal(i), None if i % 4 == 0 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, fine int, m decimal(18,2), x double")
    measures = Measures(sums={"s": "m", "sx": "x"}, means={"mean": "x", "mm": "m"}, rows="n")
    direct = summarize(df, ["k"], measures).collect()
    two_steps = reported(roll_up(preaggregate(df, ["k", "fine"], measures), ["k"]), ["k"], measures).collect()
    assert direct == two_steps
    assert direct[0].asDict() == {"k": "a", "s": 780.0, "sx": 600.0, "n": 40, "mean": 20.0, "mm": 19.5}


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, m decimal(18,2)")
    row = summarize(df, ["k"], Measures(sums={"s": "m"}, means={"mean": "m"}, rows="n")).first()
    assert (row.s, row.mean, row.n) == (None, None, 1)


def test_decimal_totals_are_exact(spark):
    df = spark.createDataFrame([(Decimal("0.10"),)] * 10, "m decimal(18,2)").withColumn("k", F.lit("a"))
    assert summarize(df, ["k"], Measures(sums={"s": "m"})).first().s == 1.0


@pytest.mark.parametrize("kind", ["decimal(18,2)", "decimal(18,6)", "decimal(18,0)", "decimal(7,2)", "decimal(18,7)", "decimal(30,4)"])
def test_every_decimal_adds_up_exactly(spark, kind):
    precision, scale = map(int, kind[8:-1].split(","))
    top = Decimal(10**min(precision, 24) - 1).scaleb(-scale)
    cases = [top, -top, top, Decimal(1).scaleb(-scale), Decimal(-1).scaleb(-scale), Decimal(0), -top / 3, top / 7]
    cases = [c.quantize(Decimal(1).scaleb(-scale)) for c in cases] * 5 + [None]
    df = spark.createDataFrame([("a", c) for c in cases], f"k string, m {kind}").repartition(3)
    expected = sum(c for c in cases if c is not None)
    total = totals(df, ["k"], "m", "t").first().t
    assert total == expected
    assert summarize(df, ["k"], Measures(means={"mean": "m"})).first().mean == float(expected) / 40


def test_declared_digits_make_double_sums_exact(spark):
    rows = [("a", x / 100) for x in range(-1000, 100_000, 7)] + [("b", None), ("c", 0.1), ("c", 0.2)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    got = {r.k: r.t for r in totals(df, ["k"], "x", "t", minor_digits=2).collect()}
    assert got == {"a": Decimal(sum(range(-1000, 100_000, 7))).scaleb(-2), "b": None, "c": Decimal("0.30")}
    with pytest.raises(ValueError):
        totals(df, ["k"], "x", "t", minor_digits=9)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        totals(df.select("k", F.lit(float("nan")).alias("x")), ["k"], "x", "t", minor_digits=2).collect()


def test_weather_day_rolls_up_readings(spark):
    rows = [("Agra", "2015-01-01 00:00:00", 10.0, 40.0, 0.0), ("Agra", "2015-01-01 23:00:00", 20.0, None, 0.5), ("Agra", "2015-01-02 00:00:00", None, None, None)]
    df = spark.createDataFrame(rows, "city string, date string, temperature_2m double, relative_humidity_2m double, precipitation double")
    first, second = masters.weather_daily(df).orderBy("date").collect()
    assert (first.avg_temp_C, first.avg_humidity_pct, first.total_precip_mm, first.rain_flag) == (15.0, 40.0, 0.5, True)
    assert (first.year, first.month, first.day, first.state, first.latitude, first.longitude) == (2015, 1, 1, "Unknown", 0.0, 0.0)
    assert (second.avg_temp_C, second.total_precip_mm, second.rain_flag) == (None, None, False)


def test_kpis_and_vendor_summary(spark):
    sales = sales_of(spark, sale(revenue=10, units=2, price=5, discount=10.0, rating=4.0), sale(revenue=20, units=3, price=6, discount=None, rating=5.0))
    row = summaries.overall_kpis(sales).first()
    assert row.asDict() == {
        "date": date(2025, 8, 21), "total_revenue": 30.0, "total_units": 5, "total_tx": 2, "avg_price": 5.5,
        "avg_discount": 10.0, "avg_seller_rating": 4.5, "year": 2025, "month": 8, "day": 21}
    row = summaries.payment_vendor_summary(sales).first()
    assert row.asDict() == {"vendor_type": "Online", "payment_methods": "UPI", "year": 2025, "total_revenue": 30.0, "total_units": 5, "avg_discount": 10.0}


def test_double_money_works_as_it_is(spark):
    sales = sales_of(spark, sale(revenue=10), sale(revenue=20)).withColumn("revenue_INR", F.col("revenue_INR").cast("double"))
    assert summaries.overall_kpis(sales).first().total_revenue == 30.0
    assert summaries.festival_category_summary(sales).first().top_products[0].revenue == 30.0


# --- unmatched rows ----------------------------------------------------------------------------------


def weather_case(spark):
    day = date(2025, 8, 21)
    sales = sales_of(
        spark, sale(city="Agra"), sale(city="Agra"), sale(city="Bhuj"), sale(city=None), sale(city="Cuttack"), sale(city="Cuttack"), sale(city="Cuttack"))
    weather = spark.createDataFrame([reading("Agra", day, 20.0, 50.0, 0.0), reading("Bhuj", day, None, 50.0, 0.0), reading(None, day, 1.0, 1.0, 0.0)], WEATHER)
    return sales, weather, day


def test_report_tells_missing_keys_from_missing_measures(spark):
    sales, weather, _ = weather_case(spark)
    report = summaries.unmatched_report(summaries.sales_days_with_weather(sales, weather)).first()
    assert report.asDict() == {"total_rows": 7, "no_key": 4, "no_measure": 5, "unmatched_ratio": 5 / 7, "alarm": True}


def test_report_by_rows_equals_report_by_days(spark):
    sales, weather, _ = weather_case(spark)
    rows = enrich(sales, weather, {"city": "city", "festival_date": "date"}, ["avg_temp_C"])
    days = summaries.sales_days_with_weather(sales, weather)
    assert match_report(rows, "avg_temp_C").first() == summaries.unmatched_report(days).first()


def test_sample_by_days_equals_sample_by_rows(spark):
    sales, weather, day = weather_case(spark)
    days = summaries.sales_days_with_weather(sales, weather)
    rows = enrich(sales, weather, {"city": "city", "festival_date": "date"}, ["avg_temp_C"]).withColumnRenamed("festival_date", "join_date")
    for n in (1, 3, 4, 10):
        by_rows = unmatched_sample(rows, ["city", "join_date"], "avg_temp_C", n).collect()
        assert summaries.unmatched_days_sample(days, n).collect() == by_rows
    assert by_rows == [(None, day), ("Bhuj", day), ("Cuttack", day), ("Cuttack", day), ("Cuttack", day)]


def test_report_of_no_rows_has_no_alarm(spark):
    sales, weather, _ = weather_case(spark)
    report = summaries.unmatched_report(summaries.sales_days_with_weather(sales.limit(0), weather)).first()
    assert report.asDict() == {"total_rows": 0, "no_key": 0, "no_measure": 0, "unmatched_ratio": 0.0, "alarm": False}


def join_first(sales, weather):
    """The weather summary in its plain form: row-level join, then one aggregate."""
    rows = enrich(sales, weather, {"city": "city", "festival_date": "date"}, ["avg_temp_C", "avg_humidity_pct", "total_precip_mm"])
    keyed = rows.select(
        "city", F.col("festival_date").alias("date"), F.year("festival_date").alias("year"), F.month("festival_date").alias("month"),
        band(F.col("avg_temp_C"), TEMPERATURE).alias("temp_bucket"), band(F.col("avg_humidity_pct"), HUMIDITY).alias("humidity_bucket"),
        positive_flag(F.col("total_precip_mm")).alias("rain_flag"), "revenue_INR", "units_sold", "price_INR")
    keys = ["city", "date", "year", "month", "temp_bucket", "humidity_bucket", "rain_flag"]
    return summarize(keyed, keys, summaries.SALES)


def test_aggregate_first_equals_join_first_even_with_repeated_weather(spark):
    sales, weather, day = weather_case(spark)
    again = spark.createDataFrame([reading("Agra", day, 40.0, 90.0, 1.0), reading("Agra", day, 21.0, 51.0, 0.0)], WEATHER)
    for right in (weather, weather.union(again)):
        ours = summaries.weather_sales_summary(sales, right)
        plain = join_first(sales, right)
        assert sorted(map(str, ours.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


# --- checks and exploration --------------------------------------------------------------------------


def test_require_names_every_fault_and_minds_case(spark):
    df = spark.createDataFrame([("x", 1)], "City string, units int")
    with pytest.raises(MissingColumns, match="city, revenue"):
        require(df, ["city", "revenue", "units"])
    with pytest.raises(MissingColumns, match=r"units \(int\)"):
        from pyspark.sql.types import StringType
        require(df, {"units": StringType})
    with pytest.raises(MissingColumns, match="revenue_INR"):
        summaries.overall_kpis(df)


def test_correlation_of_constant_and_holey_columns(spark):
    rows = [(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, 1.0), (3.0, 7.0, 7.0, None), (4.0, None, 7.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("name", F.lit("x"))
    r = {(row.x, row.y): row.r for row in explore.corr_matrix(df).collect()}
    assert len(r) == 16
    assert r["a", "a"] == 1.0 and r["c", "c"] is None and r["a", "c"] is None
    assert r["a", "b"] == r["b", "a"] == pytest.approx(0.99339927)
    assert r["a", "d"] == pytest.approx(1.0)
    assert r["b", "d"] is None
    opposite = spark.createDataFrame([(1.0, -1.0, 0.1), (2.0, -2.0, 0.1), (float("nan"), 5.0, 0.1), (3.0, -3.0, 0.1)], "a double, b double, c double")
    r = {(row.x, row.y): row.r for row in explore.corr_matrix(opposite.repartition(4)).collect()}
    assert r["b", "a"] == pytest.approx(-1.0) and r["a", "c"] is None and r["c", "b"] is None
    with pytest.raises(ValueError):
        explore.corr_matrix(df.select("a", "name"))


def test_correlations_of_many_columns_and_partitions(spark):
    columns = [f"c{i}" for i in range(8)]
    df = spark.range(500).select(*[F.pmod(F.hash("id", F.lit(i)), F.lit(97 + i)).alias(c) for i, c in enumerate(columns)])
    df = df.withColumn("c1", F.when(F.col("c0") > 9, F.col("c1") + 1e6)).repartition(7)
    r = {(row.x, row.y): row.r for row in explore.corr_matrix(df).collect()}
    expected = df.toPandas().corr()
    assert len(r) == 64
    for (x, y), value in r.items():
        assert value == pytest.approx(expected.loc[x, y], abs=1e-9)


def test_cards_choose_sum_or_mean_by_name(spark):
    df = spark.createDataFrame([("x", 1000.0, 3, 1.0, 2.0, 9), ("y", 234567.5, 4, 2.005, None, 9)],
                               "name string, total_revenue double, total_units int, avg_price double, total_tx double, fifth int")
    cards = explore.metric_cards(df).collect()
    assert [(c.label, c.value) for c in cards] == [
        ("Total Revenue", "₹235,568"), ("Total Units", "7"), ("Avg Price", "1.50"), ("Total Tx", "2.00")]
    assert cards[1].spread == "0.71" and cards[3].spread is None
    assert explore.metric_cards(df.limit(1)).first().spread is None
    assert explore.metric_cards(df, kinds={"total_tx": "sum"}).collect()[3].value == "2"


def test_numbers_round_like_the_reports_do(spark):
    df = spark.createDataFrame([(0.125, "0.12"), (1.005, "1.00"), (1234.5, "1234.50"), (-0.375, "-0.38")], "x double, t string")
    assert df.filter(two_decimals(F.col("x")) != F.col("t")).count() == 0
    assert label_of("temperature_2m") == "Temperature 2M"


def test_item_lists_as_text(spark):
    df = spark.sql("select array(named_struct('product','A','revenue',1234.4D), named_struct('product','B','revenue',567D)) as l "
                   "union all select cast(null as array<struct<product:string,revenue:double>>)")
    assert values(df.select(items_as_text(F.col("l")).alias("t")), "t") == ["A (₹1,234), B (₹567)", "N/A"]
    assert values(explore.preview(df), "l") == ["A (₹1,234), B (₹567)", "N/A"]


def test_shares_leave_out_rows_without_a_name(spark):
    df = spark.createDataFrame([("a", 30), ("a", 30), ("b", 40), (None, 900)], "n string, v int")
    assert sorted(explore.share_data(df, "n", "v").collect()) == [("a", 60, 60.0), ("b", 40, 40.0)]


def test_value_filter_with_null_and_default(spark):
    df = spark.createDataFrame([(v,) for v in ("f", "a", "b", None, "c", "d", "e", "a")], "v string")
    assert sorted(values(explore.filter_values(df, "v"), "v")) == ["a", "a", "b", "c", "d", "e"]
    assert set(values(explore.filter_values(df, "v", ["f", None]), "v")) == {"f", None}
    assert values(explore.filter_values(df, "v", []), "v") == []
    assert explore.distinct_values(df, "v").count() == 7
    few = df.filter("v in ('a', 'b') or v is null")
    assert few.count() == explore.filter_values(few, "v").count()


def test_chart_data(spark):
    df = spark.createDataFrame([("x", "r", 1.0, 10, 2024), ("x", "s", 2.0, 20, 2023), ("y", "r", 4.0, 40, 2022)], "c string, g string, v double, w int, year int")
    assert sorted(explore.bar_data(df, "c", "v").collect()) == [("x", 3.0), ("y", 4.0)]
    assert len(explore.bar_data(df, "c", "v", "g").collect()) == 3
    assert explore.line_data(df, "year", "v").collect() == [(2022, 4.0), (2023, 2.0), (2024, 1.0)]
    assert explore.line_data(df, "year", "v", "c").collect() == [("x", 2023, 2.0), ("x", 2024, 1.0), ("y", 2022, 4.0)]
    assert explore.scatter_data(df, "v", "w", "c").columns == ["v", "w", "c"]
    for bad in (lambda: explore.line_data(df, "v", "w"), lambda: explore.scatter_data(df, "v", "v"), lambda: explore.scatter_data(df, "v", "c")):
        with pytest.raises(ValueError):
            bad()


def test_digits_are_declared_by_column_and_never_rounded_away(spark):
    df = spark.createDataFrame([(0.1, 4.567), (0.2, 0.004)], "a double, b double")
    measures = Measures(sums={"x": "a", "y": "b"}, minor_digits={"a": 1, "b": 3})
    assert summarize(df, [], measures).first().asDict() == {"x": 0.3, "y": 4.571}
    with pytest.raises(Exception, match="more than 2 decimal digits"):
        summarize(df, [], Measures(sums={"y": "b"}, minor_digits=2)).collect()


def test_a_table_can_be_enriched_twice(spark):
    sales = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "city string, n int")
    first = spark.createDataFrame([("a", 10.0)], "place string, t double")
    second = spark.createDataFrame([("b", 5.0)], "town string, h double")
    both = enrich(enrich(sales, first, {"city": "place"}, ["t"]), second, {"city": "town"}, ["h"], marker="__second")
    assert match_report(both, "t").first().no_key == 2
    assert match_report(both, "h", marker="__second", threshold=0.7).first().asDict()["alarm"] is False
    with pytest.raises(ValueError, match="another marker"):
        enrich(both, second, {"city": "town"}, [])
