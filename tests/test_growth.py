"""Plans whose cost must not grow with columns or with the rows of one colour."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

from marigold.operators import explore
from marigold.sources import schemas
from marigold.sources.typed import infer_schema, lattice_rows, typed

COMPILED = 8_000  # bytes of a method beyond which it is never compiled


def largest_method(df) -> int:
    codes = df._jdf.queryExecution().debug().codegenToSeq()
    return max((codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())), default=0)


def texts(spark, names):
    return spark.createDataFrame([("1",) * len(names)], T.StructType([T.StructField(n, T.StringType()) for n in names]))


def test_converting_many_columns_stays_compiled_code(spark, tmp_path):
    names = schemas.products().names
    texts(spark, names).write.option("header", True).csv(str(tmp_path / "p.csv"))
    scan = typed(spark.read.option("header", True).csv(str(tmp_path / "p.csv")), schemas.products())
    assert largest_method(scan.rows) < COMPILED
    assert largest_method(scan.faults()) < COMPILED


def test_values_at_the_ends_of_their_types(spark):
    kinds = {"b": T.ByteType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DecimalType(4, 2), "w": T.DecimalType(38, 0)}
    rows = [
        ("127", "2147483647", "9223372036854775807", "99.994", "9" * 38),
        ("128", "2147483648", "9223372036854775808", "99.995", "1" + "0" * 38),
        ("-128.0", "-2147483648", "-9223372036854775808", "-99.99", " "),
        ("-129", "+7", "1e3", "1e1", "x"),
    ]
    scan = typed(spark.createDataFrame(rows, "b string, i string, l string, d string, w string"), kinds)
    got = [tuple(r) for r in scan.visible.collect()]
    assert got == [
        (127, 2147483647, 9223372036854775807, Decimal("99.99"), Decimal("9" * 38)),
        (None, None, None, None, None),
        (-128, -2147483648, -9223372036854775808, Decimal("-99.99"), None),
        (None, 7, 1000, Decimal("10.00"), None),
    ]
    faults = [sorted((e["column"], e["fault"]) for e in r["faults"]) for r in scan.faults().collect()]
    assert faults == [[("d", "rounded")], [(c, "failed") for c in "bdilw"], [("b", "failed"), ("w", "failed")]]


def test_each_text_is_converted_once_where_rows_with_faults_are_found(spark):
    faults = typed(spark.createDataFrame([("1",)], "n string"), {"n": T.IntegerType()}).faults()
    assert faults._jdf.queryExecution().optimizedPlan().toString().count("as decimal(38,0))") == 1


def test_inference_of_many_columns_stays_compiled_code(spark, tmp_path):
    names = [f"c{i}" for i in range(40)]
    texts(spark, names).write.option("header", True).csv(str(tmp_path / "t.csv"))
    raw = spark.read.option("header", True).csv(str(tmp_path / "t.csv"))
    assert largest_method(lattice_rows(raw)) < COMPILED
    assert infer_schema(raw).simpleString() == "struct<" + ",".join(f"{n}:int" for n in names) + ">"


def test_only_rows_near_the_limit_of_a_large_colour_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(explore, "LARGE_COLOUR", 50, raising=False)
    rows = [(float(i), float(i * 7 % 1000), None if i % 3 == 0 else "few" if i % 100 == 1 else "many") for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, y double, c string").repartition(4)
    sample = explore.scatter_sample(df, "x", "y", "c", 20, ["x"])
    got = [tuple(r) for r in sample.collect()]
    sizes = {c: sum(r[2] == c for r in rows) for c in (None, "few", "many")}
    assert {c: sum(r[2] == c for r in got) for c in sizes} == {c: min(20, n) for c, n in sizes.items()}
    assert {(c, share) for _, _, c, share in got} == {(c, min(1.0, 20 / n)) for c, n in sizes.items()}
    monkeypatch.setattr(explore, "LARGE_COLOUR", 1_000_000, raising=False)
    assert sorted(map(str, explore.scatter_sample(df, "x", "y", "c", 20, ["x"]).collect())) == sorted(map(str, sample.collect()))
    plan = sample._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan and "Join LeftOuter" in plan
