"""The driver's star schema in the roles of the library's masters.

``sales`` plays the product transactions and ``readings`` the hourly weather readings.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The star keeps money as doubles with two decimal digits; readings have up to three.
MONEY_DIGITS = 2
READING_DIGITS = 3


@lru_cache
def _schema(path: str) -> T.StructType:
    """Schema of a table, looked up once: every unschemed read starts a job that opens a footer."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def _order_columns() -> dict:
    day = F.col("o_orderdate").cast("date")
    return {
        "festival": F.col("o_orderpriority"),
        "festival_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        # Events only cover January 2024, so orders meet them by day of month.
        "sale_day": F.make_date(F.lit(2024), F.lit(1), F.dayofmonth(day)),
    }


def _place_columns() -> dict:
    return {
        "state": F.col("r_name"),
        "city": F.col("n_name"),
        "latitude": F.col("n_nationkey").cast("double"),
        "longitude": (F.col("n_regionkey") * 10).cast("double"),
    }


def _customer_columns() -> dict:
    return {"vendor_type": F.col("c_mktsegment")}


def _part_columns() -> dict:
    return {
        "product": F.col("p_name"),
        "product_category": F.col("p_type"),
        "price_INR": F.col("p_retailprice"),
    }


def _supplier_columns() -> dict:
    return {"seller_rating": F.col("s_acctbal")}


def _line_columns() -> dict:
    return {
        "product_id": F.col("l_partkey"),
        "payment_methods": F.col("l_returnflag"),
        "revenue_INR": F.col("l_extendedprice"),
        "units_sold": F.col("l_quantity").cast("int"),
        "discount_pct": F.floor(F.col("l_discount") * 100 + 0.5).cast("int"),
    }


def _pick(df: DataFrame, keys: list[str], offered: dict, wanted: set[str]) -> DataFrame:
    return df.select(*keys, *[value.alias(name) for name, value in offered.items() if name in wanted])


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The sales rows with the given columns (all by default), one per line item.

    Every line item has one order, part, supplier and customer (the star's declared foreign keys, checked
    by a test), so a dimension that contributes no column is not joined. Dimensions are folded into the
    orders first: line items then shuffle once per large dimension they really meet. They meet it by a left
    join: no sale is lost, and the fact can never become the broadcast side of a misjudged join.
    """
    every = [*_line_columns(), *_order_columns(), *_place_columns(), *_customer_columns(), *_part_columns(), *_supplier_columns()]
    wanted = set(columns or every)
    unknown = wanted - set(every)
    if unknown:
        raise ValueError(f"no such sales columns: {sorted(unknown)}")

    def need(offered: dict) -> bool:
        return bool(wanted & set(offered))

    rows = table(spark, sf_dir, "lineitem")
    if need(_order_columns()) or need(_place_columns()) or need(_customer_columns()):
        orders = _pick(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], _order_columns(), wanted)
        if need(_place_columns()) or need(_customer_columns()):
            customers = _pick(table(spark, sf_dir, "customer"), ["c_custkey", "c_nationkey"], _customer_columns(), wanted)
            if need(_place_columns()):
                nations = table(spark, sf_dir, "nation")
                if "state" in wanted:
                    nations = nations.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
                places = _pick(nations, ["n_nationkey"], _place_columns(), wanted)
                customers = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey")).drop("n_nationkey")
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if need(_part_columns()):
        parts = _pick(table(spark, sf_dir, "part"), ["p_partkey"], _part_columns(), wanted)
        rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    if need(_supplier_columns()):
        suppliers = _pick(table(spark, sf_dir, "supplier"), ["s_suppkey"], _supplier_columns(), wanted)
        rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    computed = _line_columns()
    return rows.select(*[computed[name].alias(name) if name in computed else name for name in every if name in wanted])


def readings(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Weather readings made of events, one each: city, time, three measures and ``more`` columns of the event. No event is on a 31st."""
    hundredths = F.floor(F.col("value") * 100 + 0.5)
    return (
        table(spark, sf_dir, "events")
        .select(
            F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("city"),
            F.col("ts").alias("date"),
            (hundredths / 200).alias("temperature_2m"),
            (20 + (F.col("user_id") * 7 + F.col("event_id")) % 61).alias("relative_humidity_2m"),
            F.when(F.col("event_type") == "error", hundredths / 100).otherwise(F.lit(0.0)).alias("precipitation"),
            *more,
        )
    )
