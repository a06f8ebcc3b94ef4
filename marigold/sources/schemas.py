"""Column types of the raw files."""

from __future__ import annotations

from pyspark.sql import types as T

# Money adds up exactly as a decimal; pass another type to the schema functions for other currencies.
MONEY = T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def festival_sales() -> T.StructType:
    """One festival sale per row, in file order; the day is still text."""
    text, number = T.StringType(), T.DoubleType()
    return _schema(
        ProductID=text, ProductName=text, Category=text, Sales=number, State=text, Region=text, City=text,
        Latitude=number, Longitude=number, Date=text, Festival=text,
    )


def products(money: T.DataType = MONEY) -> T.StructType:
    """One product transaction per row; the day is still text."""
    text, number = T.StringType(), T.DoubleType()
    return _schema(
        product_id=text, product=text, product_category=text, festival=text, festival_date=text,
        revenue_INR=money, units_sold=T.IntegerType(), price_INR=money, discount_pct=number,
        seller_rating=number, state=text, city=text, latitude=number, longitude=number,
        vendor_type=text, payment_methods=text,
    )


def weather() -> T.StructType:
    """One hourly reading per row; the time is still text because it may carry an offset."""
    number = T.DoubleType()
    return _schema(date=T.StringType(), temperature_2m=number, relative_humidity_2m=number, precipitation=number)


def city_list() -> T.StructType:
    return T.StructType([T.StructField("City Name", T.StringType())])
