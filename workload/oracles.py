"""For each query of the catalog, the SQL whose result it must equal."""

from __future__ import annotations

from itertools import product

from workload.job_oracles import JOB_ORACLES
from workload.sql import (
    CATEGORY, FACT, FESTIVAL_CATEGORY, JOINED, KPIS, PAYMENT_VENDOR, READINGS, TOP, TOTALS, UNITS_RANKED, WEATHER_DAILY, WX, weather_sales_sql,
)

def _typed_days(columns: str, day: str) -> str:
    return f"""with typed as (
  select o_orderkey, case when o_orderkey % 7 = 0 then null else cast(o_orderdate as date) end as {day} from orders
)
select o_orderkey, {day}{columns} from typed"""


def _correlations(names: tuple[str, ...]) -> str:
    cells = []
    for x, y in product(names, names):
        r = f"case when stddev_pop({x}) > 0 then 1.0 end" if x == y else f"round(corr(cast({x} as double), cast({y} as double)), 6) + 0.0"
        cells.append(f"select '{x}' as x, '{y}' as y, cast({r} as double) as r from fact")
    return f"with {FACT}\n" + "\nunion all\n".join(cells)


def _cards() -> str:
    def card(position: int, column: str, label: str, kind: str, value: str) -> str:
        return f"""select cast({position} as integer) as position, '{column}' as column_name, '{label}' as label,
       '{kind}' as kind, {value} as value, format('{{:.2f}}', stddev_samp({column})) as spread from kpis"""

    cards = (
        card(0, "total_revenue", "Total Revenue", "money", "'₹' || format('{:,.0f}', sum(total_revenue))"),
        card(1, "total_units", "Total Units", "sum", "format('{:,.0f}', cast(sum(total_units) as double))"),
        card(2, "total_tx", "Total Tx", "mean", "format('{:.2f}', avg(total_tx))"),
        card(3, "avg_price", "Avg Price", "mean", "format('{:.2f}', avg(avg_price))"),
    )
    return f"with {KPIS}\n" + "\nunion all\n".join(cards)


TABLES_WITH_TEXT = ("documents", "benchmark", "conversations")
TABLES_WITHOUT_TEXT = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "pages", "labels",
)


def _tables_by_name() -> str:
    parts = [f"select '{name}' as table_name, count(*) as n_rows, count(text) as n_texts from {name}" for name in TABLES_WITH_TEXT]
    parts += [f"select '{name}', count(*), cast(0 as bigint) from {name}" for name in TABLES_WITHOUT_TEXT]
    return "\nunion all\n".join(parts)


def _listed(membership: str) -> str:
    return f"""with {READINGS}
select city, count(*) as readings from readings
where city {membership} (select n_name from nation where n_regionkey % 2 = 0) group by city"""


ORACLES: dict[str, str] = {
    "scan_csv_roundtrip": """select o_orderkey, o_custkey, o_orderpriority, o_totalprice,
       strftime(o_orderdate, '%d-%m-%Y') as order_day from orders""",
    "csv_to_parquet": "select l_orderkey, l_linenumber, l_returnflag, l_tax from lineitem",
    "scan_multi_file_key": f"""with {READINGS}
select city, cast(sum(p) as double) as total_precip_mm, count(*) as readings from readings group by city""",
    "weather_daily_from_files": WEATHER_DAILY,
    "scan_tables_by_file_name": _tables_by_name(),
    "select_files_by_name_list": f"""with {READINGS},
counts as (select city, count(*) as readings from readings group by city)
select replace(n_name, '_', ' ') as name, c.city is not null as found, c.readings
from nation left join counts c on n_name = c.city
union all
select n_name, c.city is not null, c.readings from nation left join counts c on n_name = c.city""",
    "rows_on_name_list": _listed("in"),
    "rows_not_on_name_list": _listed("not in"),
    "parquet_partitioned_roundtrip": f"""with {FACT}
select product_id, festival_date, year, month, units_sold, cast(revenue_INR as double) as revenue from fact""",
    "parquet_state_roundtrip": f"""with {FACT}
select state, year, cast(sum(units_sold) as bigint) as total_units from fact group by state, year""",
    "export_csv": f"""with {FACT}
{PAYMENT_VENDOR} where vendor_type in ('BUILDING', 'MACHINERY') group by vendor_type, payment_methods, year""",
    "parse_day_calendar": _typed_days(
        """, cast(year(festival_date) as integer) as year, cast(month(festival_date) as integer) as month,
       cast(day(festival_date) as integer) as day""",
        "festival_date",
    ),
    "festival_sales_master": _typed_days("", "date"),
    "weather_daily": WEATHER_DAILY,
    "require_columns": f"""with {FACT}
select 'overall_kpis' as plan, count(*) as input_rows, count(distinct festival_date) as output_rows from fact""",
    "overall_kpis": f"""with {KPIS}
select *, cast(year(date) as integer) as year, cast(month(date) as integer) as month, cast(day(date) as integer) as day
from kpis""",
    "festival_category": f"with {FESTIVAL_CATEGORY}\nselect * from summary",
    "top_products": f"""with {TOP}
select festival, year, product, cast(total as double) as total, cast("rank" as integer) as "rank"
from ranked where "rank" <= 5""",
    "top_products_by_units": f"""with {UNITS_RANKED}
select * from (select *, cast(rank() over (partition by festival, year order by total desc) as integer) as "rank" from units)
where "rank" <= 5""",
    "top_products_first_of_ties": f"""with {UNITS_RANKED}
select * from (
  select *, cast(row_number() over (partition by festival, year order by total desc, product) as integer) as "rank" from units)
where "rank" <= 5""",
    "geo_summary": f"""with {CATEGORY}
select b.*, t.top_category
from (select state, city, latitude, longitude, year, {TOTALS}
      from fact group by state, city, latitude, longitude, year) b
left join best t on b.state = t.state and b.city = t.city and b.year = t.year""",
    "top_category": f"with {CATEGORY}\nselect * from best",
    "payment_vendor": f"with {FACT}\n{PAYMENT_VENDOR} group by vendor_type, payment_methods, year",
    "weather_sales": weather_sales_sql(">35", ">70"),
    "weather_sales_unknown_band": weather_sales_sql("unknown", "unknown"),
    "enriched_sales": f"""with {JOINED}
select product_id, city, sale_day, units_sold, avg_temp_C, total_precip_mm, wx_city is not null as matched from joined""",
    "unmatched_report": f"""with {JOINED},
counts as (
  select count(*) as total_rows, count(*) filter (where wx_city is null) as no_key,
         count(*) filter (where avg_temp_C is null) as no_measure
  from joined
)
select *, cast(no_measure as double) / total_rows as unmatched_ratio,
       cast(no_measure as double) / total_rows > 0.05 as alarm
from counts""",
    "unmatched_alarm": f"""with {JOINED},
counts as (
  select count(*) as total_rows, count(*) filter (where wx_city is null) as no_key,
         count(*) filter (where avg_temp_C is null) as no_measure
  from joined
)
select *, cast(no_measure as double) / total_rows as unmatched_ratio,
       cast(no_measure as double) / total_rows > 0.01 as alarm
from counts""",
    "unmatched_sample": f"""with {JOINED}
select city, sale_day as join_date from joined where avg_temp_C is null order by city, sale_day limit 10""",
    "band_temperature": f"""with {READINGS}
select city, case when t / 2 < 15 then '<15' when t / 2 <= 25 then '15-25' when t / 2 <= 35 then '25-35' else '>35' end
         as temp_bucket, count(*) as readings
from readings group by all""",
    "band_humidity": f"""with {READINGS}
select city, case when h < 40 then '<40' when h <= 70 then '40-70' else '>70' end as humidity_bucket, count(*) as readings
from readings group by all""",
    "preview_daily": f"""with {KPIS}
select *, cast(year(date) as integer) as year, cast(month(date) as integer) as month, cast(day(date) as integer) as day
from kpis order by date limit 500""",
    "list_datasets": f"select table_name, n_rows from ({_tables_by_name()})",
    "top_products_nested": f"""with {TOP}
select festival, year, cast(row_number() over (partition by festival, year order by total desc, product) - 1 as integer) as place,
       product, cast(total as double) as revenue
from ranked where "rank" <= 5""",
    "preview_text": f"""with {FESTIVAL_CATEGORY}
select * from summary order by festival, year, product_category limit 500""",
    "metric_cards": _cards(),
    "bar_data": f"""with {FACT}
select product_category, festival, cast(sum(revenue_INR) as double) as revenue_INR from fact
group by product_category, festival""",
    "share_data": f"""with {FACT}
select vendor_type, cast(sum(revenue_INR) as double) as revenue_INR,
       cast(sum(revenue_INR) as double) / (select cast(sum(revenue_INR) as double) from fact where vendor_type is not null) * 100 as share_pct
from fact where vendor_type is not null group by vendor_type""",
    "line_data": f"with {WX}\nselect city, date, avg_temp_C from wx",
    "scatter_data": f"with {FACT}\nselect units_sold, discount_pct, festival from fact",
    "corr_matrix": _correlations(("revenue_INR", "units_sold", "price_INR", "discount_pct", "seller_rating")),
    "distinct_values": f"with {FACT}\nselect distinct product_category from fact",
    "filter_values": f"""with {FACT}
select product_id, product_category, festival_date, units_sold from fact
where product_category in (select distinct product_category from fact order by product_category limit 5)""",
}

# A job writes what its plan computes.
ORACLES |= {f"job_{name}": ORACLES[name] for name in ("overall_kpis", "festival_category", "geo_summary", "payment_vendor", "weather_sales")}
ORACLES |= JOB_ORACLES
