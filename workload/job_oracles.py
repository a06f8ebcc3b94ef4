"""For each query of the job catalog, the SQL whose result it must equal."""

from __future__ import annotations

from workload.sql import FACT, FESTIVAL_CATEGORY, KPIS, PAYMENT_VENDOR, READINGS, TOTALS, UNITS_RANKED, WX

# --- text that does not fit --------------------------------------------------------------------------

DAMAGED = """
lines as (
  select l_orderkey, l_linenumber, l_orderkey % 11 as o, l_linenumber % 5 as n, cast(l_extendedprice as decimal(18,2)) as p,
         cast(l_quantity as integer) as q, l_tax
  from lineitem
),
faults as (
  select l_orderkey, l_linenumber, 'price' as column_name,
         case o when 0 then cast(p as varchar) || '5' when 1 then '1e20' else 'x' end as text,
         case o when 0 then 'rounded' else 'failed' end as fault
  from lines where o in (0, 1, 2)
  union all
  select l_orderkey, l_linenumber, 'quantity', case n when 1 then cast(q as varchar) || '.7' else '99999999999' end,
         case n when 1 then 'rounded' else 'failed' end
  from lines where n in (1, 2)
  union all
  select l_orderkey, l_linenumber, 'tax', '1d', 'failed' from lines where o = 4
)"""


def _types(table: str, kinds: dict[str, str]) -> str:
    return "\nunion all\n".join(f"select '{table}' as table_name, '{column}' as column_name, '{kind}' as kind" for column, kind in kinds.items())


ORDER_KINDS = {
    "o_orderkey": "integer", "big_key": "long", "o_orderpriority": "string", "o_totalprice": "decimal", "order_day": "date",
    "ordered_at": "timestamp", "code": "string", "is_final": "boolean",
}
LINE_KINDS = {
    "l_orderkey": "integer", "l_partkey": "integer", "l_suppkey": "integer", "l_linenumber": "integer", "l_quantity": "decimal",
    "l_extendedprice": "decimal", "l_discount": "decimal", "l_tax": "decimal", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp",
}

# --- city files --------------------------------------------------------------------------------------


def _daily(temperature: str = "t", rain: str = "p", kept: str = "true") -> str:
    """The weather master of readings, some of which have no such value."""
    return f"""with {READINGS},
changed as (select city, date, {temperature} as t, h, {rain} as p from readings where {kept}),
daily as (
  select city, date, cast(sum(t) as double) / nullif(count(t), 0) / 2 as avg_temp_C, cast(sum(h) as double) / count(h) as avg_humidity_pct,
         cast(sum(p) as double) as total_precip_mm, coalesce(sum(p) > 0, false) as rain_flag
  from changed group by city, date)
select city, date, avg_temp_C, avg_humidity_pct, total_precip_mm, rain_flag,
       cast(year(date) as integer) as year, cast(month(date) as integer) as month, cast(day(date) as integer) as day,
       'Unknown' as state, cast(0 as double) as latitude, cast(0 as double) as longitude
from daily"""


ANY_HEADERS = _daily(rain="case when cast(regexp_extract(city, '(\\d+)$', 1) as integer) % 3 = 2 then null else p end")
LISTED = _daily(kept="city in (select n_name from nation where n_regionkey % 2 = 0)").replace("select city, date, avg_temp_C", "select replace(city, '_', ' ') as city, date, avg_temp_C")

# --- masters and summaries as jobs -------------------------------------------------------------------

MASTERS = f"""{FACT},
typed as (select * replace (case when product_id % 7 = 0 then null else festival_date end as festival_date) from fact)"""

# Sales as they fall into January 2024.
JANUARY = f"""{FACT},{WX},
january as (select * replace (sale_day as festival_date, cast(2024 as integer) as year, cast(1 as integer) as month) from fact)"""


def _groups(job: str, keys: str) -> str:
    return f"select '{job}' as job, (select count(*) from january) as input_rows, count(*) as output_rows from (select distinct {keys} from january)"


COUNTS = f"""with {JANUARY},
best as (
  select state, city, year, count(*) as ties from (
    select state, city, year, rank() over (partition by state, city, year order by sum(revenue_INR) desc) as r
    from january group by state, city, year, product_category)
  where r = 1 group by state, city, year),
places as (select distinct state, city, latitude, longitude, year from january)
{_groups("overall_kpis", "festival_date")}
union all
{_groups("festival_category_summary", "festival, product_category, year")}
union all
select 'geo_summary', (select count(*) from january), cast(sum(ties) as bigint) from places join best using (state, city, year)
union all
{_groups("weather_sales_summary", "city, festival_date")}
union all
{_groups("payment_vendor_summary", "vendor_type, payment_methods, year")}"""

ALARM = f"""with {JANUARY}
select city, festival_date as join_date from january j
where not exists (select 1 from wx w where w.city = j.city and w.date = j.festival_date and day(w.date) <= 20)
order by city, festival_date limit 10"""

# --- refresh -----------------------------------------------------------------------------------------


def _doubled(sql: str) -> str:
    """A query over the sales, with the units of one year doubled."""
    return sql.replace("cast(l.l_quantity as int) as units_sold", "cast(l.l_quantity as int) * case when year(o.o_orderdate) = 1995 then 2 else 1 end as units_sold")


REFRESH_KPIS = f"""with {KPIS}
select *, cast(year(date) as integer) as year, cast(month(date) as integer) as month, cast(day(date) as integer) as day from kpis"""

PLACES = f"""with {FACT},
best as (
  select state, city, year, product_category as top_category
  from (select state, city, year, product_category, rank() over (partition by state, city, year order by sum(revenue_INR) desc) as r
        from fact group by state, city, year, product_category)
  where r = 1)
select b.*, t.top_category
from (select state, city, latitude, longitude, year, {TOTALS} from fact group by state, city, latitude, longitude, year) b
left join best t on b.state = t.state and b.city = t.city and b.year = t.year"""

# --- bounded results ---------------------------------------------------------------------------------

BOUNDED = f"""with {UNITS_RANKED},
placed as (
  select *, rank() over (partition by festival, year order by total desc) as r,
         row_number() over (partition by festival, year order by total desc, product) as i
  from units)
select festival, year,
       string_agg(product || ' (₹' || format('{{:,.0f}}', cast(total as double)) || ')', ', ' order by i) filter (i <= 3) as top_products,
       count(*) filter (r <= 3) - count(*) filter (i <= 3) as more_ties
from placed group by festival, year"""

FESTIVAL_BOUNDED = f"""with {FESTIVAL_CATEGORY},
placed as (select *, row_number() over (partition by festival, year order by total desc, product) as i from ranked),
bounded as (
  select festival, year, string_agg(product || ' (₹' || format('{{:,.0f}}', cast(total as double)) || ')', ', ' order by i) filter (i <= 5) as top_products,
         count(*) filter ("rank" <= 5) - count(*) filter (i <= 5) as more_ties
  from placed group by festival, year)
select s.* exclude (top_products), coalesce(b.top_products, 'N/A') as top_products, b.more_ties
from summary s left join bounded b on s.festival = b.festival and s.year = b.year"""


def _sample(table: str, x: str, y: str, color: str | None, n: int, keys: list[str]) -> str:
    name = " || '|' || ".join(f"coalesce('=' || cast({k} as varchar), '-')" for k in keys)
    told = ", ".join(dict.fromkeys([x, y, *([color] if color else [])]))
    hue = color or "0"
    return f"""with placed as (
  select *, cast('0x' || substr(md5({name}), 1, 13) as bigint) as place, count(*) over (partition by {hue}) as n_rows from {table}),
ranked as (select *, row_number() over (partition by {hue} order by place, {", ".join(keys)}) as i from placed)
select {told}, least(1.0::double, cast({n} as double) / n_rows) as share from ranked where i <= {n}"""


# --- looking at tables -------------------------------------------------------------------------------

# Columns, types and keys of the tables, as the inspection shows them.
SHOWN = {
    "region": ("r_regionkey int, r_name string", "r_regionkey"),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", "n_nationkey"),
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "c_custkey"),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", "s_suppkey"),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", "p_partkey"),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        "o_orderkey",
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        "l_orderkey, l_linenumber, l_partkey, l_suppkey",
    ),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string", "event_id"),
    "documents": ("doc_id bigint, text string, lang string, source string, n_chars bigint", "doc_id"),
    "embeddings": ("vec_id bigint, embedding array<float>, label int", "vec_id"),
    "pages": ("page_id bigint, url string, html string", "page_id"),
    "benchmark": ("item_id bigint, text string", "item_id"),
    "labels": ("doc_id bigint, quality int, toxic int", "doc_id"),
    "conversations": ("conv_id bigint, turn bigint, role string, text string", "conv_id, turn"),
}


def _inspection() -> str:
    parts = []
    for name, (columns, keys) in SHOWN.items():
        first = f"(select *, row_number() over (order by {keys}) as row_number from {name} order by {keys} limit 3)"
        for position, column in enumerate(columns.split(", ")):
            own, kind = column.split(" ")
            value = f"'array of ' || cast(len({own}) as varchar)" if kind.startswith("array") else f"cast({own} as varchar)"
            parts.append(
                f"select '{name}' as table_name, cast({position} as integer) as position, '{own}' as column_name, '{kind}' as column_type, "
                f"cast(row_number as integer) as row_number, {value} as value from {first}"
            )
    return "\nunion all\n".join(parts)


VENDORS = f"{PAYMENT_VENDOR} group by vendor_type, payment_methods, year"

JOB_ORACLES: dict[str, str] = {
    "job_typed_csv": f"""with {DAMAGED}
select l_orderkey, l_linenumber,
       cast(case when o = 0 then p + 0.01 when o in (1, 2, 3) then null else p end as decimal(18,2)) as price,
       cast(case when n = 1 then q + 1 when n = 2 then null else q end as integer) as quantity,
       case when o = 4 then null else l_tax end as tax
from lines""",
    "job_typed_csv_account": f"""with {DAMAGED}
select column_name, count(*) filter (fault = 'failed') as failed, count(*) filter (fault = 'rounded') as rounded from faults group by column_name""",
    "job_typed_csv_quarantine": f"with {DAMAGED}\nselect * from faults",
    "job_inferred_csv": """select cast(o_orderkey as integer) as o_orderkey, o_orderkey + 5000000000 as big_key, o_orderpriority, o_totalprice,
       cast(o_orderdate as date) as order_day, cast(o_orderdate as timestamp) as ordered_at,
       lpad(cast(o_custkey % 1000 as varchar), 3, '0') as code, o_orderstatus = 'F' as is_final
from orders""",
    "inferred_types": _types("orders", ORDER_KINDS) + "\nunion all\n" + _types("lineitem", LINE_KINDS),
    "job_weather_daily": _daily(temperature="case when event_id % 17 = 0 then null else t end", kept="event_id % 13 <> 0"),
    "job_weather_account": f"""with {READINGS}
select count(*) as input_rows, (select count(*) from (select distinct city, date from readings where event_id % 13 <> 0)) as output_rows,
       count(*) filter (event_id % 13 = 0) as unparsed_times, count(*) filter (event_id % 17 = 0) as failed_temperatures,
       count(*) filter (event_id % 13 = 0 or event_id % 17 = 0) as quarantined
from readings""",
    "job_weather_quarantine": f"""with {READINGS}
select city, 'date' as column_name, 'nonsense' as text, count(*) as readings from readings where event_id % 13 = 0 group by city
union all
select city, 'temperature_2m', 'cold', count(*) from readings where event_id % 17 = 0 group by city""",
    "weather_of_any_headers": ANY_HEADERS,
    "weather_of_any_headers_by_position": ANY_HEADERS,
    "job_weather_of_listed_files": LISTED,
    "job_weather_of_listed_keys": LISTED,
    "job_masters": f"""with {MASTERS}
select 'festival_sales' as job, 'done' as status, count(*) as input_rows, count(*) filter (product_id % 7 = 0) as unparsed_days,
       nullif(count(*) filter (product_id % 7 = 0), 0) as quarantined from fact
union all
select 'products', 'done', count(*), count(*) filter (product_id % 7 = 0), nullif(count(*) filter (product_id % 7 = 0), 0) from fact
union all
select 'weather_daily', 'missing', null, null, null""",
    "job_products_master": f"""with {MASTERS}
select cast(product_id as varchar) as product_id, product, product_category, festival, festival_date, units_sold, cast(discount_pct as double) as discount_pct,
       state, city, vendor_type, payment_methods, cast(year(festival_date) as integer) as year, cast(month(festival_date) as integer) as month,
       cast(day(festival_date) as integer) as day
from typed""",
    "job_festival_master": f"""with {MASTERS}
select product_category as Category, festival as Festival, festival_date as date, count(*) as n, cast(sum(units_sold) as double) as sales
from typed group by product_category, festival, festival_date""",
    "job_counts": COUNTS,
    "job_unmatched_alarm": ALARM,
    "job_refresh_kpis": _doubled(REFRESH_KPIS),
    "job_refresh_festivals": _doubled(f"with {FESTIVAL_CATEGORY}\nselect * from summary"),
    "job_refresh_places": _doubled(PLACES),
    "job_refresh_vendors": _doubled(f"with {FACT}\n{VENDORS}"),
    "top_products_bounded": BOUNDED,
    "festival_category_bounded": FESTIVAL_BOUNDED,
    "scatter_sample": _sample("lineitem", "l_quantity", "l_extendedprice", "l_returnflag", 400, ["l_orderkey", "l_linenumber"]),
    "scatter_sample_of_few": "select s_acctbal, s_nationkey, 1.0::double as share from supplier",
    "inspect_tables": _inspection(),
    "load_by_extension": f"""with {FACT},
vendors as ({VENDORS})
select *, 'parquet' as loaded_as, cast(1 as integer) as missing from vendors
union all
select *, 'csv', cast(1 as integer) from vendors""",
    "job_filter_export": f"with {FACT},\nvendors as ({VENDORS})\nselect * from vendors where year in (1993, 1996)",
    "job_bar_data": f"with {FACT}\nselect vendor_type, year, cast(sum(units_sold) as bigint) as total_units from fact group by vendor_type, year",
    "tables_through_mount": f"""with {WX}
select city, sum(cast(total_precip_mm as decimal(18,3)))::double as rain, count(*) as n_days,
       (select count(*) from (select distinct year(date), month(date) from wx)) as month_folders
from wx group by city""",
}
