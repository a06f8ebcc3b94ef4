"""SQL over the test star schema: the parts that queries share."""

from __future__ import annotations

FACT = """
fact as (
  select p.p_partkey as product_id, p.p_name as product, p.p_type as product_category,
         o.o_orderpriority as festival, cast(o.o_orderdate as date) as festival_date,
         cast(year(o.o_orderdate) as integer) as year, cast(month(o.o_orderdate) as integer) as month,
         cast(day(o.o_orderdate) as integer) as day,
         make_date(2024, 1, day(o.o_orderdate)) as sale_day,
         r.r_name as state, n.n_name as city,
         cast(n.n_nationkey as double) as latitude, cast(n.n_regionkey * 10 as double) as longitude,
         c.c_mktsegment as vendor_type, l.l_returnflag as payment_methods,
         cast(l.l_extendedprice as decimal(18,2)) as revenue_INR,
         cast(l.l_quantity as int) as units_sold,
         cast(p.p_retailprice as decimal(18,2)) as price_INR,
         cast(round(l.l_discount * 100) as int) as discount_pct,
         cast(s.s_acctbal as decimal(18,2)) as seller_rating
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join part p on l.l_partkey = p.p_partkey
  join supplier s on l.l_suppkey = s.s_suppkey
  join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey
  join region r on n.n_regionkey = r.r_regionkey
)"""

READINGS = """
readings as (
  select event_id, 'NATION_' || cast(user_id % 25 as varchar) as city, ts, cast(ts as date) as date,
         cast(value as decimal(18,2)) as t,
         20 + (user_id * 7 + event_id) % 61 as h,
         case when event_type = 'error' then cast(value as decimal(18,2)) else cast(0 as decimal(18,2)) end as p
  from events
)"""

WX = READINGS + """,
wx as (
  select city, date, cast(sum(t) as double) / count(t) / 2 as avg_temp_C,
         cast(sum(h) as double) / count(h) as avg_humidity_pct,
         cast(sum(p) as double) as total_precip_mm,
         coalesce(sum(p) > 0, false) as rain_flag
  from readings group by city, date
)"""

JOINED = f"""{FACT},{WX},
joined as (
  select f.*, w.city as wx_city, w.avg_temp_C, w.avg_humidity_pct, w.total_precip_mm
  from fact f left join wx w on f.city = w.city and f.sale_day = w.date
)"""

TOTALS = """cast(sum(revenue_INR) as double) as total_revenue, cast(sum(units_sold) as bigint) as total_units,
         cast(sum(price_INR) as double) / count(price_INR) as avg_price"""

KPIS = f"""{FACT},
kpis as (
  select festival_date as date, {TOTALS}, count(*) as total_tx,
         cast(sum(discount_pct) as double) / count(discount_pct) as avg_discount,
         cast(sum(seller_rating) as double) / count(seller_rating) as avg_seller_rating
  from fact group by festival_date
)"""

TOP = f"""{FACT},
ranked as (
  select festival, year, product, total, rank() over (partition by festival, year order by total desc) as "rank"
  from (select festival, year, product, sum(revenue_INR) as total from fact group by festival, year, product)
)"""

FESTIVAL_CATEGORY = f"""{TOP},
lists as (
  select festival, year,
         string_agg(product || ' (₹' || format('{{:,.0f}}', cast(total as double)) || ')', ', '
                    order by total desc, product) as top_products
  from ranked where "rank" <= 5 group by festival, year
),
summary as (
  select b.*, coalesce(l.top_products, 'N/A') as top_products
  from (select festival, product_category, year, {TOTALS} from fact group by festival, product_category, year) b
  left join lists l on b.festival = l.festival and b.year = l.year
)"""

CATEGORY = f"""{FACT},
best as (
  select state, city, year, product_category as top_category
  from (select state, city, year, product_category,
               rank() over (partition by state, city, year order by sum(revenue_INR) desc) as r
        from fact group by state, city, year, product_category)
  where r = 1
)"""

UNITS_RANKED = f"""{FACT},
units as (
  select festival, year, product, cast(sum(units_sold) as bigint) as total from fact group by festival, year, product
)"""

WEATHER_DAILY = f"""with {WX}
select city, date, avg_temp_C, avg_humidity_pct, total_precip_mm, rain_flag,
       cast(year(date) as integer) as year, cast(month(date) as integer) as month, cast(day(date) as integer) as day,
       'Unknown' as state, cast(0 as double) as latitude, cast(0 as double) as longitude
from wx"""

PAYMENT_VENDOR = """select vendor_type, payment_methods, year,
       cast(sum(revenue_INR) as double) as total_revenue, cast(sum(units_sold) as bigint) as total_units,
       cast(sum(discount_pct) as double) / count(discount_pct) as avg_discount
from fact"""


def weather_sales_sql(temp_missing: str, humidity_missing: str) -> str:
    return f"""with {JOINED}
select city, sale_day as date, cast(2024 as integer) as year, cast(1 as integer) as month,
       case when avg_temp_C < 15 then '<15' when avg_temp_C >= 15 and avg_temp_C <= 25 then '15-25'
            when avg_temp_C > 25 and avg_temp_C <= 35 then '25-35'
            when avg_temp_C is null then '{temp_missing}' else '>35' end as temp_bucket,
       case when avg_humidity_pct < 40 then '<40' when avg_humidity_pct >= 40 and avg_humidity_pct <= 70 then '40-70'
            when avg_humidity_pct is null then '{humidity_missing}' else '>70' end as humidity_bucket,
       coalesce(total_precip_mm > 0, false) as rain_flag, {TOTALS}
from joined group by all"""
