"""The catalog's queries as DuckDB SQL over the same tables, written independently.

The grid is built here as a full product with a left join, and rolling values
with window frames, so that the two sides share no shortcut.
"""

from __future__ import annotations

ITEMS = """
items as (
  select l_orderkey as order_id, l_partkey as product_id, l_suppkey as seller_id,
         l_shipdate as shipping_limit_date,
         case when l_partkey % 9 <> 4 then l_extendedprice end as price,
         (cast(round(l_extendedprice * 100) as bigint) * cast(round(l_tax * 100) as bigint))::double
           / 10000.0::double as freight_value
  from lineitem)"""

ORDERS = """
bought as (
  select *, o_orderdate + to_hours(cast(o_orderkey * 7 % 24 as int)) as bought from orders),
approved as (
  select *, case when o_orderkey % 97 <> 0
                 then bought + to_hours(cast(o_custkey % 36 as int)) end as approved
  from bought),
handed as (
  select *, approved + to_days(cast(o_custkey % 40 - 2 as int))
            + to_hours(cast(o_orderkey % 5 * 5 as int)) as handed
  from approved),
ords as (
  select o_orderkey as order_id, o_custkey as customer_id,
         bought as order_purchase_timestamp, approved as order_approved_at,
         handed as order_delivered_carrier_date,
         case when o_orderstatus <> 'P'
              then handed + to_days(cast(o_orderkey % 70 - 3 as int))
                   + to_hours(cast(o_orderkey % 7 * 5 as int)) end
           as order_delivered_customer_date,
         o_orderdate + to_days(30) as order_estimated_delivery_date
  from handed)"""

CUSTOMERS = """
custs as (
  select c_custkey as customer_id,
         case when c_custkey % 41 <> 0 then n_name || '/' || cast(c_custkey % 4 as varchar) end
           as customer_city,
         case when c_custkey % 43 <> 0 then n_name end as customer_state
  from customer left join nation on c_nationkey = n_nationkey)"""

TRANSLATION = """
translation as (
  select 'Brand#' || cast(i as varchar) as product_category_name,
         'brand ' || cast(i as varchar) as product_category_name_english
  from range(1, 16) as r(i))"""


def products(fine: bool) -> str:
    name = "p_brand || '-' || cast(p_size as varchar)" if fine else "p_brand"
    return f"""
prods as (
  select p_partkey as product_id,
         case when p_partkey % 50 <> 7 then {name} end as product_category_name
  from part)"""


CATEGORIZED = """
categorized as (
  select product_id,
         coalesce(product_category_name_english, product_category_name, 'unknown')
           as product_category
  from prods left join translation using (product_category_name))"""

STAGED = """
staged as (
  select i.*, o.* exclude (order_id), c.* exclude (customer_id),
         cast(floor(date_diff('second', order_approved_at, order_delivered_carrier_date)
                    / 86400.0) as bigint) as time_to_ship,
         cast(floor(date_diff('second', order_delivered_carrier_date,
                    order_delivered_customer_date) / 86400.0) as bigint) as carrier_time,
         cast(floor(date_diff('second', order_purchase_timestamp,
                    order_delivered_customer_date) / 86400.0) as bigint) as total_delivery_time,
         cast(floor(date_diff('second', order_estimated_delivery_date,
                    order_delivered_customer_date) / 86400.0) as bigint) as delay_days
  from items i join ords o using (order_id) left join custs c on o.customer_id = c.customer_id),
valid as (
  select * from staged where time_to_ship >= 0 and carrier_time >= 0
    and time_to_ship < 30 and carrier_time < 60),
valid_total as (
  select * from staged where time_to_ship >= 0 and carrier_time >= 0
    and total_delivery_time < 100),
viewed as (select * from staged where delay_days > -20 and delay_days < 20)"""

STAGED_ALL = f"with {ITEMS}, {ORDERS}, {CUSTOMERS}, {STAGED}"

def money(column: str) -> str:
    """A decimal sum as the nearest double; casting the decimal itself rounds twice."""
    return f"sum({column}::decimal(28, 10))::varchar::double"


WEEKLY = f"""
sold as (
  select *, cast(date_trunc('week', order_purchase_timestamp - interval 1 day)
                 + interval 7 day as timestamp) as week
  from items join ords using (order_id) left join categorized using (product_id)),
weekly as (
  select coalesce(product_category, 'unknown') as product_category,
         week as order_purchase_timestamp,
         count(order_id) as quantity_sold,
         coalesce({money('price')}, 0) as revenue,
         {money('price')}
           / nullif(count(price), 0) as curr_avg_price,
         {money('freight_value')}
           / nullif(count(freight_value), 0) as curr_avg_freight,
         count(distinct seller_id) as curr_active_sellers,
         min(sold.order_purchase_timestamp) as first_sold_at
  from sold group by 1, 2)"""

GRID = """
first_sale as (
  select product_category, min(first_sold_at) as first_sale_date from weekly group by 1),
grid as (
  select c.product_category, w.order_purchase_timestamp,
         case when y.quantity_sold is null then 0 else y.quantity_sold end as quantity_sold,
         case when y.quantity_sold is null then 0.0::double else y.revenue end as revenue,
         case when y.quantity_sold is null then 0.0::double else y.curr_avg_price end
           as curr_avg_price,
         case when y.quantity_sold is null then 0.0::double else y.curr_avg_freight end
           as curr_avg_freight,
         case when y.quantity_sold is null then 0 else y.curr_active_sellers end
           as curr_active_sellers,
         first_sale_date
  from (select distinct product_category from weekly) c
  cross join (select distinct order_purchase_timestamp from weekly) w
  left join weekly y on y.product_category = c.product_category
    and y.order_purchase_timestamp = w.order_purchase_timestamp
  join first_sale f on f.product_category = c.product_category),
trimmed as (select * from grid where order_purchase_timestamp >= first_sale_date)"""

FEATURES = """
lagged as (
  select *,
         coalesce(last_value(curr_avg_price ignore nulls) over
           (partition by product_category order by order_purchase_timestamp
            rows between unbounded preceding and 1 preceding), 0) as price_lag_1,
         coalesce(last_value(curr_avg_freight ignore nulls) over
           (partition by product_category order by order_purchase_timestamp
            rows between unbounded preceding and 1 preceding), 0) as freight_lag_1,
         coalesce(lag(curr_active_sellers) over by_week, 0)::double as sellers_lag_1,
         cast(week(order_purchase_timestamp) as int) as week_of_year,
         cast(month(order_purchase_timestamp) as int) as month,
         cast(year(order_purchase_timestamp) as int) as year
  from trimmed
  window by_week as (partition by product_category order by order_purchase_timestamp)),
rolled as (
  select *,
         sin(2 * pi() * month / 12) as month_sin,
         cos(2 * pi() * month / 12) as month_cos,
         coalesce(freight_lag_1 / nullif(price_lag_1, 0), 0) as freight_ratio,
         case when count(*) over four = 4
              then (lag(price_lag_1, 3) over by_week + lag(price_lag_1, 2) over by_week
                    + lag(price_lag_1, 1) over by_week + price_lag_1) / 4.0::double end
           as price_roll_mean_4,
         lag(quantity_sold, 1) over by_week::double as sales_lag_1,
         lag(quantity_sold, 2) over by_week::double as sales_lag_2,
         lag(quantity_sold, 3) over by_week::double as sales_lag_3,
         lag(quantity_sold, 4) over by_week::double as sales_lag_4,
         lag(quantity_sold, 8) over by_week::double as sales_lag_8,
         count(*) over before as n,
         sum(quantity_sold) over before as s1,
         sum(quantity_sold * quantity_sold) over before as s2
  from lagged
  window by_week as (partition by product_category order by order_purchase_timestamp),
         four as (partition by product_category order by order_purchase_timestamp
                  rows between 3 preceding and current row),
         before as (partition by product_category order by order_purchase_timestamp
                    rows between 4 preceding and 1 preceding)),
wide as (
  select * exclude (n, s1, s2),
         coalesce(price_lag_1 / nullif(price_roll_mean_4, 0), 1) as price_momentum,
         case when n = 4 then s1::double / 4.0::double end as sales_roll_mean_4,
         case when n = 4 then sqrt((4 * s2 - s1 * s1)::double / 12.0::double) end
           as sales_roll_std_4,
         least(20, cast(floor(date_diff('day', order_purchase_timestamp,
           cast(make_date(year + case when order_purchase_timestamp >
             cast(make_date(year, 11, 24) as timestamp) then 1 else 0 end, 11, 24) as timestamp))
           / 7.0) as int)) as weeks_to_bf
  from rolled),
features as (
  select product_category, order_purchase_timestamp, quantity_sold, price_lag_1, freight_lag_1,
         sellers_lag_1, week_of_year, month, year, month_sin, month_cos, freight_ratio,
         price_roll_mean_4, price_momentum, sales_lag_1, sales_lag_2, sales_lag_3, sales_lag_4,
         sales_lag_8, sales_roll_mean_4, sales_roll_std_4, weeks_to_bf
  from wide
  where curr_avg_price is not null and curr_avg_freight is not null
    and sales_lag_8 is not null and price_roll_mean_4 is not null
    and sales_roll_std_4 is not null),
test as (select * from features where year = 2000 and month >= 6),
results as (
  select order_purchase_timestamp as date, product_category as category,
         quantity_sold as actual, sales_roll_mean_4 as predicted,
         quantity_sold - sales_roll_mean_4 as error
  from test),
latest as (
  select * from features where order_purchase_timestamp =
    (select max(order_purchase_timestamp) from features))"""


def demand(fine: bool = True) -> str:
    parts = (ITEMS, ORDERS, products(fine), TRANSLATION, CATEGORIZED, WEEKLY, GRID, FEATURES)
    return "with " + ",".join(parts)


def metrics(extra: str = "") -> str:
    return f"""select {extra} count(*) as rows,
      round(avg(abs(actual - predicted)), 6) as mae,
      round(sqrt(avg((actual - predicted) * (actual - predicted))), 6) as rmse,
      round(sum(abs(actual - predicted)) / nullif(sum(actual), 0)::double, 6) as wmape,
      round(1 - avg((actual - predicted) * (actual - predicted))
                / nullif(var_pop(actual), 0), 6) as r2"""


def histogram(source: str, value: str, bins: int) -> str:
    return f"""
, ext as (select min({value})::double as lo, max({value})::double as hi from {source}),
filled as (
  select least({bins - 1}, cast(floor(({value} - lo) * {bins}.0::double / (hi - lo)) as int))
           as bin, count(*) as n
  from {source}, ext where {value} is not null group by 1)
select cast(b as int) as bin,
       round(lo + b * (hi - lo) / {bins}.0::double, 6) as bin_start,
       round(lo + (b + 1) * (hi - lo) / {bins}.0::double, 6) as bin_end,
       coalesce(n, 0) as lines
from range({bins}) as r(b) cross join ext left join filled on bin = b"""


def density(source: str, value: str) -> str:
    return f"""
, v as (select {value}::double as v, count(*) as n from {source}
        where {value} is not null group by 1),
e as (select min(v) as lo, max(v) as hi, sum(n)::double as n from v),
b as (select stddev_samp({value}) * power((select n from e), -0.2::double) as bw from {source}),
g as (select i, lo + i * ((hi - lo) / 199.0::double) as x, e.n as total, bw
      from range(200) as r(i), e, b)
select cast(i as int) as point, round(x, 9) as x,
       round(sum(v.n * exp(-0.5::double * ((x - v) / bw) * ((x - v) / bw)))
             / (total * bw * sqrt(2 * pi())), 9) as density
from g, v group by i, x, total, bw"""


def binned_density(source: str, value: str) -> str:
    """Every value weighs on the two grid nodes around it; 32 steps lie between two points."""
    return f"""
, e as (select min({value})::double as lo, max({value})::double as hi, count({value})::double as n,
               stddev_samp({value}) * power(count({value})::double, -0.2::double) as bw,
               (max({value})::double - min({value})::double) / 6368.0::double as d from {source}),
placed as (select least(floor(({value} - lo) / d), 6367)::int as i, ({value} - lo) / d as p
       from {source}, e where {value} is not null),
masses as (select node, sum(mass) as mass from (
             select i as node, 1 - (p - i) as mass from placed union all select i + 1, p - i from placed)
           group by 1)
select cast(k as int) as point, round(lo + k * (d * 32), 9) as x,
       round(sum(mass * exp(-0.5::double * power((k * 32 - node) * d / bw, 2)))
             / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 9) as density
from range(200) as r(k), masses, e group by k, lo, d"""


def plan(z: str) -> str:
    return (
        demand()
        + f"""
, stock as (
  select product_category, ceil(sales_roll_mean_4) as predicted_weekly_demand,
         price_lag_1 as current_price,
         coalesce(sales_roll_std_4, ceil(sales_roll_mean_4)) as demand_std_dev
  from latest),
covered as (
  select *, ceil({z}::double * sqrt(2.0::double) * demand_std_dev) as safety_stock from stock)
select product_category, predicted_weekly_demand, current_price,
       round(demand_std_dev, 6) as demand_std_dev, safety_stock,
       predicted_weekly_demand * 2 + safety_stock as reorder_point,
       'Maintain ~' || cast(cast(predicted_weekly_demand * 2 + safety_stock as bigint) as varchar)
         || ' units' as order_recommendation
from covered order by predicted_weekly_demand desc, product_category"""
    )


CITY_TOP = """
, top as (
  select customer_city, count(*) as lines from staged where customer_city is not null
  group by 1 order by lines desc, customer_city limit 20)"""

REVIEWED = (
    STAGED_ALL
    + """
, reviewed as (
  select s.*, cast(quality * 2 + (1 - toxic) * 2 + 1 as double) as review_score
  from staged s left join labels l on s.order_id = l.doc_id)"""
)

HOURS = ", ".join(
    f"sum(n) filter (where hour = {h})::bigint as h{h:02d}" for h in range(24)
)

WEEKDAY_TABLE = """
days(day_index, day_of_week) as (
  values (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'), (4, 'Thursday'), (5, 'Friday'),
         (6, 'Saturday'), (7, 'Sunday'))"""

ORACLES = {
    "parse_timestamps": """
        select event_id,
               case when event_id % 7 = 0 or event_id % 11 = 0 then null
                    else date_trunc('second', ts) end as order_purchase_timestamp
        from events""",
    "category_fallback": f"""
        with {products(False)}, {TRANSLATION}, {CATEGORIZED}
        select product_id, product_category from categorized""",
    "join_category_lookup": f"""
        with {products(False)}, {TRANSLATION}
        select product_id, product_category_name, product_category_name_english
        from prods left join translation using (product_category_name)""",
    "join_items_orders": f"""
        with {ITEMS}, {ORDERS}
        select * from items join ords using (order_id)""",
    "master_table": f"""
        with {ITEMS}, {ORDERS}, {CUSTOMERS}, {products(False)}, {TRANSLATION}, {CATEGORIZED}
        select i.*, o.* exclude (order_id), c.* exclude (customer_id),
               coalesce(product_category, 'unknown') as product_category, s_name as seller_name
        from items i join ords o using (order_id) left join custs c using (customer_id)
        left join categorized p using (product_id) left join supplier on s_suppkey = seller_id""",
    "delivery_stage_days": f"""
        with {ORDERS}
        select order_id,
          cast(floor(date_diff('second', order_approved_at, order_delivered_carrier_date)
               / 86400.0) as bigint) as time_to_ship,
          cast(floor(date_diff('second', order_delivered_carrier_date,
               order_delivered_customer_date) / 86400.0) as bigint) as carrier_time,
          cast(floor(date_diff('second', order_purchase_timestamp,
               order_delivered_customer_date) / 86400.0) as bigint) as total_delivery_time,
          cast(floor(date_diff('second', order_estimated_delivery_date,
               order_delivered_customer_date) / 86400.0) as bigint) as delay_days
        from ords""",
    "first_sale_date": demand() + " select product_category, first_sale_date from first_sale",
    "weekly_demand": demand()
    + """
        select product_category, order_purchase_timestamp, quantity_sold,
               revenue, curr_avg_price, curr_avg_freight, curr_active_sellers, first_sold_at
        from weekly""",
    "observed_weeks": demand() + " select distinct order_purchase_timestamp from weekly",
    "demand_grid": demand()
    + """
        select * from grid""",
    "demand_grid_trimmed": demand()
    + """
        select * from trimmed""",
    "zombie_row_counts": demand()
    + """
        select count(*) as grid_rows,
               count(*) filter (where order_purchase_timestamp >= first_sale_date) as kept_rows,
               count(*) filter (where order_purchase_timestamp < first_sale_date) as dropped_rows
        from grid""",
    "lagged_drivers": demand()
    + """
        select product_category, order_purchase_timestamp, price_lag_1, freight_lag_1, sellers_lag_1
        from lagged""",
    "ffill_price": demand()
    + """
        select product_category, order_purchase_timestamp,
               curr_avg_price, price_lag_1 from lagged""",
    "calendar_features": demand()
    + """
        select distinct order_purchase_timestamp, week_of_year, month, year,
               round(month_sin, 9) as month_sin, round(month_cos, 9) as month_cos
        from (select order_purchase_timestamp,
                     cast(week(order_purchase_timestamp) as int) as week_of_year,
                     cast(month(order_purchase_timestamp) as int) as month,
                     cast(year(order_purchase_timestamp) as int) as year,
                     sin(2 * pi() * month(order_purchase_timestamp) / 12) as month_sin,
                     cos(2 * pi() * month(order_purchase_timestamp) / 12) as month_cos
              from weekly)""",
    "weeks_to_event": f"""
        with {ORDERS},
        dated as (
          select order_id, order_purchase_timestamp as ts,
                 cast(make_date(year(order_purchase_timestamp), 11, 24) as timestamp) as this_year,
                 cast(make_date(year(order_purchase_timestamp) + 1, 11, 24) as timestamp)
                   as next_year
          from ords)
        select order_id,
               least(20, cast(floor(floor(date_diff('second', ts,
                 case when ts > this_year then next_year else this_year end) / 86400.0) / 7.0)
                 as int)) as weeks_to_bf
        from dated""",
    "freight_ratio": demand()
    + """
        select product_category, order_purchase_timestamp,
               freight_ratio from wide""",
    "price_momentum": demand()
    + """
        select product_category, order_purchase_timestamp,
               price_roll_mean_4, price_momentum from wide""",
    "sales_lags": demand()
    + """
        select product_category, order_purchase_timestamp, sales_lag_1, sales_lag_2, sales_lag_3,
               sales_lag_4, sales_lag_8 from wide""",
    "sales_rolling_stats": demand()
    + """
        select product_category, order_purchase_timestamp,
               round(sales_roll_mean_4, 6) as sales_roll_mean_4,
               round(sales_roll_std_4, 6) as sales_roll_std_4 from wide""",
    "features_full": demand()
    + """
        select * replace (
          round(month_sin, 6) as month_sin, round(month_cos, 6) as month_cos,
          round(sales_roll_std_4, 6) as sales_roll_std_4) from features""",
    "time_split_counts": demand()
    + """
        select 'train' as part, count(*) as rows, sum(quantity_sold)::bigint as units
        from features where year < 2000 or (year = 2000 and month < 6)
        union all select 'test', count(*), sum(quantity_sold)::bigint from test""",
    "latest_week_snapshot": demand()
    + """
        select * replace (
          round(month_sin, 6) as month_sin, round(month_cos, 6) as month_cos,
          round(sales_roll_std_4, 6) as sales_roll_std_4) from latest""",
    "forecast_metrics": demand() + metrics() + " from results",
    "wmape_by_category": demand(False)
    + """
        , tagged as (
          select product_category as category, 'rolling_mean' as model,
                 quantity_sold as actual, sales_roll_mean_4 as predicted from test
          union all
          select product_category, 'last_week', quantity_sold, sales_lag_1 from test)"""
    + metrics("category, model,")
    + " from tagged group by category, model",
    "global_forecast_by_week": demand()
    + """
        select date, sum(actual)::bigint as actual, round(sum(predicted), 6) as predicted
        from results group by date""",
    "top_categories": demand()
    + """
        select category, sum(actual)::bigint as actual from results
        group by category order by actual desc, category limit 3""",
    "top_category_forecasts": demand()
    + """
        , best as (select category from results group by category
                   order by sum(actual) desc, category limit 3)
        select category, date, sum(actual)::bigint as actual,
               round(sum(predicted), 6) as predicted
        from results where category in (select category from best) group by category, date""",
    "hist_residuals": demand() + histogram("results", "error", 50),
    "ts_cv_folds": demand(False)
    + """
        , folds as (
          select cast(f as int) as fold,
                 (select max(order_purchase_timestamp) from features)
                   - to_days(cast((3 - f + 1) * 56 as int)) as train_end,
                 (select max(order_purchase_timestamp) from features)
                   - to_days(cast((3 - f) * 56 as int)) as test_end
          from range(1, 4) as r(f))
        select fold, train_end, test_end,
               count(*) filter (where order_purchase_timestamp <= train_end) as train_rows,
               count(*) filter (where order_purchase_timestamp > train_end) as test_rows,
               sum(quantity_sold) filter (where order_purchase_timestamp <= train_end)::bigint
                 as train_units,
               sum(quantity_sold) filter (where order_purchase_timestamp > train_end)::bigint
                 as test_units
        from folds join features on order_purchase_timestamp <= test_end
        group by fold, train_end, test_end""",
    "forecast_routes": demand(False)
    + """
        select order_purchase_timestamp as date, product_category as category,
               quantity_sold as actual, sales_roll_mean_4 as predicted,
               round(quantity_sold - sales_roll_mean_4, 6) as error,
               'monthly_planning' as route from test
        union all
        select order_purchase_timestamp, product_category, quantity_sold, sales_lag_1,
               quantity_sold - sales_lag_1, 'operations' from test""",
    "inventory_plan": plan("1.645"),
    "inventory_plan_z128": plan("1.28"),
    "plan_top5": plan("1.645") + " limit 5",
    "valid_logistics": STAGED_ALL
    + " select order_id, product_id, seller_id, time_to_ship, carrier_time from valid",
    "valid_logistics_v1": STAGED_ALL
    + """
        select order_id, product_id, seller_id, time_to_ship, carrier_time, total_delivery_time
        from valid_total""",
    "median_delay_by_state": STAGED_ALL
    + """
        select customer_state, quantile_cont(delay_days::double, 0.5) as median_delay_days
        from viewed where customer_state is not null group by 1""",
    "late_rate_by_state": STAGED_ALL
    + """
        select customer_state,
               round(avg(case when delay_days > 0 then 1 else 0 end) * 100, 6) as late_pct,
               count(*) filter (where delay_days > 0) as late_lines, count(*) as lines
        from staged where customer_state is not null group by 1""",
    "late_rate_national": STAGED_ALL
    + """
        , rates as (
          select customer_state,
                 avg(case when delay_days > 0 then 1 else 0 end) * 100 as pct,
                 count(*) filter (where delay_days > 0) as late, count(*) as n
          from staged where customer_state is not null group by 1)
        select round(avg(pct), 6) as mean_of_states_pct,
               round(sum(late) * 100.0::double / sum(n), 6) as weighted_pct from rates""",
    "delay_boxplot_by_state": STAGED_ALL
    + """
        , q as (
          select customer_state, quantile_cont(delay_days::double, 0.25) as q1,
                 quantile_cont(delay_days::double, 0.5) as median,
                 quantile_cont(delay_days::double, 0.75) as q3
          from viewed where customer_state is not null group by 1),
        fenced as (
          select v.customer_state, q1, median, q3, delay_days,
                 delay_days >= q1 - 1.5::double * (q3 - q1)
                   and delay_days <= q3 + 1.5::double * (q3 - q1) as inside
          from viewed v join q using (customer_state))
        select customer_state, q1, median, q3,
               min(delay_days) filter (where inside) as whisker_low,
               max(delay_days) filter (where inside) as whisker_high,
               count(*) filter (where not inside) as outliers, count(*) as lines
        from fenced group by customer_state, q1, median, q3""",
    "top_cities": STAGED_ALL + CITY_TOP + " select customer_city, lines from top",
    "city_delivery_time": STAGED_ALL
    + CITY_TOP
    + """
        select customer_city, count(*) as lines,
               round(avg(total_delivery_time), 6) as mean_delivery_days
        from staged semi join top using (customer_city) group by customer_city""",
    "state_delivery_time": STAGED_ALL
    + """
        select customer_state, round(avg(total_delivery_time), 6) as mean_delivery_days,
               count(total_delivery_time) as delivered_lines
        from staged where customer_state is not null group by 1""",
    "state_logistics_breakdown": STAGED_ALL
    + """
        select customer_state, round(avg(time_to_ship), 6) as mean_time_to_ship,
               round(avg(carrier_time), 6) as mean_carrier_time,
               round(avg(time_to_ship) + avg(carrier_time), 6) as mean_total
        from valid where customer_state is not null group by 1""",
    "delivery_composition": STAGED_ALL
    + """
        , m as (select avg(time_to_ship) as a, avg(carrier_time) as b from valid_total)
        select round(a, 6) as mean_time_to_ship, round(b, 6) as mean_carrier_time,
               round(a + b, 6) as mean_total, round(a / (a + b), 6) as seller_share,
               round(b / (a + b), 6) as carrier_share from m""",
    "city_delivery_normal_ci": STAGED_ALL
    + CITY_TOP
    + """
        , s as (
          select customer_city, count(total_delivery_time) as n, avg(total_delivery_time) as m,
                 stddev_samp(total_delivery_time) as d
          from staged semi join top using (customer_city)
          where total_delivery_time is not null group by 1)
        select customer_city, n as lines, round(m, 6) as mean,
               round(m - 1.96::double * d / sqrt(n), 6) as ci_low,
               round(m + 1.96::double * d / sqrt(n), 6) as ci_high from s""",
    "city_delivery_ci_agrees": STAGED_ALL
    + CITY_TOP
    + """
        select customer_city, count(total_delivery_time) as lines,
               round(avg(total_delivery_time), 6) as mean, true as agrees
        from staged semi join top using (customer_city)
        where total_delivery_time is not null group by 1""",
    "monthly_revenue": f"""
        with {ITEMS}, {ORDERS},
        lines as (select date_trunc('month', order_purchase_timestamp)::date as m, price
                  from items join ords using (order_id)),
        spine as (select unnest(generate_series((select min(m) from lines)::timestamp,
                    (select max(m) from lines)::timestamp, interval 1 month))::date as m),
        sums as (select m, {money('price')} as r
                 from lines group by m)
        select cast(last_day(spine.m) as timestamp) as month_end,
               coalesce(r, 0) as revenue
        from spine left join sums using (m)""",
    "weekday_hour_counts": """
        select dayname(ts) as day_of_week, cast(hour(ts) as int) as hour, count(*) as orders
        from events where ts is not null group by 1, 2""",
    "weekday_hour_pivot": f"""
        with {ITEMS}, {ORDERS}, {WEEKDAY_TABLE},
        cells as (
          select dayname(order_purchase_timestamp) as day_of_week,
                 hour(order_purchase_timestamp) as hour, count(*) as n
          from items join ords using (order_id) group by 1, 2)
        select day_of_week, cast(day_index as int) as day_index, {HOURS}
        from days left join cells using (day_of_week) group by 1, 2""",
    "payment_share": """
        with p as (
          select case when o_orderkey % 53 <> 0 then o_orderpriority end as payment_type
          from orders)
        select payment_type, count(*) as payments,
               round(count(*) * 100.0::double / sum(count(*)) over (), 1) as share_pct
        from p where payment_type is not null group by 1""",
    "hist_seller_time": STAGED_ALL + histogram("valid", "time_to_ship", 20),
    "hist_carrier_time": STAGED_ALL + histogram("valid", "carrier_time", 40),
    "hist_seller_time_v1": STAGED_ALL + histogram("valid_total", "time_to_ship", 30),
    "hist_carrier_time_v1": STAGED_ALL + histogram("valid_total", "carrier_time", 30),
    "kde_carrier_time": STAGED_ALL + density("valid", "carrier_time"),
    "kde_seller_time": STAGED_ALL + density("valid", "time_to_ship"),
    "kde_residuals": demand() + binned_density("results", "error"),
    "vendor_risk": REVIEWED
    + """
        , s as (
          select seller_id, count(*) as lines, avg(time_to_ship) as ship,
                 avg(review_score) as review
          from reviewed group by 1)
        select seller_id, lines, round(ship, 6) as mean_time_to_ship,
               round(review, 6) as mean_review,
               coalesce(lines >= (select quantile_disc(lines, 0.75) from s)
                 and ship >= (select quantile_disc(ship, 0.75) from s), false) as at_risk
        from s""",
    "ship_review_corr": REVIEWED
    + """
        select count(*) as reviewed_lines,
               round(corr(time_to_ship, review_score), 6) as corr_ship,
               round(corr(total_delivery_time, review_score), 6) as corr_total
        from reviewed where review_score is not null""",
    "dissatisfaction_rate": """
        with r as (
          select source as review_source, quality * 2 + (1 - toxic) * 2 + 1 as score
          from labels join documents using (doc_id))
        select review_source, count(*) as reviews,
               count(*) filter (where score <= 2) as low_reviews,
               round(count(*) filter (where score <= 2) * 100.0::double / count(*), 6)
                 as dissatisfied_pct
        from r where review_source is not null group by 1""",
    "dissatisfaction_by_category": "with "
    + ",".join((ITEMS, ORDERS, products(False), TRANSLATION, CATEGORIZED))
    + """,
        scores as (
          select doc_id as order_id, avg(quality * 2 + (1 - toxic) * 2 + 1) as score from labels group by 1)
        select coalesce(product_category, 'unknown') as product_category, count(*) as reviews,
               count(*) filter (where score <= 2) as low_reviews,
               round(count(*) filter (where score <= 2) * 100.0::double / count(*), 6) as dissatisfied_pct
        from items join ords using (order_id) left join categorized using (product_id)
        join scores using (order_id) where score is not null group by 1""",
    "stream_weekly_demand": f"""
        with s as (
          select event_type as product_category,
                 date_trunc('week', ts - interval 1 day) + interval 7 day as w, *,
                 case when event_id % 3 <> 0 then value end as freight
          from events)
        select product_category, cast(w as timestamp) as order_purchase_timestamp,
               count(*) as quantity_sold,
               round({money('value')}, 6) as revenue,
               round({money('value')}
                     / count(value), 6) as curr_avg_price,
               round({money('freight')}
                     / count(freight), 6) as curr_avg_freight,
               count(distinct user_id) as curr_active_sellers,
               min(ts) as first_sold_at
        from s group by 1, 2""",
    "category_levels": demand()
    + """,
        train as (select * from features where year < 2000 or (year = 2000 and month < 6)),
        week_sums as (
          select order_purchase_timestamp, sum(quantity_sold) as s, count(*) as n from train group by 1),
        priors as (
          select a.order_purchase_timestamp,
                 coalesce(sum(b.s)::double / nullif(sum(b.n), 0), 0) as prior
          from week_sums a left join week_sums b
            on b.order_purchase_timestamp < a.order_purchase_timestamp group by 1)
        select product_category, order_purchase_timestamp,
               round((coalesce(sum(quantity_sold) over before, 0)::double + prior * 8)
                     / (count(*) over before + 8), 9) as category_level
        from train join priors using (order_purchase_timestamp)
        window before as (partition by product_category order by order_purchase_timestamp
                          rows between unbounded preceding and 1 preceding)""",
    "category_levels_final": demand()
    + """,
        train as (select * from features where year < 2000 or (year = 2000 and month < 6)),
        overall as (select sum(quantity_sold)::double / count(*) as prior from train)
        select product_category,
               round((sum(quantity_sold)::double + any_value(prior) * 8) / (count(*) + 8), 9) as category_level
        from train, overall group by product_category
        union all select null, round(prior, 9) from overall""",
    "stream_features": demand(False)
    + """
        select * replace (
          round(month_sin, 6) as month_sin, round(month_cos, 6) as month_cos,
          round(sales_roll_std_4, 6) as sales_roll_std_4) from features""",
}
