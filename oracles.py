"""DuckDB SQL that says, independently of the Spark plans, what each query returns.

Views are written over the given tables and pulled into a query as CTEs when it names
them.  Means are rounded half away from zero in integer arithmetic.
"""

from __future__ import annotations

import re

from tillstream.sources.shaped import CITIES, COUNTRIES, RETAIL_NOW

DAY_MICROS = 86_400_000_000
NOW = f"timestamp '{RETAIL_NOW}'"
WORDS = "['Clear', 'Clouds', 'Rain', 'Snow', 'Mist']"


def half_up(numerator: str, denominator: str, digits: int, scale: int = 0) -> str:
    """round(numerator / 10^scale / denominator, digits) of exact integers, as double."""
    n = f"cast({numerator} as hugeint)"
    d = f"nullif(cast({denominator} as hugeint) * {10 ** scale}, 0)"
    return (
        f"(case when {n} < 0 then -1 else 1 end"
        f" * ((2 * abs({n}) * {10 ** digits} + {d}) // (2 * {d}))) / {10 ** digits}.0::double"
    )


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


VIEWS = {
    "dim_city": f"select * from (values {_rows(CITIES)}) as t(city_id, city, country_code, lat, lon)",
    "dim_country": f"""
        select country_code, country_name, currency, cast(population as bigint) as population, region
        from (values {_rows(COUNTRIES)}) as t(country_code, country_name, currency, population, region)""",
    "raw_orders": f"""
        with p as (select *, o_orderdate + to_seconds(cast((o_orderkey * 7919) % 86400 as integer)) as pts from orders),
        a as (select *, pts + to_minutes(cast(5 + o_orderkey % 56 as integer)) as ats from p)
        select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
          case o_orderpriority when '1-URGENT' then 'delivered' when '2-HIGH' then 'shipped'
            when '3-MEDIUM' then 'processing' when '4-NOT SPECIFIED' then 'cancelled' else 'returned' end as order_status,
          pts as order_purchase_ts, ats as order_approved_ts,
          case when o_orderpriority = '1-URGENT' then ats + to_days(cast(3 + o_orderkey % 18 as integer)) end as order_delivered_ts,
          cast(pts + to_days(cast(7 + cast(floor(o_totalprice) as bigint) % 24 as integer)) as date) as order_estimated_delivery_date,
          pts as created_at,
          case o_orderkey % 7 when 0 then 'Clear' when 1 then 'Clouds' when 2 then 'Rain' when 3 then 'Snow'
            when 4 then 'Mist' when 5 then '' end as weather_condition,
          cast(cast((o_orderkey * 13) % 401 - 50 as double) / 10 as decimal(5,1)) as temperature_c,
          cast(o_orderkey % 101 as int) as humidity
        from a""",
    "raw_order_items": """
        select cast(l_orderkey as varchar) as order_id, cast(l_partkey as varchar) as product_id,
          cast(l_suppkey as varchar) as seller_id, cast(l_quantity as int) as quantity,
          cast(l_extendedprice as decimal(18,2)) as price,
          round(cast(l_extendedprice as decimal(18,2)) * cast(0.1 as decimal(2,1)), 2) as freight_value
        from lineitem""",
    "raw_customers": """
        select cast(c.c_custkey as varchar) as customer_id, d.city as customer_city, d.country_code as customer_state,
          '' as customer_zip, d.country_code, coalesce(k.country_name, d.country_code) as country_name,
          cast(case when c.c_custkey % 13 = 0 then null when c.c_custkey % 17 = 0 then 0 else d.lat end as double) as lat,
          cast(d.lon as double) as lon
        from customer c join dim_city d on d.city_id = c.c_custkey % 12
        left join dim_country k on k.country_code = d.country_code""",
    "raw_products": """
        select cast(p_partkey as varchar) as product_id, p_type as category_name,
          cast(p_size * 100 as int) as product_weight_g, cast(p_retailprice as decimal(18,2)) as product_price
        from part""",
    "dirty_orders": """
        select * replace (
          case when cast(order_id as bigint) % 997 = 3 then null when cast(order_id as bigint) % 1009 = 5 then '7' else order_id end as order_id,
          case when cast(order_id as bigint) % 499 = 7 then null else customer_id end as customer_id,
          case when cast(order_id as bigint) % 61 = 11 then 'lost' when cast(order_id as bigint) % 1499 = 9 then null else order_status end as order_status,
          case when cast(order_id as bigint) % 2003 = 17 then null
            when cast(order_id as bigint) % 3001 = 19 then order_purchase_ts + interval '20' year else order_purchase_ts end as order_purchase_ts,
          case when cast(order_id as bigint) % 701 = 13 then order_purchase_ts - interval '1' hour else order_approved_ts end as order_approved_ts)
        from raw_orders""",
    "dirty_customers": """
        select * replace (
          case when cast(customer_id as bigint) % 401 = 2 then null else customer_id end as customer_id,
          case when cast(customer_id as bigint) % 37 = 0 then null else customer_city end as customer_city)
        from raw_customers""",
    "dirty_products": """
        select * replace (
          case when cast(product_id as bigint) % 503 = 4 then '9' else product_id end as product_id,
          case when cast(product_id as bigint) % 29 = 0 then null else category_name end as category_name,
          case when cast(product_id as bigint) % 307 = 1 then -product_price
            when cast(product_id as bigint) % 411 = 3 then 0 else product_price end as product_price)
        from raw_products""",
    "dirty_order_items": """
        select * replace (
          case when cast(order_id as bigint) % 2999 = 21 then null
            when cast(order_id as bigint) % 1999 = 23 then concat('X', order_id) else order_id end as order_id,
          case when cast(product_id as bigint) % 1777 = 1 then null else product_id end as product_id,
          case when cast(product_id as bigint) % 1301 = 2 then 0 else quantity end as quantity,
          case when cast(product_id as bigint) % 1103 = 3 then -price else price end as price)
        from raw_order_items""",
    "order_events": """
        select event_id, concat('E', cast(event_id as varchar)) as order_id, concat('U', cast(user_id as varchar)) as customer_id,
          case event_type when 'purchase' then 'delivered' when 'signup' then 'shipped' when 'view' then 'processing'
            when 'error' then 'cancelled' else 'returned' end as order_status,
          concat('P', json_extract_string(props, '$.k')) as product_id,
          cast(json_extract_string(props, '$.k') as int) % 10 as category_no,
          cast(value as decimal(18,2)) as price, cast(1 + event_id % 5 as int) as quantity, cast(user_id % 12 as int) as city_id,
          ts - to_seconds(cast((event_id * 37) % 3600 as integer)) as purchased_at, ts
        from events""",
    "weather_readings": f"""
        select cast(user_id % 12 as int) as city_id, ts as fetched_at,
          {WORDS}[cast(json_extract_string(props, '$.k') as int) % 5 + 1] as weather_condition,
          lower({WORDS}[cast(json_extract_string(props, '$.k') as int) % 5 + 1]) as weather_desc,
          round(cast(value as decimal(18,2)), 1) as temperature_c,
          round(cast(value as decimal(18,2)) - 2, 1) as feels_like_c,
          cast(json_extract_string(props, '$.k') as int) as humidity,
          cast(cast(json_extract_string(props, '$.k') as int) as double) / 10 as wind_speed
        from events where event_type = 'view'""",
    # What the messages hold after parsing, whatever their JSON text looks like.
    "wire_events": f"""
        select e.*, concat('category_', category_no) as category_name,
          round(price * cast(0.1 as decimal(2,1)), 2) as freight_value,
          event_id % 101 = 5 as bare, event_id % 251 = 17 as cut,
          d.city, d.country_code, k.country_name, k.currency, k.population, k.region, d.lat, d.lon,
          lpad(cast(e.city_id * 100 as varchar), 5, '0') as zip,
          {WORDS}[event_id % 5 + 1] as weather_condition,
          ((event_id * 13) % 401 - 50)::double / 10 as temperature_c,
          ((event_id * 13) % 401 - 70)::double / 10 as feels_like_c,
          cast(event_id % 101 as int) as humidity, (event_id % 150)::double / 10 as wind_speed
        from order_events e left join dim_city d on d.city_id = e.city_id
        left join dim_country k on k.country_code = d.country_code""",
    # Messages that can be stored: cut ones are gone, some come twice.
    "messages": """
        select * from wire_events where not cut
        union all select * from wire_events where not cut and event_id % 127 = 4""",
    "stg_orders": f"""
        select order_id, customer_id, order_status, order_purchase_ts as purchased_at, order_approved_ts as approved_at,
          order_delivered_ts as delivered_at, order_estimated_delivery_date as estimated_delivery_date,
          date_diff('microsecond', order_purchase_ts, order_delivered_ts)::double / {DAY_MICROS}.0::double as delivery_days,
          coalesce(order_delivered_ts > order_estimated_delivery_date, false) as is_late, created_at
        from raw_orders where order_id is not null and customer_id is not null""",
    "item_totals": """
        select order_id, sum(price * quantity) as gross_revenue, sum(freight_value) as total_freight,
          count(distinct product_id) as distinct_products
        from raw_order_items group by order_id""",
}


def mart_sql(orders: str, totals: str) -> str:
    """The staged daily mart over any orders and item totals."""
    returned = "count(*) filter (where order_status = 'returned')"
    return f"""
        select date_trunc('day', order_purchase_ts)::timestamp as order_date,
          count(distinct o.order_id) as total_orders, count(distinct customer_id) as unique_customers,
          cast(sum(gross_revenue) as double) as gross_revenue,
          {half_up("sum(gross_revenue) * 100", "count(gross_revenue)", 2, 2)} as avg_order_value,
          {half_up("sum(date_diff('microsecond', order_purchase_ts, order_delivered_ts))",
                   f"count(order_delivered_ts - order_purchase_ts) * {DAY_MICROS}", 1)} as avg_delivery_days,
          count(*) filter (where order_delivered_ts > order_estimated_delivery_date) as late_orders,
          {returned} as returned_orders,
          {half_up(f"100 * {returned}", "count(*)", 2)} as return_rate_pct
        from {orders} o left join {totals} i on i.order_id = o.order_id
        where o.order_id is not null and customer_id is not null
        group by 1"""


VIEWS["mart"] = mart_sql("raw_orders", "item_totals")
VIEWS["dirty_totals"] = (
    "select order_id, sum(price * quantity) as gross_revenue from dirty_order_items group by order_id"
)
VIEWS["dirty_mart"] = mart_sql("dirty_orders", "dirty_totals")

# check: condition for failing rows, or None for the two checks that need a grouping.
CONDITIONS = {
    "orders": {
        "null_order_id": "order_id is null",
        "null_customer_id": "customer_id is null",
        "null_status": "order_status is null",
        "null_purchase_ts": "order_purchase_ts is null",
        "duplicate_order_id": None,
        "future_purchase_ts": f"order_purchase_ts > {NOW}",
        "approved_before_purchase": "order_approved_ts < order_purchase_ts",
        "invalid_status": "order_status not in ('delivered', 'shipped', 'processing', 'cancelled', 'returned')",
    },
    "customers": {
        "null_customer_id": "customer_id is null",
        "null_city": "customer_city is null",
        "duplicate_customer_id": None,
    },
    "products": {
        "null_product_id": "product_id is null",
        "null_category": "category_name is null",
        "negative_price": "product_price < 0",
        "zero_price": "product_price = 0",
        "duplicate_product_id": None,
    },
    "order_items": {
        "null_order_id": "order_id is null",
        "null_product_id": "product_id is null",
        "negative_price": "price < 0",
        "zero_quantity": "quantity <= 0",
        "orphan_order_id": None,
    },
}


def checks_sql(prefix: str, tables: list[str] | None = None) -> str:
    parts = []
    for table in tables or CONDITIONS:
        source = f"{prefix}_{table}"
        for check, condition in CONDITIONS[table].items():
            if condition:
                fails = f"(select count(*) filter (where {condition}) from {source})"
            elif check.startswith("duplicate_"):
                key = check.removeprefix("duplicate_")
                fails = f"(select count(*) from (select 1 from {source} group by {key} having count(*) > 1))"
            else:
                fails = (
                    f"(select count(*) from {source} c anti join {prefix}_orders p on p.order_id = c.order_id)"
                )
            parts.append(
                f"select '{table}' as table_name, '{check}' as check_name,"
                f" (select count(*) from {source}) as row_count, {fails} as fail_count"
            )
    return f"""
        select table_name, check_name,
          case when fail_count = 0 then 'PASS' when fail_count * 100 < greatest(row_count, 1) then 'WARN' else 'FAIL' end as status,
          case when fail_count = 0 then '' else printf('%d rows affected (%.1f%%)', fail_count,
            fail_count::double / greatest(row_count, 1)::double * 100.0::double) end as detail,
          row_count, fail_count
        from ({" union all ".join(parts)})"""


VIEWS["dq_clean"] = checks_sql("raw")
VIEWS["dq_dirty"] = checks_sql("dirty")
VIEWS["dq_log"] = """
    select *, timestamp '2001-08-01 23:45:00' as run_at from dq_clean
    union all select *, timestamp '2001-08-01 23:55:00' as run_at from dq_dirty"""


def schema_tests_sql() -> str:
    def not_null(dataset: str, source: str, column: str) -> str:
        return f"select '{dataset}' as dataset, '{column}' as column_name, 'not_null' as test, (select count(*) from {source} where {column} is null) as failures"

    def unique(dataset: str, source: str, column: str) -> str:
        return f"select '{dataset}', '{column}', 'unique', (select count(*) from (select {column} from {source} where {column} is not null group by 1 having count(*) > 1))"

    staged = "(select * from dirty_orders where order_id is not null and customer_id is not null)"
    return " union all ".join(
        [
            not_null("orders", "dirty_orders", "order_id"),
            unique("orders", "dirty_orders", "order_id"),
            not_null("orders", "dirty_orders", "customer_id"),
            not_null("orders", "dirty_orders", "order_status"),
            "select 'orders', 'order_status', 'accepted_values', (select count(distinct order_status) from dirty_orders"
            " where order_status not in ('delivered', 'shipped', 'processing', 'cancelled', 'returned'))",
            not_null("customers", "dirty_customers", "customer_id"),
            unique("customers", "dirty_customers", "customer_id"),
            not_null("products", "dirty_products", "product_id"),
            unique("products", "dirty_products", "product_id"),
            not_null("products", "dirty_products", "product_price"),
            not_null("order_items", "dirty_order_items", "order_id"),
            not_null("order_items", "dirty_order_items", "product_id"),
            not_null("stg_orders", staged, "order_id"),
            unique("stg_orders", staged, "order_id"),
            not_null("stg_orders", staged, "customer_id"),
            not_null("mart_order_metrics", "dirty_mart", "order_date"),
            unique("mart_order_metrics", "dirty_mart", "order_date"),
            not_null("mart_order_metrics", "dirty_mart", "gross_revenue"),
        ]
    )


def asof_sql(valid_seconds: int, events: str = "order_events") -> str:
    """Newest reading per event; of equal times the largest reading."""
    found = f"date_diff('microsecond', w.fetched_at, e.purchased_at) <= {valid_seconds * 1_000_000}"
    return f"""
        with w as (
          select city_id, fetched_at, max((weather_condition, weather_desc, temperature_c, feels_like_c, humidity, wind_speed)) as r
          from weather_readings group by city_id, fetched_at)
        select e.order_id, e.city_id, e.purchased_at,
          coalesce(case when {found} then r[1] end, 'Unknown') as weather_condition,
          coalesce(case when {found} then r[2] end, 'unavailable') as weather_desc,
          cast(coalesce(case when {found} then r[3] end, 0) as double) as temperature_c,
          cast(coalesce(case when {found} then r[4] end, 0) as double) as feels_like_c,
          cast(coalesce(case when {found} then r[5] end, 0) as bigint) as humidity,
          cast(coalesce(case when {found} then r[6] end, 0) as double) as wind_speed
        from {events} e asof left join w on w.city_id = e.city_id and e.purchased_at >= w.fetched_at"""


COUNTRY_SQL = """
    select e.order_id, d.city, d.country_code, coalesce(k.country_name, d.country_code) as country_name,
      coalesce(k.currency, 'USD') as currency, coalesce(k.population, 0) as population, coalesce(k.region, '') as region
    from order_events e left join dim_city d on d.city_id = e.city_id
    left join dim_country k on k.country_code = d.country_code"""

FLAT_ORDERS = """
    select order_id, customer_id, order_status, purchased_at as order_purchase_ts,
      case when bare then '' else weather_condition end as weather_condition,
      case when bare then '' else lower(weather_condition) end as weather_desc,
      cast(case when bare then 0 else temperature_c end as double) as temperature_c,
      cast(case when bare then 0 else humidity end as bigint) as humidity,
      cast(case when bare then 0 else wind_speed end as double) as wind_speed
    from messages"""

FLAT_CUSTOMERS = """
    select customer_id, case when bare then '' else city end as customer_city,
      case when bare then '' else country_code end as customer_state, '' as customer_zip,
      case when bare then '' else country_code end as country_code,
      case when bare then '' else coalesce(country_name, '') end as country_name,
      case when bare then '' else coalesce(currency, '') end as currency,
      case when bare then 0 else coalesce(population, 0) end as population,
      case when bare then '' else coalesce(region, '') end as region,
      cast(case when bare then 0 else lat end as double) as lat,
      cast(case when bare then 0 else lon end as double) as lon
    from messages"""

ORACLES = {
    "stg_orders": "select * from stg_orders",
    "order_item_agg": """
        select order_id, cast(gross_revenue as double) as gross_revenue, cast(total_freight as double) as total_freight,
          distinct_products from item_totals""",
    "mart_order_metrics": "select * from mart",
    "spark_order_metrics": f"""
        select cast(order_purchase_ts as date) as order_date, count(distinct o.order_id) as total_orders,
          count(distinct customer_id) as unique_customers, cast(sum(gross_revenue) as double) as gross_revenue,
          {half_up("sum(gross_revenue) * 100", "count(gross_revenue)", 2, 2)} as avg_order_value,
          {half_up("sum(cast(order_delivered_ts as date) - cast(order_purchase_ts as date))",
                   "count(cast(order_delivered_ts as date) - cast(order_purchase_ts as date))", 1)} as avg_delivery_days,
          count(*) filter (where order_status = 'returned') as returned_orders,
          {half_up("100 * count(*) filter (where order_status = 'returned')", "count(distinct o.order_id)", 2)} as return_rate_pct
        from raw_orders o left join item_totals i on i.order_id = o.order_id group by 1""",
    "hourly_order_metrics": f"""
        select date_trunc('hour', order_purchase_ts)::timestamp as hour, count(distinct o.order_id) as total_orders,
          cast(sum(price * quantity) as double) as gross_revenue, count(distinct customer_id) as unique_customers
        from raw_orders o left join raw_order_items i on i.order_id = o.order_id
        where order_purchase_ts >= {NOW} - interval 48 hour group by 1""",
    "weather_order_metrics": f"""
        select weather_condition, count(*) as total_orders,
          {half_up("sum(temperature_c) * 10", "count(temperature_c)", 1, 1)} as avg_temp,
          {half_up("sum(humidity)", "count(humidity)", 1)} as avg_humidity
        from raw_orders where weather_condition <> '' and order_purchase_ts >= {NOW} - interval 7 day group by 1""",
    "city_order_metrics": f"""
        select customer_city as city, country_name, country_code, lat, coalesce(lon, 0) as lon,
          count(distinct o.order_id) as total_orders, cast(sum(price * quantity) as double) as gross_revenue
        from raw_customers c join raw_orders o on o.customer_id = c.customer_id
        left join raw_order_items i on i.order_id = o.order_id
        where lat <> 0 and order_purchase_ts >= {NOW} - interval 7 day group by 1, 2, 3, 4, 5""",
    "live_order_feed": f"""
        select o.order_id, customer_city as city, country_code, order_status, weather_condition,
          cast(temperature_c as double) as temperature_c, cast(price as double) as price, order_purchase_ts as purchased_at
        from raw_orders o left join raw_customers c on c.customer_id = o.customer_id
        left join raw_order_items i on i.order_id = o.order_id
        where order_purchase_ts >= {NOW} - interval 7 day
        order by order_purchase_ts desc, o.order_id, o.customer_id, order_status, weather_condition nulls first,
          temperature_c, price nulls first limit 20""",
    "daily_metrics_recent": "select * from mart order by order_date desc nulls first limit 90",
    "kpi_latest": """
        with recent as (select * from mart order by order_date desc nulls first limit 90),
        pair as (select *, lead(total_orders) over w as before_orders, lead(gross_revenue) over w as before_revenue,
            row_number() over w as n from recent window w as (order by order_date desc nulls first))
        select order_date, total_orders, total_orders - before_orders as orders_delta, gross_revenue,
          case when before_revenue <> 0 then cast(cast(gross_revenue as decimal(28,2)) - cast(before_revenue as decimal(28,2)) as double) end as revenue_delta,
          avg_order_value, coalesce(avg_delivery_days, 0) as avg_delivery_days, coalesce(return_rate_pct, 0) as return_rate_pct
        from pair where n = 1""",
    "revenue_trend_30d": """
        select order_date, gross_revenue from mart order by order_date desc nulls first limit 30""",
    "dq_latest_results": """
        select table_name, check_name, status, fail_count, run_at from dq_log
        order by run_at desc, table_name, check_name limit 50""",
    "dq_orders": checks_sql("dirty", ["orders"]),
    "dq_customers": checks_sql("dirty", ["customers"]),
    "dq_products": checks_sql("dirty", ["products"]),
    "dq_order_items": checks_sql("dirty", ["order_items"]),
    "dq_results": "select * from dq_dirty",
    "dq_results_single_table": checks_sql("dirty", ["orders"]),
    "dq_summary": """
        select count(*) as total, count(*) filter (where status = 'PASS') as passed,
          count(*) filter (where status = 'WARN') as warned, count(*) filter (where status = 'FAIL') as failed from dq_dirty""",
    "dq_gate": f"""
        select count(*) as fail_count from dq_log
        where status = 'FAIL' and run_at >= {NOW} - interval 10 minute""",
    "duplicate_keys": """
        select 'orders' as table_name, order_id as key, count(*) as copies from dirty_orders group by 2 having count(*) > 1
        union all select 'customers', customer_id, count(*) from dirty_customers group by 2 having count(*) > 1
        union all select 'products', product_id, count(*) from dirty_products group by 2 having count(*) > 1""",
    "orphan_order_items": """
        select c.order_id, count(*) as items from dirty_order_items c
        anti join dirty_orders p on p.order_id = c.order_id group by 1""",
    "schema_tests": schema_tests_sql(),
    "insert_new_customers": """
        with incoming as (
          select customer_id, customer_city, customer_state, timestamp '2001-08-02 00:00:00' as sent from raw_customers
          union all
          select customer_id, case when bare then '' else city end, case when bare then '' else country_code end, ts from messages),
        first as (select * from incoming qualify row_number() over (partition by customer_id order by sent, customer_city, customer_state) = 1)
        select customer_id, customer_city, customer_state from first f
        where not exists (select 1 from dirty_customers d where d.customer_id = f.customer_id)""",
    "insert_new_products": """
        with incoming as (
          select product_id, category_name, product_price, timestamp '2001-08-02 00:00:00' as sent from raw_products
          union all select product_id, category_name, price, ts from messages),
        first as (select * from incoming qualify row_number() over (partition by product_id order by sent, category_name, product_price) = 1)
        select product_id, category_name, cast(product_price as double) as product_price from first f
        where not exists (select 1 from dirty_products d where d.product_id = f.product_id)""",
    "insert_new_orders": """
        with incoming as (
          select order_id, customer_id, order_status, order_purchase_ts from raw_orders
          union all select order_id, customer_id, order_status, purchased_at from messages)
        select distinct * from incoming f
        where not exists (select 1 from dirty_orders d where d.order_id = f.order_id)""",
    "append_order_items": """
        select order_id, product_id, seller_id, quantity::bigint as quantity, cast(price as double) as price,
          cast(freight_value as double) as freight_value from raw_order_items
        union all select order_id, product_id, 'kafka-hybrid', quantity, cast(price as double), cast(freight_value as double) from messages""",
    "parse_order_events": """
        select order_id, customer_id, order_status, product_id, category_name, cast(price as double) as price,
          quantity::bigint as quantity, cast(freight_value as double) as freight_value,
          case when not bare then city end as city, case when not bare then country_code end as country_code,
          case when not bare then weather_condition end as weather_condition,
          case when not bare then temperature_c end as temperature_c, purchased_at, ts
        from messages""",
    "flatten_orders": FLAT_ORDERS,
    "flatten_customers": FLAT_CUSTOMERS,
    "flatten_products": "select product_id, category_name, cast(price as double) as product_price from messages",
    "flatten_order_items": """
        select order_id, product_id, 'kafka-hybrid' as seller_id, quantity::bigint as quantity,
          cast(price as double) as price, cast(freight_value as double) as freight_value from messages""",
    "flatten_simple_events": """
        select order_id, customer_id, order_status, purchased_at as order_purchase_ts,
          case when not bare then city end as customer_city, case when not bare then country_code end as customer_state,
          case when not bare then zip end as customer_zip, product_id, category_name, cast(price as double) as product_price,
          'kafka-seller' as seller_id, quantity::bigint as quantity, cast(freight_value as double) as freight_value
        from messages""",
    "ensure_columns": """
        select *, cast(null as varchar) as currency, cast(null as bigint) as population, cast(null as varchar) as region
        from raw_customers""",
    "derive_freight": """
        select order_id, product_id, quantity::bigint as quantity, cast(price as double) as price,
          cast(freight_value as double) as freight_value, cast(price * quantity as double) as line_revenue
        from raw_order_items""",
    "sample_ids": """
        select * from (
          select 'customers' as source, customer_id as id from (select distinct customer_id from raw_customers)
          order by md5(concat(customer_id, '42')), customer_id limit 200)
        union all select * from (
          select 'products', product_id from (select distinct product_id from raw_products)
          order by md5(concat(product_id, '42')), product_id limit 100)""",
    "country_currency": """
        select event_id, coalesce(json_keys(props)[1], 'USD') as currency from events""",
    "publish_order_events": """
        select order_id as key, replace(cast(to_json({
            'event_type': 'order_created', 'order_id': order_id, 'customer_id': customer_id, 'order_status': order_status,
            'product': {'product_id': product_id, 'category_name': category_name, 'price': price},
            'quantity': quantity, 'freight_value': freight_value,
            'purchased_at': replace(cast(purchased_at as varchar), ' ', 'T'), 'ts': replace(cast(ts as varchar), ' ', 'T')
          }) as varchar), ' ', '') as value
        from wire_events""",
    "enrich_country": COUNTRY_SQL,
    "enrich_weather_asof": asof_sql(300),
    "enrich_weather_asof_6h": asof_sql(21600),
    # The simple event needs a customer struct: bare events are not stored.
    "stream_ingest_orders": """
        with first_customer as (select * from messages where not bare qualify row_number() over (partition by customer_id order by ts) = 1),
        first_product as (select * from messages where not bare qualify row_number() over (partition by product_id order by ts) = 1)
        select e.order_id, e.customer_id, e.order_status, e.purchased_at as order_purchase_ts,
          c.city as customer_city, c.zip as customer_zip,
          e.product_id, p.category_name, cast(p.price as double) as product_price, 'kafka-seller' as seller_id,
          e.quantity::bigint as quantity, cast(e.price as double) as price, cast(e.freight_value as double) as freight_value
        from (select distinct * from messages where not bare) e
        join first_customer c on c.customer_id = e.customer_id join first_product p on p.product_id = e.product_id""",
    "stream_ingest_enriched": f"""
        with first_customer as (select * from messages qualify row_number() over (partition by customer_id order by ts) = 1)
        select e.order_id, e.customer_id, e.order_status, e.purchased_at as order_purchase_ts,
          case when e.bare then '' else e.weather_condition end as weather_condition,
          cast(case when e.bare then 0 else e.temperature_c end as double) as temperature_c,
          e.product_id, 'kafka-hybrid' as seller_id, e.quantity::bigint as quantity, cast(e.price as double) as price,
          case when c.bare then '' else c.city end as customer_city,
          case when c.bare then '' else coalesce(c.country_name, '') end as country_name,
          cast(case when c.bare then 0 else coalesce(c.population, 0) end as bigint) as population, e.category_name
        from (select distinct * from messages) e join first_customer c on c.customer_id = e.customer_id""",
    "reject_batch_rows": """
        select 'orders without order_id' as reason, count(*) as rows from dirty_orders where order_id is null having count(*) > 0
        union all select 'customers without customer_id', count(*) from dirty_customers where customer_id is null having count(*) > 0
        union all select 'products without product_id', count(*) from dirty_products where product_id is null having count(*) > 0""",
    "ensure_order_columns": """
        select order_id, weather_condition, cast(null as varchar) as weather_desc, cast(null as double) as temperature_c,
          cast(null as bigint) as humidity, cast(null as double) as wind_speed from raw_orders""",
    "stream_dedup_orders": f"select distinct * from ({FLAT_ORDERS})",
    "stream_hourly_orders": """
        select date_trunc('hour', purchased_at)::timestamp as hour, count(*) as total_orders,
          cast(sum(price * quantity) as double) as gross_revenue, count(distinct customer_id) as unique_customers
        from wire_events where not cut group by 1""",
    "stream_hourly_windows": """
        select date_trunc('hour', purchased_at)::timestamp as hour, count(*) as total_orders,
          cast(sum(price * quantity) as double) as gross_revenue from order_events group by 1""",
    "stream_enrich_orders": f"""
        select a.*, c.* exclude (order_id) from ({asof_sql(300)}) a join ({COUNTRY_SQL}) c on c.order_id = a.order_id""",
    "reject_malformed_events": """
        select order_id as key, 'malformed' as reason from wire_events where cut
        union all select order_id, 'malformed' from wire_events where cut and event_id % 127 = 4""",
    "pipeline_daily": f"""
        with all_orders as (
          select order_id, customer_id, order_status, order_purchase_ts, order_delivered_ts, order_estimated_delivery_date from raw_orders
          union all select order_id, customer_id, order_status, purchased_at, null, null from order_events),
        all_totals as (select order_id, sum(price * quantity) as gross_revenue from (
            select order_id, price, quantity from raw_order_items union all select order_id, price, quantity from order_events)
          group by 1)
        {mart_sql("all_orders", "all_totals")}""",
}


def _needed(sql: str) -> set[str]:
    names = {v for v in VIEWS if re.search(rf"\b{v}\b", sql)}
    for name in list(names):
        names |= _needed(VIEWS[name]) if VIEWS[name] != sql else set()
    return names


def with_views(sql: str) -> str:
    """The query with the views it uses in front, in the order they are defined."""
    needed = _needed(sql)
    if not needed:
        return sql
    ctes = ", ".join(f"{v} as ({VIEWS[v]})" for v in VIEWS if v in needed)
    return f"with {ctes} select * from ({sql})"


ORACLES["hourly_customers_bitmap"] = """
    select 'hour' as period, date_trunc('hour', purchased_at)::timestamp as start, count(distinct customer_id) as unique_customers
    from wire_events where not cut group by 2
    union all select 'day', date_trunc('day', purchased_at)::timestamp, count(distinct customer_id) from wire_events where not cut group by 2"""
ORACLES["stream_live_feed"] = """
    with first_customer as (select * from messages qualify row_number() over (partition by customer_id order by ts) = 1)
    select e.order_id, case when c.bare then '' else c.city end as city, case when c.bare then '' else c.country_code end as country_code,
      e.order_status, case when e.bare then '' else e.weather_condition end as weather_condition,
      cast(case when e.bare then 0 else e.temperature_c end as double) as temperature_c, cast(e.price as double) as price, e.purchased_at
    from (select distinct * from messages) e join first_customer c on c.customer_id = e.customer_id
    where e.purchased_at >= timestamp '2024-01-31 00:00:00' - interval 1 day
    order by e.purchased_at desc, e.order_id limit 20"""
ORACLES["stream_from_latest"] = """
    select order_id, customer_id, order_status, purchased_at from messages where ts >= timestamp '2024-01-16'"""
ORACLES["evolve_stored_tables"] = """
    select order_id, customer_id, quantity::bigint as quantity,
      case when part > 0 and not bare then weather_condition end as weather_condition,
      case when bare then null when part = 1 then floor(temperature_c) when part = 2 then temperature_c end as temperature_c,
      case when part = 2 and not bare then country_code end as country_code
    from (select *, least((day(ts) - 1) // 11, 2) as part from wire_events)"""
# Other ways to the same result.
ORACLES["hourly_order_metrics_placed"] = ORACLES["hourly_order_metrics"]
ORACLES["city_order_metrics_placed"] = ORACLES["city_order_metrics"]
ORACLES["stream_asof_weather"] = ORACLES["enrich_weather_asof"]
ORACLES["stream_ingest_atomic"] = ORACLES["stream_ingest_orders"]
ORACLES["insert_orders_by_index"] = ORACLES["insert_new_orders"]
ORACLES["mart_incremental"] = ORACLES["pipeline_daily"]
ORACLES["dq_on_write"] = ORACLES["dq_results"]
# The job that writes the second mart returns what the plan states.
ORACLES["write_spark_metrics"] = ORACLES["spark_order_metrics"]


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLES.items()}
