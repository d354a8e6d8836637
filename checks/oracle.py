"""The same queries as DuckDB SQL, written independently of the Spark code.

Tables are named subqueries that refer to each other; `sql(name)` puts the ones
a query needs into one WITH clause. Rounded means and shares of money are taken
in whole cents, so that both engines round the same exact value.
"""

from __future__ import annotations

import re

from checks.adapters import RAW_VIEWS

def _initcap(text: str) -> str:
    words = f"string_split(lower({text}), ' ')"
    return (
        f"list_aggregate(list_transform({words}, lambda w: upper(w[1]) || w[2:]),"
        " 'string_agg', ' ')"
    )


def _cents(amount: str) -> str:
    return f"cast({amount} * 100 as hugeint)"


def _half_up(numerator: str, denominator: str) -> str:
    """Quotient of two non-negative whole numbers, rounded half up."""
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


def _mean6(amount: str, count: str) -> str:
    """Mean of money in millionths."""
    return _half_up(f"{_cents(amount)} * 10000", count)


def _mean2(amount: str, count: str) -> str:
    """Mean of money with six digits, rounded again to two."""
    return f"cast({_half_up(_mean6(amount, count), '10000')} as double) / 100"


def _share2(part: str, whole: str) -> str:
    return f"cast({_half_up(f'{part} * 10000', whole)} as double) / 100"


def _region(state: str) -> str:
    return f"""case when {state} in ('SP', 'RJ', 'MG', 'ES') then 'Southeast'
        when {state} in ('PR', 'SC', 'RS') then 'South'
        when {state} in ('MT', 'MS', 'GO', 'DF') then 'Central-West'
        when {state} in ('BA', 'PE', 'CE', 'MA', 'PI', 'RN', 'PB', 'SE', 'AL') then 'Northeast'
        else 'North' end"""


def _date_key(time: str) -> str:
    return f"cast(strftime({time}, '%Y%m%d') as int)"


TABLES: dict[str, str] = {
    "stg_orders": """
        select order_id, customer_id, order_status,
          order_purchase_timestamp as order_purchase_at, order_approved_at,
          order_delivered_carrier_date as shipped_at,
          order_delivered_customer_date as delivered_at,
          order_estimated_delivery_date as estimated_delivery_at,
          cast(date_diff('day', cast(order_purchase_timestamp as date),
            cast(order_delivered_customer_date as date)) as int) as delivery_days,
          coalesce(order_delivered_customer_date <= order_estimated_delivery_date, false) as is_on_time
        from raw_orders where order_id is not null""",
    "stg_order_items": """
        select order_id, order_item_id, product_id, seller_id,
          order_id || '_' || cast(order_item_id as varchar) as order_line_id,
          cast(price as decimal(10,2)) as price, cast(freight_value as decimal(10,2)) as freight_value,
          cast(price + freight_value as decimal(10,2)) as line_total,
          shipping_limit_date as shipping_limit_at
        from raw_order_items where order_id is not null and product_id is not null""",
    "stg_order_payments": "select * from raw_order_payments where order_id is not null",
    "stg_customers": f"""
        select customer_id, customer_unique_id, customer_zip_code_prefix as zip_code,
          {_initcap('customer_city')} as city, customer_state as state
        from raw_customers where customer_id is not null""",
    "stg_sellers": f"""
        select seller_id, seller_zip_code_prefix as zip_code,
          {_initcap('seller_city')} as city, seller_state as state
        from raw_sellers where seller_id is not null""",
    "stg_products": """
        select p.product_id, p.product_category_name as category_name_pt,
          coalesce(t.product_category_name_english, p.product_category_name) as category_name,
          p.product_weight_g as weight_grams,
          cast(p.product_length_cm as bigint) * p.product_height_cm * p.product_width_cm as volume_cm3
        from raw_products p left join raw_category_translation t using (product_category_name)
        where p.product_id is not null""",
    "stg_order_reviews": """
        with parsed as (
          select *, case when regexp_matches(review_score, '^[0-9]+$')
              then try_cast(review_score as int) end as score,
            case when regexp_matches(review_creation_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')
              then try_cast(review_creation_date as timestamp) end as created
          from raw_order_reviews)
        select review_id, order_id, score as review_score,
          case when score >= 4 then 'positive' when score = 3 then 'neutral'
            when score is null then 'unknown' else 'negative' end as review_sentiment,
          review_comment_title, review_comment_message, created as review_created_at
        from parsed where review_id is not null""",
    "dim_customers": f"""
        select c.customer_id, c.customer_unique_id, c.zip_code, c.city, c.state,
          {_region('c.state')} as region,
          (select count(*) from stg_orders o where o.customer_id = c.customer_id) as total_orders
        from stg_customers c""",
    "dim_products": f"""
        with sold as (
          select product_id, count(*) as n, sum(price) as revenue
          from stg_order_items group by product_id)
        select p.product_id, p.category_name, p.category_name_pt, p.weight_grams, p.volume_cm3,
          case when weight_grams < 500 then 'Small' when weight_grams < 2000 then 'Medium'
            when weight_grams < 10000 then 'Large' else 'Extra Large' end as size_tier,
          coalesce(n, 0) as times_sold, coalesce(revenue, 0) as total_revenue,
          coalesce(cast({_mean6('revenue', 'n')} as double) / 1000000, 0) as avg_selling_price
        from stg_products p left join sold using (product_id)""",
    "dim_sellers": f"""
        with sold as (
          select seller_id, count(distinct order_id) as orders, sum(price) as revenue
          from stg_order_items group by seller_id)
        select s.seller_id, s.zip_code, s.city, s.state,
          case when s.state in ('SP', 'RJ', 'MG', 'ES') then 'Southeast'
            when s.state in ('PR', 'SC', 'RS') then 'South' else 'Other' end as region,
          coalesce(orders, 0) as total_orders, coalesce(revenue, 0) as total_revenue,
          case when revenue >= 100000 then 'Platinum' when revenue >= 50000 then 'Gold'
            when revenue >= 10000 then 'Silver' else 'Bronze' end as seller_tier
        from stg_sellers s left join sold using (seller_id)""",
    "dim_dates": f"""
        with days as (
          select distinct cast(order_purchase_at as date) as d
          from stg_orders where order_purchase_at is not null)
        select {_date_key('d')} as date_key, cast(d as timestamp) as full_date,
          cast(year(d) as int) as year_number, cast(quarter(d) as int) as quarter_number,
          cast(month(d) as int) as month_number, monthname(d) as month_name,
          strftime(d, '%Y-%m') as year_month, cast(weekofyear(d) as int) as week_of_year,
          cast(dayofweek(d) + 1 as int) as day_of_week_number, dayname(d) as day_of_week_name,
          dayofweek(d) in (0, 6) as is_weekend
        from days""",
    "dim_geolocation": f"""
        with points as (
          select geolocation_zip_code_prefix as zip, geolocation_lat as lat,
            geolocation_lng as lng, geolocation_city as city, geolocation_state as state,
            row_number() over (partition by geolocation_zip_code_prefix
              order by (case when geolocation_city is null then 1 else 0 end)
                + (case when geolocation_state is null then 1 else 0 end),
                geolocation_city nulls first, geolocation_state nulls first) as pick
          from raw_geolocation),
        picked as (select zip, city, state from points where pick = 1)
        select p.zip as zip_code, {_initcap('any_value(k.city)')} as city,
          any_value(k.state) as state, avg(lat) as latitude, avg(lng) as longitude,
          {_region('any_value(k.state)')} as region, count(*) as data_points
        from points p join picked k on p.zip is not distinct from k.zip
        group by p.zip""",
    "dim_payment_types": f"""
        with grouped as (
          select payment_type, count(*) as n, count(distinct order_id) as orders,
            sum(payment_value) as value, avg(payment_installments) as installments
          from stg_order_payments group by payment_type),
        total as (select sum(payment_value) as value from stg_order_payments)
        select payment_type,
          case payment_type when 'credit_card' then 'Credit Card'
            when 'boleto' then 'Boleto Bancario' when 'voucher' then 'Voucher'
            when 'debit_card' then 'Debit Card'
            else {_initcap('payment_type')} end as payment_type_name,
          n as transaction_count, orders as order_count, g.value as total_value,
          {_mean2('g.value', 'n')} as avg_transaction_value,
          round(installments, 1) as avg_installments,
          {_share2(_cents('g.value'), _cents('total.value'))} as value_share_pct
        from grouped g, total""",
    "dim_categories": f"""
        with lines as (
          select p.category_name, p.category_name_pt, p.product_id, i.order_id,
            i.order_line_id, i.price
          from stg_products p left join stg_order_items i using (product_id)),
        total as (select coalesce(nullif(sum(price), 0), 1) as revenue from lines),
        grouped as (
          select category_name, category_name_pt, count(distinct product_id) as products,
            count(distinct order_id) as orders, count(order_line_id) as items,
            count(price) as n, sum(price) as sold, coalesce(sum(price), 0) as revenue
          from lines group by category_name, category_name_pt)
        select cast('0x' || substr(md5(category_name || chr(31) || category_name_pt), 1, 15)
            as bigint) as category_id,
          category_name, category_name_pt, products as product_count, orders as order_count,
          items as items_sold, g.revenue as total_revenue,
          case when n = 0 then 0.0 else {_mean2('g.revenue', 'n')} end as avg_price,
          case when sold >= 1000000 then 'Tier 1 (Top)' when sold >= 100000 then 'Tier 2 (High)'
            when sold >= 10000 then 'Tier 3 (Medium)' else 'Tier 4 (Low)' end as category_tier,
          {_share2(_cents('g.revenue'), _cents('total.revenue'))} as revenue_share_pct
        from grouped g, total where category_name is not null""",
    "dim_order_status": f"""
        with grouped as (
          select order_status, count(*) as n, avg(delivery_days) as days,
            count(*) filter (where is_on_time) as on_time
          from stg_orders group by order_status)
        select order_status as status_code,
          {_initcap('order_status')} as status_name,
          case when order_status = 'delivered' then 'Completed'
            when order_status in ('shipped', 'processing', 'invoiced', 'approved', 'created')
              then 'In Progress'
            when order_status in ('canceled', 'unavailable') then 'Failed'
            else 'Other' end as status_category,
          order_status in ('delivered', 'canceled', 'unavailable') as is_terminal,
          n as order_count, round(days, 1) as avg_delivery_days, on_time as on_time_count,
          round(cast(on_time as double) / n * 100, 1) as on_time_rate_pct,
          round(cast(n as double) / (select count(*) from stg_orders) * 100, 2) as volume_share_pct
        from grouped""",
    "fct_sales": f"""
        select i.order_line_id, i.order_id, i.product_id, i.seller_id, o.customer_id,
          {_date_key('o.order_purchase_at')} as date_key, o.order_status, o.order_purchase_at,
          o.delivered_at, o.delivery_days, o.is_on_time, i.price, i.freight_value, i.line_total,
          p.category_name, c.state as customer_state, s.state as seller_state,
          coalesce(c.state = s.state, false) as is_same_state
        from stg_order_items i join stg_orders o on i.order_id = o.order_id
          left join stg_customers c on o.customer_id = c.customer_id
          left join stg_products p on i.product_id = p.product_id
          left join stg_sellers s on i.seller_id = s.seller_id""",
    "fct_order_reviews": f"""
        select r.review_id, r.order_id, o.customer_id,
          {_date_key('o.order_purchase_at')} as order_date_key,
          {_date_key('r.review_created_at')} as review_date_key,
          r.review_score, r.review_sentiment, o.order_status, o.delivery_days, o.is_on_time
        from stg_order_reviews r left join stg_orders o on r.order_id = o.order_id""",
    "mart_executive": f"""
        with people as (
          select f.price, f.order_id, c.customer_unique_id
          from fct_sales f left join dim_customers c on f.customer_id = c.customer_id),
        totals as (
          select sum(price) as revenue, count(distinct order_id) as orders,
            count(distinct customer_unique_id) as customers
          from people)
        select revenue as total_revenue, orders as total_orders, customers as total_customers,
          {_mean2('revenue', 'orders')} as avg_order_value
        from totals""",
    "mart_sales_category": """
        select category_name, sum(price) as revenue, count(distinct order_id) as orders,
          count(*) as items
        from fct_sales group by category_name""",
    "mart_sales_state": """
        select customer_state, sum(price) as revenue, count(distinct order_id) as orders,
          count(*) as items
        from fct_sales group by customer_state""",
    "mart_sales_month": """
        select strftime(order_purchase_at, '%Y-%m') as year_month, sum(price) as revenue,
          count(distinct order_id) as orders, count(*) as items
        from fct_sales group by 1""",
    "mart_customer_region": """
        select region, state, count(distinct customer_unique_id) as customers,
          count(*) as accounts, cast(sum(total_orders) as bigint) as orders
        from dim_customers group by region, state""",
    "mart_customer_repeat": """
        with people as (
          select customer_unique_id, sum(total_orders) as bought
          from dim_customers group by customer_unique_id)
        select case when bought = 0 then 'no orders' when bought = 1 then 'one-time'
            else 'repeat' end as customer_kind,
          count(*) as customers, cast(sum(bought) as bigint) as orders,
          round(cast(count(*) as double) / (select count(*) from people) * 100, 2) as share_pct
        from people group by 1""",
    "mart_seller_rank": """
        with sold as (
          select seller_id, count(distinct order_id) as orders, count(*) as items,
            sum(price) as revenue, count(*) filter (where is_on_time) as on_time
          from fct_sales group by seller_id),
        board as (
          select d.seller_id, d.state as seller_state, d.seller_tier,
            coalesce(orders, 0) as orders, coalesce(items, 0) as items,
            coalesce(revenue, 0) as revenue,
            round(cast(on_time as double) / items * 100, 1) as on_time_rate_pct
          from dim_sellers d left join sold using (seller_id))
        select *, rank() over (order by revenue desc) as revenue_rank,
          rank() over (partition by seller_state order by revenue desc) as state_rank
        from board""",
    "mart_delivery": """
        with placed as (
          select distinct order_id, strftime(order_purchase_at, '%Y-%m') as year_month,
            customer_state, delivery_days, is_on_time
          from fct_sales)
        select year_month, customer_state, count(*) as orders, count(delivery_days) as delivered,
          round(avg(delivery_days), 1) as avg_delivery_days,
          round(cast(count(*) filter (where is_on_time) as double) / count(*) * 100, 1)
            as on_time_rate_pct
        from placed group by year_month, customer_state""",
    "mart_satisfaction": """
        select review_sentiment, count(*) as reviews, round(avg(review_score), 2) as avg_score,
          round(avg(delivery_days), 1) as avg_delivery_days,
          round(cast(count(*) filter (where is_on_time) as double) / count(is_on_time) * 100, 1)
            as on_time_rate_pct
        from fct_order_reviews group by review_sentiment""",
    "preview_products": """
        select *, 'raw_products.csv' as _source_file
        from raw_products order by product_id limit 5""",
    "clean_locations": f"""
        with places as (
          select 'customer' as place_of, customer_city as city, customer_state as state
          from raw_customers
          union all select 'seller', seller_city, seller_state from raw_sellers)
        select place_of, {_initcap('city')} as city, state, count(*) as rows_seen
        from places group by place_of, city, state""",
    "latest_per_key": """
        with batches as (
          select *, 1 as batch from raw_orders
          union all
          select * replace ('delivered' as order_status), 2 as batch from raw_orders
          where order_status in ('shipped', 'processing', 'invoiced', 'approved'))
        select * exclude (batch) from batches
        qualify row_number() over (partition by order_id order by batch desc) = 1""",
    # An upsert of everything that changed must end in the full rebuild.
    "upsert_dim_customers": "select * from dim_customers",
    "upsert_dim_payment_types": "select * from dim_payment_types",
    "incremental_dim_customers": "select * from dim_customers",
    # Each line as of the last day it came, without those that have no product then; and, of the
    # lines without a number, those of the second day.
    "incremental_order_items": """
        with lines as (
          select order_id, order_item_id, min(product_id) as product_id, min(seller_id) as seller_id, min(price) as price,
            min(freight_value) as freight_value, min(shipping_limit_date) as shipping_limit_date
          from raw_order_items group by order_id, order_item_id),
        days as (
          select *, 1 as day from lines where cast(order_id as bigint) % 5 <> 0
          union all
          select * replace (price + 1 as price, case when cast(order_id as bigint) % 3 <> 0 then product_id end as product_id), 2
          from lines where cast(order_id as bigint) % 7 = 0 and cast(order_id as bigint) % 5 <> 0
          union all
          select *, 2 from lines where cast(order_id as bigint) % 5 = 0 and cast(order_id as bigint) % 7 <> 0),
        newest as (
          select * exclude (day) from days
          qualify row_number() over (partition by order_id, order_item_id order by day desc) = 1
          union all
          select * replace (null as order_item_id) from lines where cast(order_id as bigint) % 40 = 3)
        select order_id, order_item_id, product_id, seller_id, order_id || '_' || cast(order_item_id as string) as order_line_id,
          cast(price as decimal(10,2)) as price, cast(freight_value as decimal(10,2)) as freight_value,
          cast(price + freight_value as decimal(10,2)) as line_total, shipping_limit_date as shipping_limit_at
        from newest where product_id is not null""",
    "incremental_products": """
        with moved as (
          select * replace (case when cast(product_id as bigint) % 9 = 0 then 'promo_pt' else product_category_name end as product_category_name)
          from raw_products),
        names as (
          select product_category_name, case when product_category_name like '%s%' then upper(product_category_name_english)
            else product_category_name_english end as english
          from raw_category_translation)
        select product_id, product_category_name as category_name_pt, coalesce(english, product_category_name) as category_name,
          cast(product_weight_g as decimal(10,2)) as weight_grams,
          cast(product_length_cm as bigint) * product_height_cm * product_width_cm as volume_cm3
        from moved left join names using (product_category_name)""",
    "since_fct_sales": "select * from fct_sales",
    "since_fct_order_reviews": "select * from fct_order_reviews",
    # One file name in two folders; the first folder's file was extracted again without odd customers.
    "latest_per_file": """
        select *, 'part-0.csv' as _source_file from raw_geolocation
        union all
        select *, 'part-0.csv' as _source_file from raw_geolocation
        where cast(geolocation_zip_code_prefix as int) % 2 = 0""",
}
# Marts merged from monthly sums must equal those over all rows.
for _name in ("executive", "sales_category", "sales_state", "sales_month", "seller_rank", "delivery", "satisfaction"):
    TABLES[f"merged_mart_{_name}"] = f"select * from mart_{_name}"
for _name in RAW_VIEWS:
    TABLES[f"bronze_{_name.removeprefix('raw_')}"] = (
        f"select *, '{_name}.csv' as _source_file from {_name}"
    )


# Key of each table, and where its foreign keys point.
SILVER_KEYS = {
    "stg_orders": ("order_id", {"customer_id": "stg_customers"}),
    "stg_order_items": (
        "order_id, order_item_id",
        {"order_id": "stg_orders", "product_id": "stg_products", "seller_id": "stg_sellers"},
    ),
    "stg_order_payments": ("order_id, payment_sequential", {"order_id": "stg_orders"}),
    "stg_customers": ("customer_id", {}),
    "stg_products": ("product_id", {}),
    "stg_sellers": ("seller_id", {}),
    "stg_order_reviews": ("review_id, order_id", {"order_id": "stg_orders"}),
}
GOLD_KEYS = {
    "dim_customers": ("customer_id", {}),
    "dim_products": ("product_id", {}),
    "dim_sellers": ("seller_id", {}),
    "dim_dates": ("date_key", {}),
    "dim_geolocation": ("zip_code", {}),
    "dim_payment_types": ("payment_type", {}),
    "dim_categories": ("category_id", {}),
    "dim_order_status": ("status_code", {}),
    "fct_sales": (
        "order_line_id",
        {
            "date_key": "dim_dates",
            "customer_id": "dim_customers",
            "product_id": "dim_products",
            "seller_id": "dim_sellers",
        },
    ),
    "fct_order_reviews": ("review_id, order_id", {"customer_id": "dim_customers"}),
}


def _audit(keys) -> str:
    parts = []
    for table, (key, parents) in keys.items():
        null = " or ".join(f"{c} is null" for c in key.split(", "))
        distinct = f"(select count(*) from (select distinct {key} from {table} where not ({null})))"
        measures = {
            "total_rows": f"select count(*) from {table}",
            "null_keys": f"select count(*) from {table} where {null}",
            "duplicate_keys": f"select count(*) - {distinct} from {table} where not ({null})",
        }
        for column, parent in parents.items():
            measures[f"orphan_{column}"] = (
                f"select count(*) from {table} where {column} is not null"
                f" and {column} not in (select {column} from {parent} where {column} is not null)"
            )
        parts += [
            f"select '{table}' as table_name, '{m}' as measure, ({q}) as row_count"
            for m, q in measures.items()
        ]
    return "\n        union all ".join(parts)


TABLES["audit_silver"] = _audit(SILVER_KEYS)
TABLES["audit_gold"] = _audit(GOLD_KEYS)


def _audit_months(table: str, date: str, month: str) -> str:
    key, parents = GOLD_KEYS[table]
    null = " or ".join(f"{c} is null" for c in key.split(", "))
    flags = [f"cast({date} // 100 as bigint) as {month}", f"({null}) as no_key", f"row({key}) as whole_key"]
    measures = {
        "total_rows": "count(*)",
        "null_keys": "count(*) filter (where no_key)",
        "duplicate_keys": "count(*) filter (where not no_key) - count(distinct whole_key) filter (where not no_key)",
    }
    for column, parent in parents.items():
        known = f"(select {column} from {parent} where {column} is not null)"
        flags.append(f"({column} is not null and {column} not in {known}) as orphan_{column}")
        measures[f"orphan_{column}"] = f"count(*) filter (where orphan_{column})"
    return "\n        union all ".join(
        f"select {month}, '{m}' as measure, {q} as row_count from (select {', '.join(flags)} from {table}) group by {month}"
        for m, q in measures.items()
    )


TABLES["audit_months_fct_sales"] = _audit_months("fct_sales", "date_key", "order_month")
TABLES["audit_months_fct_order_reviews"] = _audit_months("fct_order_reviews", "review_date_key", "review_month")


_LINE_MONEY = ("price", "freight_value", "line_total")

# Decimal and whole-number columns that are compared as doubles.
DOUBLES: dict[str, tuple[str, ...]] = {
    "bronze_order_items": ("price", "freight_value"),
    "bronze_order_payments": ("payment_value",),
    "bronze_products": (
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "stg_order_items": _LINE_MONEY,
    "stg_order_payments": ("payment_value",),
    "stg_products": ("weight_grams",),
    "dim_products": ("weight_grams", "total_revenue"),
    "dim_sellers": ("total_revenue",),
    "dim_payment_types": ("total_value",),
    "dim_categories": ("total_revenue",),
    "fct_sales": _LINE_MONEY,
    "since_fct_sales": _LINE_MONEY,
    "upsert_dim_payment_types": ("total_value",),
    "mart_executive": ("total_revenue",),
    "mart_sales_category": ("revenue",),
    "mart_sales_state": ("revenue",),
    "mart_sales_month": ("revenue",),
    "mart_seller_rank": ("revenue",),
    "merged_mart_executive": ("total_revenue",),
    "merged_mart_sales_category": ("revenue",),
    "merged_mart_sales_state": ("revenue",),
    "merged_mart_sales_month": ("revenue",),
    "merged_mart_seller_rank": ("revenue",),
    "preview_products": ("product_weight_g",),
    "incremental_order_items": ("price", "freight_value", "line_total"),
    "incremental_products": ("weight_grams",),
}


def _needed(text: str, found: dict[str, str]) -> None:
    everything = RAW_VIEWS | TABLES
    for name in everything:
        if name not in found and re.search(rf"\b(?:from|join)\s+{name}\b", text):
            _needed(everything[name], found)
            found[name] = everything[name]


def sql(name: str) -> str:
    """The query as one statement over the test tables, with decimals as doubles."""
    ctes: dict[str, str] = {}
    _needed(TABLES[name], ctes)
    named = [f"{n} as materialized ({q})" for n, q in ctes.items()]
    named.append(f"answer as ({TABLES[name]})")
    doubles = ", ".join(f"cast({c} as double) as {c}" for c in DOUBLES.get(name, ()))
    columns = f"* replace ({doubles})" if doubles else "*"
    return f"with {', '.join(named)}\nselect {columns} from answer"


ORACLE = {name: sql(name) for name in TABLES}
