"""The nine raw tables, derived from the test tables.

The same SQL text runs in Spark and in DuckDB, so both sides of a check start
from the same rows. It puts in the missing keys, orphans and unusable texts
that the transforms have to deal with.
"""

from __future__ import annotations

# View name -> SQL over the test tables.
RAW_VIEWS = {
    "raw_orders": """
        select cast(o_orderkey as string) as order_id,
          cast(case when o_custkey % 11 = 0 then o_custkey + 1000000 else o_custkey end as string) as customer_id,
          case cast(o_orderkey % 20 as int) when 0 then 'canceled' when 1 then 'unavailable' when 2 then 'shipped'
            when 3 then 'processing' when 4 then 'invoiced' when 5 then 'approved' when 6 then 'created'
            when 7 then 'on_hold' else 'delivered' end as order_status,
          case when o_orderkey % 67 <> 0 then o_orderdate + interval '1' second * cast(o_orderkey * 7919 % 86400 as int) end as order_purchase_timestamp,
          o_orderdate + interval '1' day as order_approved_at,
          case when o_orderkey % 20 >= 8 then o_orderdate + interval '1' day * cast(o_orderkey % 5 + 1 as int) end as order_delivered_carrier_date,
          case when o_orderkey % 20 >= 8 then o_orderdate + interval '1' hour * cast((o_orderkey % 25 + 6) * 23 as int) end as order_delivered_customer_date,
          o_orderdate + interval '1' day * cast(o_orderkey % 7 + 12 as int) as order_estimated_delivery_date
        from orders
    """,
    "raw_order_items": """
        select cast(case when l_orderkey % 101 = 0 then l_orderkey + 100000000 else l_orderkey end as string) as order_id,
          l_linenumber as order_item_id,
          case when l_partkey % 97 = 0 then null when l_partkey % 89 = 1 then cast(l_partkey - 1 as string) else cast(l_partkey as string) end as product_id,
          cast(case when l_suppkey % 10 = 9 then l_suppkey - 1 else l_suppkey end as string) as seller_id,
          cast(cast(l_extendedprice as decimal(10,2)) * case cast(l_suppkey % 4 as int) when 0 then cast(0.1 as decimal(8,4))
            when 1 then cast(0.0025 as decimal(8,4)) when 2 then cast(0.001 as decimal(8,4)) else cast(0.0001 as decimal(8,4)) end as decimal(10,2))
            + case when l_orderkey % 59 = 0 then cast(0.005 as decimal(5,3)) else cast(0 as decimal(5,3)) end as price,
          cast(cast(l_quantity as decimal(10,2)) * cast(0.37 as decimal(4,2)) as decimal(10,2))
            + case when l_orderkey % 59 = 0 then cast(0.005 as decimal(5,3)) else cast(0 as decimal(5,3)) end as freight_value,
          l_shipdate as shipping_limit_date
        from lineitem
    """,
    "raw_order_payments": """
        select cast(o_orderkey as string) as order_id, 1 as payment_sequential,
          case when o_orderkey % 71 = 0 then null when o_orderpriority = '1-URGENT' then 'credit_card' when o_orderpriority = '2-HIGH' then 'boleto' when o_orderpriority = '3-MEDIUM' then 'voucher'
            when o_orderpriority = '5-LOW' then 'debit_card' else 'not_defined' end as payment_type,
          cast(o_orderkey % 10 + 1 as int) as payment_installments, cast(o_totalprice as decimal(10,2)) as payment_value
        from orders
        union all
        select cast(o_orderkey as string), 2, 'voucher', 1, cast(cast(o_orderkey % 50 as decimal(10,2)) + cast(0.99 as decimal(10,2)) as decimal(10,2))
        from orders where o_orderstatus = 'P'
    """,
    "raw_order_reviews": """
        select case when event_id % 211 = 0 then null else cast(event_id as string) end as review_id,
          cast(event_id * 3 % 16000 as string) as order_id,
          case cast(event_id % 8 as int) when 0 then 'abc' when 1 then '99999999999' else cast(event_id % 5 + 1 as string) end as review_score,
          cast(null as string) as review_comment_title, event_type as review_comment_message,
          case cast(event_id % 13 as int) when 0 then 'bad' when 1 then '2024-13-45 00:00:00'
            else cast(cast(ts as date) as string) || ' 00:00:00' end as review_creation_date
        from events
    """,
    "raw_customers": """
        select cast(c_custkey as string) as customer_id, cast(c_custkey % 1000 as string) as customer_unique_id,
          lpad(cast(c_custkey % 400 as string), 5, '0') as customer_zip_code_prefix,
          'porto nacao ' || cast(c_nationkey as string) as customer_city,
          case when c_custkey % 53 = 0 then null else substr('SPRJMGESPRSCRSMTMSGODFBAPECEMAPIRNPBSEALAMPAACROTO', c_nationkey * 2 + 1, 2) end as customer_state
        from customer
    """,
    "raw_sellers": """
        select cast(s_suppkey as string) as seller_id, lpad(cast(s_suppkey % 400 as string), 5, '0') as seller_zip_code_prefix,
          'vila nacao ' || cast(s_nationkey as string) as seller_city,
          substr('SPRJMGESPRSCRSMTMSGODFBAPECEMAPIRNPBSEALAMPAACROTO', s_nationkey * 2 + 1, 2) as seller_state
        from supplier
    """,
    "raw_products": """
        select cast(p_partkey as string) as product_id,
          case when p_partkey % 41 = 0 then null when p_partkey = 1 then 'fantasma_pt' when p_partkey = 3 then 'mini_pt'
            when p_partkey in (5, 6, 7, 8) then 'medio_pt' else lower(p_type) || '_pt' end as product_category_name,
          case when p_partkey % 37 = 0 then null else cast(p_size * 250 as decimal(10,2)) end as product_weight_g,
          p_size as product_length_cm, p_size % 7 + 1 as product_height_cm, p_size % 5 + 1 as product_width_cm
        from part
    """,
    "raw_category_translation": """
        select distinct lower(p_type) || '_pt' as product_category_name, lower(p_type) as product_category_name_english
        from part where p_type <> 'PROMO'
    """,
    "raw_geolocation": """
        select lpad(cast(c_custkey % 400 as string), 5, '0') as geolocation_zip_code_prefix,
          cast(c_custkey % 64 as double) / 4 as geolocation_lat, cast(c_custkey % 32 as double) / 8 as geolocation_lng,
          'porto nacao ' || cast(c_nationkey as string) as geolocation_city,
          substr('SPRJMGESPRSCRSMTMSGODFBAPECEMAPIRNPBSEALAMPAACROTO', c_nationkey * 2 + 1, 2) as geolocation_state
        from customer
    """,
}

# Types of the test tables in use; declared, so that planning reads no footers.
TEST_TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

# Test tables that each view reads.
RAW_INPUTS = {
    "raw_orders": ("orders",),
    "raw_order_items": ("lineitem",),
    "raw_order_payments": ("orders",),
    "raw_order_reviews": ("events",),
    "raw_customers": ("customer",),
    "raw_sellers": ("supplier",),
    "raw_products": ("part",),
    "raw_category_translation": ("part",),
    "raw_geolocation": ("customer",),
}
