"""Oracle SQL per query name."""

from __future__ import annotations

from .relations import PLAIN_RAW, RELATIONS, key, longs, rate, with_relations, ymd

_PLAIN: dict[str, str] = {}
_FAULTY: dict[str, str] = {}

for _name in {**RELATIONS, **PLAIN_RAW}:
    if _name.split("_")[0] in ("stg", "int", "fct", "mart") or (
        _name.startswith("dim_") and _name not in ("dim_date", "dim_time")
    ):
        _PLAIN[_name] = f"select * from {_name}"

_ROLLUP = f"""
    select order_id, customer_nk, customer_key, customer_city_key, order_date_key, order_time_key, payment_method_key,
        shipping_key, cancellation_stage, is_new_customer_order, count(*) as item_count,
        {longs(*[f"{c} {c}" for c in ("quantity", "subtotal", "discount_amount", "shipping_subsidy", "voucher_amount",
                                      "total_payment", "estimated_cost", "profit")])},
        count(total_payment) as paid_item_count,
        {longs("discount_amount+voucher_amount+shipping_subsidy promo_loss")}, max(order_ts) as order_ts,
        sum(delivery_duration_minutes) as minutes_sum, count(delivery_duration_minutes) as minutes_count,
        min(delivery_duration_minutes) as minutes_min, max(delivery_duration_minutes) as minutes_max,
        count(*) filter (where is_cancelled) as cancelled_items,
        count(*) filter (where is_returned) as returned_items,
        count(*) filter (where is_delayed) as delayed_items
    from fct_order_item group by all"""

_PROMO = "discount_amount + shipping_subsidy + voucher_amount"


_REJECTS = """
    select i.order_item_id, i.order_id, concat_ws(',',
        case when o.order_id is null then 'order' end,
        case when o.order_id is not null and o.order_id not in (
            select s.order_id from stg_orders s join dim_customer v
            on s.customer_id = v.customer_nk and s.order_ts >= v.valid_from and s.order_ts < v.valid_to)
            then 'customer_version' end,
        case when o.order_id is not null and m.payment_method_nk is null then 'payment_method' end,
        case when o.order_id is not null and d.shipping_service_nk is null then 'shipping' end,
        case when o.order_id is not null and u.voucher_nk is null then 'voucher' end,
        case when o.order_id is not null and o.order_status is null then 'order_status' end,
        case when p.product_nk is null then 'product' end,
        case when i.is_cancelled is null or i.is_returned is null or i.voucher_amount is null or i.shipping_subsidy is null
            then 'order_flags' end) as reasons
    from stg_order_items i left join stg_orders o on i.order_id = o.order_id
        left join dim_payment_method m on o.payment_method_id = m.payment_method_nk
        left join dim_shipping d on o.shipping_service_id = d.shipping_service_nk
        left join dim_voucher u on o.voucher_id = u.voucher_nk
        left join (select product_nk from dim_product where category_key in (select category_key from dim_category)) p
            on i.product_id = p.product_nk
    where reasons <> ''"""


def _product_top(columns: str, condition: str, order: str, n: int) -> str:
    return f"""select {columns} from (select * from mart_product_performance where {condition}
        order by {order}, product_key limit {n}) t"""


def _percentiles(source: str, group: str, value: str, shares: dict[str, float]) -> str:
    picks = ", ".join(f"min(v) filter (where upto >= ceil(total * cast({s} as double))) as {n}" for n, s in shares.items())
    return f"""
        with r as (select {group}, {value} as v, row_number() over (partition by {group} order by {value}) as upto,
            count(*) over (partition by {group}) as total from {source} where {value} is not null)
        select {group}, max(total) as value_count, {picks} from r group by {group}"""


_PLAIN |= {
    "dim_date": f"""
        select {ymd("d")} as date_key, d as date_day, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
            cast(month(d) as int) as month, rpad(strftime(d, '%B'), 9, ' ') as month_name,
            cast(day(d) as int) as day_of_month, cast(isodow(d) as int) as day_of_week,
            rpad(strftime(d, '%A'), 9, ' ') as day_name, cast(weekofyear(d) as int) as week_of_year,
            isodow(d) in (6, 7) as is_weekend
        from (select cast(unnest(generate_series(cast(min(order_ts) as date), cast(max(order_ts) as date),
            interval 1 day)) as date) as d from stg_orders) s""",
    "dim_time": """
        select t.*, (select count(*) from stg_orders o where hour(o.order_ts) * 60 + minute(o.order_ts) = t.time_key)
            as order_count
        from dim_time t""",

    "src_latest_profiles": """
        select distinct on (customer_id) * from stg_customer_profile_events
        order by customer_id, effective_at desc, customer_profile_event_id desc""",
    "src_max_keys": " union all ".join(
        f"select '{t}' as table_name, coalesce(max({k}), 0) as max_key from stg_{t}" for t, k in [
            ("orders", "order_id"), ("order_items", "order_item_id"), ("payments", "payment_id"),
            ("shipments", "shipment_id"), ("order_status_events", "status_event_id"),
            ("customer_profile_events", "customer_profile_event_id")]),
    "src_new_data_start": "select max(order_ts) as latest_order_ts from stg_orders",
    "src_date_spine": """
        select cast(unnest(generate_series(cast(min(checkout_ts) as date), cast(max(checkout_ts) as date),
            interval 1 day)) as date) as date_day from stg_shipments""",

    **dict.fromkeys(("snk_keyed_merge", "snk_bucketed_merge"), """
        select * replace (cast(quantity + case when loaded_at <= timestamp '1999-01-01' and product_id % 5 = 0
            then 1 else 0 end as int) as quantity) from stg_order_items"""),
    "int_customer_scd2_incremental": "select * from int_customer_scd2",
    "snk_insert_absent": """
        select * from stg_products where product_id not in (
            select product_id from stg_order_items where loaded_at <= timestamp '1996-01-01')""",
    "snk_nan_to_null": """
        select event_id, user_id, case when user_id % 7 <> 0 then value end as value from events""",
    "snk_watermarks": " union all ".join(
        f"select '{t}' as table_name, max(loaded_at) as last_loaded_at from stg_{t}" for t in (
            "orders", "order_items", "payments", "shipments", "order_status_events", "customer_profile_events")),
    "snk_append": "select * from stg_payments",
    "snk_csv_round_trip": """
        select * exclude (loaded_at), (select count(*) from stg_products) as reported_rows from stg_products""",
    "src_typed_raw_tables": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count, {n}::int as column_count from stg_{t}"
        for t, n in (("cities", 6), ("products", 9), ("orders", 12), ("shipments", 12))),
    "pipe_full_fact": "select * from fct_order_item",
    "pipe_full_snapshot": "select * from dim_customer",
    "pipe_full_marts": "select * from mart_city_performance",
    "pipe_incremental_fact": "select * from fct_order_item",
    "pipe_incremental_rollup": _ROLLUP,
    "pipe_incremental_marts": "select * from mart_monthly_revenue",
    "pipe_incremental_segments": "select * from mart_customer_segments",
    "pipe_stream_fact": """
        select * from fct_order_item""",
    "pipe_marks": " union all ".join([
        *(f"select '{t}' as table_name, max(loaded_at) as last_loaded_at from stg_{t}" for t in (
            "cities", "categories", "products", "payment_methods", "shipping_services", "vouchers", "customer_profile_events",
            "orders", "order_items", "payments", "shipments", "order_status_events")),
        "select '_dbt_last_run', max(loaded_at) from stg_orders"]),
    "new_data_gate": "select count(*) as new_rows from stg_orders where loaded_at > timestamp '1999-01-01'",

    "key_surrogate": f"""
        select shipment_id, {key("shipment_id")} as one,
            {key("shipment_id", "is_delayed", "delivered_ts", "tracking_number")} as several
        from stg_shipments""",
    "fct_incremental_slice": "select * from fct_order_item where loaded_at > timestamp '1999-01-01'",
    "fct_incremental_customers": """
        select * from fct_order_item where customer_nk in (
            select o.customer_id from stg_order_items i join stg_orders o on i.order_id = o.order_id
            where i.loaded_at > timestamp '2001-01-01')""",
    "fct_flags_lookup": """
        select order_item_id, order_flags_key, order_status_key, is_delayed, is_cancelled from fct_order_item
        where order_flags_key in (select order_flags_key from dim_order_flags where not is_delayed)""",
    "fct_date_time_keys": f"""
        select o.order_id, {ymd("o.order_ts")} as order_date_key,
            cast(hour(o.order_ts) * 60 + minute(o.order_ts) as int) as order_time_key,
            {ymd("p.payment_ts")} as payment_date_key
        from stg_orders o left join stg_payments p on o.order_id = p.order_id""",
    "fct_asof_events": """
        with versions as (
            select user_id, event_id, event_type, ts, coalesce(lead(ts) over (partition by user_id order by ts, event_id),
                timestamp '9999-12-31') as until
            from events where event_type <> 'purchase')
        select e.event_id, e.user_id, e.ts, e.value, v.event_id as version_id, v.event_type as version_type
        from events e join versions v on e.user_id = v.user_id and e.ts >= v.ts and e.ts < v.until
        where e.event_type = 'purchase'""",
    "fct_dropped_rows": """
        select cast(year(o.order_ts) as int) as order_year, count(*) as dropped_items
        from stg_order_items i join stg_orders o on i.order_id = o.order_id
        where i.order_item_id not in (select order_item_id from fct_order_item) group by 1""",
    "fct_reject_counts": f"""
        with rejects as ({_REJECTS})
        select reason, (select count(*) from rejects where list_contains(string_split(reasons, ','), reason)) as items
        from (select unnest(['order', 'customer_version', 'payment_method', 'shipping', 'voucher', 'order_status',
            'product', 'order_flags']) as reason)""",
    "order_rollup": _ROLLUP,

    "q01_monthly_trend": "select month_start_date, net_revenue, profit, profit_margin from mart_monthly_revenue",
    "q02_city_ranking": "select city_name, province, transaction_count, revenue, profit from mart_city_performance",
    "q03_top_products": _product_top(
        "product_name, category_name, quantity_sold, revenue", "true", "revenue desc, quantity_sold desc", 10),
    "q04_payment_frequency": """
        select payment_method_name, transaction_count, transaction_value from mart_payment_method_performance""",
    "q05_voucher_rules": """
        select voucher_code, voucher_name, voucher_type, rule_description, min_order_amount, discount_amount
        from dim_voucher""",
    "q06_shipping_usage": "select shipping_provider, shipping_service, order_count from mart_shipping_performance",
    "q07_shipping_cancellations": """
        select shipping_provider, shipping_service, cancelled_order_count from mart_shipping_performance""",
    "q08_return_rates": _product_top(
        "product_name, category_name, order_count, returned_quantity, return_rate", "order_count >= 10",
        "return_rate desc, returned_quantity desc", 20),
    "q08_return_rates_busy": _product_top(
        "product_name, category_name, order_count, returned_quantity, return_rate", "order_count >= 30",
        "return_rate desc, returned_quantity desc", 20),
    "q09_promo_loss": f"""
        select month_start_date, discount_amount, shipping_subsidy, voucher_amount, {_PROMO} as total_promo_loss,
            net_revenue, profit, profit_margin from mart_monthly_revenue""",
    "q10_peak_hours": "select hour_of_day, daypart, order_count, revenue from mart_hourly_orders",
    "q11_cancellation_stage": """
        select cancellation_stage, count(distinct order_id) filter (where is_cancelled) as cancelled_orders,
            count(distinct order_id) as total_orders,
            cast(count(distinct order_id) filter (where is_cancelled) as double) / count(distinct order_id)
                as cancellation_rate
        from fct_order_item group by cancellation_stage""",
    "q12_cancellation_rates": _product_top(
        "product_name, order_count, cancellation_rate", "order_count >= 10", "cancellation_rate desc", 20),
    "q12_cancellation_rates_busy": _product_top(
        "product_name, order_count, cancellation_rate", "order_count >= 30", "cancellation_rate desc", 20),
    "q13_payment_value": """
        select payment_method_name, transaction_value, transaction_count, avg_item_value
        from mart_payment_method_performance""",
    "q14_provider_quarter": """
        select cast(date_trunc('quarter', date_day) as date) as quarter_start, shipping_provider,
            count(distinct order_id) as total_orders
        from fct_order_item f join dim_date d on f.order_date_key = d.date_key
            join dim_shipping s on f.shipping_key = s.shipping_key group by 1, 2""",
    "q15_loyalty_tier": f"""
        select loyalty_tier, count(distinct order_id) as total_orders, {longs("total_payment total_value")}
        from fct_order_item f join dim_customer c on f.customer_key = c.customer_key group by 1""",
    "q16_category_margin": f"""
        select category_name, {longs("revenue total_revenue", "profit total_profit")},
            round(cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0) * 100, 2) as margin_percent
        from mart_product_performance group by 1""",

    "kpi_promo_loss_total": f"select cast(sum({_PROMO}) as bigint) as total_promo_loss from mart_monthly_revenue",
    "kpi_customers_in_group": "select * from mart_customer_segments where customer_group = 'Frequent Low Basket'",
    "kpi_high_revenue_low_frequency": """
        select * from mart_customer_segments where customer_group = 'High Revenue Low Frequency'""",
    "kpi_new_vs_returning": f"""
        select is_new_customer_order, count(distinct order_id) as order_count, {longs("total_payment revenue")}
        from fct_order_item group by 1""",
    "kpi_top_products_by_quantity": _product_top(
        "product_name, category_name, quantity_sold, revenue", "true", "quantity_sold desc", 10),
    "kpi_high_profit_low_sales": """
        select product_key, product_name, category_name, quantity_sold, profit from mart_product_performance
        where profit >= (select profit from (select profit, row_number() over (order by profit) as i,
                count(*) over () as n from mart_product_performance) p where i = ceil(n * cast(0.75 as double)))
            and quantity_sold <= (select quantity_sold from (select quantity_sold,
                row_number() over (order by quantity_sold) as i, count(*) over () as n
                from mart_product_performance) s where i = ceil(n * cast(0.5 as double)))""",
    "kpi_fastest_slowest_service": """
        select (select shipping_provider || ' ' || shipping_service from mart_shipping_performance
                order by fastest_delivery_minutes, 1 limit 1) as fastest,
            min(fastest_delivery_minutes) as fastest_minutes,
            (select shipping_provider || ' ' || shipping_service from mart_shipping_performance
                order by slowest_delivery_minutes desc, 1 desc limit 1) as slowest,
            max(slowest_delivery_minutes) as slowest_minutes
        from mart_shipping_performance""",
    "kpi_overall_rates": f"""
        select {rate("is_returned")} as return_rate, {rate("is_cancelled")} as cancellation_rate from fct_order_item""",
    "kpi_average_order_value": """
        select payment_method_key, count(distinct order_id) as order_count,
            cast(sum(total_payment) as double) / count(distinct order_id) as average_order_value
        from fct_order_item group by 1""",
    "kpi_delivery_percentiles": """
        select shipping_provider, shipping_service, value_count, median_minutes, p90_minutes from ("""
        + _percentiles("fct_order_item", "shipping_key", "delivery_duration_minutes",
                       {"median_minutes": 0.5, "p90_minutes": 0.9})
        + ") t join dim_shipping using (shipping_key)",

    "dq_unique": """
        select l_orderkey, l_linenumber, count(*) as row_count from lineitem group by 1, 2 having count(*) > 1""",
    "dq_not_null": "select order_item_id, order_id from fct_order_item where payment_date_key is null",
    "dq_relationships": """
        select order_id as missing_key, count(*) as row_count from stg_order_items
        where order_id not in (select order_id from stg_payments) group by 1""",
    "dq_row_count": "select count(*) as row_count from dim_city having count(*) <> 34",
    "dq_minimum_rows": "select count(*) as row_count from fct_order_item having count(*) < 10000000",
    "dq_one_current_version": """
        select customer_nk, count(*) as current_row_count from int_customer_scd2
        where valid_to > timestamp '1997-06-01' group by 1 having count(*) <> 1""",
    "dq_scd2_overlap": """
        select b.customer_nk, b.customer_key, b.valid_from, b.valid_to, max(a.valid_to) as earlier_valid_to
        from dim_customer a join dim_customer b on a.customer_nk = b.customer_nk and a.customer_key <> b.customer_key
            and a.valid_from < b.valid_to and b.valid_from < a.valid_to
        group by all""",
    "dq_interval_overlap": """
        with d as (select customer_id, s.order_id, checkout_ts, delivered_ts from stg_shipments s
            join stg_orders o on s.order_id = o.order_id where delivered_ts is not null)
        select b.customer_id, b.order_id, b.checkout_ts, b.delivered_ts, max(a.delivered_ts) as earlier_valid_to
        from d a join d b on a.customer_id = b.customer_id
            and (a.checkout_ts, a.delivered_ts, a.order_id) < (b.checkout_ts, b.delivered_ts, b.order_id)
        group by all having b.checkout_ts < max(a.delivered_ts)""",
    "dq_missing_measures": """
        select count(*) as bad_rows from fct_order_item where quantity is null or unit_price is null
            or subtotal is null or discount_amount is null or shipping_subsidy is null or voucher_amount is null
            or total_payment is null or estimated_cost is null or profit is null or is_returned is null
            or is_cancelled is null or payment_status is null or delivery_duration_minutes is null""",
    "dq_missing_parents": """
        select count(*) as missing_rows from stg_order_items i left join stg_shipments s on i.order_id = s.order_id
        where s.order_id is null""",

    "rule_voucher_eligibility": """
        select order_id, 'NO_DISCOUNT' as voucher_code from order_subtotals
        union all select order_id, 'CASHBACK_10_MIN_200K' from order_subtotals where order_subtotal >= 200000
        union all select order_id, 'FREE_SHIPPING_MIN_50K' from order_subtotals where order_subtotal >= 50000
        union all select order_id, 'ELECTRONICS_100K' from order_subtotals where electronics_subtotal > 0""",
    "rule_promotion_pools": "select * from promotion_pools",
    "rule_allocation_whole": """
        with weighed as (
            select i.*, p.cashback_pool + p.electronics_pool as vp, p.shipping_pool as sp, greatest(i.subtotal, 0) as sw,
                case when p.electronics_pool > 0 and i.category_name is distinct from 'Electronics' then 0
                    else greatest(i.subtotal, 0) end as vw
            from categorised_items i join promotion_pools p on i.order_id = p.order_id),
        summed as (
            select *, sum(vw) over o as vt, sum(sw) over o as st, count(*) over o as k
            from weighed window o as (partition by order_id)),
        parts as (
            select *, cast(vp as hugeint) * (case when vt = 0 then 1 else vw end) as vx, case when vt = 0 then k else vt end as vd,
                cast(sp as hugeint) * (case when st = 0 then 1 else sw end) as sx, case when st = 0 then k else st end as sd
            from summed),
        ranked as (
            select *, row_number() over (partition by order_id order by vx % vd desc, order_item_id) as vn,
                sum(vx // vd) over (partition by order_id) as vg,
                row_number() over (partition by order_id order by sx % sd desc, order_item_id) as sn,
                sum(sx // sd) over (partition by order_id) as sg
            from parts),
        given as (
            select order_item_id, order_id, product_id, quantity, subtotal, discount_amount, estimated_cost,
                cast(vx // vd + case when vn <= vp - vg then 1 else 0 end as bigint) as voucher_amount,
                cast(sx // sd + case when sn <= sp - sg then 1 else 0 end as bigint) as shipping_subsidy
            from ranked)
        select *, subtotal - discount_amount - voucher_amount as total_payment,
            subtotal - discount_amount - voucher_amount - estimated_cost - shipping_subsidy as profit from given""",
    "rule_allocation": """
        with shares as (
            select i.*, p.cashback_pool, p.electronics_pool, p.shipping_pool,
                cast(i.subtotal as double) / nullif(p.order_subtotal, 0) as general,
                case when i.category_name = 'Electronics' and p.electronics_subtotal <> 0
                    then cast(i.subtotal as double) / p.electronics_subtotal else 0 end as electronic
            from categorised_items i join promotion_pools p on i.order_id = p.order_id),
        given as (
            select * exclude (voucher_amount, shipping_subsidy),
                cast(round_even(cashback_pool * coalesce(general, 0) + electronics_pool * electronic, 0) as bigint)
                    as voucher_amount,
                cast(round_even(shipping_pool * coalesce(general, 0), 0) as bigint) as shipping_subsidy
            from shares)
        select order_item_id, order_id, product_id, quantity, subtotal, discount_amount, estimated_cost, voucher_amount,
            shipping_subsidy, subtotal - discount_amount - voucher_amount as total_payment,
            subtotal - discount_amount - voucher_amount - estimated_cost - shipping_subsidy as profit
        from given""",
    "rule_money_rounding": """
        select p_partkey, cast(round_even(p_partkey / 2.0, 0) as bigint) as half,
            cast(round_even(p_retailprice, 0) as bigint) as price from part""",
    "rule_payment_amounts": f"""
        select order_id, {longs("total_payment payment_amount")} from stg_order_items group by 1""",
    "rule_stage_times": """
        select order_id, min(status_ts) filter (where status = 'shipped') as shipped_ts,
            min(status_ts) filter (where status = 'delivered') as delivered_ts
        from stg_order_status_events group by 1""",
    "rule_late_deliveries": """
        select * from (select shipment_id, order_id, s.shipping_service_id,
            cast(floor(epoch_us(delivered_ts - shipped_ts) / 864e8) as int) as delivery_days, max_delivery_days
            from stg_shipments s join stg_shipping_services v on s.shipping_service_id = v.shipping_service_id) t
        where delivery_days > max_delivery_days""",
    "rule_payment_status": """
        select order_id, case when order_status = 'cancelled' and cancellation_stage = 'placed' then 'cancelled'
            when order_status = 'returned' then 'refunded' else 'paid' end as payment_status from stg_orders""",
    "rule_shipping_status": """
        select o.order_id, case when order_status = 'cancelled' then 'cancelled'
            when delivered_ts is not null then 'delivered' else 'in_progress' end as shipping_status
        from stg_orders o left join stg_shipments s on o.order_id = s.order_id""",
    "rule_order_numbers": """
        select order_id, 'ORD-' || strftime(order_ts, '%Y%m%d') || '-' || printf('%08d', order_id) as order_number
        from stg_orders""",
    "rule_skus": "select product_id, sku from stg_products",
    "rule_continued_keys": """
        select order_id, payment_ts, (select max(payment_id) from stg_payments where loaded_at <= timestamp '1999-01-01')
            + row_number() over (order by payment_ts, order_id) as payment_id
        from stg_payments where loaded_at > timestamp '1999-01-01'""",
    "expr_completed_years": """
        select o.order_id, cast(year(order_ts) - year(birth_date)
            - case when month(order_ts) * 100 + day(order_ts) < month(birth_date) * 100 + day(birth_date)
                then 1 else 0 end as int) as age_years
        from stg_orders o join stg_customer_profile_events c on o.customer_id = c.customer_id
        where c.operation = 'insert'""",
    **dict.fromkeys(("expr_percentiles", "expr_percentiles_selected"), _percentiles(
        "events", "event_type", "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})),
}

_FAULTY |= {
    "fct_rejects": _REJECTS,
    "dq_unique_customer_key": """
        select customer_key, count(*) as row_count from dim_customer group by 1 having count(*) > 1""",
    "dq_accepted_values": """
        select order_status as value, count(*) as row_count from stg_orders
        where order_status not in ('placed', 'paid', 'packed', 'shipped', 'delivered', 'cancelled', 'returned')
        group by 1""",
    "dq_expression": "select order_item_id, quantity from stg_order_items where not (quantity > 0)",
    "dq_table_expression": """
        select order_item_id, total_payment, profit from fct_order_item
        where not (total_payment >= 0 and profit <= total_payment)""",
    "dq_fact_grain": """
        select order_id, item_number, count(*) as row_count from fct_order_item group by 1, 2 having count(*) > 1""",
    "dq_amount_formula": """
        select order_item_id, subtotal, discount_amount, voucher_amount, total_payment from fct_order_item
        where abs(total_payment - (subtotal - discount_amount - voucher_amount)) > 0.01""",
    "dq_profit_formula": """
        select order_item_id, total_payment, estimated_cost, shipping_subsidy, profit from fct_order_item
        where abs(profit - (total_payment - estimated_cost - shipping_subsidy)) > 0.01""",
    "rule_item_amounts": """
        select order_item_id, subtotal - discount_amount - voucher_amount as total_payment,
            subtotal - discount_amount - voucher_amount - estimated_cost - shipping_subsidy as profit,
            total_payment as stored_payment, profit as stored_profit from stg_order_items""",
    "rule_illegal_steps": """
        select * from (select order_id, status_event_id, status, lead(status) over (partition by order_id
            order by status_ts, status_event_id) as next_status, status_ts from stg_order_status_events) t
        where next_status is not null and (status, next_status) not in (
            ('placed', 'paid'), ('paid', 'packed'), ('packed', 'shipped'), ('shipped', 'delivered'),
            ('placed', 'cancelled'), ('paid', 'cancelled'), ('packed', 'cancelled'), ('shipped', 'cancelled'),
            ('delivered', 'returned'))""",
}


def _suite(cities: int, items: int) -> str:
    """One row per declared and singular check."""
    def report(check: str, model: str, column: str, bad: str) -> str:
        return f"""select '{check}' as "check", '{model}' as model, '{column}' as "column", ({bad}) as n_bad"""

    def table(model: str) -> str:
        return model.replace("raw.", "stg_").replace("stg.", "stg_")

    plain = {
        "raw.cities": "city_id", "raw.categories": "category_id", "raw.products": "product_id",
        "raw.payment_methods": "payment_method_id", "raw.shipping_services": "shipping_service_id",
        "raw.vouchers": "voucher_id", "raw.customer_profile_events": "customer_profile_event_id",
        "raw.orders": "order_id", "raw.order_items": "order_item_id", "raw.payments": "payment_id",
        "raw.shipments": "shipment_id", "raw.order_status_events": "status_event_id",
        "stg.order_items": "order_item_id", "stg.orders": "order_id",
        "stg.customer_profile_events": "customer_profile_event_id", "int_customer_scd2": "customer_key",
        "dim_customer": "customer_key", "dim_product": "product_key product_nk",
        "dim_category": "category_key category_nk", "dim_city": "city_key city_nk",
        "int_order_item_enriched": "order_item_id", "dim_payment_method": "payment_method_key payment_method_name",
        "dim_shipping": "shipping_key shipping_service_nk", "dim_order_status": "order_status_key order_status",
        "dim_voucher": "voucher_key voucher_code", "dim_date": "date_key", "dim_time": "time_key",
        "dim_order_flags": "order_flags_key", "fct_order_item": "order_item_key order_item_id",
    }
    filled = {
        "raw.products": "category_id", "raw.customer_profile_events": "customer_id city_id",
        "raw.order_items": "order_id", "stg.order_items": "quantity total_payment", "stg.orders": "order_ts",
        "stg.customer_profile_events": "effective_at", "int_customer_scd2": "customer_nk valid_from valid_to",
        "dim_customer": "customer_nk city_key valid_from valid_to is_current", "dim_product": "category_key",
        "int_order_item_enriched": "total_payment",
        "fct_order_item": """customer_key product_key category_key payment_method_key shipping_key voucher_key order_date_key
            order_time_key quantity unit_price subtotal total_payment estimated_cost""",
    }
    links = [
        ("raw.products", "category_id", "stg_categories"), ("raw.customer_profile_events", "city_id", "stg_cities"),
        ("raw.order_items", "order_id", "stg_orders"), ("dim_customer", "city_key", "dim_city"),
        ("dim_product", "category_key", "dim_category"),
        *(("fct_order_item", f"{d}_key", f"dim_{d}") for d in ("customer", "product", "category", "payment_method", "shipping", "voucher")),
    ]
    rows = []
    for model, columns in plain.items():
        for c in columns.split():
            rows.append(report("unique", model, c, f"""select count(*) from (select {c} from {table(model)}
                where {c} is not null group by {c} having count(*) > 1) t"""))
    for part in (plain, filled):
        for model, columns in part.items():
            for c in columns.split():
                rows.append(report("not_null", model, c, f"select count(*) from {table(model)} where {c} is null"))
    for model, c, parent in links:
        rows.append(report("relationships", model, c, f"""select count(distinct {c}) from {table(model)}
            where {c} is not null and {c} not in (select {c} from {parent})"""))
    for c, parent, k in (("order_date_key", "dim_date", "date_key"), ("order_time_key", "dim_time", "time_key")):
        rows.append(report("relationships", "fct_order_item", c, f"""select count(distinct {c}) from fct_order_item
            where {c} is not null and {c} not in (select {k} from {parent})"""))
    rows.append(report("accepted_values", "dim_payment_method", "payment_method_name", """select count(*) from dim_payment_method
        where payment_method_name not in ('E-wallet', 'QRIS', 'COD', 'Paylater')"""))
    rows.append(report("is_true", "int_order_item_enriched", "total_payment",
                       "select count(*) from int_order_item_enriched where not (total_payment >= 0)"))
    for c, least in (("quantity", "> 0"), ("subtotal", ">= 0"), ("total_payment", ">= 0"), ("estimated_cost", ">= 0")):
        rows.append(report("is_true", "fct_order_item", c, f"select count(*) from fct_order_item where not ({c} {least})"))
    singular = {
        ("city_rows", "dim_city"): f"select 1 from dim_city having count(*) <> {cities}",
        ("grain", "fct_order_item"): "select 1 from fct_order_item group by order_id, item_number having count(*) > 1",
        ("minimum_rows", "fct_order_item"): f"select 1 from fct_order_item having count(*) < {items}",
        ("one_current_version", "dim_customer"):
            "select 1 from dim_customer where is_current group by customer_nk having count(*) <> 1",
        ("amount_formula", "fct_order_item"): """select 1 from fct_order_item
            where abs(total_payment - (subtotal - discount_amount - voucher_amount)) > 0.01""",
        ("profit_formula", "fct_order_item"): """select 1 from fct_order_item
            where abs(profit - (total_payment - estimated_cost - shipping_subsidy)) > 0.01""",
        ("versions_overlap", "dim_customer"): """select distinct b.customer_key
            from dim_customer a join dim_customer b on a.customer_nk = b.customer_nk and a.customer_key <> b.customer_key
                and a.valid_from < b.valid_to and b.valid_from < a.valid_to and a.valid_from <= b.valid_from""",
    }
    for (check, model), bad in singular.items():
        rows.append(report(check, model, "", f"select count(*) from ({bad}) t"))
    rows.append(report("accepted_values", "raw.customer_profile_events", "operation",
                       "select count(*) from stg_customer_profile_events where operation not in ('insert', 'update')"))
    rows.append(report("accepted_values", "raw.orders", "order_status", """select count(*) from stg_orders where
        order_status not in ('placed', 'paid', 'packed', 'shipped', 'delivered', 'cancelled', 'returned')"""))
    rows.append(report("is_true", "stg.order_items", "quantity",
                       "select count(*) from stg_order_items where not (quantity > 0)"))
    rows.append(report("is_true", "stg.order_items", "total_payment",
                       "select count(*) from stg_order_items where not (total_payment >= 0)"))
    return " union all ".join(rows)


_LOADED = """
    with late as (select * from stg_orders where loaded_at > timestamp '1999-01-01' or order_id % 50 = 0),
    delta as (
        select * replace (case when order_id % 64 <> 1 then currency end as currency,
            case when order_id % 96 <> 33 then customer_id end as customer_id,
            case when order_id % 64 = 2 then timestamp '2003-01-01' else loaded_at end as loaded_at) from late
        union all select * replace (customer_id + 1000000 as customer_id) from late where order_id % 64 = 3
        union all select * replace (-order_id as order_id) from late where order_id % 64 = 4),
    marked as (
        select *, concat_ws(',', case when customer_id is null then 'null:customer_id' end,
            case when currency is null then 'null:currency' end) as gaps,
            order_id in (select order_id from stg_orders where loaded_at <= timestamp '1999-01-01') as id_stored,
            order_number in (select order_number from stg_orders where loaded_at <= timestamp '1999-01-01') as number_stored
        from delta),
    by_id as (select *, gaps <> '' or id_stored as out_id, row_number() over (
        partition by order_id order by gaps <> '' or id_stored, customer_id) as id_place from marked),
    by_number as (select *, out_id or id_place > 1 or number_stored as out_number, row_number() over (
        partition by order_number order by out_id or id_place > 1 or number_stored, order_id, customer_id) as number_place from by_id),
    judged as (select * exclude (gaps), concat_ws(',', nullif(gaps, ''), case when id_stored then 'stored:order_id' end,
        case when not out_id and id_place > 1 then 'repeated:order_id' end, case when number_stored then 'stored:order_number' end,
        case when not out_number and number_place > 1 then 'repeated:order_number' end) as reasons from by_number)"""
_PLAIN["snk_checked_load"] = _LOADED + """
    select * from stg_orders where loaded_at <= timestamp '1999-01-01'
    union all select * exclude (id_stored, number_stored, out_id, id_place, out_number, number_place, reasons) from judged where reasons = ''"""
_PLAIN["snk_quarantine"] = _LOADED + """
    select 1::bigint as load, order_id, order_number, customer_id, reasons from judged where reasons <> ''"""
_PLAIN["snk_control_ledger"] = " union all ".join(
    f"select '{t}' as table_name, max(loaded_at) as last_loaded_at, 1::bigint as last_batch, -1::bigint as unknown_batch from stg_{t}"
    for t in ("orders", "payments"))
_FAULTY["dq_unique_incremental"] = """
    select order_id, item_number, count(*) as row_count from stg_order_items group by 1, 2 having count(*) > 1"""
_FAULTY["dq_relationships_incremental"] = """
    select order_id as missing_key, count(*) as row_count from stg_order_items
    where order_id not in (select order_id from stg_payments where order_id % 10 <> 3) group by 1"""
_FAULTY["dq_suite"] = _FAULTY["dq_suite_measured"] = _suite(34, 10_000_000)
_PLAIN["pipe_checks"] = _suite(25, 1_000)
for _mart in ("city_performance", "customer_segments", "hourly_orders", "monthly_revenue", "payment_method_performance",
              "product_performance", "shipping_performance", "voucher_recommendations"):
    _PLAIN[f"pipe_delta_{_mart}"] = f"select * from mart_{_mart}"
_PLAIN["snk_versioned_merge"] = """
    select year(loaded_at) as year, count(*) as items, sum(total_payment)::bigint as paid, 1 as place
    from stg_order_items where loaded_at <= timestamp '1999-01-01' group by 1
    union all select year(loaded_at), count(*), sum(total_payment)::bigint, 2 from stg_order_items group by 1"""
_PLAIN["snk_version_changes"] = """
    select year(loaded_at) as year, count(*) as new_items from stg_order_items
    where loaded_at > timestamp '1999-01-01' group by 1"""

ORACLE: dict[str, str] = {
    **{name: with_relations(sql) for name, sql in _PLAIN.items()},
    **{name: with_relations(sql, faulty=True) for name, sql in _FAULTY.items()},
}
