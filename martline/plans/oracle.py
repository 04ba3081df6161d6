"""The same results as plain SQL over the driver tables, for the side-by-side check."""

from __future__ import annotations

from martline.plans.standins import EVENT_DAY, ORDER_DAY

SQL: dict[str, str] = {}

_DAY = "strftime({}, '%Y-%m-%d')"
_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_CUT = "cast(cast(l_extendedprice as decimal(16,2)) * cast(l_discount as decimal(4,2)) as decimal(16,2))"
_LINE = """concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint),
    cast(l_extendedprice as decimal(16,2)))"""
_COUPON = "cast(cast(round(l_discount * 100) as int) as varchar)"
_PAID_AT = "(o_orderdate + to_seconds(o_orderkey % 172800))"
_DONE = "(o_orderdate + to_seconds(432000))"
_PAGE = "case event_type when 'view' then 'home' when 'click' then 'good_detail' when 'signup' then 'register' else event_type end"
_LOCAL = "strftime(ts + interval 8 hour, '%Y-%m-%d %H:%M:%S')"


def _m(expression: str) -> str:
    return f"cast({expression} as decimal(16,2))"


def _b(expression: str) -> str:
    return f"cast({expression} as bigint)"


def _v(expression: str) -> str:
    return f"cast({expression} as varchar)"


# Common tables, each written once and put in front of the queries that use it.
_WITH = {
    "detail": f"""
        select {_LINE} as id, {_v('l_orderkey')} as order_id, {_v('o_custkey')} as user_id,
            {_v('l_partkey')} as sku_id, {_v('c_nationkey')} as province_id, {_DAY.format('o_orderdate')} as dt,
            {_b('l_quantity')} as num, {_m('l_extendedprice')} as original,
            case when l_discount >= 0.05 then {_CUT} else {_m('0')} end as activity,
            case when l_discount >= 0.05 then {_m('0')} else {_CUT} end as coupon,
            {_m(f"{_m('l_extendedprice')} - {_CUT}")} as total
        from lineitem join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey""",
    "sku": f"""
        select {_v('p_partkey')} as id, p_name as sku_name, p_type as category1_id, 'c1 ' || p_type as category1_name,
            p_type || '-' || p_size // 10 as category2_id, 'c2 ' || p_type || '-' || p_size // 10 as category2_name,
            p_type || '-' || p_size as category3_id, 'c3 ' || p_type || '-' || p_size as category3_name,
            p_brand as tm_id, 'tm ' || p_brand as tm_name
        from part""",
    "province": f"""
        select {_v('n_nationkey')} as id, n_name as province_name, {_v('n_nationkey')} as area_code,
            'N' || n_nationkey as iso_code, 'X-' || n_nationkey as iso_3166_2
        from nation""",
    "ev": f"""
        select *, cast(json_extract_string(props, '$.k') as bigint) as k, {_DAY.format('ts')} as day,
            epoch_us(ts) // 1000 as ms, {_v('user_id')} as usr, {_PAGE} as page_id
        from events""",
    "views": f"""
        select usr as mid_id, 'brand' || user_id % 3 as brand, 'model' || user_id % 4 as model,
            'os' as operate_system, 'v1' as version_code, 'ch' || user_id % 5 as channel, usr || '-' || day as session_id,
            page_id, {_TIME.format('ts')} as view_time, ms as ts, {_b('round(value * 1000)')} as during_time, day as dt
        from ev""",
    "log": f"""
        select event_id, event_type, ms as ts, ts as moment, k, usr as mid_id, case when k >= 5 then usr end as user_id,
            usr || '-' || day as session_id, {_v('k % 34')} as province_id, 'brand' || user_id % 3 as brand,
            'ch' || user_id % 5 as channel, 'model' || user_id % 4 as model, 'os' as operate_system,
            'v1' as version_code,
            case when event_type <> 'purchase' then page_id end as page_id,
            case when event_type <> 'purchase' then {_v(_b('round(value * 1000)'))} end as during_time, day as dt
        from ev""",
    "logins": """
        select concat_ws('-', usr, k % 8) as user_id, day as dt from ev where event_type = 'purchase'""",
    "cart_feed": f"""
        select case event_type when 'click' then 'insert' else 'update' end as type, ms as ts, {_v('event_id')} as id,
            usr as user_id, {_v('k')} as sku_id, k as sku_num, {_TIME.format('ts')} as create_time, day as dt,
            case when event_type = 'view' and value >= 1 then {_b('floor(value)')} end as old_num
        from ev where event_type in ('click', 'view')""",
    "paid": f"""
        select o_orderkey, o_totalprice, {_TIME.format(_PAID_AT)} as pay_time, {_DAY.format(_PAID_AT)} as pay_day,
            left(o_orderpriority, 1) as pay_code, substr(o_orderpriority, 3) as pay_name
        from orders where o_orderstatus in ('F', 'P')""",
    "sessions": """
        select session_id, mid_id, channel, sum(during_time) as stay, count(*) as pages, dt
        from views group by session_id, mid_id, brand, model, operate_system, version_code, channel, dt""",
    "zip_changes": """
        select usr as id, 'user ' || usr as name, 'L' || k as user_level, day, ms,
            row_number() over (partition by user_id, day order by ms desc, 'L' || k desc) as rn
        from ev where event_type = 'signup'""",
}

_NEEDS = {
    "views": ["ev"], "log": ["ev"], "logins": ["ev"], "cart_feed": ["ev"], "sessions": ["ev", "views"],
    "zip_changes": ["ev"],
}


def _oracle(name: str, tables: str, sql: str) -> None:
    wanted: list[str] = []
    for table in tables.split():
        wanted += [t for t in [*_NEEDS.get(table, []), table] if t not in wanted]
    head = ", ".join(f"{t} as ({_WITH[t]})" for t in wanted)
    SQL[name] = f"with {head} {sql}" if head else sql


def _back(day: str, days: int) -> str:
    """SQL text of the day ``days`` before ``day``."""
    return f"strftime(date '{day}' - {days}, '%Y-%m-%d')"


ED, OD = f"'{EVENT_DAY}'", f"'{ORDER_DAY}'"
_OPEN = "'9999-12-31'"

# Sources

_FLAT_LOG = """
    select dt, ts, mid_id, user_id, session_id, page_id, during_time, cast(k % 3 as int) as actions,
        cast(k % 3 as int) as displays, case when event_type = 'signup' then k end as loading_time,
        case when event_type = 'error' then 'm' || k end as error
    from log"""
_oracle("s1_read_log_json", "log", _FLAT_LOG)
_oracle("s4_load_partition", "log", f"{_FLAT_LOG} where dt = {ED}")
_oracle("s7_tail_files_stream", "log", _FLAT_LOG)
_oracle("s7_tail_growing_files", "log", _FLAT_LOG)
_oracle("s2_read_snapshot_tsv", "", f"""
    select {_v('p_partkey')} as id, {_v('p_size')} as spu_id, {_m('p_retailprice')} as price, p_name as sku_name,
        {_m('p_size')} as weight, p_brand as tm_id, p_type || '-' || p_size as category3_id,
        cast(null as varchar) as sku_default_img, case when p_size < 25 then '1' end as is_sale,
        '2024-01-01 00:00:00' as create_time, {OD} as dt
    from part""")
_oracle("s3_read_change_feed", "cart_feed", f"""
    select type, ts, id, user_id, sku_num, create_time, cast(null as varchar) as is_ordered, {_v('old_num')} as old_num,
        dt
    from cart_feed""")
_oracle("s5_land_log_stream", "ev", f"""
    select strftime(ts + interval 8 hour, '%Y-%m-%d') as dt, ms as ts, usr as mid_id, event_type as page_id from ev""")
_oracle("s6_land_change_stream", "ev", f"""
    select case when event_type in ('click', 'view') then 'cart_info' else 'user_info' end as feed,
        case event_type when 'click' then 'insert' else 'update' end as type, ms // 1000 as ts,
        {_v('event_id')} as id, day as dt
    from ev""")
_oracle("s9_bootstrap_vs_incremental", "ev", """
    select 'bootstrap-insert' as type, '2023-12-31' as dt, count(*) as row_count
    from ev where event_type in ('click', 'error')
    union all
    select case event_type when 'click' then 'insert' else 'update' end, day, count(*)
    from ev where event_type in ('click', 'error') group by 1, 2""")
_CALENDAR = """
    select strftime(d, '%Y-%m-%d') as date_id, cast(week(d) as varchar) as week_id,
        cast(isodow(d) as varchar) as week_day, cast(day(d) as varchar) as "day", cast(month(d) as varchar) as "month",
        cast(quarter(d) as varchar) as "quarter", cast(year(d) as varchar) as "year",
        case when isodow(d) <= 5 then '1' else '0' end as is_workday{}
    from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders)"""
_oracle("d7_dim_date", "", _CALENDAR.format(""))
_oracle("s10_load_calendar", "", _CALENDAR.format(", cast(null as varchar) as holiday_id"))

# Sinks

_COUNTS = "select day as dt, event_type, count(*) * {} as n from ev {} group by 1, 2"
_oracle("k1_overwrite_partition", "ev", f"""
    select dt, event_type, case when dt = {ED} then n * 2 else n end as n
    from ({_COUNTS.format(1, '')}) where dt <> {_back(EVENT_DAY, 1)}""")
_oracle("k2_overwrite_dynamic", "ev", f"""
    select dt, event_type, case when dt >= {_back(EVENT_DAY, 6)} then n * 3 else n end as n
    from ({_COUNTS.format(1, '')})""")
_oracle("k3_accumulate_report", "ev", f"""
    select dt, event_type, case when dt = {ED} then n * 5 else n end as n
    from ({_COUNTS.format(1, '')}) where dt >= {_back(EVENT_DAY, 1)}""")
_oracle("k3_accumulate_distinct", "ev", _COUNTS.format(1, ""))
_oracle("k5_columnar_table", "ev", "select event_id, user_id, event_type, k, day from ev")
_oracle("k6_tsv_table", "ev", "select event_id, user_id, event_type, nullif(k, 0) as k from ev")
_ODD_TEXT = """
    select event_id, case k % 8 when 0 then '  ' || event_type || ' ' when 1 then event_type || chr(9) || event_type
        when 2 then event_type || chr(10) || event_type when 3 then '\\' || event_type || '\\t\\\\' when 4 then ''
        when 5 then '\\N' when 6 then chr(13) || chr(10) || chr(9) || '\\' || event_type end as text, event_type
    from ev"""
_oracle("k6_tsv_table_texts", "ev", _ODD_TEXT)
_oracle("s2_read_snapshot_tsv_texts", "ev", f"""
    select event_id, nullif(text, '') as text, event_type, {ED} as dt from ({_ODD_TEXT})""")
_oracle("k7_check_partition", "ev", "select day as dt, count(distinct event_type) as row_count from ev group by 1")

# Dimensions

_oracle("d1_dim_sku", "sku", f"""
    select {_v('p_partkey')} as id, {_m('p_retailprice')} as price, p_name as sku_name, p_type as sku_desc,
        {_m('p_size')} as weight, p_size < 25 as is_sale, {_v('p_size')} as spu_id, 'spu ' || p_size as spu_name,
        category3_id, category3_name, category2_id, category2_name, category1_id, category1_name, tm_id, tm_name,
        '1:' || p_size || ':size:' || p_size || ',2:' || p_brand || ':brand:' || p_brand as sku_attr_values,
        sales as sku_sale_attr_values, '2024-01-01 00:00:00' as create_time, {OD} as dt
    from part join sku on id = {_v('p_partkey')}
    left join (
        select l_partkey, string_agg('1:' || f || ':flag:' || s, ',' order by f, s) as sales
        from (select distinct l_partkey, l_returnflag as f, l_linestatus as s from lineitem) group by 1
    ) on l_partkey = p_partkey""")
_oracle("d2_dim_coupon", "", f"""
    select {_v('p_partkey')} as id, p_name as coupon_name, '320' || p_size // 10 as coupon_type_code,
        r1.r_name || ' 32' as coupon_type_name, {_m('p_retailprice')} as condition_amount,
        {_b('p_size')} as condition_num, {_m('p_retailprice')} as benefit_amount, {_m('p_size')} as benefit_discount,
        case p_size // 10
            when 1 then '满' || {_m('p_retailprice')} || '元减' || {_m('p_retailprice')} || '元'
            when 2 then '满' || p_size || '件打' || {_m('p_size')} || '折'
            when 3 then '无门槛减' || {_m('p_retailprice')} || '元' end as benefit_rule,
        '330' || (length(p_brand) - 5) as range_type_code, r2.r_name || ' 33' as range_type_name,
        {_b('p_size')} as limit_num, {_b('0')} as taken_count, {OD} as dt
    from part left join region r1 on r1.r_regionkey = p_size // 10
    left join region r2 on r2.r_regionkey = length(p_brand) - 5""")
_oracle("d3_dim_activity", "", f"""
    select {_v('s_suppkey')} as activity_rule_id, {_v('s_nationkey')} as activity_id, n_name as activity_name,
        '310' || s_nationkey // 5 as activity_type_code, r_name || ' 31' as activity_type_name,
        'about ' || n_name as activity_desc, {_m('s_acctbal')} as condition_amount,
        {_b('s_nationkey')} as condition_num, {_m('s_acctbal')} as benefit_amount,
        {_m('s_nationkey')} as benefit_discount,
        case s_nationkey // 5
            when 1 then '满' || {_m('s_acctbal')} || '元减' || {_m('s_acctbal')} || '元'
            when 2 then '满' || s_nationkey || '件打' || {_m('s_nationkey')} || '折'
            when 3 then '无门槛打' || {_m('s_nationkey')} || '折' end as benefit_rule,
        '1' as benefit_level, {OD} as dt
    from supplier left join nation on n_nationkey = s_nationkey left join region on r_regionkey = s_nationkey // 5""")
_oracle("d4_dim_province", "province", f"""
    select p.*, {_v('r_regionkey')} as region_id, r_name as region_name, {OD} as dt
    from province p join nation on id = {_v('n_nationkey')} join region on n_regionkey = r_regionkey""")
_oracle("d5_dim_promotion_pos", "", f"""
    select {_v('s_suppkey')} as id, s_name as pos_location, {_v('s_nationkey')} as pos_type, {OD} as dt from supplier""")
_oracle("d6_dim_promotion_refer", "", f"""
    select {_v('s_suppkey')} as id, s_name as refer_name, {OD} as dt from supplier""")
_oracle("d8a_scd2_init", "", f"""
    select {_v('c_custkey')} as id, c_name as name, c_mktsegment as user_level, {ED} as start_date,
        {_OPEN} as end_date, {_OPEN} as dt
    from customer""")


def _states(*days: str) -> str:
    """All states of the users: the base row and one per changed day, with the day each one starts."""
    listed = ", ".join(days)
    return f"""
        select *, coalesce(strftime(cast(lead(start_date) over (partition by id order by start_date) as date) - 1,
            '%Y-%m-%d'), {_OPEN}) as end_date
        from (
            select {_v('c_custkey')} as id, c_name as name, c_mktsegment as user_level, '2023-12-31' as start_date
            from customer
            union all
            select id, name, user_level, day from zip_changes where rn = 1 and day in ({listed})
        )"""


_BOTH = _states(_back(EVENT_DAY, 1), ED)
_oracle("d8b_scd2_merge", "zip_changes", f"""
    select id, name, user_level, start_date, end_date, end_date as dt from ({_states(ED)})""")
_oracle("d8b_scd2_merge_in_transactions", "", f"""
    select {_v('c_custkey')} as id, c_name as name, c_mktsegment as user_level, '2023-12-31' as start_date,
        {_back(EVENT_DAY, 1)} as end_date, {_back(EVENT_DAY, 1)} as dt from customer
    union all
    select {_v('c_custkey')}, 'a third ' || c_custkey, 'a', {ED}, {_OPEN}, {_OPEN} from customer""")
_oracle("d8c_scd2_current", "zip_changes", f"""
    select id, name, user_level, start_date from ({_BOTH}) where end_date = {_OPEN}""")
_oracle("d8c_scd2_as_of", "zip_changes", f"""
    select id, name, user_level, start_date, end_date from ({_BOTH})
    where start_date <= {_back(EVENT_DAY, 1)} and end_date >= {_back(EVENT_DAY, 1)}""")
_oracle("d8c_scd2_join_as_of", "zip_changes", f"""
    select day, user_level, count(*) as n
    from ev left join ({_BOTH}) on usr = id and day between start_date and end_date group by 1, 2""")
_oracle("d9_decode_dictionary", "", f"""
    select {_v('o_orderkey')} as order_id, left(o_orderpriority, 1) as payment_type_code,
        substr(o_orderpriority, 3) as payment_type_name
    from orders""")

# Facts

_oracle("f1_fact_cart_add", "cart_feed", f"""
    select id, user_id, sku_id, dt as date_id, create_time,
        case type when 'insert' then sku_num else sku_num - old_num end as sku_num, dt
    from cart_feed where dt = {ED} and (type = 'insert' or sku_num > old_num)""")
_oracle("f1_fact_cart_add_first_day", "cart_feed", """
    select id, user_id, sku_id, dt as date_id, create_time, sku_num, dt from cart_feed""")
_ORDER_LINES = f"""
    select {_LINE} as id, {_v('l_orderkey')} as order_id, {_v('o_custkey')} as user_id, {_v('l_partkey')} as sku_id,
        {_v('c_nationkey')} as province_id, case when l_discount >= 0.05 then 'a' end as activity_id,
        case when l_discount >= 0.05 then {_v('l_suppkey')} end as activity_rule_id,
        case when l_discount > 0 and l_discount < 0.05 then {_COUPON} end as coupon_id, {{columns}},
        {_b('l_quantity')} as sku_num,
        {_m(f"{_m('l_extendedprice')} * {_b('l_quantity')}")} as split_original_amount,
        case when l_discount >= 0.05 then {_CUT} else {_m('0')} end as split_activity_amount,
        case when l_discount < 0.05 then {_CUT} else {_m('0')} end as split_coupon_amount, {{amount}}
    from lineitem join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey"""
_SHARE = _m(f"{_m('l_extendedprice')} - {_CUT}")
_PLACED = _ORDER_LINES.format(
    columns=f"{_DAY.format('o_orderdate')} as date_id, {_TIME.format('o_orderdate')} as create_time",
    amount=f"{_SHARE} as split_total_amount, {_DAY.format('o_orderdate')} as dt",
)
_oracle("f2_fact_order_detail", "", f"{_PLACED} where {_DAY.format('o_orderdate')} = {OD}")
_oracle("f2_fact_order_detail_first_day", "", _PLACED)
_PAID_COLUMNS = (
    "pay_code as payment_type_code, pay_name as payment_type_name, pay_day as date_id, pay_time as callback_time"
)
_JOIN_PAID = "join paid on paid.o_orderkey = l_orderkey"
_oracle("f3_fact_payment_success", "paid", f"""
    {_ORDER_LINES.format(columns=_PAID_COLUMNS, amount=_m('paid.o_totalprice') + ' as split_payment_amount, pay_day as dt')
     .replace('from lineitem join orders on l_orderkey = o_orderkey',
              f'from lineitem join orders on l_orderkey = orders.o_orderkey {_JOIN_PAID}')}
    where pay_day = {OD} and {_DAY.format('o_orderdate')} between {_back(ORDER_DAY, 1)} and {OD}""")
_oracle("f3_fact_payment_success_first_day", "paid", f"""
    {_ORDER_LINES.format(columns=_PAID_COLUMNS, amount=_SHARE + ' as split_payment_amount, pay_day as dt')
     .replace('from lineitem join orders on l_orderkey = o_orderkey',
              f'from lineitem join orders on l_orderkey = orders.o_orderkey {_JOIN_PAID}')}""")
_oracle("f4_fact_cart_snapshot", "", f"""
    select {_LINE} as id, {_v('o_custkey')} as user_id, {_v('l_partkey')} as sku_id,
        'sku ' || l_partkey as sku_name, {_b('l_quantity')} as sku_num, {OD} as dt
    from lineitem join orders on l_orderkey = o_orderkey
    where o_orderstatus = 'O'""")


def _flow(daily: bool, stream: bool = False) -> str:
    """Milestones known after the run: all of them on the first day and from a stream, those up to the day otherwise."""
    known = f"{_DAY.format('{}')} <= {OD}"
    paid = "o_orderstatus in ('F', 'P')" + (f" and {known.format(_PAID_AT)}" if daily else "")
    done = "o_orderstatus = 'F'" + (f" and {known.format(_DONE)}" if daily else "")
    activity = "cast(null as decimal(16,2))" if daily or stream else _m("0")
    rows = f"""
        select {_v('o_orderkey')} as order_id, {_v('o_custkey')} as user_id, {_v('c_nationkey')} as province_id,
            {_DAY.format('o_orderdate')} as order_date_id, {_TIME.format('o_orderdate')} as order_time,
            case when {paid} then {_DAY.format(_PAID_AT)} end as payment_date_id,
            case when {paid} then {_TIME.format(_PAID_AT)} end as payment_time,
            case when {done} then {_DAY.format(_DONE)} end as finish_date_id,
            case when {done} then {_TIME.format(_DONE)} end as finish_time,
            {_m('o_totalprice')} as order_original_amount, {activity} as order_activity_amount,
            {_m('1')} as order_coupon_amount, {_m('o_totalprice')} as order_total_amount,
            case when {paid} then {_m('o_totalprice')} end as payment_amount,
            case when {done} then {_DAY.format(_DONE)} else {_OPEN} end as dt
        from orders left join customer on o_custkey = c_custkey"""
    if not daily:
        return rows
    return f"select * from ({rows}) where order_date_id <= {OD} and dt >= {OD}"


_oracle("f5_fact_trade_flow", "", _flow(True))
_oracle("f5_fact_trade_flow_repeated_inserts", "", _flow(True))
_oracle("f5_fact_trade_flow_first_day", "", _flow(False))
_oracle("t3_order_flow_stream", "", _flow(False, stream=True))
_USED = f"""
    select {_LINE} as id, {_COUPON} as coupon_id, {_v('o_custkey')} as user_id, {_v('l_orderkey')} as order_id,
        {_DAY.format('o_orderdate')} as date_id, {_TIME.format('o_orderdate')} as payment_time,
        {_DAY.format('o_orderdate')} as dt
    from lineitem join orders on l_orderkey = o_orderkey
    where l_discount > 0 and l_discount < 0.05 and l_returnflag <> 'R'"""
_oracle("f6_fact_coupon_used", "", f"{_USED} and {_DAY.format('o_orderdate')} = {OD}")
_oracle("f6_fact_coupon_used_first_day", "", _USED)
_oracle("f7_fact_favor_add", "ev", f"""
    select {_v('event_id')} as id, usr as user_id, {_v('k')} as sku_id, day as date_id,
        {_TIME.format('ts')} as create_time, day as dt
    from ev where event_type = 'click' and day = {ED}""")
_oracle("f8_fact_page_view", "ev log", f"""
    select province_id, brand, channel, '0' as is_new, model, mid_id, operate_system, user_id, version_code,
        {_v('k')} as page_item, 'sku_id' as page_item_type, page_id,
        left({_LOCAL.replace('ts +', 'moment +')}, 10) as date_id, {_LOCAL.replace('ts +', 'moment +')} as view_time, session_id,
        {_b('during_time')} as during_time, ts, dt
    from log where event_type <> 'purchase'""")
_REGISTER = f"""
    select {_v('c_custkey')} as user_id, {ED} as date_id, {ED} || ' 08:00:00' as create_time, channel, province_id,
        version_code, mid_id, brand, model, operate_system, {ED} as dt
    from customer left join ({{}}) on user_id = {_v('c_custkey')}"""
_REGISTER_PAGES = f"select * from log where dt = {ED} and page_id = 'register' and user_id is not null"
_oracle("f9_fact_register", "log", _REGISTER.format(_REGISTER_PAGES))
_oracle("f9_fact_register_dedup", "log", _REGISTER.format(
    f"select * from ({_REGISTER_PAGES}) qualify row_number() over (partition by user_id order by ts) = 1"
))
_oracle("f10_fact_login", "log", f"""
    select user_id, left({_LOCAL.replace('ts +', 'moment +')}, 10) as date_id, {_LOCAL.replace('ts +', 'moment +')} as login_time,
        channel, province_id, version_code, mid_id, brand, model, operate_system, dt
    from log where event_type <> 'purchase' and user_id is not null
    qualify row_number() over (partition by dt, session_id order by ts) = 1""")
_oracle("f11_field_changed", "cart_feed", f"""
    select dt, id, {_v('old_num')} as old_num, sku_num from cart_feed where old_num is not null""")
_oracle("f12_latest_change", "ev", """
    select ms as ts, usr as id, 'user ' || usr as name, 'L' || k as user_level from ev where event_type = 'signup'
    qualify row_number() over (partition by user_id order by ms desc, 'L' || k desc) = 1""")
_oracle("f12_latest_change_in_transactions", "", f"""
    select cast(1704067200 as bigint) as ts, {_v('c_custkey')} as id, 'a third ' || c_custkey as name, 'a' as user_level from customer""")
_NTH = "(select unnest(generate_series(1, 2)) as i) on i <= k % 3"
_oracle("f13_explode_actions", "log", f"""
    select mid_id, user_id, session_id, page_id, 'act' || i as action_id, {_v('k')} as item, 'sku_id' as item_type,
        {_TIME.format('make_timestamp((ts + i) * 1000)')} as action_time, dt
    from log join {_NTH}""")
_oracle("f14_explode_displays", "log", f"""
    select mid_id, user_id, session_id, page_id, 'query' as display_type, {_v('k + i')} as item,
        'sku_id' as item_type, {_v('i')} as pos_seq, 'p1' as pos_id, {_TIME.format('moment')} as display_time, dt
    from log join {_NTH}""")
_oracle("f15_start_events", "log", f"""
    select mid_id, user_id, channel, 'icon' as entry, {_b('0')} as first_open, k as loading_time, k as open_ad_id,
        k as open_ad_ms, {_b('0')} as open_ad_skip_ms, {_TIME.format('moment')} as start_time, dt
    from log where event_type = 'signup'""")
_oracle("f16_error_events", "log", f"""
    select mid_id, user_id, page_id, k as error_code, 'm' || k as msg, {_TIME.format('moment')} as error_time, dt
    from log where event_type = 'error'""")

# Summaries

_ORDER_SUMS = (
    f"{_b('sum(num)')} as order_num_1d, {_m('sum(original)')} as order_original_amount_1d, "
    f"{_m('sum(activity)')} as activity_reduce_amount_1d, {_m('sum(coupon)')} as coupon_reduce_amount_1d, "
    f"{_m('sum(total)')} as order_total_amount_1d"
)
_PROVINCE_SUMS = _ORDER_SUMS.split(", ", 1)[1]
_SKU_NAMES = (
    "sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name"
)
_USER_SKU = f"""
    select user_id, sku_id, {_SKU_NAMES}, count(*) as order_count_1d, {_ORDER_SUMS}, dt
    from detail left join sku on sku_id = sku.id {{}} group by user_id, sku_id, {_SKU_NAMES}, dt"""
_USER = f"""
    select user_id, count(distinct order_id) as order_count_1d, {_ORDER_SUMS}, dt from detail {{}} group by user_id, dt"""
_PROVINCE_NAMES = "province_name, area_code, iso_code, iso_3166_2"
_PROVINCE = f"""
    select province_id, {_PROVINCE_NAMES}, count(distinct order_id) as order_count_1d, {_PROVINCE_SUMS}, dt
    from detail left join province on province_id = province.id {{}} group by province_id, {_PROVINCE_NAMES}, dt"""
_ON_DAY = f"where dt = {OD}"
_IN_MONTH = f"where dt between {_back(ORDER_DAY, 29)} and {OD}"
_oracle("a1_user_sku_order_1d", "detail sku", _USER_SKU.format(_ON_DAY))
_oracle("a1_user_sku_order_1d_first_day", "detail sku", _USER_SKU.format(""))
_oracle("a2_user_order_1d", "detail", _USER.format(_ON_DAY))
_oracle("a2_user_order_1d_first_day", "detail", _USER.format(""))
_oracle("a3_user_cart_add_1d", "ev", f"""
    select usr as user_id, count(*) as cart_add_count_1d, {_b('sum(k)')} as cart_add_num_1d, day as dt
    from ev where event_type = 'click' group by 1, 4""")
_oracle("a4_user_payment_1d", "paid", f"""
    select {_v('o_custkey')} as user_id, count(distinct l_orderkey) as payment_count_1d,
        {_b('sum(cast(l_quantity as bigint))')} as payment_num_1d,
        {_m(f"sum({_m('paid.o_totalprice')})")} as payment_amount_1d, pay_day as dt
    from lineitem join orders on l_orderkey = orders.o_orderkey {_JOIN_PAID} group by 1, 5""")
_oracle("a5_province_order_1d", "detail province", _PROVINCE.format(_ON_DAY))
_oracle("a5_province_order_1d_first_day", "detail province", _PROVINCE.format(""))
_COUPON_USED = f"""
    select {_v('o_custkey')} as user_id, {_COUPON} as coupon_id, p_name as coupon_name,
        {_v('p_size')} as coupon_type_code, p_type as coupon_type_name, p_brand as benefit_rule,
        count(*) as used_count_1d, {_DAY.format('o_orderdate')} as dt
    from lineitem join orders on l_orderkey = o_orderkey left join part on {_v('p_partkey')} = {_COUPON}
    where l_discount > 0 and l_discount < 0.05 group by 1, 2, 3, 4, 5, 6, 8"""
_oracle("a6_user_coupon_used_1d", "", _COUPON_USED)
_FAVORS = f"""
    select {_v('k')} as sku_id, {_SKU_NAMES}, count(*) as favor_add_count_1d, day as dt
    from ev left join sku on {_v('k')} = id where event_type = 'click' group by {_v('k')}, {_SKU_NAMES}, day"""
_oracle("a7_sku_favor_add_1d", "ev sku", _FAVORS)
_oracle("a8_session_page_view_1d", "views", f"""
    select session_id, mid_id, brand, model, operate_system, version_code, channel,
        {_b('sum(during_time)')} as during_time_1d, count(*) as page_count_1d, dt
    from views group by session_id, mid_id, brand, model, operate_system, version_code, channel, dt""")
_oracle("a9_visitor_page_view_1d", "views", f"""
    select mid_id, brand, model, operate_system, page_id, {_b('sum(during_time)')} as during_time_1d,
        count(*) as view_count_1d, dt
    from views group by mid_id, brand, model, operate_system, page_id, dt""")


def _windows(counted: str, amounts_only: bool = False) -> str:
    recent = f"filter (dt >= {_back(ORDER_DAY, 6)})"
    columns = []
    for window, condition in ((7, recent), (30, "")):
        columns.append(f"coalesce({counted} {condition}, 0) as order_count_{window}d")
        if not amounts_only:
            columns.append(f"{_b(f'coalesce(sum(num) {condition}, 0)')} as order_num_{window}d")
        for source, name in (
            ("original", "order_original_amount"), ("activity", "activity_reduce_amount"),
            ("coupon", "coupon_reduce_amount"), ("total", "order_total_amount"),
        ):
            columns.append(f"{_m(f'coalesce(sum({source}) {condition}, 0)')} as {name}_{window}d")
    return ", ".join(columns)


_USER_SKU_ND = f"""
    select user_id, sku_id, {_SKU_NAMES}, {_windows('count(*)')}, {OD} as dt
    from detail left join sku on sku_id = sku.id {_IN_MONTH} group by user_id, sku_id, {_SKU_NAMES}"""
_oracle("a10_user_sku_order_nd", "detail sku", _USER_SKU_ND)
_oracle("a11_province_order_nd", "detail province", f"""
    select province_id, {_PROVINCE_NAMES}, {_windows('count(distinct order_id)', True)}, {OD} as dt
    from detail left join province on province_id = province.id {_IN_MONTH} group by province_id, {_PROVINCE_NAMES}""")
_TO_DATE = f"""
    select user_id, min(dt) as order_date_first, max(dt) as order_date_last,
        count(distinct order_id) as order_count_td, {_b('sum(num)')} as order_num_td,
        {_m('sum(original)')} as original_amount_td, {_m('sum(activity)')} as activity_reduce_amount_td,
        {_m('sum(coupon)')} as coupon_reduce_amount_td, {_m('sum(total)')} as total_amount_td, {OD} as dt
    from detail where dt <= {OD} group by user_id"""
_oracle("a12_user_order_td", "detail", _TO_DATE)
_oracle("a12_user_order_td_first_day", "detail", _TO_DATE)
_LOGIN_TD = f"""
    select user_id, max(dt) as login_date_last, min(dt) as login_date_first, count(*) as login_count_td, {ED} as dt
    from logins group by user_id"""
_oracle("a13_user_login_td", "logins", _LOGIN_TD)
_oracle("a13_user_login_td_first_day", "logins", _LOGIN_TD)
_oracle("a14_rolling", "views", "select mid_id, page_id, " + ", ".join(
    f"{_b(f'coalesce(sum(during_time) {f}, 0)')} as during_time_{n}d, count(*) {f} as view_count_{n}d"
    for n, f in ((n, f"filter (dt >= {_back(EVENT_DAY, n - 1)})") for n in (3, 7, 14, 30))
) + f", {ED} as dt from views group by mid_id, page_id")
_oracle("a14_moving_total", "views", f"""
    select mid_id, page_id, {_b('sum(during_time)')} as during_time_7d, count(*) as view_count_7d, {ED} as dt
    from views where dt >= {_back(EVENT_DAY, 6)} and dt <= {ED} group by 1, 2""")
_oracle("a15_to_date", "ev", f"""
    select usr as user_id, min(day) as first_day, max(day) as last_day, count(*) as cart_add_count_1d,
        {_b('sum(k)')} as cart_add_num_1d
    from ev where event_type = 'click' group by 1""")

# Reports


def _days(day: str, windows: tuple[int, ...] = (1, 7, 30)) -> str:
    rows = ", ".join(f"({n}, {_back(day, n - 1)})" for n in windows)
    return f"(select cast(n as bigint) as recent_days, first from (values {rows}) w(n, first))"


def _traffic(windows: str) -> str:
    return f"""
        select {ED} as dt, recent_days, channel, count(distinct mid_id) as uv_count,
            {_b('sum(stay) // (1000 * count(*))')} as avg_duration_sec,
            {_b('sum(pages) // count(*)')} as avg_page_count, count(distinct session_id) as sv_count,
            {_m('(200 * count(*) filter (pages = 1) + count(distinct session_id)) // (2 * count(distinct session_id)) * cast(0.01 as decimal(3,2))')}
            as bounce_rate
        from sessions join {windows} on dt >= first group by recent_days, channel"""


_oracle("t1_first_of_key_stream", "ev", """
    select day, event_type, count(*) as n from ev group by 1, 2
    union all
    select 'late', 'late', count(*) from ev where ms < (select min(ms) from ev) + 3600000""")
_oracle("t2_channel_traffic_stream", "sessions", f"""
    select dt, channel, count(distinct mid_id) as uv_count, {_b('sum(stay) // (1000 * count(*))')} as avg_duration_sec,
        {_b('sum(pages) // count(*)')} as avg_page_count, count(distinct session_id) as sv_count,
        {_m('(200 * count(*) filter (pages = 1) + count(distinct session_id)) // (2 * count(distinct session_id)) * cast(0.01 as decimal(3,2))')}
        as bounce_rate
    from sessions
    where epoch_ms(cast(dt as timestamp)) + 86400000 <= (select max(epoch_us(ts) // 1000) from events) - 3600000
    group by dt, channel""")
_oracle("p1_traffic_by_channel", "sessions", _traffic(_days(EVENT_DAY)))
_oracle("p21_weekly_traffic", "sessions", _traffic(_days(EVENT_DAY, (7,))))
_oracle("p22_monthly_traffic", "sessions", _traffic(
    f"(select cast(30 as bigint) as recent_days, '{EVENT_DAY[:8]}01' as first)"
))
_oracle("p1_distinct_from_sketches", "sessions", f"""
    select dt, recent_days, channel, uv_count, sv_count, true as uv_close, true as sv_close
    from ({_traffic(_days(EVENT_DAY))})""")
_PATH = """
    select dt, source, target, count(*) as path_count
    from (
        select dt, 'step-' || rn || ':' || page_id as source, 'step-' || (rn + 1) || ':' || next as target
        from (
            select dt, page_id, lead(page_id, 1, 'out') over w as next, row_number() over w as rn
            from views window w as (partition by dt, session_id order by view_time, ts, page_id)
        )
    )"""
_oracle("p2_page_path", "views", f"{_PATH} where dt = {ED} group by 1, 2, 3")
_oracle("p2_page_path_all_days", "views", f"{_PATH} group by 1, 2, 3")
_oracle("p3_user_change", "logins", f"""
    select {ED} as dt, count(*) filter (last_day = {_back(EVENT_DAY, 7)}) as user_churn_count,
        count(*) filter (last_day = {ED} and before <= {_back(EVENT_DAY, 8)}) as user_back_count
    from (select user_id, max(dt) as last_day, max(dt) filter (dt < {ED}) as before from logins group by 1)""")
_oracle("p4_user_retention", "logins", f"""
    select {ED} as dt, first_day as create_date, cast(date '{EVENT_DAY}' - cast(first_day as date) as int) as retention_day,
        kept as retention_count, n as new_user_count,
        {_m('(20000 * kept + n) // (2 * n) * cast(0.01 as decimal(3,2))')} as retention_rate
    from (
        select first_day, count(*) as n, count(*) filter (last_day = {ED}) as kept
        from (select user_id, min(dt) as first_day, max(dt) as last_day from logins group by 1)
        where first_day >= {_back(EVENT_DAY, 7)} and first_day < {ED} group by 1
    )""")
_oracle("p5_user_stats", "logins", f"""
    select {ED} as dt, recent_days, count(*) filter (first_day >= first) as new_user_count,
        count(*) filter (last_day >= first) as active_user_count
    from (select user_id, min(dt) as first_day, max(dt) as last_day from logins group by 1), {_days(EVENT_DAY)}
    where last_day >= {_back(EVENT_DAY, 29)} group by recent_days""")
_oracle("p6_user_action", "ev", f"""
    select {ED} as dt, count(distinct usr) filter (page_id = 'home') as home_count,
        count(distinct usr) filter (page_id = 'good_detail') as good_detail_count,
        count(distinct usr) filter (event_type = 'click') as cart_count,
        count(distinct usr) filter (event_type = 'purchase') as order_count,
        count(distinct usr) filter (event_type = 'purchase' and {_m('value')} >= 20) as payment_count
    from ev where day = {ED}""")
_FIRST_ORDERS = f"""
    select {OD} as dt, recent_days, count(*) filter (first_day >= first) as new_order_user_count
    from (select user_id, min(dt) as first_day from detail where dt <= {OD} group by 1), {_days(ORDER_DAY)}
    group by recent_days"""
_oracle("p7_new_order_user_stats", "detail", _FIRST_ORDERS)
_oracle("p20_new_order_user_direct", "detail", _FIRST_ORDERS)
_oracle("p8_order_continuously_user_count", "ev", f"""
    select {ED} as dt, cast(7 as bigint) as recent_days, count(distinct user_id) as order_continuously_user_count
    from (
        select user_id, day, lead(day, 2) over (partition by user_id order by day desc) as third
        from (select distinct user_id, day from ev
              where event_type = 'purchase' and day >= {_back(EVENT_DAY, 6)})
    ) where cast(day as date) - cast(third as date) = 2""")
_oracle("p8_order_continuously_user_count_span_90", "ev", f"""
    select {ED} as dt, cast(90 as bigint) as recent_days, count(distinct user_id) as order_continuously_user_count
    from (
        select user_id, day, lead(day, 3) over (partition by user_id order by day desc) as fourth
        from (select distinct user_id, day from ev
              where event_type = 'purchase' and day >= {_back(EVENT_DAY, 89)})
    ) where cast(day as date) - cast(fourth as date) = 3""")
_oracle("p9_repeat_purchase_by_tm", "detail sku", f"""
    select {OD} as dt, cast(30 as bigint) as recent_days, tm_id, tm_name,
        {_m('(200 * count(*) filter (n >= 2) + count(*)) // (2 * count(*)) * cast(0.01 as decimal(3,2))')}
        as order_repeat_rate
    from (select user_id, tm_id, tm_name, count(*) as n from detail left join sku on sku_id = sku.id {_IN_MONTH}
          group by 1, 2, 3)
    group by tm_id, tm_name""")


def _order_stats(group: str, orders: str, users: str) -> str:
    """Groups with an order in the month get a 7 and a 30 day row; the one-day row needs an order that day."""
    return f"""
        select {OD} as dt, recent_days, {group}, {orders} as order_count, {users} as order_user_count
        from (select * from detail left join sku on sku_id = sku.id {_IN_MONTH}), {_days(ORDER_DAY)}
        group by recent_days, {group} having recent_days > 1 or count(*) filter (dt >= first) > 0"""


_BRAND = "tm_id, tm_name"
_CATEGORY = "category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"
_LINES = "count(*) filter (dt >= first)"
_BUYERS = "count(distinct user_id) filter (dt >= first)"
_oracle("p10_order_stats_by_tm", "detail sku", _order_stats(_BRAND, _LINES, _BUYERS))
_oracle("p11_order_stats_by_cate", "detail sku", _order_stats(_CATEGORY, _LINES, _BUYERS))
_oracle("p18_order_stats_by_tm_nd", "detail sku", _order_stats(_BRAND, _LINES, _BUYERS))
_oracle("p19_order_stats_by_cate_nd", "detail sku", _order_stats(
    _CATEGORY, _LINES, "case when recent_days = 1 then " + _BUYERS + " else count(distinct user_id) end"
))
_oracle("p12_order_by_province", "detail province", f"""
    select {OD} as dt, recent_days, province_id, province_name, area_code, iso_code, iso_3166_2 as iso_code_3166_2,
        count(distinct order_id) filter (dt >= first) as order_count,
        {_m('coalesce(sum(total) filter (dt >= first), 0)')} as order_total_amount
    from (select * from detail left join province on province_id = province.id {_IN_MONTH}), {_days(ORDER_DAY)}
    group by recent_days, province_id, {_PROVINCE_NAMES}
    having recent_days > 1 or count(*) filter (dt >= first) > 0""")
_oracle("p13_coupon_stats", "", f"""
    select {OD} as dt, coupon_id, coupon_name, {_b('sum(used_count_1d)')} as used_count,
        count(user_id) as used_user_count
    from ({_COUPON_USED}) where dt = {OD} group by coupon_id, coupon_name""")
_oracle("p14_cart_num_top3_by_cate", "sku", f"""
    select {OD} as dt, {_CATEGORY}, sku_id, sku_name, cart_num, rk
    from (
        select *, rank() over (partition by category3_id order by cart_num desc) as rk
        from (
            select {_v('l_partkey')} as sku_id, {_b('sum(cast(l_quantity as bigint))')} as cart_num
            from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'O' group by 1
        ) left join sku on sku_id = id
    ) where rk <= 3""")
_oracle("p15_favor_count_top3_by_tm", "ev sku", f"""
    select dt, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d as favor_count, rk
    from (select *, rank() over (partition by tm_id order by favor_add_count_1d desc) as rk
          from ({_FAVORS}) where dt = {ED})
    where rk <= 3""")
_oracle("p16_order_to_pay_interval_avg", "", f"""
    select {OD} as dt, {_b('sum(wait) // count(*)')} as order_to_pay_interval_avg
    from (select o_orderkey % 172800 as wait from orders
          where o_orderstatus in ('F', 'P') and {_DAY.format(_PAID_AT)} = {OD})""")
_oracle("p17_order_stats_by_tm_direct", "detail sku", f"""
    select {OD} as dt, recent_days, tm_id, tm_name, count(distinct order_id) as order_count,
        count(distinct user_id) as order_user_count
    from detail left join sku on sku_id = sku.id, {_days(ORDER_DAY)}
    where dt >= first and dt <= {OD} group by recent_days, tm_id, tm_name""")
