"""The catalogue's queries as SQL over the same tables, to check results against."""

from __future__ import annotations

from types import SimpleNamespace

from clickloom.sources import retail

# What is asked for and what is expected, written out here and not taken from the code that
# these queries check. Only the sample log lines, which are input, come from there.
TASK_ID, SAMPLE_TOTAL, SAMPLE_SEED = 1, 3000, 42
PATTERN_LIMIT = 21_600_000_000

FILTER = SimpleNamespace(
    start_date="2024-01-03", end_date="2024-01-27", start_age=5, end_age=50, sex="male",
    professionals=["BUILDING", "MACHINERY", "HOUSEHOLD"], keywords=["kw1", "kw3", "kw5", "kw7"],
)

VISIT_BUCKETS = {
    "visit_length_1s_3s": (1, 3), "visit_length_4s_6s": (4, 6), "visit_length_7s_9s": (7, 9),
    "visit_length_10s_30s": (10, 30), "visit_length_30s_60s": (31, 60), "visit_length_1m_3m": (61, 180),
    "visit_length_3m_10m": (181, 600), "visit_length_10m_30m": (601, 1800), "visit_length_30m": (1801, None),
}
STEP_BUCKETS = {
    "step_length_1_3": (1, 3), "step_length_4_6": (4, 6), "step_length_7_9": (7, 9),
    "step_length_10_30": (10, 30), "step_length_30_60": (31, 60), "step_length_60": (61, None),
}

COMMON_FIELDS = "mid uid vc vn l sr os ar md ba sv g hw t nw ln la".split()
# Fields of an event; numbers are marked, the others are text.
EVENT_FIELDS = {
    "start": "entry open_ad_type action loading_time detail extend1",
    "display": "action newsid place extend1 category",
    "newsdetail": "entry action newsid showtype news_staytime loading_time type1 category",
    "loading": "action loading_time loading_way extend1 extend2 type type1",
    "ad": "entry action content detail source behavior newstype show_style",
    "notification": "action type ap_time content",
    "active_foreground": "push_id access",
    "active_background": "active_source",
    "error": "errorBrief errorDetail",
    "comment": "userid# comment_id# p_comment_id# content addtime other_id# praise_count# reply_count#",
    "favorites": "id# course_id# userid# add_time",
    "praise": "id# userid# target_id# type# add_time",
}

EVENTS = """ev as (select event_id, ts, user_id, event_type, epoch_us(ts) // 1000 as ms, epoch_us(ts) as us,
    cast(regexp_extract(props, '"k": *([0-9]+)', 1) as bigint) as k from events)"""

ACTIONS = f"""{EVENTS}, act as (select strftime(ts, '%Y-%m-%d') as date, user_id,
    cast(user_id as varchar) || '_' || strftime(ts, '%Y-%m-%d') as session_id, k % 10 as page_id,
    date_trunc('second', ts) as t, strftime(ts, '%Y-%m-%d %H:%M:%S') as action_time,
    case when event_type = 'view' then 'kw' || (k % 10) end as search_keyword,
    case when event_type = 'click' then k end as click_category_id,
    case when event_type = 'click' then event_id % 100 end as click_product_id,
    case when event_type = 'signup' then k || ',' || ((k + 1) % 100) end as order_category_ids,
    case when event_type = 'signup' then cast(event_id % 100 as varchar) end as order_product_ids,
    case when event_type = 'purchase' then cast(k as varchar) end as pay_category_ids,
    case when event_type = 'purchase' then cast(event_id % 100 as varchar) end as pay_product_ids,
    k % 10 as city_id from ev)"""

USERS = """usr as (select c_custkey as user_id, 'user' || c_custkey as username, c_name as name,
    cast(c_custkey % 60 as integer) as age, c_mktsegment as professional, n_name as city,
    case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
    from customer join nation on c_nationkey = n_nationkey)"""

ROLLUP = """ses as (select session_id, min(user_id) as user_id, min(t) as t0, max(t) as t1,
    strftime(min(t), '%Y-%m-%d %H:%M:%S') as start_time, strftime(max(t), '%Y-%m-%d %H:%M:%S') as end_time,
    count(*) as step_length, epoch_us(max(t)) // 1000000 - epoch_us(min(t)) // 1000000 as visit_length,
    coalesce(array_to_string(list_sort(list(distinct search_keyword)
      filter (search_keyword is not null)), ','), '') as kws,
    coalesce(array_to_string(list_sort(list(distinct click_category_id)
      filter (click_category_id is not null)), ','), '') as cats,
    {hit} as hit from {source} group by session_id)"""

FULL = "full_ses as (select s.*, u.age, u.professional, u.city, u.sex from ses s join usr u using (user_id))"

DETAIL = """user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
    order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"""

SESSION = "session_id, user_id, start_time, end_time, step_length, visit_length"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


BASE = f"with {ACTIONS}, {USERS}, {ROLLUP.format(hit='true', source='act')}, {FULL}"

FILTERED = f"""with {ACTIONS}, {USERS},
    ranged as (select * from act where date between '{FILTER.start_date}' and '{FILTER.end_date}'),
    {ROLLUP.format(hit=f"bool_or(coalesce(search_keyword in ({_quoted(FILTER.keywords)}), false))", source="ranged")},
    {FULL}, kept as (select * from full_ses where hit and age between {FILTER.start_age} and {FILTER.end_age}
    and professional in ({_quoted(FILTER.professionals)}) and sex = '{FILTER.sex}')"""

HOURS = """slot as (select session_id, t0, start_time, strftime(t0, '%Y-%m-%d') as date,
    strftime(t0, '%H') as hour from full_ses),
    hours as (select date, hour, count(*) as session_count from slot group by all)"""

QUOTAS = f"""{HOURS}, quo as (select date, hour, least(session_count, cast(trunc(
    cast(session_count as double) / cast(sum(session_count) over (partition by date) as double)
    * ({SAMPLE_TOTAL} // (select count(distinct date) from hours))) as bigint)) as quota from hours)"""

SAMPLE = f"""{QUOTAS}, sam as (select session_id, start_time, date, hour, position from (
    select s.*, q.quota, cast(row_number() over (partition by s.date, s.hour
    order by md5(session_id || '{SAMPLE_SEED}'), session_id) as integer) as position
    from slot s join quo q on s.date = q.date and s.hour = q.hour) where position <= quota)"""

TOUCHES = """tou as (select session_id, 'click' as kind, click_category_id as category_id from act
      where click_category_id is not null
    union all select session_id, 'order', cast(unnest(string_split(order_category_ids, ',')) as bigint) from act
    union all select session_id, 'pay', cast(unnest(string_split(pay_category_ids, ',')) as bigint) from act)"""

COUNTS = """count(*) filter (kind = 'click') as click_count, count(*) filter (kind = 'order') as order_count,
    count(*) filter (kind = 'pay') as pay_count"""

CATEGORY_COUNTS = (
    f"cnt as (select category_id, {COUNTS} from tou where session_id in (select session_id from {{chosen}}) group by 1)"
)

TOP_CATEGORIES = """top as (select * from cnt
    order by click_count desc, order_count desc, pay_count desc, category_id limit 10)"""

TOP_SESSIONS = """tops as (select * from (select category_id, session_id, click_count, cast(row_number() over (
    partition by category_id order by click_count desc, session_id) as integer) as rank from (
    select category_id, session_id, count(*) as click_count from tou where kind = 'click'
    and category_id in (select category_id from top) and session_id in (select session_id from full_ses)
    group by 1, 2)) where rank <= 10)"""

TOP = f"{BASE}, {TOUCHES}, {CATEGORY_COUNTS.format(chosen='full_ses')}, {TOP_CATEGORIES}"


def _bucket(col: str, borders) -> str:
    low, high = borders
    return f"{col} >= {low}" if high is None else f"{col} between {low} and {high}"


BUCKETS = [(n, _bucket("visit_length", b)) for n, b in VISIT_BUCKETS.items()] + [
    (n, _bucket("step_length", b)) for n, b in STEP_BUCKETS.items()
]


def _length_counts(source: str) -> str:
    counts = ", ".join(f"count(*) filter ({cond}) as {name}" for name, cond in BUCKETS)
    return f"select count(*) as session_count, {counts} from {source}"


def _length_stats(source: str) -> str:
    ratios = ", ".join(
        f"((200 * {name} + session_count) // nullif(2 * session_count, 0)) / 100.0::double as {name}_ratio"
        for name, _ in BUCKETS
    )
    return f"select cast({TASK_ID} as bigint) as task_id, session_count, {ratios} from ({_length_counts(source)})"


def _sliding(key: str, source: str, length: int, slide: int) -> str:
    return f"""win as (select {key}, (ms // {slide}) * {slide} - i * {slide} + {length} as window_end
      from ({source}), range({length // slide}) as r(i)),
    num as (select {key}, window_end, count(*) as count from win group by 1, 2),
    rnk as (select * from (select *, cast(row_number() over (
      partition by window_end order by count desc, {key}) as integer) as rank from num) where rank <= {{n}})"""


ITEMS = f"with {EVENTS}, " + _sliding(
    "item_id",
    "select k as item_id, ms from ev where event_type = 'view'",
    3_600_000,
    300_000,
).format(n=3)

URLS = f"with {EVENTS}, " + _sliding(
    "url",
    "select '/p/' || k as url, ms from ev where event_type in ('view', 'click')",
    60_000,
    5_000,
).format(n=5)

COARSE_URLS = f"with {EVENTS}, " + _sliding(
    "url",
    "select '/g/' || (k % 10) as url, ms from ev where event_type in ('view', 'click')",
    3_600_000,
    600_000,
).format(n=1)


def _report(base: str, key: str, labels, rulers) -> str:
    return f"""{base} select window_end, '{rulers[0]}' || chr(10) || '时间: '
      || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
      || string_agg('No' || rank || ':{labels[0]}' || {key} || '{labels[1]}' || count, chr(10) order by rank)
      || chr(10) || '{rulers[1]}' || chr(10) || chr(10) as report from rnk group by window_end"""


def _closed(us: str, blocks_per_limit: int, blocks: int) -> str:
    """When the block that a time is in closes: so many blocks after it starts."""
    width = PATTERN_LIMIT // blocks_per_limit
    return f"({us} // {width} + {blocks}) * {width}"


IP = "'10.0.' || (user_id % 256) || '.' || (event_id % 256)"
METHOD = "case when event_type in ('view', 'click') then 'GET' else 'POST' end"
BEHAVIOR = """case event_type when 'view' then 'pv' when 'click' then 'cart' when 'purchase' then 'buy'
    when 'signup' then 'fav' when 'error' then 'err' end"""

LOGINS = f"""log as (select user_id, {IP} as ip, case event_type when 'error' then 'fail' else 'success' end as kind,
    us, event_id as seq from ev where event_type in ('error', 'signup'))"""

BURST = f"""with {EVENTS}, {LOGINS}, anc as (select *, min(us) over (partition by user_id order by us
    range between {PATTERN_LIMIT} preceding and current row) as anchor from log where kind = 'fail')
    select user_id, arg_min(ip, (us, seq)) as ip, min(us) as us, arg_min(seq, (us, seq)) as seq,
    count(*) as failures from anc group by user_id, anchor having count(*) > 1"""

PAIR = f"""with {EVENTS}, {LOGINS}, prv as (select *, lag(kind) over w as kind0, lag(us) over w as us0,
    lag(ip) over w as ip0 from log window w as (partition by user_id order by us, seq))
    select user_id, ip0 as first_ip, ip as second_ip, us, seq from prv
    where kind = 'fail' and kind0 = 'fail' and us - us0 < {PATTERN_LIMIT}"""

ORDERS = f"""with {EVENTS}, ord as (select user_id as order_id, us, event_id as seq, event_type from ev
    where event_type in ('click', 'purchase')), nxt as (select *, min(case when event_type = 'purchase' then us end)
    over (partition by order_id order by us, seq rows between 1 following and unbounded following) as pay from ord)
    select order_id, us, seq, case when pay - us < {PATTERN_LIMIT} then 'success' else 'timeout' end as status,
    case when pay - us < {PATTERN_LIMIT} then pay end as pay_us from nxt where event_type = 'click'"""

# The validity rule step by step, not as the one pattern the Spark side uses.
LOG = f"""with {EVENTS}, raw as (select *, {retail.log_line_sql('ms', 'k', **retail.log_part_sql('ms', 'k'))} as value from ev),
    cut as (select *, string_split(value, '|') as p from raw),
    ok as (select * from cut where len(p) >= 2 and length(p[1]) = 13 and regexp_full_match(p[1], '[0-9]+')
      and starts_with(trim(p[2], chr(9) || ' '), '{{') and ends_with(trim(p[2], chr(9) || ' '), '}}')),
    one as (select *, 0 as position, ms as event_time, event_id % 12 as en from ok
      union all select *, 1, ms + 1000, (event_id + 5) % 12 from ok where event_id % 2 = 0),
    nam as (select *, list_extract([{_quoted(EVENT_FIELDS)}], cast(en + 1 as integer)) as event_name from one)"""


def _common_field(i: int, name: str) -> str:
    value = "cast(user_id as varchar)" if name in ("uid", "mid") else f"'{name}' || (k % {i + 2})"
    return f'{value} as "{name}"'


def _fields(name: str) -> list[tuple[str, bool]]:
    """(field, whether it is a number) of an event."""
    return [(f.rstrip("#"), f.endswith("#")) for f in EVENT_FIELDS[name].split()]


def _event_table(name: str) -> str:
    fields = ", ".join(
        f'cast(k + {i} as {"integer" if number else "varchar"}) as "{field}"'
        for i, (field, number) in enumerate(_fields(name))
    )
    return f"""{LOG} select ms as log_time, cast(user_id as varchar) as uid, position, event_time, {fields}
      from nam where event_name = '{name}'"""


def _kv_text(name: str) -> str:
    parts = []
    for i, (field, number) in enumerate(_fields(name)):
        quote = "" if number else '"'
        parts.append(f"""'"{field}":{quote}' || (k + {i}) || '{quote}'""")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


KV = "case event_name " + " ".join(f"when '{n}' then {_kv_text(n)}" for n in EVENT_FIELDS) + " end"


def oracle_sql() -> dict[str, str]:
    record = "'sessionid=' || event_id || '|searchKeywords=' || coalesce(kw, '') || '|stepLength='"
    sql = {
        "actions_by_date": f"""with {ACTIONS} select * exclude (t) from act
            where date between '{FILTER.start_date}' and '{FILTER.end_date}'""",
        "user_info": f"with {USERS} select * from usr",
        "product_info": """select p_partkey as product_id, p_name as product_name,
            '{"product_status": ' || (p_partkey % 2) || '}' as extend_info from part""",
        "task_params": """select c_custkey as task_id, '2024-01-05' as start_date, cast(null as varchar) as end_date,
            case when c_custkey % 3 <> 0 then cast(c_custkey % 60 as varchar) end as start_age,
            case when c_custkey % 3 <> 0 then cast(c_custkey % 60 + 9 as varchar) end as end_age,
            c_mktsegment || ',BUILDING' as professionals, cast(null as varchar) as cities,
            cast(null as varchar) as sex, cast(null as varchar) as keywords,
            cast(null as varchar) as category_ids from customer""",
        "behavior_parse": f"""with {EVENTS} select user_id, k as item_id, cast(k % 10 as integer) as category_id,
            {BEHAVIOR} as behavior, us // 1000000 as timestamp from ev where event_id % 97 <> 0""",
        "behavior_bad_lines": f"""with {EVENTS} select user_id || ',x,' || (k % 10) || ',' || {BEHAVIOR} || ','
            || (us // 1000000) as value from ev where event_id % 97 = 0""",
        "access_log_parse": f"""with {EVENTS} select {IP} as ip, cast(user_id as varchar) as user_id,
            us // 1000000 * 1000 as event_time, {METHOD} as method, '/p/' || k as url
            from ev where event_id % 89 <> 0""",
        "access_log_bad_lines": f"""with {EVENTS} select {IP} || ' ' || user_id || ' - - +0000 ' || {METHOD}
            || ' /p/' || k as value from ev where event_id % 89 = 0""",
        "record_fields": f"""with {EVENTS}, r as (select *, case when event_type = 'view' then 'kw' || k end as kw
            from ev) select event_id, {record} || k as record, kw as keywords, k as step_length,
            cast(null as varchar) as missing, {record} || '0' as updated from r""",
        "text_functions": f"""with {EVENTS} select event_id,
            not (event_type = 'view') as empty, event_type = 'view' as not_empty,
            ',' || k || ',7,,x,' || event_id || ',' as trimmed, lpad(cast(k as varchar), 2, '0') as padded,
            cast(7 as integer) as token_count, k || '-7-' || event_id as ids,
            event_type in ('view', 'click', 'signup') as has_i from ev""",
        "time_functions": f"""with {EVENTS} select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as time_text,
            strftime(ts, '%Y-%m-%d') as day_text, strftime(ts, '%Y%m%d') as day_key,
            strftime(ts, '%Y%m%d%H%M') as minute_text, strftime(ts, '%Y-%m-%d_%H') as hour_key,
            strftime(ts, '%Y-%m-%d') as day_back, cast(null as varchar) as unparsed,
            us // 1000000 - epoch_us(date_trunc('day', ts)) // 1000000 as seconds,
            date_trunc('day', ts) < date_trunc('second', ts) as before,
            date_trunc('day', ts) > date_trunc('second', ts) as after,
            strftime(ts, '%Y-%m-%d') as access_day, us // 1000000 * 1000 as epoch_ms, ms // 1000 as epoch_s from ev""",
        "ratio_values": f"""with {EVENTS} select event_id,
            ((200 * k + user_id + 100) // (2 * (user_id + 100))) / 100.0::double as ratio from ev""",
        "session_rollup": f"{BASE} select {SESSION}, kws as search_keywords, cats as click_category_ids from ses",
        "session_full": f"""{BASE} select {SESSION}, kws as search_keywords, cats as click_category_ids,
            age, professional, city, sex from full_ses""",
        "session_filter": f"{FILTERED} select {SESSION}, age, professional, city, sex from kept",
        "session_length_counts": f"{BASE} {_length_counts('full_ses')}",
        "session_aggr_stat": f"{BASE} {_length_stats('full_ses')}",
        "session_aggr_stat_filtered": f"{FILTERED} {_length_stats('kept')}",
        "session_detail_filtered": f"""{FILTERED} select cast({TASK_ID} as bigint) as task_id, 'filter' as source,
            {DETAIL} from ranged where session_id in (select session_id from kept)""",
        "session_hour_counts": f"{BASE}, {HOURS} select * from hours",
        "session_day_counts": f"""{BASE}, {HOURS} select date, cast(sum(session_count) as bigint) as session_count
            from hours group by date""",
        "session_quotas": f"{BASE}, {QUOTAS} select * from quo where quota > 0",
        "session_sample": f"{BASE}, {SAMPLE} select * from sam",
        "session_random_extract": f"""{BASE}, {SAMPLE} select cast({TASK_ID} as bigint) as task_id, session_id,
            start_time, kws as search_keywords, cats as click_category_ids
            from ses where session_id in (select session_id from sam)""",
        "session_sample_detail": f"""{BASE}, {SAMPLE} select cast({TASK_ID} as bigint) as task_id,
            'sample' as source, {DETAIL} from act where session_id in (select session_id from sam)""",
        "category_touches": f"with {ACTIONS}, {TOUCHES} select * from tou",
        "touched_categories": f"with {ACTIONS}, {TOUCHES} select distinct category_id from tou",
        "session_category_counts": f"""with {ACTIONS}, {TOUCHES} select session_id, category_id, {COUNTS}
            from tou group by 1, 2""",
        "category_counts": f"{BASE}, {TOUCHES}, {CATEGORY_COUNTS.format(chosen='full_ses')} select * from cnt",
        "top10_category": f"{TOP} select cast({TASK_ID} as bigint) as task_id, * from top",
        "top10_category_filtered": f"""{FILTERED}, {TOUCHES.replace("from act", "from ranged")},
            {CATEGORY_COUNTS.format(chosen="kept")}, {TOP_CATEGORIES} select * from top""",
        "category_session_clicks": f"""with {ACTIONS} select click_category_id as category_id, session_id,
            count(*) as click_count from act where click_category_id is not null group by 1, 2""",
        "top10_session": f"{TOP}, {TOP_SESSIONS} select * from tops",
        "top10_session_detail": f"""{TOP}, {TOP_SESSIONS} select cast({TASK_ID} as bigint) as task_id,
            'top' as source, {DETAIL} from act where session_id in (select session_id from tops)""",
        "hot_items_counts": f"{ITEMS} select * from num",
        "hot_items_top3": f"{ITEMS} select * from rnk",
        "hot_items_report": _report(ITEMS, "item_id", (" 商品ID=", " 浏览量="), ("=" * 40, "=" * 29)),
        "url_traffic_counts": f"{URLS} select * from num",
        "url_traffic_top5": f"{URLS} select * from rnk",
        "url_traffic_report": _report(URLS, "url", ("  URL=", "  流量="), ("=" * 36, "=" * 36)),
        "login_burst": BURST,
        "login_strict_pair": PAIR,
        "order_timeout": ORDERS,
        "app_log_clean": f"{LOG} select value from ok",
        "app_log_typed": f"""{LOG} select value, case when contains(value, 'start') then 'start' else 'event' end
            as log_type from ok""",
        "app_log_typed_by_event": f"""{LOG} select value, case when event_id in (
            select event_id from nam where event_name = 'start') then 'start' else 'event' end as log_type from ok""",
        "app_log_common": f"""{LOG} select ms as log_time, 'shop' as ap,
            {", ".join(_common_field(i, f) for i, f in enumerate(COMMON_FIELDS))},
            cast(case when event_id % 2 = 0 then 2 else 1 end as integer) as event_count from ok""",
        "app_log_events": f"""{LOG} select ms as log_time, 'shop' as ap, cast(user_id as varchar) as mid,
            cast(user_id as varchar) as uid, position, event_time, event_name, {KV} as kv from nam""",
    }
    sql["session_city_category_filter"] = f"""with {ACTIONS}, {USERS},
        {ROLLUP.format(hit="bool_or(coalesce(click_category_id in (3, 11, 47), false))", source="act")}, {FULL}
        select {SESSION}, age, professional, city, sex from full_ses
        where hit and city in ('NATION_3', 'NATION_8', 'NATION_21')"""
    sql["session_unknown_users"] = f"""{BASE} select {SESSION}, age, professional, city, sex from full_ses
        where user_id in (select o_custkey from orders)"""
    sql["url_traffic_top1"] = f"{COARSE_URLS} select * from rnk"
    sql["format_doubles"] = f"""with {EVENTS}, q as (select event_id, k, 2 * k - user_id as n from ev)
        select event_id, sign(n) * ((abs(n) * 200 + 16) // 32) / 100.0::double as sixteenth,
        (k + event_id % 2) / 100.0::double as thousandth from q"""
    # Streams report what the watermark, the newest event less the allowed delay, has passed.
    # Every event that the stream carries moves it, counted or not.
    views = "(select max(ms) from ev)"
    gets = "(select max(ms) - 10000 from ev)"
    sql["hot_items_top3_stream"] = f"{ITEMS} select * from rnk where window_end <= {views}"
    sql["url_traffic_top5_stream"] = f"{URLS} select * from rnk where window_end <= {gets}"
    sql["login_burst_stream"] = f"""{BURST.replace("anchor having", f"anchor having {_closed('anchor', 1, 2)}"
        + " <= (select max(us // 1000) * 1000 from log) and")}"""
    sql["login_strict_pair_stream"] = f"""{PAIR} and {_closed("us", 1, 1)}
        <= (select max(us // 1000) * 1000 from log)"""
    sql["order_timeout_stream"] = f"""select o.* from ({ORDERS}) o, (select max(epoch_us(ts) // 1000) * 1000 as mark
        from events where event_type in ('click', 'purchase')) where {_closed("us", 3, 4)} <= mark"""
    sql["app_log_routed_stream"] = sql["app_log_typed"]
    sql["access_lines_stream"] = f"""with {EVENTS} select 'good' as quality, {IP} as ip,
        cast(user_id as varchar) as user_id, us // 1000000 * 1000 as event_time, {METHOD} as method,
        '/p/' || k as url, null::varchar as value from ev where event_id % 89 <> 0
        union all select 'bad', null, null, null, null, null, {IP} || ' ' || user_id || ' - - +0000 ' || {METHOD}
        || ' /p/' || k from ev where event_id % 89 = 0"""
    sql["url_traffic_lines_stream"] = f"""with {EVENTS}, req as (select us // 1000000 * 1000 as ms, '/p/' || k as url,
        {METHOD} as method from ev where event_id % 89 <> 0), win as (select url,
        unnest(range((ms // 5000 + 1) * 5000, ms + 60001, 5000)) as window_end from req where method = 'GET')
        select window_end, url, count(*) as count from win
        where window_end <= (select max(ms) - 10000 from req) group by window_end, url"""
    # The same rows from tables by day and by session, and from rankings inside the stream.
    for name, same in {
        "hot_items_ranked_stream": "hot_items_top3_stream",
        "url_traffic_ranked_stream": "url_traffic_top5_stream",
        "session_rollup_days": "session_rollup",
        "session_filter_days": "session_filter",
        "hot_items_days": "hot_items_counts",
        "session_rollup_table": "session_rollup",
        "session_detail_table": "session_detail_filtered",
    }.items():
        sql[name] = sql[same]
    sql |= {f"app_log_event_{name}": _event_table(name) for name in EVENT_FIELDS}
    return sql
