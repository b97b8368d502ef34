"""Every query by name: (spark, directory of the retail tables) -> DataFrame.

All run over whole tables. Filters appear only where filtering is the operator.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom import schemas
from clickloom.functions import numbers, text, times
from clickloom.functions.once import once
from clickloom.operators import applog, categories, patterns, rollups, sampling, sessions, traffic
from clickloom.session import shared_dir
from clickloom.sources import lines, retail, tables
from clickloom.sources.layout import ActionTable
from clickloom.sources.tasks import TaskParams, param_columns
from clickloom.streaming import logins as stream_logins, orders as stream_orders, run, traffic as stream_traffic

Query = Callable[[SparkSession, str], DataFrame]

TASK_ID = 1
SAMPLE_TOTAL, SAMPLE_SEED = 3000, 42
ACTION_BUCKETS = 16

# The tables are sparse: at two seconds or fifteen minutes no pattern would occur.
PATTERN_LIMIT = 6 * 3600 * patterns.SECOND

CITY_FILTER = TaskParams(cities=("NATION_3", "NATION_8", "NATION_21"), category_ids=("3", "11", "47"))

FILTER = TaskParams(
    start_date="2024-01-03",
    end_date="2024-01-27",
    start_age=5,
    end_age=50,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    sex="male",
    keywords=("kw1", "kw3", "kw5", "kw7"),
)


def _at_utc(spark: SparkSession) -> SparkSession:
    """The session, or one beside it if its time zone is another: the queries read times at
    UTC and leave the settings of the caller alone."""
    if spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return spark
    beside = spark.newSession()
    beside.conf.set("spark.sql.session.timeZone", "UTC")
    return beside


def _events(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return retail.events(_at_utc(spark), sf_dir, start, end)


def _actions(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams()) -> DataFrame:
    actions = retail.actions(_events(spark, sf_dir, params.start_date, params.end_date))
    return tables.actions_between(actions, params.start_date, params.end_date)


def _full(spark: SparkSession, sf_dir: str, params: TaskParams = TaskParams(), lists: bool = False) -> DataFrame:
    return sessions.select_sessions(_actions(spark, sf_dir, params), retail.users(spark, sf_dir), params, lists)


def _timed(df: DataFrame) -> DataFrame:
    """Session times as text, the way results show them."""
    return df.withColumns({c: times.time_text(F.col(c)) for c in ("start_time", "end_time") if c in df.columns})


# Sources, parsing, functions


def actions_by_date(spark, sf_dir):
    actions = _actions(spark, sf_dir, TaskParams(start_date=FILTER.start_date, end_date=FILTER.end_date))
    return actions.withColumn("action_time", times.time_text(F.col("action_time")))


def user_info(spark, sf_dir):
    return retail.users(spark, sf_dir)


def session_city_category_filter(spark, sf_dir):
    """Sessions by city and clicked category, the filters that `session_filter` leaves out."""
    return _timed(_full(spark, sf_dir, CITY_FILTER))


def session_unknown_users(spark, sf_dir):
    """Sessions whose user has no attributes are in no report: here the users who never ordered
    are unknown."""
    ordered = _at_utc(spark).read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("user_id"))
    known = retail.users(_at_utc(spark), sf_dir).join(ordered, "user_id", "left_semi")
    return _timed(sessions.select_sessions(_actions(spark, sf_dir), known, TaskParams()))


def url_traffic_top1(spark, sf_dir):
    """The busiest of ten coarser urls in every window: nearly every window has more."""
    requests = retail.requests(_events(spark, sf_dir)).where("method = 'GET'")
    coarse = requests.withColumn("url", F.concat(F.lit("/g/"), F.substring("url", -1, 1)))
    counts = traffic.sliding_counts(coarse, "url", 3_600_000, 600_000)
    return traffic.rank_windows(counts, "url", 1)


def format_doubles(spark, sf_dir):
    """Half-up rounding of doubles: sixteenths, with exact ties, and thousandths beside the ties."""
    e = _events(spark, sf_dir)
    sixteenth = F.col("k") / 8 - F.col("user_id") / 16
    thousandth = (F.col("k") * 10 + 4 + 2 * F.pmod("event_id", F.lit(2))) / 1000
    return e.select(
        "event_id",
        numbers.format_double(sixteenth, 2).alias("sixteenth"),
        numbers.format_double(thousandth, 2).alias("thousandth"),
    )


def product_info(spark, sf_dir):
    return retail.products(spark, sf_dir)


def task_params(spark, sf_dir):
    return param_columns(retail.tasks(spark, sf_dir))


def behavior_parse(spark, sf_dir):
    return lines.behaviors(retail.behavior_lines(_events(spark, sf_dir))).drop("ts")


def behavior_bad_lines(spark, sf_dir):
    return lines.bad_behaviors(retail.behavior_lines(_events(spark, sf_dir)))


def access_log_parse(spark, sf_dir):
    parsed = lines.requests(retail.request_lines(_events(spark, sf_dir)))
    return parsed.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "event_time")


def access_log_bad_lines(spark, sf_dir):
    return lines.bad_requests(retail.request_lines(_events(spark, sf_dir)))


def record_fields(spark, sf_dir):
    """Pack, read and update the legacy `k=v|k=v` records."""
    e = _events(spark, sf_dir)
    record = text.pack_fields(
        sessionid=F.col("event_id"),
        searchKeywords=F.when(F.col("event_type") == "view", F.concat(F.lit("kw"), "k")),
        stepLength=F.col("k"),
    )
    packed = e.select("event_id", record.alias("record"))
    return packed.select(
        "event_id",
        "record",
        text.get_field(F.col("record"), "searchKeywords").alias("keywords"),
        text.get_field(F.col("record"), "stepLength").cast("bigint").alias("step_length"),
        text.get_field(F.col("record"), "missing").alias("missing"),
        text.set_field(F.col("record"), "stepLength", F.lit("0")).alias("updated"),
    )


def text_functions(spark, sf_dir):
    e = _events(spark, sf_dir)
    keyword = F.when(F.col("event_type") == "view", F.col("k").cast("string")).when(F.col("event_type") == "click", "")
    listed = F.concat(F.lit(",,"), F.col("k"), F.lit(",7,,x,"), F.col("event_id"), F.lit(",,"))
    listed_once = e.select("*", once(listed).alias("listed"))
    listed = F.col("listed")
    return listed_once.select(
        "event_id",
        text.is_empty(keyword).alias("empty"),
        text.is_not_empty(keyword).alias("not_empty"),
        text.trim_comma(listed).alias("trimmed"),
        text.pad_two(F.col("k").cast("string")).alias("padded"),
        F.size(text.tokens(listed)).alias("token_count"),
        F.array_join(text.id_list(listed).cast("array<string>"), "-").alias("ids"),
        F.col("event_type").contains("i").alias("has_i"),
    )


def time_functions(spark, sf_dir):
    e = _events(spark, sf_dir)
    unpadded = F.date_format("ts", "yyyy-MM-dd H:mm:ss")
    parsed = times.parse_time(unpadded)
    midnight = F.date_trunc("day", "ts")
    return e.select(
        "event_id",
        times.time_text(parsed).alias("time_text"),
        times.day_text(parsed).alias("day_text"),
        times.day_key(parsed).alias("day_key"),
        times.minute_text(parsed).alias("minute_text"),
        times.hour_key(parsed).alias("hour_key"),
        times.day_text(times.parse_day_key(times.day_key(parsed))).alias("day_back"),
        times.time_text(times.parse_time(F.col("event_type"))).alias("unparsed"),
        times.seconds_between(parsed, midnight).alias("seconds"),
        times.before(midnight, parsed).alias("before"),
        times.after(midnight, parsed).alias("after"),
        times.day_text(times.parse_access_time(F.date_format("ts", times.ACCESS_LOG_FORMAT))).alias("access_day"),
        F.unix_millis(times.from_epoch_seconds(F.unix_seconds("ts"))).alias("epoch_ms"),
        F.unix_seconds(times.from_epoch_millis(F.unix_millis("ts").cast("string"))).alias("epoch_s"),
    )


def ratio_values(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", numbers.ratio(F.col("k"), F.col("user_id") + 100).alias("ratio"))


# Sessions


def session_rollup(spark, sf_dir):
    return _timed(sessions.rollup(_actions(spark, sf_dir), lists=True))


def session_full(spark, sf_dir):
    return _timed(_full(spark, sf_dir, lists=True))


def session_filter(spark, sf_dir):
    return _timed(_full(spark, sf_dir, FILTER))


def session_length_counts(spark, sf_dir):
    return sessions.length_counts(_full(spark, sf_dir))


def session_aggr_stat(spark, sf_dir):
    return sessions.length_stats(_full(spark, sf_dir), TASK_ID)


def session_aggr_stat_filtered(spark, sf_dir):
    return sessions.length_stats(_full(spark, sf_dir, FILTER), TASK_ID)


def session_detail_filtered(spark, sf_dir):
    kept = sessions.actions_of(_actions(spark, sf_dir, FILTER), _full(spark, sf_dir, FILTER))
    return sessions.details(kept, TASK_ID, "filter")


# Sampling


def session_hour_counts(spark, sf_dir):
    return sampling.hour_counts(_full(spark, sf_dir))


def session_day_counts(spark, sf_dir):
    return sampling.day_counts(sampling.hour_counts(_full(spark, sf_dir)))


def session_quotas(spark, sf_dir):
    return sampling.quotas(sampling.hour_counts(_full(spark, sf_dir)), SAMPLE_TOTAL)


def _sample(spark, sf_dir):
    return sampling.sample_sessions(_full(spark, sf_dir), SAMPLE_TOTAL, SAMPLE_SEED)


def _sample_actions(spark, sf_dir):
    return sampling.sample_actions(_actions(spark, sf_dir), _sample(spark, sf_dir), SAMPLE_TOTAL)


def session_sample(spark, sf_dir):
    return _timed(_sample(spark, sf_dir))


def session_random_extract(spark, sf_dir):
    return sampling.sample_report(_sample_actions(spark, sf_dir), TASK_ID)


def session_sample_detail(spark, sf_dir):
    return sessions.details(_sample_actions(spark, sf_dir), TASK_ID, "sample")


# Categories


def category_touches(spark, sf_dir):
    return categories.touches(_actions(spark, sf_dir))


def touched_categories(spark, sf_dir):
    return categories.touched(_actions(spark, sf_dir))


def session_category_counts(spark, sf_dir):
    return categories.session_category_counts(_actions(spark, sf_dir))


def _category_counts(spark, sf_dir, params=TaskParams()):
    pairs = categories.session_category_counts(_actions(spark, sf_dir, params))
    return categories.category_counts(pairs, _full(spark, sf_dir, params))


def category_counts(spark, sf_dir):
    return _category_counts(spark, sf_dir)


def top10_category(spark, sf_dir):
    return categories.top_categories(_category_counts(spark, sf_dir)).select(
        F.lit(TASK_ID).cast("bigint").alias("task_id"), "*"
    )


def top10_category_filtered(spark, sf_dir):
    return categories.top_categories(_category_counts(spark, sf_dir, FILTER))


def category_session_clicks(spark, sf_dir):
    return categories.category_session_clicks(categories.session_category_counts(_actions(spark, sf_dir)))


def top10_session(spark, sf_dir):
    pairs = categories.session_category_counts(_actions(spark, sf_dir))
    chosen = _full(spark, sf_dir)
    top = categories.top_categories(categories.category_counts(pairs, chosen))
    return categories.top_sessions(categories.category_session_clicks(pairs), top, sessions=chosen)


def top10_session_detail(spark, sf_dir):
    kept = categories.top_session_actions(_actions(spark, sf_dir), top10_session(spark, sf_dir))
    return sessions.details(kept, TASK_ID, "top")


# Sliding windows


def hot_items_counts(spark, sf_dir):
    return traffic.hot_items(retail.behaviors(_events(spark, sf_dir)))


def hot_items_top3(spark, sf_dir):
    return traffic.rank_windows(hot_items_counts(spark, sf_dir), "item_id", traffic.ITEM_TOP)


def hot_items_report(spark, sf_dir):
    return traffic.report(hot_items_top3(spark, sf_dir), "item_id", traffic.ITEM_LABELS, traffic.ITEM_RULERS)


def url_traffic_counts(spark, sf_dir):
    return traffic.url_traffic(retail.requests(_events(spark, sf_dir)))


def url_traffic_top5(spark, sf_dir):
    return traffic.rank_windows(url_traffic_counts(spark, sf_dir), "url", traffic.URL_TOP)


def url_traffic_report(spark, sf_dir):
    return traffic.report(url_traffic_top5(spark, sf_dir), "url", traffic.URL_LABELS, traffic.URL_RULERS)


# Patterns


def login_burst(spark, sf_dir):
    return patterns.login_bursts(retail.logins(_events(spark, sf_dir)), PATTERN_LIMIT)


def login_strict_pair(spark, sf_dir):
    return patterns.login_pairs(retail.logins(_events(spark, sf_dir)), PATTERN_LIMIT)


def order_timeout(spark, sf_dir):
    return patterns.order_outcomes(retail.orders(_events(spark, sf_dir)), PATTERN_LIMIT)


# App logs


def _log_lines(spark, sf_dir):
    return retail.log_lines(_events(spark, sf_dir)).select("value")


def _log_events(spark, sf_dir):
    return applog.events(applog.parse(applog.clean(_log_lines(spark, sf_dir)), applog.EVENT_COMMON))


def app_log_clean(spark, sf_dir):
    return applog.clean(_log_lines(spark, sf_dir))


def app_log_typed(spark, sf_dir):
    return applog.with_log_type(applog.clean(_log_lines(spark, sf_dir)))


def app_log_typed_by_event(spark, sf_dir):
    return applog.with_log_type(applog.clean(_log_lines(spark, sf_dir)), by="event_name")


def app_log_common(spark, sf_dir):
    parsed = applog.parse(applog.clean(_log_lines(spark, sf_dir)))
    return parsed.withColumns({"log_time": F.unix_millis("log_time"), "et": F.size("et")}).withColumnRenamed(
        "et", "event_count"
    )


def _millis(df):
    return df.withColumns({c: F.unix_millis(c) for c in ("log_time", "event_time")})


def app_log_events(spark, sf_dir):
    return _millis(_log_events(spark, sf_dir))


def _event_table(name: str) -> Query:
    def query(spark, sf_dir):
        return _millis(applog.event_table(_log_events(spark, sf_dir), name))

    return query


# Streams: the events table read as a stream to its end, results from the stream's files.
# What the last event leaves open does not come out.


def _event_stream(spark, sf_dir):
    # A pattern that only this name fits: streams read a table of one file by a pattern only.
    # All files make one batch, so however many there are, no row comes behind the watermark.
    return retail.typed_events(run.table_rows(_at_utc(spark), f"{sf_dir}/events.parque[t]", retail.EVENTS_DDL))


def _folder(spark, name):
    return f"{shared_dir(spark)}/clickloom/{name}-{uuid4().hex}"


def _batched_stream(spark, stream, result_of, schema, name, split_by=None):
    folder = _folder(spark, name)
    run.finished(run.into_batches(stream, folder, result_of, split_by, available_now=True))
    return spark.read.schema(schema).parquet(f"{folder}/data").drop("batch_id")


def _filed_stream(spark, stream, name, split_by=None):
    folder = _folder(spark, name)
    run.finished(run.into_files(stream, folder, split_by, available_now=True))
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


def hot_items_top3_stream(spark, sf_dir):
    counts = stream_traffic.hot_items(retail.behaviors(_event_stream(spark, sf_dir)))
    ranked = partial(traffic.rank_windows, key="item_id", n=traffic.ITEM_TOP)
    schema = "window_end bigint, item_id bigint, count bigint, rank int"
    return _batched_stream(spark, counts, ranked, schema, "hot-items")


def url_traffic_top5_stream(spark, sf_dir):
    counts = stream_traffic.url_traffic(retail.requests(_event_stream(spark, sf_dir)))
    ranked = partial(traffic.rank_windows, key="url", n=traffic.URL_TOP)
    schema = "window_end bigint, url string, count bigint, rank int"
    return _batched_stream(spark, counts, ranked, schema, "url-traffic")


def login_burst_stream(spark, sf_dir):
    blocks = stream_logins.burst_blocks(retail.logins(_event_stream(spark, sf_dir)), PATTERN_LIMIT)
    bursts = partial(stream_logins.bursts_of, limit=PATTERN_LIMIT)
    schema = "user_id bigint, ip string, us bigint, seq bigint, failures bigint"
    return _batched_stream(spark, blocks, bursts, schema, "login-burst")


def login_strict_pair_stream(spark, sf_dir):
    blocks = stream_logins.pair_blocks(retail.logins(_event_stream(spark, sf_dir)), PATTERN_LIMIT)
    pairs = partial(stream_logins.pairs_of, limit=PATTERN_LIMIT)
    schema = "user_id bigint, first_ip string, second_ip string, us bigint, seq bigint"
    return _batched_stream(spark, blocks, pairs, schema, "login-pair")


def order_timeout_stream(spark, sf_dir):
    blocks = stream_orders.order_blocks(retail.orders(_event_stream(spark, sf_dir)), PATTERN_LIMIT)
    outcomes = partial(stream_orders.outcomes_of, limit=PATTERN_LIMIT)
    schema = "order_id bigint, us bigint, seq bigint, status string, pay_us bigint"
    return _batched_stream(spark, blocks, outcomes, schema, "order-outcome", split_by=["status"])


def app_log_routed_stream(spark, sf_dir):
    lines = retail.log_lines(_event_stream(spark, sf_dir)).select("value")
    return _filed_stream(spark, applog.with_log_type(applog.clean(lines)), "app-log", split_by=["log_type"])


def _line_stream(spark, sf_dir):
    """Access-log lines out of text files, as a stream; the files are made of the events."""
    folder = _folder(spark, "access-lines")
    retail.request_lines(_events(spark, sf_dir)).write.text(folder)
    return run.text_lines(_at_utc(spark), folder)


def access_lines_stream(spark, sf_dir):
    """Raw lines, good ones parsed and bad ones as they came, from one pass."""
    routed = _filed_stream(spark, lines.routed_requests(_line_stream(spark, sf_dir)), "access-log", split_by=["quality"])
    return routed.withColumn("ts", F.unix_millis("ts")).withColumnRenamed("ts", "event_time")


def url_traffic_lines_stream(spark, sf_dir):
    """Counts of windows straight from raw lines: the watermark follows the parsed times."""
    return _filed_stream(spark, stream_traffic.url_traffic(lines.requests(_line_stream(spark, sf_dir))), "url-lines")


def hot_items_ranked_stream(spark, sf_dir):
    """Counting and ranking in one stream, into files."""
    counts = stream_traffic.hot_items(retail.behaviors(_event_stream(spark, sf_dir)))
    return _filed_stream(spark, stream_traffic.ranked(counts, "item_id", traffic.ITEM_TOP), "hot-items-ranked")


def url_traffic_ranked_stream(spark, sf_dir):
    counts = stream_traffic.url_traffic(retail.requests(_event_stream(spark, sf_dir)))
    return _filed_stream(spark, stream_traffic.ranked(counts, "url", traffic.URL_TOP), "url-traffic-ranked")


# Tables made once and asked many times: partial results by day, and actions by date and session.


def _session_days(spark, sf_dir, params=TaskParams()):
    folder = _folder(spark, "session-days")
    rollups.save(rollups.session_days(_actions(spark, sf_dir)), folder)
    return rollups.load(_at_utc(spark), folder, rollups.SESSION_DAYS, params.start_date, params.end_date)


def session_rollup_days(spark, sf_dir):
    return _timed(rollups.merged_sessions(_session_days(spark, sf_dir), lists=True))


def session_filter_days(spark, sf_dir):
    """The filtered sessions of a range of dates, out of the days of all dates."""
    days = _session_days(spark, sf_dir, FILTER)
    return _timed(rollups.select_sessions(days, retail.users(_at_utc(spark), sf_dir), FILTER))


def hot_items_days(spark, sf_dir):
    folder, shape = _folder(spark, "item-days"), ("item_id", traffic.ITEM_WINDOW, traffic.ITEM_SLIDE)
    viewed = retail.behaviors(_events(spark, sf_dir)).where("behavior = 'pv'")
    rollups.save(rollups.pane_days(viewed, *shape), folder)
    days = rollups.load(_at_utc(spark), folder, "item_id bigint, pane bigint, n bigint, date string")
    return rollups.merged_windows(days, *shape)


def _action_table(spark, sf_dir):
    name = f"actions_{uuid4().hex}"
    return ActionTable(_at_utc(spark), name, _folder(spark, "actions"), ACTION_BUCKETS).save(_actions(spark, sf_dir))


def session_rollup_table(spark, sf_dir):
    return _timed(_action_table(spark, sf_dir).rollup(lists=True))


def session_detail_table(spark, sf_dir):
    table = _action_table(spark, sf_dir)
    chosen = table.select_sessions(retail.users(_at_utc(spark), sf_dir), FILTER)
    return sessions.details(table.actions_of(chosen, FILTER), TASK_ID, "filter")


TABLES = [session_rollup_days, session_filter_days, hot_items_days, session_rollup_table, session_detail_table]

STREAMS = [
    hot_items_top3_stream, url_traffic_top5_stream, login_burst_stream, login_strict_pair_stream,
    order_timeout_stream, app_log_routed_stream,
]

RANKED_STREAMS = [hot_items_ranked_stream, url_traffic_ranked_stream]

LINE_STREAMS = [access_lines_stream, url_traffic_lines_stream]

BATCH = [
    actions_by_date, user_info, product_info, task_params, behavior_parse, behavior_bad_lines,
    access_log_parse, access_log_bad_lines, record_fields, text_functions, time_functions, ratio_values,
    session_rollup, session_full, session_filter, session_length_counts, session_aggr_stat,
    session_aggr_stat_filtered, session_detail_filtered, session_hour_counts, session_day_counts,
    session_quotas, session_sample, session_random_extract, session_sample_detail, category_touches,
    touched_categories, session_category_counts, category_counts, top10_category, top10_category_filtered,
    category_session_clicks, top10_session, top10_session_detail, hot_items_counts, hot_items_top3,
    hot_items_report, url_traffic_counts, url_traffic_top5, url_traffic_report, login_burst,
    login_strict_pair, order_timeout, app_log_clean, app_log_typed, app_log_typed_by_event,
    app_log_common, app_log_events, session_city_category_filter, session_unknown_users, url_traffic_top1,
    format_doubles,
]


def queries() -> dict[str, Query]:
    named = {q.__name__: q for q in BATCH}
    named |= {f"app_log_event_{name}": _event_table(name) for name in schemas.EVENT_FIELDS}
    return named | {q.__name__: q for q in STREAMS + LINE_STREAMS + RANKED_STREAMS + TABLES}
