"""The analytics model over a retail star schema: events, customers, nations, parts.

Every mapping takes a DataFrame of events, so it serves batch and streams alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom import schemas
from clickloom.functions import times
from clickloom.functions.once import once

# The tables as stored. Stating them saves a look into a file for every read, and
# streams need it anyway.
EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
TABLES = {
    "events": EVENTS_DDL,
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
}

BEHAVIOR_OF = {"view": "pv", "click": "cart", "purchase": "buy", "signup": "fav", "error": "err"}
LOGIN_OF = {"error": "fail", "signup": "success"}
ORDER_OF = {"click": "create", "purchase": "pay"}

EVENT_NAMES = list(schemas.EVENT_FIELDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Events with `ts` as a zoned timestamp and `k` out of the properties. The date
    range is put on the stored column, so the scan can skip by it."""
    raw = table(spark, sf_dir, "events")
    if start is not None:
        raw = raw.where(F.col("ts") >= F.expr(f"timestamp_ntz'{start} 00:00:00'"))
    if end is not None:
        raw = raw.where(F.col("ts") < F.expr(f"timestamp_ntz'{end} 00:00:00' + interval 1 day"))
    return typed_events(raw)


def typed_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _mapped(col: str, mapping: dict[str, str]) -> Column:
    cases = F
    for theirs, ours in mapping.items():
        cases = cases.when(F.col(col) == theirs, ours)
    return cases


def _only(kind: str, value: Column) -> Column:
    return F.when(F.col("event_type") == kind, value)


def actions(events: DataFrame) -> DataFrame:
    """user_visit_action; a session is a user's day. `action_time` stays a timestamp."""
    date = times.day_text(F.col("ts"))
    k = F.col("k")
    pair = F.concat_ws(",", k, F.pmod(k + 1, F.lit(100)))
    product = F.pmod("event_id", F.lit(100))
    return events.select(
        date.alias("date"),
        "user_id",
        F.concat_ws("_", "user_id", date).alias("session_id"),
        F.pmod(k, F.lit(10)).alias("page_id"),
        F.date_trunc("second", "ts").alias("action_time"),
        _only("view", F.concat(F.lit("kw"), F.pmod(k, F.lit(10)))).alias("search_keyword"),
        _only("click", k).alias("click_category_id"),
        _only("click", product).alias("click_product_id"),
        _only("signup", pair).alias("order_category_ids"),
        _only("signup", product.cast("string")).alias("order_product_ids"),
        _only("purchase", k.cast("string")).alias("pay_category_ids"),
        _only("purchase", product.cast("string")).alias("pay_product_ids"),
        F.pmod(k, F.lit(10)).alias("city_id"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_info: customers with their nation as city. The nations are a fixed 25 rows."""
    key = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customers.join(nations, "c_nationkey").select(
        key.alias("user_id"),
        F.concat(F.lit("user"), key).alias("username"),
        F.col("c_name").alias("name"),
        F.pmod(key, F.lit(60)).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.pmod(key, F.lit(2)) == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_info out of the parts."""
    key = F.col("p_partkey")
    status = F.concat(F.lit('{"product_status": '), F.pmod(key, F.lit(2)), F.lit("}"))
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"), F.col("p_name").alias("product_name"), status.alias("extend_info")
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per customer; every third asks for no age, `cities` is always an empty array."""
    key = F.col("c_custkey")
    low = F.pmod(key, F.lit(60))
    age = F.when(
        F.pmod(key, F.lit(3)) != 0,
        F.concat(F.lit('"startAge":["'), low, F.lit('"],"endAge":["'), low + 9, F.lit('"],')),
    ).otherwise("")
    param = F.concat(
        F.lit('{"startDate":["2024-01-05"],'),
        age,
        F.lit('"professionals":["'),
        F.col("c_mktsegment"),
        F.lit(',BUILDING","OTHER"],"cities":[]}'),
    )
    text = F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select(
        key.alias("task_id"),
        F.concat(F.lit("task"), key).alias("task_name"),
        *[text.alias(c) for c in ("create_time", "start_time", "finish_time", "task_type", "task_status")],
        param.alias("task_param"),
    )


def behaviors(events: DataFrame) -> DataFrame:
    return events.select(
        "user_id",
        F.col("k").alias("item_id"),
        F.pmod("k", F.lit(10)).cast("int").alias("category_id"),
        _mapped("event_type", BEHAVIOR_OF).alias("behavior"),
        "ts",
    )


def behavior_lines(events: DataFrame) -> DataFrame:
    """Behaviour as text lines; every 97th has a broken item id."""
    item = F.when(F.pmod("event_id", F.lit(97)) == 0, "x").otherwise(F.col("k").cast("string"))
    return events.select(
        F.concat_ws(
            ",",
            "user_id",
            item,
            F.pmod("k", F.lit(10)),
            _mapped("event_type", BEHAVIOR_OF),
            F.unix_seconds("ts"),
        ).alias("value")
    )


def _ip() -> Column:
    return F.concat(
        F.lit("10.0."), F.pmod("user_id", F.lit(256)), F.lit("."), F.pmod("event_id", F.lit(256))
    )


def _method() -> Column:
    return F.when(F.col("event_type").isin("view", "click"), "GET").otherwise("POST")


def requests(events: DataFrame) -> DataFrame:
    return events.select(
        _ip().alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        "ts",
        _method().alias("method"),
        F.concat(F.lit("/p/"), F.col("k")).alias("url"),
    )


def request_lines(events: DataFrame) -> DataFrame:
    """Requests as access-log lines; every 89th has a time that does not parse."""
    stamp = F.when(F.pmod("event_id", F.lit(89)) == 0, "-").otherwise(
        F.date_format("ts", times.ACCESS_LOG_FORMAT)
    )
    return events.select(
        F.concat_ws(
            " ", _ip(), F.col("user_id").cast("string"), F.lit("-"), stamp, F.lit("+0000"), _method(),
            F.concat(F.lit("/p/"), F.col("k")),
        ).alias("value")
    )


def logins(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*LOGIN_OF)).select(
        "user_id",
        _ip().alias("ip"),
        _mapped("event_type", LOGIN_OF).alias("event_type"),
        "ts",
        F.unix_micros("ts").alias("us"),
        F.col("event_id").alias("seq"),
    )


def orders(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(*ORDER_OF)).select(
        F.col("user_id").alias("order_id"),
        _mapped("event_type", ORDER_OF).alias("event_type"),
        "ts",
        F.unix_micros("ts").alias("us"),
        F.col("event_id").alias("seq"),
    )


def log_part_sql(ms: str, k: str) -> dict[str, str]:
    """SQL texts of the parts of an app log line, over event_id and user_id. They hold
    nothing but `||`, `%`, case and casts, so other SQL engines read them as well.
    Even event ids carry two events, odd ones one.
    """

    def text(sql: str) -> str:
        return f"cast({sql} as varchar(64))"

    def kv(name: str) -> str:
        parts = []
        for i, field in enumerate(event_fields(name)):
            quote = '"' if field[1] == "string" else ""
            parts.append(f"""'"{field[0]}":{quote}' || {text(f"{k} + {i}")} || '{quote}'""")
        return "'{' || " + " || ',' || ".join(parts) + " || '}'"

    def event(shift: int, delay: int) -> str:
        cases = " ".join(
            f"""when {i} then '"en":"{name}","kv":' || {kv(name)}""" for i, name in enumerate(EVENT_NAMES)
        )
        return (
            f"""'{{"ett":"' || {text(f"{ms} + {delay}")} || '",' || """
            f"case (event_id + {shift}) % {len(EVENT_NAMES)} {cases} end || '}}'"
        )

    common = " || ',' || ".join(
        f"""'"{f}":"' || {text("user_id") if f in ("uid", "mid") else f"'{f}' || {text(f'{k} % {i + 2}')}"} || '"'"""
        for i, f in enumerate(schemas.COMMON_FIELDS)
    )
    return {
        "common": common,
        "first": event(0, 0),
        "second": f"case when event_id % 2 = 0 then ',' || {event(5, 1000)} else '' end",
    }


def log_line_sql(ms: str, k: str, common: str, first: str, second: str) -> str:
    """SQL text of an app log line out of its parts.

    Of every seven lines, one has a short stamp, one a `|` inside its body, one an
    open body, one a tail after a second `|`, and one a tab before the body.
    """
    ms_text = f"cast({ms} as varchar(64))"
    open_body = (
        f"""'{{"cm":{{' || {common} || '}},"ap":"sh' || case when event_id % 7 = 2 then '|' else '' end || """
        f"""'op","et":[' || {first} || {second} || ']'"""
    )
    stamp = f"case when event_id % 7 = 1 then substr({ms_text}, 1, 12) else {ms_text} end"
    tab = "case when event_id % 7 = 4 then '\t' else '' end"
    tail = "case event_id % 7 when 5 then '' when 3 then '}||' else '}' end"
    return f"{stamp} || '|' || {tab} || {open_body} || {tail}"


def event_fields(name: str) -> list[tuple[str, str]]:
    """(field, type) of an app event."""
    return [tuple(f.split()) for f in schemas.EVENT_FIELDS[name].split(",")]


def log_lines(events: DataFrame) -> DataFrame:
    """App log lines. Part by part, because one expression for all would be more code
    than the JVM compiles."""
    parts = log_part_sql("unix_millis(ts)", "k")
    for name, sql in parts.items():
        events = events.select("*", once(F.expr(sql)).alias(name))
    line = log_line_sql("unix_millis(ts)", "k", **{name: name for name in parts})
    return events.select("ts", once(F.expr(line)).alias("value"))
