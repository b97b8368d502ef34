"""Column layouts of the data model, as DDL text. Every column is nullable."""

from __future__ import annotations

ACTIONS = """date string, user_id bigint, session_id string, page_id bigint, action_time string,
       search_keyword string, click_category_id bigint, click_product_id bigint,
       order_category_ids string, order_product_ids string,
       pay_category_ids string, pay_product_ids string, city_id bigint"""

USERS = "user_id bigint, username string, name string, age int, professional string, city string, sex string"

PRODUCTS = "product_id bigint, product_name string, extend_info string"

TASKS = """task_id bigint, task_name string, create_time string, start_time string, finish_time string,
       task_type string, task_status string, task_param string"""

BEHAVIORS = "user_id bigint, item_id bigint, category_id int, behavior string, timestamp bigint"

LOGINS = "user_id bigint, ip string, event_type string, event_time bigint"

ORDER_EVENTS = "order_id bigint, event_type string, event_time bigint"

# The seventeen common fields of an app log line, all text.
COMMON_FIELDS = [
    "mid", "uid", "vc", "vn", "l", "sr", "os", "ar", "md", "ba", "sv", "g", "hw", "t", "nw", "ln", "la",
]

# The fields of each app event by event name.
EVENT_FIELDS = {
    "start": "entry string, open_ad_type string, action string, loading_time string, detail string, extend1 string",
    "display": "action string, newsid string, place string, extend1 string, category string",
    "newsdetail": """entry string, action string, newsid string, showtype string, news_staytime string,
                     loading_time string, type1 string, category string""",
    "loading": """action string, loading_time string, loading_way string, extend1 string, extend2 string,
                  type string, type1 string""",
    "ad": """entry string, action string, content string, detail string, source string, behavior string,
             newstype string, show_style string""",
    "notification": "action string, type string, ap_time string, content string",
    "active_foreground": "push_id string, access string",
    "active_background": "active_source string",
    "error": "errorBrief string, errorDetail string",
    "comment": """userid int, comment_id int, p_comment_id int, content string, addtime string,
                  other_id int, praise_count int, reply_count int""",
    "favorites": "id int, course_id int, userid int, add_time string",
    "praise": "id int, userid int, target_id int, type int, add_time string",
}


def app_log(fields: list[str]) -> str:
    """The body of a log line with these common fields. `kv` stays text here: its shape
    depends on the event name."""
    common = ", ".join(f"{name}: string" for name in fields)
    return f"cm struct<{common}>, ap string, et array<struct<ett: string, en: string, kv: string>>"
