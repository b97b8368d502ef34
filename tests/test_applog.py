import json
import re

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import applog
from clickloom.plans import catalog
from clickloom.sources import lines

STAMP = "1600000000123"


@pytest.mark.parametrize(
    ("line", "valid"),
    [
        (STAMP + '|{"a":1}', True),
        (STAMP + "| {} |z", True),
        (STAMP + '|{"a":1}||', True),
        (STAMP + "|\t{}\n", True),
        ("160000000012|{}", False),
        ("16000000001234|{}", False),
        ("160000000012x|{}", False),
        (STAMP + '|{"a":"x|y"}', False),
        (STAMP + "|", False),
        (STAMP + "||{}", False),
        (STAMP + "|{", False),
        ("abc", False),
        ("", False),
        (None, False),
    ],
)
def test_validity(spark, line, valid):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(applog.is_valid(F.col("value"))).first()[0] is valid
    assert applog.clean(df).count() == valid


def test_log_type(spark):
    rows = [('{"en":"start"}',), ('{"en":"ad","kv":"restart"}',), ('{"en":"ad"}',)]
    df = spark.createDataFrame(rows, "value string")
    assert [r.log_type for r in applog.with_log_type(df).collect()] == ["start", "start", "event"]
    by_event = applog.with_log_type(df, by="event_name")
    assert [r.log_type for r in by_event.collect()] == ["start", "event", "event"]
    with pytest.raises(ValueError):
        applog.log_type(F.col("value"), by="size")


def test_line_to_tables(spark):
    et = [
        {"ett": "1600000000009", "en": "active_background", "kv": {"active_source": "widget"}},
        {"ett": "1600000000010", "en": "favorites", "kv": {"course_id": 512, "userid": 40}},
        {"ett": "oops", "en": "unknown", "kv": {}},
    ]
    line = STAMP + "|" + json.dumps({"cm": {"uid": "u7", "mid": "m9", "la": "1.5"}, "ap": "shop", "et": et})
    logs = applog.parse(spark.createDataFrame([(line,)], "value string"))
    assert logs.columns == ["log_time", "ap", *schemas.COMMON_FIELDS, "et"]
    events = applog.events(logs)
    assert [(r.position, r.event_name, r.uid) for r in events.collect()] == [
        (0, "active_background", "u7"),
        (1, "favorites", "u7"),
        (2, "unknown", "u7"),
    ]
    (hidden,) = applog.event_table(events, "active_background").collect()
    assert hidden.active_source == "widget"
    (liked,) = applog.event_table(events, "favorites").collect()
    assert (liked.course_id, liked.userid, liked.id, liked.add_time) == (512, 40, None, None)
    assert applog.event_table(events, "start").count() == 0


def test_every_event_has_a_table(spark):
    events = applog.events(applog.parse(spark.createDataFrame([], "value string")))
    for name in schemas.EVENT_FIELDS:
        assert applog.event_table(events, name).count() == 0


def test_only_asked_fields_are_parsed(spark):
    """Two of seventeen common fields go into the events."""
    lines = spark.createDataFrame([], "value string")
    plan = applog.events(applog.parse(lines, applog.EVENT_COMMON))._jdf.queryExecution().optimizedPlan().toString()
    (parsed,) = set(re.findall(r"StructField\(cm,StructType\((.*?)\),true\)", plan))
    assert re.findall(r"StructField\((\w+),", parsed) == ["mid", "uid"]


def test_event_tables_out_of_one_pass(spark, sf_dir, tmp_path):
    lines = catalog._log_lines(spark, sf_dir)
    applog.write_events(lines, str(tmp_path / "events"))
    tables = applog.event_tables(spark, str(tmp_path / "events"))
    assert set(tables) == set(schemas.EVENT_FIELDS)
    for name in ("start", "comment"):
        expected = applog.event_table(catalog._log_events(spark, sf_dir), name)
        assert tables[name].columns == expected.columns
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, expected.collect()))
        plan = tables[name]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(event_name" in plan


def test_behavior_lines(spark):
    rows = ["1,2,3,pv,1511658000", "1,2,3,pv,1511658000,more", "1,x,3,pv,1511658000", "1,2,3,pv", "", "1,2,3,pv,"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    good = lines.behaviors(df).collect()
    assert [(r.user_id, r.item_id, r.category_id, r.behavior, r.timestamp) for r in good] == [
        (1, 2, 3, "pv", 1511658000)
    ] * 2
    assert str(good[0].ts) == "2017-11-26 01:00:00"
    assert [r.value for r in lines.bad_behaviors(df).collect()] == rows[2:]


def test_access_log_lines(spark):
    rows = ["10.9.8.7 u5 - 03/11/2021:23:59:58 +0000 PUT /cart/7", "10.9.8.7 u5 - never +0000 PUT /cart", "short"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    (row,) = lines.requests(df).collect()
    assert (row.ip, row.user_id, row.method, row.url) == ("10.9.8.7", "u5", "PUT", "/cart/7")
    assert str(row.ts) == "2021-11-03 23:59:58"
    assert [r.value for r in lines.bad_requests(df).collect()] == rows[1:]
