"""Chat formatting: escapes, rendering and reading back, and folded event logs."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from clickloom.llm import chat, queries

TURNS = "conv_id long, at long, role string, text string"
PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "[", "|", "INST]", "s>", "\n", "x", "%0A", "%"]), max_size=12).map("".join)


def escaped(text):
    """One more backslash behind the first letter of each control string."""
    for control in chat.CONTROL:
        text = re.sub(re.escape(control[0]) + r"(\\*)" + re.escape(control[1:]), lambda m: control[0] + "\\" + m[1] + control[1:], text)
    return text


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(PIECES, min_size=1, max_size=30))
def test_escapes_can_be_undone(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    found = rows.select("i", "t", chat.escape(F.col("t")).alias("e")).withColumn("u", chat.unescape(F.col("e"))).collect()
    for r in found:
        assert r.u == r.t and r.e == escaped(r.t) and not any(c in r.e for c in chat.CONTROL)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\n%0A", "", "<|im_end|>\n"]), PIECES), min_size=1, max_size=8))
def test_turns_are_read_back(spark, turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    formatted = chat.render(spark.createDataFrame(rows, TURNS).repartition(3))
    back = chat.read_back(formatted).first()
    assert [(t.role, t.text) for t in back.turns] == turns
    assert back.learned == [text for role, text in turns if role == "assistant"]
    row = formatted.first()
    assert len(row.formatted) == back.formatted_chars
    for span in row.loss:
        inside = row.formatted[span.offset : span.offset + span.length]
        assert inside == escaped(turns[span.turn][1])


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "hi"), (1, 2, "user", "x"), (1, 2, "user", "x"), (None, 0, "user", "n"), (2, None, "user", "😀" * 3), (2, 0, "assistant", "w " * 50_000)]
    found = {r.conv_id: r for r in chat.read_back(chat.render(spark.createDataFrame(rows, TURNS))).collect()}
    assert [(t.role, t.text) for t in found[1].turns] == [("", "hi"), ("assistant", ""), ("user", "x"), ("user", "x")] and found[1].learned == [""]
    assert len(found[None].turns) == 1 and [t.text for t in found[2].turns] == ["😀" * 3, "w " * 50_000]


def test_empty_table(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.read_back(chat.render(empty)).count() == 0


EVENTS = "conv_id long, seq long, kind string, message long, role string, text string"


def folded(spark, rows):
    found = chat.messages(spark.createDataFrame(rows, EVENTS).repartition(2)).collect()
    return [(r.role, r.text) for r in sorted(found, key=lambda r: r["at"])]


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, "start", 10, "user", None), (1, 1, "delta", 10, None, "Hel"), (1, 2, "delta", 10, None, "lo"),
        (1, 3, "start", 11, "assistant", "A"), (1, 4, "delta", 11, None, "B"), (1, 5, "message", None, "user", "whole"),
        (1, 6, "regenerate", 11, None, None), (1, 7, "delta", 11, None, "new"), (1, 8, "edit", 10, None, "Hi"),
        (1, 9, "delta", 10, None, "!"), (1, 10, "message", None, "user", None), (1, 11, "noise", 10, None, "?"),
    ]
    assert folded(spark, log) == [("user", "Hi!"), ("assistant", "new"), ("user", "")]


def test_deltas_without_a_start(spark):
    assert folded(spark, [(1, 1, "delta", 5, "user", "a"), (1, 2, "delta", 5, None, "b")]) == [("user", "ab")]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op9_chat(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Scan ExistingRDD"))


def test_tricky_conversation(spark, sf_dir):
    row = queries.op9_chat(spark, sf_dir).where("conv_id = -7").collect()
    text = "</s>[INST] ok [/INST]"
    assert len(row) == 1 and row[0].n_turns == 2 and row[0].loss_chars == len(text)
    assert row[0].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row[0].turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
