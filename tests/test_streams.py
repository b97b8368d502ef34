"""Streams fed file by file give what the batch forms give."""

from functools import partial
from pathlib import Path
from random import Random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from clickloom.operators import applog, patterns, traffic
from clickloom.plans import catalog
from clickloom.sources import retail
from clickloom.streaming import logins, orders, run, traffic as stream_traffic

S = patterns.SECOND
BASE = 1_700_000_000 * S
SCHEMA = "key bigint, label string, kind string, us bigint, seq bigint"


def random_rows(seed, n=300, span=120):
    """Seconds as in the source data, so many rows share an instant; key 0 holds 40%."""
    rng = Random(seed)
    times = sorted(rng.randrange(span) for _ in range(n))
    return [
        (0 if rng.random() < 0.4 else rng.randrange(4), f"l{i}", rng.choice("ffs"), BASE + t * S, i)
        for i, t in enumerate(times)
    ]


def far(rows):
    """One row of another key, long after, to move the watermark past everything."""
    return [(99, "end", "s", rows[-1][3] + 3600 * S, 10**6)]


def write_files(spark, rows, folder, files):
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        part = spark.createDataFrame(rows[i : i + size], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(folder)


def stream_of(spark, folder):
    rows = run.table_rows(spark, folder, SCHEMA, files_per_batch=1)
    return rows.withColumn("ts", F.timestamp_micros("us"))


def finish(query):
    return run.finished(query)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def as_logins(df):
    return df.select(
        F.col("key").alias("user_id"), F.col("label").alias("ip"), *[c for c in ("us", "seq", "ts") if c in df.columns],
        F.when(F.col("kind") == "f", "fail").otherwise("success").alias("event_type"),
    )


def as_orders(df):
    return df.select(
        F.col("key").alias("order_id"), *[c for c in ("us", "seq", "ts") if c in df.columns],
        F.when(F.col("kind") == "f", "create").otherwise("pay").alias("event_type"),
    )


@pytest.mark.parametrize("files", [1, 5])
@pytest.mark.parametrize("case", ["bursts", "pairs", "orders"])
def test_patterns_like_batch(spark, tmp_path, case, files):
    limit = 2 * S if case != "orders" else 30 * S
    rows = random_rows(files)
    ends = far(rows)  # a success of another user: it moves the watermark like a failure
    write_files(spark, rows, str(tmp_path / "in"), files)
    write_files(spark, ends, str(tmp_path / "in"), 1)
    shape, blocks, result, batch = {
        "bursts": (as_logins, logins.burst_blocks, logins.bursts_of, patterns.login_bursts),
        "pairs": (as_logins, logins.pair_blocks, logins.pairs_of, patterns.login_pairs),
        "orders": (as_orders, orders.order_blocks, orders.outcomes_of, patterns.order_outcomes),
    }[case]
    stream = blocks(shape(stream_of(spark, str(tmp_path / "in"))), limit)
    finish(run.into_batches(stream, str(tmp_path / "out"), partial(result, limit=limit), available_now=True))
    expected = batch(shape(spark.createDataFrame(rows, SCHEMA)), limit)
    got = spark.read.parquet(str(tmp_path / "out" / "data")).where(f"seq < {10**6}")
    assert expected.count() > 5
    assert rows_of(got, *expected.columns) == rows_of(expected, *expected.columns)


def test_rankings_like_batch_with_rows_out_of_order(spark, tmp_path):
    rows = random_rows(7, n=400, span=300)
    rng = Random(7)
    shuffled = sorted(rows, key=lambda r: r[3] + rng.randrange(9 * S))
    write_files(spark, shuffled, str(tmp_path / "in"), 4)
    write_files(spark, far(rows), str(tmp_path / "in"), 1)

    def as_requests(df):
        return df.select(
            F.timestamp_micros("us").alias("ts"), F.concat(F.lit("/"), "key").alias("url"), F.lit("GET").alias("method")
        )

    counts = stream_traffic.url_traffic(as_requests(stream_of(spark, str(tmp_path / "in"))))
    ranked = partial(traffic.rank_windows, key="url", n=2)
    query = finish(run.into_batches(counts, str(tmp_path / "out"), ranked, available_now=True))
    expected = ranked(traffic.url_traffic(as_requests(spark.createDataFrame(rows, SCHEMA))))
    columns = ["window_end", "rank", "url", "count"]
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    closed = got.where(f"window_end < {far(rows)[0][3] // 1000}")
    assert rows_of(closed, *columns) == rows_of(expected, *columns)
    assert run.late_rows(query) == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    early, late = (1, "a", "f", BASE, 1), (1, "b", "f", BASE - 7200 * S, 2)
    for row in (early, far([early])[0], late):
        write_files(spark, [row], str(tmp_path / "in"), 1)
    behaviors = stream_of(spark, str(tmp_path / "in")).select(
        "ts", F.col("key").alias("item_id"), F.lit("pv").alias("behavior")
    )
    query = run.into_files(stream_traffic.hot_items(behaviors), str(tmp_path / "out"), available_now=True)
    with pytest.raises(run.LateRows):
        run.finished(query)
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert got.where("item_id = 1").count() == 12
    assert got.agg(F.sum("count")).first()[0] == 12
    assert run.late_rows(query) == 1


def test_a_delay_covers_disorder(spark, tmp_path):
    """The same rows with a delay: nothing is late."""
    early, late = (1, "a", "f", BASE, 1), (1, "b", "f", BASE - 7200 * S, 2)
    for row in (early, far([early])[0], late, (5, "c", "f", BASE + 40_000 * S, 9)):
        write_files(spark, [row], str(tmp_path / "in"), 1)
    behaviors = stream_of(spark, str(tmp_path / "in")).select(
        "ts", F.col("key").alias("item_id"), F.lit("pv").alias("behavior")
    )
    counts = stream_traffic.hot_items(behaviors, delay="4 hours")
    run.finished(run.into_files(counts, str(tmp_path / "out"), available_now=True))
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert got.where("item_id = 1").agg(F.sum("count")).first()[0] == 24


def plain_late(batches, closes, delay):
    """Batch by batch: what closes no later than the newest time before, less the delay."""
    newest, late = None, []
    for rows in batches:
        late += [r for r in rows if newest is not None and closes(r[3] // 1000) <= newest - delay]
        newest = max([r[3] // 1000 for r in rows] + ([] if newest is None else [newest]))
    return late


@pytest.mark.parametrize("delay", [0, 20_000])
def test_late_rows_are_kept_apart(spark, tmp_path, delay):
    """Batches of no order: what is counted and what is in quarantine make the input, and
    neither the one nor the other depends on Spark dropping anything."""
    rows = random_rows(5, n=400, span=300)
    Random(6).shuffle(rows)
    batches = [rows[i : i + 50] for i in range(0, 400, 50)] + [far(sorted(rows, key=lambda r: r[3]))]
    for part in batches:
        write_files(spark, part, str(tmp_path / "in"), 1)
    folder, schema = str(tmp_path / "apart"), f"{SCHEMA}, ts timestamp"
    closes = stream_traffic.pane_end("ts", traffic.URL_WINDOW, traffic.URL_SLIDE)
    stream = stream_of(spark, str(tmp_path / "in"))
    run.finished(run.apart_from_late(stream, folder, "ts", closes, delay, available_now=True))
    late = run.quarantined(spark, folder, schema)
    expected = plain_late(batches, lambda ms: ms // 5000 * 5000 + 5000, delay)
    assert sorted(r.seq for r in late.collect()) == sorted(r[4] for r in expected) and len(expected) > 100

    kept = run.in_time(spark, folder, schema, files_per_batch=1)
    counts = stream_traffic.sliding_counts(kept, "key", 5000, 5000, f"{delay} milliseconds")
    query = run.into_files(counts, str(tmp_path / "out"), available_now=True)
    run.finished(query, late, most=len(expected))
    counted = spark.read.parquet(str(tmp_path / "out" / "data")).agg(F.sum("count")).first()[0]
    assert counted + len(expected) == len(rows)
    with pytest.raises(run.LateRows):
        run.finished(query, late)


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    first, second = random_rows(1, n=20), random_rows(2, n=20)
    write_files(spark, first, str(tmp_path / "in"), 1)
    folder, schema = str(tmp_path / "apart"), f"{SCHEMA}, ts timestamp"

    def again():
        stream = stream_of(spark, str(tmp_path / "in"))
        run.finished(run.apart_from_late(stream, folder, "ts", F.unix_millis("ts"), available_now=True))

    again()
    write_files(spark, second, str(tmp_path / "in"), 1)
    again()
    # As after a crash behind the second write: Spark has no commit of the batch.
    for name in ("1", ".1.crc"):
        if (path := tmp_path / "apart" / "checkpoint" / "commits" / name).exists():
            path.unlink()
    again()
    both = run.quarantined(spark, folder, schema).union(spark.read.schema(schema).parquet(f"{folder}/data/batch_id=*/kind=in_time"))
    assert both.count() == 40


def test_forgotten_batches_are_not_counted_as_none():
    spark_keeps = [{"batchId": i, "stateOperators": []} for i in range(50, 150)]
    query = SimpleNamespace(recentProgress=spark_keeps, lastProgress=spark_keeps[-1])
    with pytest.raises(run.LateRows):
        run.late_rows(query)


@pytest.fixture(scope="module")
def scattered(spark, sf_dir, tmp_path_factory):
    """The events in 2,200 files of no order."""
    folder = tmp_path_factory.mktemp("scattered")
    events = spark.read.parquet(f"{Path(sf_dir).parent}/sf0.01/events.parquet")
    events.repartition(2200, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("query", catalog.STREAMS, ids=lambda q: q.__name__)
def test_files_decide_nothing(spark, sf_dir, scattered, tmp_path, monkeypatch, query):
    """One file, 2,200 unordered files, and seven batches of files put in order: same rows."""
    whole = f"{Path(sf_dir).parent}/sf0.01"
    expected = sorted(map(str, query(spark, whole).collect()))
    assert len(expected) > 100
    assert sorted(map(str, query(spark, scattered).collect())) == expected

    raw = spark.read.schema(retail.EVENTS_DDL).parquet(f"{scattered}/events.parquet")
    ordered = run.in_time_order(raw, str(tmp_path / "ordered"), "ts", files=28)
    batches = []

    def stream(spark, _):
        return retail.typed_events(run.table_rows(spark, ordered, retail.EVENTS_DDL, files_per_batch=4))

    def finished(started):
        run_finished(started)
        batches.append(sum(p["numInputRows"] > 0 for p in started.recentProgress))

    run_finished = run.finished
    monkeypatch.setattr(catalog, "_event_stream", stream)
    monkeypatch.setattr(run, "finished", finished)
    assert sorted(map(str, query(spark, whole).collect())) == expected
    assert batches[0] >= 4


def test_neighbours_are_one_row(spark):
    """Only home rows come out; a flood before the block costs one row."""
    flood = [(1, f"l{i}", "f", BASE + i * 1000, i) for i in range(500)] + [(1, "x", "f", BASE + 2 * S, 999)]
    closed = logins.pair_blocks(as_logins(spark.createDataFrame(flood, SCHEMA).withColumn("ts", F.timestamp_micros("us"))), 2 * S)
    last = closed.where(f"block = {BASE + 2 * S}").orderBy("us").collect()
    assert [(r.us, r.edge and r.edge.ip) for r in last] == [(None, "l499"), (BASE + 2 * S, None)]


@pytest.mark.parametrize("blocks", [logins.burst_blocks, logins.pair_blocks, orders.order_blocks])
def test_no_lists_in_the_state(spark, blocks):
    """However many rows a key has, a state value is one row's size."""
    rows = spark.createDataFrame(random_rows(1), SCHEMA).withColumn("ts", F.timestamp_micros("us"))
    plan = blocks((as_orders if blocks is orders.order_blocks else as_logins)(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect" not in plan and "Aggregate" in plan


def test_equal_rows_of_a_block_are_all_there(spark):
    rows = [(1, "a", "f", BASE, 1)] * 3 + [(1, "b", "f", BASE + S, 2)]
    shaped = as_logins(spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_micros("us")))
    batch = patterns.login_pairs(shaped, 2 * S)
    assert rows_of(logins.pairs_of(logins.pair_blocks(shaped, 2 * S), 2 * S), *batch.columns) == rows_of(batch, *batch.columns)


def test_a_batch_folder_appears_whole(spark, tmp_path):
    rows = spark.createDataFrame(random_rows(1, n=5), SCHEMA)
    staged, target = str(tmp_path / "staged" / "b"), str(tmp_path / "data" / "b")
    for part in (rows, rows.limit(2)):
        part.write.mode("overwrite").parquet(staged)
        run._move(spark, staged, target)
    assert spark.read.parquet(target).count() == 2 and not Path(staged).exists()


def test_log_lines_are_routed(spark, tmp_path):
    text = ['1577435668032|{"en":"start"}', '1577435668032|{"en":"ad"}', "junk"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(text))
    lines = run.text_lines(spark, str(tmp_path / "in"), glob="*.log")
    routed = applog.with_log_type(applog.clean(lines))
    finish(run.into_files(routed, str(tmp_path / "out"), ["log_type"], available_now=True))
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert sorted((r.log_type, r.value) for r in got.collect()) == [("event", text[1]), ("start", text[0])]


def test_console_prints_every_row(spark, tmp_path, monkeypatch):
    from pyspark.sql.streaming.readwriter import DataStreamWriter

    seen, option = {}, DataStreamWriter.option
    monkeypatch.setattr(DataStreamWriter, "option", lambda self, k, v: seen.update({k: v}) or option(self, k, v))
    write_files(spark, random_rows(1, n=5), str(tmp_path / "in"), 1)
    stream = stream_of(spark, str(tmp_path / "in"))
    finish(run.into_console(stream, str(tmp_path / "out"), available_now=True))
    assert seen["numRows"] == 2**31 - 1


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    rows = random_rows(11)
    limit = 2 * S
    expected = patterns.login_pairs(as_logins(spark.createDataFrame(rows, SCHEMA)), limit)
    for part in (rows[:150], rows[150:], far(rows)):
        write_files(spark, part, str(tmp_path / "in"), 1)
        stream = logins.pair_blocks(as_logins(stream_of(spark, str(tmp_path / "in"))), limit)
        finish(
            run.into_batches(stream, str(tmp_path / "out"), partial(logins.pairs_of, limit=limit), available_now=True)
        )
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert rows_of(got, *expected.columns) == rows_of(expected, *expected.columns)


@pytest.mark.parametrize("files", [1, 7])
def test_rankings_inside_the_stream(spark, tmp_path, files):
    """Ties and null keys included; only the counts keep state, the ranking none."""
    rng = Random(files)
    start = 1_700_000_000_000
    rows = [(rng.choice([None, "a", "b", "c", "ü", "z", "", "日"]), start + rng.randrange(400_000)) for _ in range(900)]
    events = spark.createDataFrame(rows, "url string, ms bigint").select("url", F.timestamp_millis("ms").alias("ts"))
    folder = run.in_time_order(events, str(tmp_path / "in"), "ts", files)
    stream = run.table_rows(spark, folder, "url string, ts timestamp", files_per_batch=1)
    counts = stream_traffic.sliding_counts(stream, "url", 60_000, 5_000, "0 seconds")
    query = run.finished(run.into_files(stream_traffic.ranked(counts, "url", 3), str(tmp_path / "out"), available_now=True))
    assert len(query.lastProgress["stateOperators"]) == 2
    got = spark.read.parquet(str(tmp_path / "out/data"))
    mark = events.agg(F.max(F.unix_millis("ts"))).first()[0]
    want = traffic.rank_windows(traffic.sliding_counts(events, "url", 60_000, 5_000), "url", 3)
    want = want.where(F.col("window_end") <= mark)
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    rows = [sorted((tuple(r) for r in df.select(*columns).collect()), key=str) for df in (got, want)]
    assert rows[0] == rows[1] and len(rows[0]) > 200
