import datetime
import json

import pytest
from pyspark.sql import functions as F

from nightglass.operators import detect as d
from nightglass.operators.rules import CompiledRule, compile_rules, rules_table
from nightglass.session import run_folder, shared_folder
from nightglass.sources.events import parse_events, read_event_lines, stream_event_lines
from nightglass.streaming import streams as s

SCHEMA = "`event.action` string, n int, ts timestamp"
RULES = [
    {"id": "a", "detection": {"sel": {"event.action": "a"}, "condition": "sel"}},
    {"id": "not_a", "detection": {"sel": {"event.action": "A"}, "condition": "not sel"}},
]


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def event(action, n, ts="2024-01-01T00:00:00Z"):
    return {"event.action": action, "n": n, "ts": ts}


def test_stream_equals_batch(spark, tmp_path, rows):
    folder = tmp_path / "in"
    put(folder, "1.ndjson", [event("a", 1), event("b", 2), "broken"])
    put(folder, "2.ndjson", [event("A", 3), {"n": 4}])
    batch = parse_events(read_event_lines(spark, str(folder)), SCHEMA).where("ok")
    rules = compile_rules(rules_table(spark, RULES), batch)
    want = rows(d.detect(batch, rules, ["n"]))
    assert want == [(1, "a"), (2, "not_a"), (3, "a"), (4, "not_a")]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")
    stream = lambda: s.detect_stream(parse_events(stream_event_lines(spark, str(folder)), SCHEMA).where("ok"), rules, ["n"])
    s.append_to(stream(), out, checkpoint)
    assert rows(spark.read.parquet(out)) == want
    put(folder, "3.ndjson", [event("a", 5)])
    s.append_to(stream(), out, checkpoint)  # resumes: only the new file is read
    assert rows(spark.read.parquet(out)) == sorted([*want, (5, "a")], key=repr)


def test_ingest_splits_good_and_bad(spark, tmp_path, rows):
    folder = tmp_path / "in"
    put(folder, "1.ndjson", [event("a", 1), "", "{", event("b", "x")])
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    s.ingest(stream_event_lines(spark, str(folder)), SCHEMA, good, bad, str(tmp_path / "c"), ["file"])
    assert [r.n for r in spark.read.parquet(good).collect()] == [1]
    assert spark.read.parquet(bad).count() == 2 and "file" in spark.read.parquet(bad).columns


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, f"2024-01-01 {i // 6:02d}:{i % 6}0:00", "k" if i % 3 else "hot") for i in range(60)]
    frame = spark.createDataFrame(rows, "id int, t string, key string").select("id", F.col("t").cast("timestamp").alias("ts"), "key")
    frame.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path), frame


def stream(spark, table, watermark="1 hour", files=None):
    folder, frame = table
    return s.with_event_time(s.stream_table(spark, folder, "events", frame.schema, files), "ts", watermark)


def test_window_counts_over_a_folder_of_files(spark, table, rows):
    got = s.run_updated(spark, s.windowed_counts(stream(spark, table, "1 day", 1), "ts", "2 hours", "key"), "w", "window_start", "window_end", "key")
    want = table[1].groupBy(F.window("ts", "2 hours").alias("w"), "key").agg(F.count("*").alias("matches")).select("w.start", "w.end", "key", "matches")
    assert rows(got) == rows(want)


def test_threshold(spark, table, rows):
    got = s.run_updated(spark, s.threshold(stream(spark, table, "1 day"), "ts", s.timeframe_text("60m"), 4, "key"), "t", "window_start", "window_end", "key")
    assert {r.key for r in got.collect()} == {"k"} and got.count() == 10


FRAMED = [CompiledRule("fast", "true", timeframe="2m"), CompiledRule("slow", "true", timeframe="1h"), CompiledRule("none", "true")]


def span_stream(spark, folder, least, delay="10 minutes"):
    events = s.with_event_time(spark.readStream.schema("rule_id string, ts timestamp, user string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*"), "ts", delay)
    return s.spans(events, FRAMED, "ts", least, "user")


def at(minutes, seconds=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes, seconds=seconds)


def put_rows(spark, folder, name, listed):
    spark.createDataFrame(listed, "rule_id string, ts timestamp, user string").coalesce(1).write.parquet(f"{folder}/{name}")


def test_spans_across_window_borders(spark, tmp_path, rows):
    """Two matches a minute apart on both sides of an hour are found, out of order and over a restart; the same rows in a batch give the same."""
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = [("fast", at(59, 30), "a"), ("fast", at(50), "a"), ("slow", at(5), "a"), ("none", at(6), "a"), ("fast", None, "a")]
    second = [("fast", at(60, 30), "a"), ("fast", at(59), "b"), ("slow", at(64), "a"), ("slow", at(65, 1), "a"), ("fast", at(49), "a"), ("fast", at(60, 30), "a")]
    third = [("fast", at(61), "b"), ("fast", at(63), "b"), ("slow", at(500), None), ("slow", at(500), None)]
    last = [("none", at(5000), "z"), ("slow", at(5000), "z")]
    for name, listed in (("p=1", first), ("p=2", second)):
        put_rows(spark, folder, name, listed)
    s.append_to(span_stream(spark, folder, 2, "1 hour"), out, check)
    for name, listed in (("p=3", third), ("p=4", last)):
        put_rows(spark, folder, name, listed)
    s.append_to(span_stream(spark, folder, 2, "1 hour"), out, check)
    got = rows(spark.read.schema(f"rule_id string, user string, {s.SPANS}").parquet(out))
    table = spark.createDataFrame(first + second + third + last, "rule_id string, ts timestamp, user string")
    assert got == rows(s.spans_in_batch(table, FRAMED, "ts", 2, "user"))
    assert ("fast", "a", at(59, 30), at(60, 30)) in got and ("slow", None, at(500), at(500)) in got and ("slow", "a", at(5), at(65, 1)) not in got


@pytest.mark.parametrize("least", [1, 3])
def test_spans_of_other_numbers(spark, tmp_path, rows, least):
    folder = str(tmp_path / "in")
    listed = [("fast", at(i * i % 37, i), "ab"[i % 2]) for i in range(40)]
    put_rows(spark, folder, "p=1", listed)
    put_rows(spark, folder, "p=2", [("slow", at(9000), "z")])
    got = rows(s.run_appended(spark, span_stream(spark, folder, least, "1 day"), "spans").where("user <> 'z'"))
    table = spark.createDataFrame(listed, "rule_id string, ts timestamp, user string")
    assert got == rows(s.spans_in_batch(table, FRAMED, "ts", least, "user")) and len(got) > 3


def test_spans_keep_a_state_per_group_of_keys(spark, tmp_path, rows):
    """Many keys share few states, over a restart; integers beside a null key stay exact, and times out of reach are let go."""
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema, big = "rule_id string, ts timestamp, user bigint, day date", 9007199254740993
    day = lambda i: datetime.date(2024, 1, 1 + i % 2)
    user = lambda i: None if i % 40 == 7 else big + i % 40
    parts = [[("fast", at(i * 7 % 11, i * 13 % 60), user(i), day(i)) for i in range(n, 400, 2)] for n in (0, 1)]
    parts += [[("slow", at(2000 + i), big, day(0)) for i in range(3)], [("none", at(9000), big, None), ("slow", at(9000), -1, None)]]

    def run():
        events = s.with_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*"), "ts", "1 day")
        found = s.spans(events, FRAMED, "ts", 3, "user", "day", groups=4)
        query = found.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out)
        query.awaitTermination()
        held.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]))
        left.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1])

    held, left = [], []
    s.arriving([spark.createDataFrame(p, schema) for p in parts], folder, run)
    got = rows(spark.read.schema(f"rule_id string, user bigint, day date, {s.SPANS}").parquet(out))
    table = spark.createDataFrame(sum(parts, []), schema)
    assert got == rows(s.spans_in_batch(table, FRAMED, "ts", 3, "user", "day"))
    assert {r[1] for r in got} >= {None, big, big + 1} and ("slow", big, day(0), at(2000), at(2002)) in got
    assert max(held) <= 4 and left[-1] <= 1


def test_late_rows_are_kept(spark, tmp_path, rows):
    """Behind the watermark of earlier batches a row is late if its window has ended; rows without a time are late too. Over a restart, and over a batch that is done again."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts timestamp, key string"
    batches = [[(at(300), "a"), (at(60), "a")], [(at(299), "a"), (at(100), "b"), (at(239), "b"), (None, "c")], [(at(600), "a"), (at(241), "d"), (at(200), "e")], [(at(301), "f"), (at(590), "a")]]

    def run():
        s.counts_and_late(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*"), "ts", "10 minutes", "1 hour", out, "key")

    s.arriving([spark.createDataFrame(b, schema) for b in batches], folder, run)
    late = rows(s.late_table(spark, out, schema).select("ts", "key", "batch"))
    assert late == sorted([(at(100), "b", 1), (at(239), "b", 1), (None, "c", 1), (at(200), "e", 2), (at(301), "f", 3)], key=repr)
    totals = {(r.window_start, r.key): r.matches for r in s.window_totals(spark, out, "key string", "key").collect()}
    assert totals == {(at(300), "a"): 1, (at(60), "a"): 1, (at(240), "a"): 1, (at(240), "d"): 1, (at(600), "a"): 1, (at(540), "a"): 1}


def test_late_rows_are_dropped_behind_the_watermark(spark, tmp_path):
    folder = tmp_path / "late"
    schema = "ts timestamp"
    counts = lambda: s.windowed_counts(s.with_event_time(parse_events(stream_event_lines(spark, str(folder)), schema).where("ok").select("ts"), "ts", "10 minutes"), "ts", "1 hour")
    out, check = str(tmp_path / "o"), str(tmp_path / "c")
    put(folder, "1.ndjson", [{"ts": "2024-01-01T05:00:00Z"}])
    s.updates_to(counts(), out, check)
    put(folder, "2.ndjson", [{"ts": "2024-01-01T01:00:00Z"}, {"ts": "2024-01-01T05:10:00Z"}])
    s.updates_to(counts(), out, check)
    got = s.latest(spark.read.parquet(out), "window_start", "window_end").collect()
    assert [(r.window_start.hour, r.matches) for r in got] == [(5, 2)]


def test_repeats(spark, table):
    got = s.run_appended(spark, s.drop_repeats(stream(spark, table, "1 day").select("ts", "key"), ["key"]), "d")
    assert sorted(r.key for r in got.collect()) == ["hot", "k"]


def test_timeframe():
    assert s.timeframe_text("15m") == "15 minutes"
    with pytest.raises(ValueError):
        s.timeframe_text("soon")


def test_folders_follow_the_session(spark):
    assert run_folder(spark, "x").startswith(shared_folder(spark))
