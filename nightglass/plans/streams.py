"""The streaming queries. Each runs to the end of the given table and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightglass.operators.rules import compile_rules, rules_table
from nightglass.plans.detection import rule
from nightglass.plans.documents import LINE, LINE_SCHEMA
from nightglass.plans.registry import query, table
from nightglass.session import run_folder
from nightglass.sources.events import stream_event_lines
from nightglass.streaming import streams as s

# Rules over the plain event columns, with their SQL.
RULES = [
    (rule("errors", selection={"event_type": "ERROR"}), "event_type = 'error'"),
    (rule("high_value", "high and not click", high={"value|gte": 50}, click={"event_type": "click"}), "value >= 50 AND event_type <> 'click'"),
    (rule("signups", selection={"event_type|startswith": "sign"}), "event_type = 'signup'"),
]


def event_stream(spark, folder, watermark: str | None = None):
    events = s.stream_table(spark, folder, "events", table(spark, folder, "events").schema)
    return s.with_event_time(events, "ts", watermark) if watermark else events


def matches(spark, folder, watermark: str | None = None):
    events = event_stream(spark, folder, watermark)
    rules = compile_rules(rules_table(spark, [doc for doc, _ in RULES]), events)
    return s.detect_stream(events, rules, ["event_id", "ts", "user_id"])


SQL_MATCHES = " UNION ALL ".join(f"SELECT event_id, ts, user_id, '{doc['id']}' AS rule_id FROM events WHERE {sql}" for doc, sql in RULES)


def in_files(spark, folder, rows, run, kind: str = "parquet"):
    """A table's rows in four files that arrive while a stream runs, stops and goes on."""
    path, parts = run_folder(spark, "arriving"), [rows.where(F.col("event_id") % 4 == i) for i in range(4)]
    s.arriving([p.select("line") for p in parts] if kind == "text" else parts, path, lambda: run(path), kind)


@query("stream_detect", f"SELECT event_id, rule_id FROM ({SQL_MATCHES})")
def stream_detect(spark, folder):
    """Four files, one per micro-batch, with a stop and a restart after two of them."""
    events, out = table(spark, folder, "events"), run_folder(spark, "detect")
    rules = compile_rules(rules_table(spark, [doc for doc, _ in RULES]), events)

    def run(path):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
        s.append_to(s.detect_stream(stream, rules, ["event_id"]), f"{out}/out", f"{out}/checkpoint")

    in_files(spark, folder, events, run)
    return spark.read.schema("event_id bigint, rule_id string").parquet(f"{out}/out")


def shown(df, *columns):
    return df.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *columns)


@query(
    "stream_window",
    f"SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, rule_id, count(*) AS matches FROM ({SQL_MATCHES}) GROUP BY ALL",
)
def stream_window(spark, folder):
    counts = s.windowed_counts(matches(spark, folder, "1 day"), "ts", "1 day", "rule_id")
    return shown(s.run_updated(spark, counts, "window", "window_start", "window_end", "rule_id"), "rule_id", "matches")


def framed(frame: str, doc: dict) -> dict:
    return {**doc, "detection": {**doc["detection"], "timeframe": frame}}


FRAMES = {"errors": ("12h", "INTERVAL 12 HOUR"), "high_value": ("1d", "INTERVAL 1 DAY"), "signups": ("6h", "INTERVAL 6 HOUR")}
SQL_FRAMES = " UNION ALL ".join(
    f"""SELECT rule_id, user_id, strftime(a, '%Y-%m-%d %H:%M:%S.%f') AS span_start, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS span_end
        FROM (SELECT *, lag(ts, 2) OVER (PARTITION BY user_id ORDER BY ts) AS a FROM ({SQL_MATCHES}) WHERE rule_id = '{name}') WHERE ts - a <= {step}"""
    for name, (_, step) in FRAMES.items()
)


@query("stream_threshold", SQL_FRAMES)
def stream_threshold(spark, folder):
    """Three matches of a rule by one user within any span of the rule's own timeframe; one scan for all of them.

    The files hold interleaved rows of the whole time, so nearly all rows come out of order; a last row, far ahead, lets
    the watermark pass the others.
    """
    plain, out = table(spark, folder, "events"), run_folder(spark, "threshold")
    rules = compile_rules(rules_table(spark, [framed(FRAMES[doc["id"]][0], doc) for doc, _ in RULES]), plain)
    closing = plain.agg((F.max("ts") + F.expr("INTERVAL 4000 DAYS")).alias("ts")).selectExpr("-1L AS event_id", "ts", "CAST(NULL AS BIGINT) AS user_id", "'error' AS event_type", "CAST(NULL AS DOUBLE) AS value", "CAST(NULL AS STRING) AS props")
    parts = [plain.where(F.col("event_id") % 3 == i) for i in range(3)] + [closing.select(plain.columns)]
    path = run_folder(spark, "arriving")

    def run():
        events = s.with_event_time(spark.readStream.schema(plain.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*"), "ts", "3650 days")
        found = s.detect_stream(events, rules, ["ts", "user_id"])
        s.append_to(s.spans(found, rules, "ts", 3, "user_id"), f"{out}/out", f"{out}/checkpoint")

    s.arriving(parts, path, run)
    rows = spark.read.schema(f"rule_id string, user_id bigint, {s.SPANS}").parquet(f"{out}/out")
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return rows.select("rule_id", "user_id", at("span_start"), at("span_end"))


# Rows in three files: the first holds the events up to a day, the second later ones, the third late ones of every day.
LATE = "event_id % 10 = 7"
SQL_ARRIVALS = f"""SELECT *, CASE WHEN {LATE} THEN 2 WHEN ts < mid THEN 0 ELSE 1 END AS part FROM events, (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) AS mid, max(CASE WHEN {LATE} THEN NULL ELSE ts END) AS latest FROM events) m"""


@query(
    "stream_late",
    f"""WITH a AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS w, part = 2 AND time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= latest - INTERVAL 2 DAY AS late FROM ({SQL_ARRIVALS}))
        SELECT CASE WHEN late THEN 'late' ELSE 'counted' END AS kind, strftime(w, '%Y-%m-%d') AS day, event_type, n, CASE WHEN late THEN ids END AS ids
        FROM (SELECT late, w, event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM a GROUP BY ALL)""",
)
def stream_late(spark, folder):
    """Counts per day and type, and what came too late for them, over three micro-batches with a restart between the last two."""
    events = table(spark, folder, "events")
    mid = events.select(F.timestamp_micros(F.floor((F.min(F.unix_micros(F.col("ts").cast("timestamp"))) + F.max(F.unix_micros(F.col("ts").cast("timestamp")))) / 2))).scalar()
    at = F.col("ts").cast("timestamp")
    rows = events.select("event_id", at.alias("ts"), "event_type")
    early = F.col("ts") < mid
    parts = [rows.where(early & ~F.expr(LATE)), rows.where(~early & ~F.expr(LATE)), rows.where(LATE)]
    path, out = run_folder(spark, "arriving"), run_folder(spark, "late")

    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
        s.counts_and_late(stream, "ts", "2 days", "1 day", out, "event_type")

    s.arriving(parts, path, run)
    counted = s.window_totals(spark, out, "event_type string", "event_type")
    late = s.late_table(spark, out, rows.schema).groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias("day")
    return counted.select(F.lit("counted").alias("kind"), day("window_start"), "event_type", F.col("matches").alias("n"), F.lit(None).cast("bigint").alias("ids")).unionByName(
        late.select(F.lit("late").alias("kind"), day("day"), "event_type", "n", "ids")
    )


@query(
    "stream_dedup",
    "SELECT DISTINCT user_id, event_type, CASE WHEN user_id % 3 > 0 THEN 9007199254740993 + user_id END AS big FROM events",
)
def stream_dedup(spark, folder):
    """First event per user and type; the watermark spans the table, so each pair is kept once. Big integers beside NULLs stay exact."""
    big = F.when(F.col("user_id") % 3 > 0, F.lit(9007199254740993) + F.col("user_id")).alias("big")
    events = event_stream(spark, folder, "3650 days").select("ts", "user_id", "event_type", big)
    return s.run_appended(spark, s.drop_repeats(events, ["user_id", "event_type"]), "dedup").select("user_id", "event_type", "big")


@query(
    "stream_ingest",
    """SELECT event_type, count(*) FILTER (event_id % 17 > 4) AS good, count(*) FILTER (event_id % 17 IN (0, 1, 3, 4)) AS bad
       FROM events WHERE event_id % 17 <> 2 GROUP BY event_type""",
)
def stream_ingest(spark, folder):
    """Lines in four text files, one per micro-batch with a restart; documents and refused lines go to two tables, each with its event's type."""
    # The type stands before the line, so that refused lines, which are no documents, can be told apart.
    lines = table(spark, folder, "events").selectExpr("event_id", f"event_type || chr(9) || {LINE} AS line").where("line IS NOT NULL")
    out = run_folder(spark, "ingest")

    def run(path):
        read = stream_event_lines(spark, f"{path}/*", "*.txt", 1)
        split = read.select(F.split("line", "\t").getItem(0).alias("event_type"), F.expr("substr(line, instr(line, chr(9)) + 1)").alias("line"))
        s.ingest(split, LINE_SCHEMA, f"{out}/good", f"{out}/bad", f"{out}/checkpoint", ["event_type"])

    in_files(spark, folder, lines, run, kind="text")
    good = spark.read.parquet(f"{out}/good").groupBy("event_type").agg(F.count("*").alias("good"))
    bad = spark.read.parquet(f"{out}/bad").groupBy("event_type").agg(F.count("*").alias("bad"))
    none = F.lit(0).cast("bigint")
    return good.join(bad, "event_type", "full_outer").select("event_type", F.coalesce("good", none).alias("good"), F.coalesce("bad", none).alias("bad"))
