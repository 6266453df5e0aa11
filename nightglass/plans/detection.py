"""Queries of the detection core: rules over events, limits, expectations, indicators."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightglass.functions.text import unescape, with_once
from nightglass.operators import detect as d
from nightglass.operators import expect, indicators
from nightglass.operators.rules import Profile, compile_rules, conversion_results, rules_table, shared_documents
from nightglass.plans import standins as st
from nightglass.plans.registry import query, spread_table, table
from nightglass.session import local_table, run_folder
from nightglass.sinks.artifacts import write_layout
from nightglass.sources.events import parse_open_events


def event_view(spark: SparkSession, folder: str) -> DataFrame:
    """Driver events under event field names. Only the columns a query uses are read."""
    events = with_once(table(spark, folder, "events"), port=F.get_json_object("props", "$.k").try_cast("int"))
    port = F.col("port")
    return events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("event.action"),
        F.col("user_id").alias("user.id"),
        port.alias("destination.port"),
        F.concat_ws(".", F.lit("10"), port, F.col("user_id") % 256, F.col("event_id") % 256).alias("source.ip"),
    )


EV = """(SELECT event_id, ts, event_type, user_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS port,
  user_id % 256 AS ip3, concat_ws('.', '10', json_extract_string(props, '$.k'), user_id % 256, event_id % 256) AS ip
  FROM events) e"""


def rule(rule_id: str, condition: str = "selection", logsource: dict | None = None, targets=None, **selections) -> dict:
    doc = {"id": rule_id, "detection": {**selections, "condition": condition}}
    if logsource:
        doc["logsource"] = logsource
    if targets is not None:
        doc["conversion_targets"] = targets
    return doc


# Each rule with the SQL predicate it must equal over EV.
RULES = [
    (rule("action_equals", selection={"event.action": "PURCHASE"}), "lower(event_type) = 'purchase'"),
    (rule("port_list", selection={"destination.port": [22, 53, 99]}), "port IN (22, 53, 99)"),
    (rule("error_low_port", selection={"event.action|startswith": "err", "destination.port|lt": 10}),
     "starts_with(event_type, 'err') AND port < 10"),
    (rule("not_click", "not selection", selection={"event.action": "click"}), "event_type <> 'click'"),
    (rule("one_of", "1 of sel_* and not filter", sel_a={"event.action": "signup"}, sel_b=[{"destination.port": 7}, {"user.id": 3}],
          filter={"destination.port|gte": 50}), "(event_type = 'signup' OR port = 7 OR user_id = 3) AND NOT port >= 50"),
    (rule("all_of", "all of them", sel_a={"event.action|contains": "c"}, sel_b={"destination.port|gt": 90}),
     "contains(event_type, 'c') AND port > 90"),
    (rule("wildcard", selection={"event.action": "*ur?hase"}), "event_type LIKE '%ur_hase'"),
    (rule("pattern", selection={"event.action|re": "^s[a-z]+p$"}), "regexp_matches(event_type, '^s[a-z]+p$')"),
    (rule("contains_all", selection={"event.action|contains|all": ["i", "w"]}), "contains(event_type, 'i') AND contains(event_type, 'w')"),
    (rule("network", selection={"source.ip|cidr": ["10.64.0.0/10", "10.5.128.0/17"]}), "port >= 64 OR (port = 5 AND ip3 >= 128)"),
    (rule("absent_field", "not selection", selection={"process.name": "x"}), "TRUE"),
    (rule("null_value", selection={"process.name": None}), "TRUE"),
    (rule("keyword", "words", words=["lick", "10.42."]), "contains(event_type, 'lick') OR contains(ip, '10.42.')"),
    (rule("keyword_wild", "words", words=["*ur?hase*", "no*such*thing"]), "event_type LIKE '%ur_hase%'"),
    (rule("keyword_pattern", "words", words={"|re": "^s[a-z]+p$"}), "regexp_matches(event_type, '^s[a-z]+p$')"),
    (rule("keyword_cased", "words", words={"|cased": ["PURCHASE", "GNU", "ick"]}), "contains(event_type, 'ick')"),
    (rule("has_field", selection={"destination.port|exists": True, "process.name|exists": False}), "port IS NOT NULL"),
    (rule("pattern_flags", selection={"event.action|re|i": "^S[A-Z]+P$"}), "regexp_matches(event_type, '^s[a-z]+p$')"),
    (rule("same_field", selection={"event.action|fieldref": "event.action"}), "event_type IS NOT NULL"),
    (rule("other_field", selection={"user.id|fieldref": "destination.port"}), "user_id = port"),
    (rule("dashed", "1 of sel-*", **{"sel-a": {"event.action|windash|contains": ["x -click"]}, "sel-b": {"destination.port": 8}}), "port = 8"),
    (rule("never", selection={"event.action": "no such action"}), "FALSE"),
]
DOCS = [doc for doc, _ in RULES]
# Rules that do not become a query, with the reason.
UNUSABLE = [
    (rule("bad_modifier", selection={"event.action|lookup": "x"}), "unsupported modifier: lookup"),
    (rule("bad_word", "selection and other", selection={"event.action": "click"}), "unknown word in condition: other"),
    (rule("null_keyword", "words", words=["lick", None]), "keyword must not be null"),
    (rule("bad_pattern", selection={"event.action|re": "["}), "bad regular expression: ["),
    (rule("no_selection", "1 of other*", selection={"event.action": "click"}), "no selection matches: 1 of other*"),
]


def sql_matches(columns: str = "event_id") -> str:
    return " UNION ALL ".join(f"SELECT {columns}, '{doc['id']}' AS rule_id FROM {EV} WHERE {sql}" for doc, sql in RULES)


def compiled(spark: SparkSession, events: DataFrame, docs=DOCS, profile: Profile = Profile(), field_map=None):
    return compile_rules(rules_table(spark, docs), events, profile, field_map)


def one_rule(spark, folder, doc: dict, keep=("event_id",)) -> DataFrame:
    events = event_view(spark, folder)
    return d.detect(events, compiled(spark, events, [doc]), list(keep))


def page_rule(spark, folder, doc: dict) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return d.detect(pages, compiled(spark, pages, [doc]), ["page_id"])


@query("detect_equals", "SELECT event_id, 'r' AS rule_id FROM events WHERE lower(event_type) = 'purchase'")
def detect_equals(spark, folder):
    return one_rule(spark, folder, rule("r", selection={"event.action": "Purchase"}))


@query("detect_contains", "SELECT page_id, 'r' AS rule_id FROM pages WHERE contains(lower(url), 'example.org')")
def detect_contains(spark, folder):
    return page_rule(spark, folder, rule("r", selection={"url|contains": "EXAMPLE.org"}))


@query("detect_endswith", "SELECT page_id, 'r' AS rule_id FROM pages WHERE suffix(url, '/')")
def detect_endswith(spark, folder):
    return page_rule(spark, folder, rule("r", selection={"url|endswith": "/"}))


@query("detect_selection", f"SELECT event_id, 'r' AS rule_id FROM {EV} WHERE event_type = 'error' AND port = 69 AND user_id < 500")
def detect_selection(spark, folder):
    return one_rule(spark, folder, rule("r", selection={"event.action": "error", "destination.port": 69, "user.id|lt": 500}))


@query(
    "detect_condition",
    f"SELECT event_id, 'r' AS rule_id FROM {EV} WHERE (event_type = 'error' OR port = 1) AND NOT (user_id = 5 OR port > 80)",
)
def detect_condition(spark, folder):
    doc = rule(
        "r", "(a or b) and not (c or d)", a={"event.action": "error"}, b={"destination.port": 1},
        c={"user.id": 5}, d={"destination.port|gt": 80},
    )
    return one_rule(spark, folder, doc)


@query(
    "detect_not_nullsafe",
    """SELECT d.doc_id, 'not_good' AS rule_id FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE NOT coalesce(l.quality = 1, FALSE)
       UNION ALL SELECT d.doc_id, 'not_either' FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE NOT (coalesce(l.quality = 1, FALSE) OR coalesce(l.toxic = 1, FALSE))""",
)
def detect_not_nullsafe(spark, folder):
    joined = table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels"), "doc_id", "left")
    docs = [
        rule("not_good", "not selection", selection={"quality": 1}),
        rule("not_either", "not (good or bad)", good={"quality": 1}, bad={"toxic": 1}),
    ]
    return d.detect(joined, compiled(spark, joined, docs), ["doc_id"])


@query("detect_modifiers", sql_matches())
def detect_modifiers(spark, folder):
    events = event_view(spark, folder)
    return d.detect(events, compiled(spark, events), ["event_id"])


def many(spark, folder):
    events = event_view(spark, folder)
    rules = compiled(spark, events)
    return d.detect(events, rules, ["event_id", "ts"]), rules


SQL_COUNTS = " UNION ALL ".join(f"SELECT '{doc['id']}' AS rule_id, count(*) AS total_hits FROM {EV} WHERE {sql}" for doc, sql in RULES)


@query("detect_many_rules", SQL_COUNTS)
def detect_many_rules(spark, folder):
    return d.count_matches(*many(spark, folder))


@query(
    "detect_table_rules",
    f"SELECT n_name AS rule_id, count(event_id) AS total_hits FROM nation LEFT JOIN {EV} ON port = n_nationkey GROUP BY n_name",
)
def detect_table_rules(spark, folder):
    """One rule per nation row: the rules themselves come from a table."""
    selection = F.struct(F.struct(F.col("n_nationkey").alias("destination.port")).alias("selection"), F.lit("selection").alias("condition"))
    rules = table(spark, folder, "nation").select(
        F.col("n_name").alias("rule_id"), F.to_json(F.struct(selection.alias("detection"))).alias("rule_json")
    )
    events = event_view(spark, folder)
    usable = compile_rules(rules, events)
    return d.count_matches(d.detect(events, usable, ["event_id"]), usable)


FIELD_MAP = [
    ("named", "EventAction", "event.action"), ("named", "DstPort", "destination.port"),
    ("named", "AnyNumber", "destination.port"), ("named", "AnyNumber", "user.id"),
]


@query(
    "detect_field_map",
    f"""SELECT 'named' AS profile, 'mapped' AS rule_id, count(*) AS total_hits FROM {EV} WHERE event_type = 'view' AND port = 12
        UNION ALL SELECT 'named', 'either', count(*) FROM {EV} WHERE event_type = 'view' AND (port = 7 OR user_id = 7)
        UNION ALL SELECT 'none', 'mapped', count(*) FROM {EV} WHERE event_type IS NULL AND port = 12
        UNION ALL SELECT 'none', 'either', count(*) FROM {EV} WHERE event_type IS NULL AND port = 7""",
)
def detect_field_map(spark, folder):
    events = event_view(spark, folder)
    field_map = local_table(spark, FIELD_MAP, "profile string, rule_field string, event_field string")
    docs = [rule("mapped", selection={"EventAction": "view", "DstPort": 12}), rule("either", selection={"EventAction": "view", "AnyNumber": 7})]
    parts = []
    for profile in (Profile("named"), Profile("none")):
        rules = compiled(spark, events, docs, profile, field_map)
        counts = d.count_matches(d.detect(events, rules, ["event_id"]), rules)
        parts.append(counts.select(F.lit(profile.name).alias("profile"), "rule_id", "total_hits"))
    return parts[0].unionByName(parts[1])


@query(
    "detect_nested",
    f"""SELECT event_id, 'path' AS rule_id FROM {EV} WHERE event_type = 'view' AND user_id % 100 IN (7, 8)
        UNION ALL SELECT event_id, 'absent' FROM {EV} WHERE user_id % 100 = 9""",
)
def detect_nested(spark, folder):
    """Rules on fields inside structs, as an unwrapped envelope holds them; a path that is not there is an absent field."""
    identity = F.struct(F.concat(F.lit("User"), F.col("`user.id`") % 100).alias("userName"), F.col("`event.action`").alias("kind"))
    events = event_view(spark, folder).select("event_id", F.struct(identity.alias("userIdentity")).alias("detail"), identity.alias("userIdentity"))
    docs = [
        rule("path", selection={"userIdentity.userName": ["user7", "USER8"], "detail.userIdentity.kind|startswith": "vi"}),
        rule("absent", "selection and not other", selection={"userIdentity.userName": "user9"}, other={"userIdentity.nothing": "x"}),
    ]
    return d.detect(events, compiled(spark, events, docs), ["event_id"])


# An event as an open document: dotted keys, nested objects, lists of values and of objects, numbers of several kinds.
OPEN = """'{"event.action":"' || event_type || '","net":{"ports":[' || user_id % 50 || ',' || event_id % 7 || '.0],"peer":{"name":"Host' || user_id % 9 || '"}},"users":[{"name":"u' || user_id % 20
  || '"},{"name":"root","uid":' || event_id % 3 || '}],"level":' || CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"7"' WHEN 2 THEN '7' ELSE 'true' END || '}'"""
OPEN_RULES = [
    (rule("dotted_key", selection={"doc.event.action": "ERROR"}), "event_type = 'error'"),
    (rule("nested", selection={"doc.net.peer.name|endswith": ["t3", "T4"]}), "user_id % 9 IN (3, 4)"),
    (rule("any_of_a_list", selection={"doc.net.ports": 5}), "user_id % 50 = 5 OR event_id % 7 = 5"),
    (rule("all_of_a_list", selection={"doc.net.ports|all": [5, 6]}), "(user_id % 50 = 5 OR event_id % 7 = 5) AND (user_id % 50 = 6 OR event_id % 7 = 6)"),
    (rule("number", selection={"doc.net.ports|gte": 48}), "user_id % 50 >= 48"),
    (rule("objects_in_a_list", selection={"doc.users.name": ["u7", "U8"], "doc.users.uid": 2}), "user_id % 20 IN (7, 8) AND event_id % 3 = 2"),
    (rule("text_and_number", selection={"doc.level": 7}), "event_id % 4 IN (1, 2)"),
    (rule("null_or_absent", "a and b", a={"doc.level": None}, b={"doc.nothing": None}), "event_id % 4 = 0"),
    (rule("exists", "a and not b", a={"doc.level|exists": True}, b={"doc.net.peer.no|exists": True}), "event_id % 4 <> 0"),
    (rule("map_key", selection={"tags.Kind.Of": "Err*", "tags.user|startswith": "1"}), "event_type = 'error' AND starts_with(CAST(user_id AS VARCHAR), '1')"),
    (rule("structs_in_an_array", selection={"peers.port|lt": 3, "peers.name|contains": "ick"}), "(user_id % 50 < 3 OR event_id % 7 < 3) AND event_type = 'click'"),
    (rule("values_of_an_array", "not selection", selection={"names": "view"}), "event_type <> 'view'"),
    (rule("negated", "not selection", selection={"doc.net.peer.name": "host1"}), "user_id % 9 <> 1"),
    (rule("compared", selection={"doc.users.name|fieldref": "tags.user_name"}), "user_id % 20 = event_id % 20"),
]


@query("detect_variant", " UNION ALL ".join(f"SELECT event_id, '{doc['id']}' AS rule_id FROM events WHERE {sql}" for doc, sql in OPEN_RULES))
def detect_variant(spark, folder):
    """Rules on fields of open documents (VARIANT, as parsed without a schema), maps, and arrays of structs; strict about absent fields."""
    lines = spread_table(spark, folder, "events").selectExpr("event_id", "user_id", "event_type", f"{OPEN} AS line")
    docs = parse_open_events(lines).where("ok")
    tags = F.create_map(F.lit("kind.of"), F.lit("none"), F.lit("Kind.Of"), "event_type", F.lit("user"), F.col("user_id").cast("string"), F.lit("user_name"), F.concat(F.lit("u"), F.col("event_id") % 20))
    peer = lambda port: F.struct(F.col("event_type").alias("name"), port.alias("port"))
    peers = F.array(peer(F.col("user_id") % 50), peer(F.col("event_id") % 7))
    events = docs.select("event_id", "doc", tags.alias("tags"), peers.alias("peers"), F.array(F.lit("x"), "event_type").alias("names"))
    return d.detect(events, compiled(spark, events, [doc for doc, _ in OPEN_RULES], Profile(missing="error")), ["event_id"])


# A command line in which a known text stands in base 64, behind text of 0 to 4 bytes.
COMMAND = "repeat('x', CAST(event_id % 5 AS INTEGER)) || event_type || ' /c start ' || user_id"
ENCODED_RULES = [
    (rule("offsets", selection={"plain|base64offset|contains": "purchase /c start"}), "event_type = 'purchase'"),
    (rule("offsets_cased", selection={"plain|cased|base64offset|contains": ["error /c", "Error /c"]}), "event_type = 'error'"),
    (rule("wide", selection={"wide|wide|base64offset|contains": "view /c start 1"}), "event_type = 'view' AND starts_with(CAST(user_id AS VARCHAR), '1')"),
    (rule("whole", selection={"plain|base64": "click /c start 7"}), "event_type = 'click' AND user_id = 7 AND event_id % 5 = 0"),
    (rule("expanded", selection={"text|expand|endswith": "%command% 9"}), "event_type IN ('click', 'view') AND user_id = 9"),
]


@query("detect_encoded", " UNION ALL ".join(f"SELECT event_id, '{doc['id']}' AS rule_id FROM events WHERE {sql}" for doc, sql in ENCODED_RULES))
def detect_encoded(spark, folder):
    """Values that events hold in base 64, at any offset and as UTF-16, and values from placeholders."""
    text = F.expr(COMMAND)
    events = table(spark, folder, "events").select(
        "event_id", text.alias("text"), F.base64(F.encode(text, "UTF-8")).alias("plain"),
        F.base64(F.concat(F.lit("ab").cast("binary"), F.encode(text, "UTF-16LE"))).alias("wide"),
    )
    profile = Profile(placeholders={"command": ["click /c start", "view /c start"]})
    return d.detect(events, compiled(spark, events, [doc for doc, _ in ENCODED_RULES], profile), ["event_id"])


ADDRESS = """CASE event_id % 4 WHEN 0 THEN '2001:DB8:' || user_id % 100 || '::' || event_id % 10 WHEN 1 THEN '2001:db8:0:0:' || user_id % 100 || ':0:0:1'
  WHEN 2 THEN '::ffff:10.0.' || user_id % 100 || '.1' ELSE '10.0.' || user_id % 100 || '.1' END"""
ADDRESS_RULES = [
    (rule("site", selection={"ip|cidr": "2001:db8::/32"}), "event_id % 4 IN (0, 1)"),
    (rule("subnet", selection={"ip|cidr": ["2001:db8:0042::/48", "2001:db8:0:0:43::/80"]}), "(event_id % 4 = 0 AND user_id % 100 = 42) OR (event_id % 4 = 1 AND user_id % 100 = 43)"),
    (rule("mapped", selection={"ip|cidr": "::ffff:10.0.64.0/115"}), "event_id % 4 = 2 AND user_id % 100 BETWEEN 64 AND 95"),
    (rule("old", selection={"ip|cidr": "10.0.64.0/19"}), "event_id % 4 = 3 AND user_id % 100 BETWEEN 64 AND 95"),
    (rule("none", "not selection", selection={"ip|cidr": ["::/0", "0.0.0.0/0"]}), "FALSE"),
]


@query("detect_networks", " UNION ALL ".join(f"SELECT event_id, '{doc['id']}' AS rule_id FROM events WHERE {sql}" for doc, sql in ADDRESS_RULES))
def detect_networks(spark, folder):
    """Networks of both address families, in any spelling of an address."""
    events = table(spark, folder, "events").selectExpr("event_id", f"{ADDRESS} AS ip")
    return d.detect(events, compiled(spark, events, [doc for doc, _ in ADDRESS_RULES]), ["event_id"])


CASED = "CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END"
SQL_CASES = " UNION ALL ".join(
    f"SELECT '{case}' AS profile, '{name}' AS rule_id, count(*) AS total_hits FROM events WHERE {sql}"
    for case, name, sql in (
        ("exact", "whole", "event_type = 'error' AND event_id % 2 = 0"), ("exact", "part", "contains(event_type, 'ick') AND event_id % 2 = 1"),
        ("insensitive", "whole", "event_type = 'error'"), ("insensitive", "part", "contains(event_type, 'ick')"),
        ("lowered", "whole", "event_type = 'error'"), ("lowered", "part", "contains(event_type, 'ick')"),
    )
)


@query("detect_cases", SQL_CASES)
def detect_cases(spark, folder):
    """The same rules under every case policy; `lowered` reads a column that holds lower-case text."""
    events = table(spark, folder, "events").selectExpr("event_id", f"{CASED} AS `event.action`", "event_type")
    docs = [rule("whole", selection={"event.action": "ERROR"}), rule("part", selection={"event.action|contains": "ick"})]
    lowered = events.select("event_id", F.col("event_type").alias("event.action"))
    parts = []
    for case, side in (("exact", events), ("insensitive", events), ("lowered", lowered)):
        rules = compiled(spark, side, docs, Profile(case=case))
        parts.append(d.count_matches(d.detect(side, rules, ["event_id"]), rules).select(F.lit(case).alias("profile"), "rule_id", "total_hits"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SHARED_TYPES = st.texts("s_suppkey", ["purchase", "error", "view", "click", "signup"])


@query(
    "detect_shared_tests",
    f"""SELECT 's' || s_suppkey AS rule_id, count(event_id) AS total_hits FROM (SELECT s_suppkey, s_suppkey % 100 AS p, {SHARED_TYPES} AS t FROM supplier) s
        LEFT JOIN {EV} ON CASE s_suppkey % 3 WHEN 0 THEN port = p AND event_type <> t WHEN 1 THEN (port = p AND event_type = t) OR (event_type = t AND user_id < 50) OR (port = p AND user_id < 50)
          ELSE port = p AND event_type = t AND user_id < 50 END GROUP BY s_suppkey""",
)
def detect_shared_tests(spark, folder):
    """A rule per supplier, on a hundred ports, five actions and one bound: its tests, and its documents, are made and evaluated once for all rules."""
    sel = F.struct(
        F.struct((F.col("s_suppkey") % 100).alias("destination.port")).alias("port"), F.struct(F.expr(SHARED_TYPES).alias("event.action")).alias("action"),
        F.struct(F.lit(50).alias("user.id|lt")).alias("user"),
        F.when(F.col("s_suppkey") % 3 == 0, "port and not action").when(F.col("s_suppkey") % 3 == 1, "2 of them").otherwise("all of them").alias("condition"),
    )
    rules = table(spark, folder, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("rule_id"), F.to_json(F.struct(sel.alias("detection"))).alias("rule_json"))
    events = event_view(spark, folder)
    documents, members = shared_documents(rules)
    usable = compile_rules(documents, events)
    return d.count_members(d.count_matches(d.detect(events, usable, ["event_id"]), usable), members)


@query("detect_routed", f"SELECT event_id, 'r' AS rule_id FROM {EV} WHERE event_type = 'error' AND port < 50")
def detect_routed(spark, folder):
    """The events are laid out by the routing column first; the route of the rule prunes partitions."""
    path = run_folder(spark, "routed")
    write_layout(event_view(spark, folder).select("event_id", "ts", F.col("`event.action`").alias("action"), F.col("`destination.port`").alias("port")), path, ["action"], ["port", "ts"])
    events = spark.read.parquet(path)
    profile = Profile(route={"category": ("action", {"failures": "error"})})
    doc = rule("r", logsource={"category": "failures"}, selection={"port|lt": 50})
    return d.detect(events, compiled(spark, events, [doc], profile), ["event_id"])


@query(
    "value_unescape",
    r"""SELECT p_partkey, 'C:\' || replace(p_name, ' ', '\') || '*' AS value FROM part""",
)
def value_unescape(spark, folder):
    raw = F.concat(F.lit("C:\\\\"), F.replace("p_name", F.lit(" "), F.lit("\\\\")), F.lit("\\*"))
    return table(spark, folder, "part").select("p_partkey", unescape(raw).alias("value"))


@query(
    "indicator_equals",
    f"""SELECT e.event_id, 'user.id' AS field, CAST(e.user_id AS VARCHAR) AS value, p_partkey AS indicator_id
        FROM {EV} JOIN part ON p_partkey % 2 = 0 AND p_partkey = user_id
        UNION ALL SELECT e.event_id, 'destination.port', CAST(port AS VARCHAR), p_partkey
        FROM {EV} JOIN part ON p_partkey % 2 = 1 AND p_partkey = port""",
)
def indicator_equals(spark, folder):
    listed = table(spark, folder, "part").select(
        F.col("p_partkey").alias("indicator_id"),
        F.when(F.col("p_partkey") % 2 == 0, "user.id").otherwise("destination.port").alias("field"),
        F.col("p_partkey").cast("string").alias("value"),
    )
    values = indicators.field_values(event_view(spark, folder), ["event_id"], ["user.id", "destination.port"])
    return indicators.match_equal(values, listed, ["event_id"])


@query(
    "indicator_contains",
    """SELECT page_id, 'url' AS field, s_suppkey AS indicator_id FROM pages JOIN supplier
       ON contains(lower(url), '/' || CAST(s_suppkey AS VARCHAR))""",
)
def indicator_contains(spark, folder):
    pages = indicators.field_values(table(spark, folder, "pages"), ["page_id"], ["url"])
    listed = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("indicator_id"), F.lit("url").alias("field"),
        F.concat(F.lit("/"), F.col("s_suppkey")).alias("pattern"),
    )
    return indicators.match_contained(pages, listed, ["page_id"])


FIRST = f"""SELECT rule_id, event_id, row_no FROM (SELECT rule_id, event_id,
  CAST(row_number() OVER (PARTITION BY rule_id ORDER BY ts, event_id) AS INTEGER) AS row_no FROM ({sql_matches('event_id, ts')}))"""


@query("limit_per_rule", f"{FIRST} WHERE row_no <= 1000")
def limit_per_rule(spark, folder):
    matches, _ = many(spark, folder)
    return d.first_matches(matches, 1000, ["ts", "event_id"]).select("rule_id", "event_id", "row_no")


@query("limit_large", f"{FIRST} WHERE row_no <= 50000")
def limit_large(spark, folder):
    matches, _ = many(spark, folder)
    return d.first_matches(matches, 50_000, ["ts", "event_id"]).select("rule_id", "event_id", "row_no")


@query("sample_rows", f"{FIRST} WHERE row_no <= 5")
def sample_rows(spark, folder):
    matches, _ = many(spark, folder)
    return d.sample_matches(matches, 5, ["ts", "event_id"]).select("rule_id", "event_id", "row_no")


@query("row_counts", f"SELECT rule_id, total_hits, least(total_hits, 1000) AS returned_rows FROM ({SQL_COUNTS})")
def counts_and_returned(spark, folder):
    return d.row_counts(d.count_matches(*many(spark, folder)), 1000)


# (backend, key, min, max): by path, by name, without a bound, and one that misses.
EXPECTED = [
    ("spark", "output/spark/action_equals.sql", 1, None),
    ("spark", "port_list.sql", 5, 10),
    ("spark", "never.sql", 1, None),
    ("spark", "output/spark/not_click.sql", None, 3),
    ("spark", "not_click.sql", 0, None),
    ("spark", "output/spark/pattern.sql", None, None),
]
SQL_EXPECTED = ", ".join(f"('{k}', {'NULL' if a is None else a}, {'NULL' if b is None else b})" for _, k, a, b in EXPECTED)
SQL_CHECK = f"""SELECT query_path, total_hits, error, error IS NULL AS passed FROM (
  SELECT c.query_path, total_hits, CASE
    WHEN p.k IS NULL AND n.k IS NULL THEN NULL
    WHEN total_hits < coalesce(CASE WHEN p.k IS NOT NULL THEN p.lo ELSE n.lo END, 0)
      THEN 'expected >= ' || coalesce(CASE WHEN p.k IS NOT NULL THEN p.lo ELSE n.lo END, 0) || ', got ' || total_hits
    WHEN total_hits > CASE WHEN p.k IS NOT NULL THEN p.hi ELSE n.hi END
      THEN 'expected <= ' || CASE WHEN p.k IS NOT NULL THEN p.hi ELSE n.hi END || ', got ' || total_hits END AS error
  FROM (SELECT 'output/spark/' || rule_id || '.sql' AS query_path, rule_id || '.sql' AS name, total_hits FROM ({SQL_COUNTS})) c
  LEFT JOIN (VALUES {SQL_EXPECTED}) p(k, lo, hi) ON p.k = c.query_path
  LEFT JOIN (VALUES {SQL_EXPECTED}) n(k, lo, hi) ON n.k = c.name)"""


def checked(spark, folder) -> DataFrame:
    counts = d.count_matches(*many(spark, folder))
    results = counts.select(F.concat(F.lit("output/spark/"), "rule_id", F.lit(".sql")).alias("query_path"), "total_hits")
    expected = local_table(spark, EXPECTED, "backend string, query_key string, min_rows bigint, max_rows bigint")
    return expect.check(results, expected, "spark")


@query("expectation_check", SQL_CHECK)
def expectation_check(spark, folder):
    return checked(spark, folder)


SQL_UNUSABLE = " UNION ALL ".join(f"SELECT '{doc['id']}' AS rule_id, '{error}' AS error" for doc, error in UNUSABLE)
SQL_RUN = f"""SELECT rule_id, TRUE AS compile_ok, error IS NULL AS exec_ok, total_hits, least(total_hits, 1000) AS returned_rows, error IS NULL AS passed,
  CASE WHEN error IS NOT NULL THEN rule_id || ': ' || error END AS stage_error FROM (SELECT *, regexp_extract(query_path, '([^/]*)[.]sql$', 1) AS rule_id FROM ({SQL_CHECK}))
  UNION ALL SELECT rule_id, FALSE, FALSE, 0, 0, FALSE, rule_id || ': compile failed: ' || error FROM ({SQL_UNUSABLE})"""
DURATION = "total_hits % 97 + length(rule_id)"


def whole_run(spark, folder) -> DataFrame:
    """Good and unusable rules, compiled and executed, with the expectations of their files."""
    events = event_view(spark, folder)
    rules = compiled(spark, events, DOCS + [doc for doc, _ in UNUSABLE])
    expected = local_table(spark, EXPECTED, "backend string, query_key string, min_rows bigint, max_rows bigint").where("backend = 'spark'")
    return expect.run_rules(events, rules, ["event_id"], "both", 1000, expected, "output/spark")


@query(
    "run_summary",
    f"""SELECT count(*) AS files_checked, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
        count(*) FILTER (NOT compile_ok) AS compile_failures, count(*) FILTER (NOT exec_ok) AS execution_failures, sum({DURATION})::BIGINT AS duration_ms,
        CASE WHEN bool_and(passed) THEN 'success' ELSE 'failure' END AS status FROM ({SQL_RUN})""",
)
def run_summary(spark, folder):
    """Durations stand in for measured ones, so that both sides know them."""
    return expect.run_summary(whole_run(spark, folder).withColumn("duration_ms", F.expr(DURATION).cast("bigint")))


@query(
    "stage_rollup",
    """SELECT stage, backend, count(*) AS jobs, count(*) FILTER (status <> 'success') AS failures, sum(matches)::BIGINT AS matches,
       GROUPING(stage, backend)::INTEGER AS level FROM (SELECT event_type AS stage,
       CASE user_id % 3 WHEN 0 THEN 'splunk' WHEN 1 THEN 'kql' ELSE 'elasticsearch' END AS backend,
       CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS matches FROM events) GROUP BY ROLLUP (stage, backend)""",
)
def stage_rollup(spark, folder):
    events = event_view(spark, folder)
    backend = F.when(F.col("`user.id`") % 3 == 0, "splunk").when(F.col("`user.id`") % 3 == 1, "kql").otherwise("elasticsearch")
    results = events.select(
        F.col("`event.action`").alias("stage"),
        backend.alias("backend"),
        F.when(F.col("`event.action`") == "error", "failure").otherwise("success").alias("status"),
        F.col("`destination.port`").alias("matches"),
    )
    return expect.workflow_summary(results)


@query("compile_check", SQL_RUN)
def compile_check(spark, folder):
    return whole_run(spark, folder).drop("warning")


FAULTS = [
    ("no_document", None, "rule document is missing"),
    ("not_json", "{", None),
    ("not_a_rule", "[1]", "rule must be a mapping"),
    ("bad_regex", json.dumps(rule("bad_regex", selection={"event.action|re": "["})), "bad regular expression: ["),
    ("twice", json.dumps(rule("twice", selection={"event.action": "click"})), "rule id is used 2 times: twice"),
    ("twice", json.dumps(rule("twice", selection={"destination.port": 3})), "rule id is used 2 times: twice"),
    ("good", json.dumps(rule("good", selection={"event.action": "click"})), ""),
    ("also_good", json.dumps(rule("also_good", "not s", s={"destination.port|lt": 50})), ""),
]


@query(
    "compile_faults",
    """SELECT * FROM (VALUES ('no_document', 'rule document is missing', 0), ('not_a_rule', 'rule must be a mapping', 0), ('not_json', 'no JSON', 0),
         ('bad_regex', 'bad regular expression: [', 0), ('twice', 'rule id is used 2 times: twice', 0), ('twice', 'rule id is used 2 times: twice', 0)) v(rule_id, error, total_hits)
       UNION ALL SELECT 'good', '', count(*) FILTER (event_type = 'click') FROM events
       UNION ALL SELECT 'also_good', '', count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50) FROM events""",
)
def compile_faults(spark, folder):
    """Rules that cannot be compiled stand beside good ones and harm none of them."""
    events = event_view(spark, folder)
    listed = local_table(spark, [f[:2] for f in FAULTS], "rule_id string, rule_json string")
    rules = compile_rules(listed, events)
    outcome = conversion_results(spark, rules).select("rule_id", F.when(F.col("rule_id") == "not_json", "no JSON").otherwise(F.col("error")).alias("error"))
    hits = d.detect(events, rules, ["event_id"]).groupBy("rule_id").agg(F.count("*").alias("hits"))
    return outcome.join(hits, "rule_id", "left").select("rule_id", "error", F.coalesce("hits", F.lit(0).cast("bigint")).alias("total_hits"))


SKIPPED = rule("other_target", targets=[" KQL ", ""], selection={"event.action": "view"})
TARGETED = rule("own_target", targets=["Spark"], selection={"event.action": "view"})
MISSING = rule("missing_field", selection={"process.name": "x"})


@query(
    "rule_compile",
    f"""SELECT rule_id, 'failed' AS status, error, '' AS skipped_reason, 0 AS total_hits FROM ({SQL_UNUSABLE})
        UNION ALL SELECT 'missing_field', 'failed', 'unknown field: process.name', '', 0
        UNION ALL SELECT 'other_target', 'skipped', '', 'target not selected', 0
        UNION ALL SELECT 'own_target', 'success', '', '', count(*) FROM events WHERE event_type = 'view'""",
)
def rule_compile(spark, folder):
    """Conversion outcome per rule under the strict missing-field policy, and hits of those that convert."""
    events = event_view(spark, folder)
    docs = [doc for doc, _ in UNUSABLE] + [SKIPPED, TARGETED, MISSING]
    rules = compiled(spark, events, docs, Profile(missing="error"))
    outcome = conversion_results(spark, rules)
    wanted = [r for r in rules if r.targets is None or "spark" in r.targets]
    counts = d.count_matches(d.detect(events, wanted, ["event_id"]), rules)
    return outcome.join(counts, "rule_id").select("rule_id", "status", "error", "skipped_reason", "total_hits")
