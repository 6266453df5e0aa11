"""Detection rules as tables, compiled into one dictionary of tests and a condition per rule.

A rule row is (rule_id, rule_json). Rules are taken apart by columns (VARIANT and array functions): every value
test gets a name, the digest of its field, modifiers and value, and every condition becomes a Boolean text over these names. Equal tests of
different rules share a name, so each is made once and, in `detect`, evaluated once per event. Only rules are ever
brought to the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightglass.functions.text import once
from nightglass.operators.fields import column
from nightglass.operators.values import Profile, Test, make_test
from nightglass.session import local_table

# Keys of a detection map that are not selections.
RESERVED = ("condition", "timeframe")
# Tests analysed in one go; a chunk that fails is halved.
TESTS_PER_ANALYSIS = 256
# A test's name inside a condition.
NAMED = re.compile(r"\{([0-9a-f]{32})\}")
# Keeps the parts of `2 of sel*` together as one word of a condition.
GLUE = "\u0001"


@dataclass(frozen=True)
class CompiledRule:
    """`sql` stands alone. `condition` is the same over the names of `tests`, which rules share; it is empty for a rule
    that is given by its SQL."""

    rule_id: str
    sql: str
    error: str = ""
    fields: tuple = ()
    condition: str = ""
    tests: tuple = ()
    timeframe: str = ""
    targets: tuple | None = None


def rules_table(spark: SparkSession, rules: Iterable[dict]) -> DataFrame:
    """Rules given as mappings, as (rule_id, rule_json)."""
    rows = [(str(r.get("id") or r.get("title")), json.dumps(r, default=str)) for r in rules]
    return local_table(spark, rows, "rule_id string, rule_json string")


def _list_of(value: Column) -> Column:
    """The elements of a VARIANT list, or the value alone."""
    return F.coalesce(value.try_cast("array<variant>"), F.array(value))


def _values(value: Column) -> Column:
    listed = F.transform(_list_of(value), lambda v: F.struct(F.schema_of_variant(v).alias("kind"), v.try_cast("string").alias("text")))
    return F.when(F.size(listed) > 0, listed).otherwise(F.array(F.struct(F.lit("EMPTY").alias("kind"), F.lit(None).cast("string").alias("text"))))


def _items(part: Column) -> Column:
    """Entries {field, modifiers, values} of one alternative; a bare value or list of them (keywords) has an empty field."""
    entries = F.coalesce(F.map_entries(part.try_cast("map<string,variant>")), F.array(F.struct(F.lit("").alias("key"), part.alias("value"))))
    words = lambda e: F.split(e["key"], r"\|")
    return F.transform(
        entries,
        lambda e: F.struct(
            F.get(words(e), F.lit(0)).alias("field"),
            F.transform(F.slice(words(e), 2, F.size(words(e))), F.lower).alias("modifiers"),
            _values(e["value"]).alias("values"),
        ),
    )


def _selections(detection: Column) -> Column:
    """Selections {name, alternatives}: items of an alternative are joined by AND, alternatives by OR. Empty ones drop out."""
    entries = F.filter(F.map_entries(detection), lambda e: ~e["key"].isin(*RESERVED))
    made = F.transform(
        entries,
        lambda e: F.struct(e["key"].alias("name"), F.filter(F.transform(_list_of(e["value"]), _items), lambda a: F.size(a) > 0).alias("alternatives")),
    )
    return F.filter(made, lambda s: F.size(s["alternatives"]) > 0)


def rule_parts(rules: DataFrame) -> DataFrame:
    """The rows of rules with `doc`, the document as VARIANT, and its `selections`."""
    parsed = rules.withColumn("doc", F.try_parse_json("rule_json"))
    return parsed.withColumn("selections", _selections(F.try_variant_get("doc", "$.detection", "map<string,variant>")))


def rule_predicates(rules: DataFrame) -> DataFrame:
    """(rule_id, selection, alternative, item, field, modifiers, values[{kind, text}]), one row per entry of a rule."""
    selections = rule_parts(rules).select("rule_id", F.explode("selections").alias("s")).select("rule_id", F.col("s.name").alias("selection"), F.posexplode("s.alternatives").alias("alternative", "a"))
    return selections.select("rule_id", "selection", "alternative", F.posexplode("a").alias("item", "i")).select("rule_id", "selection", "alternative", "item", "i.*")


def map_fields(predicates: DataFrame, field_map: DataFrame, profile: str) -> DataFrame:
    """Rename rule fields by field_map(profile, rule_field, event_field); others keep their name.

    A rule field with several event fields gives a row of the same item for each; any of them may match.
    """
    wanted = field_map.where(F.col("profile") == profile).select(F.col("rule_field").alias("field"), "event_field").distinct()
    joined = predicates.join(wanted, "field", "left")
    return joined.withColumn("field", F.coalesce("event_field", "field")).drop("event_field").select(*predicates.columns)


# ---- tests and selections by columns -------------------------------------------------------------


def _test_name(field: Column, modifiers: Column, value: Column) -> Column:
    return F.md5(F.to_json(F.struct(field.alias("f"), modifiers.alias("m"), value["kind"].alias("k"), value["text"].alias("t"))))


def _mapped(field: Column, names: dict[str, list[str]]) -> Column:
    """The event fields of a rule field."""
    if not names:
        return F.array(field)
    table = F.from_json(F.lit(json.dumps(names)), "map<string,array<string>>")
    return F.coalesce(F.element_at(table, field), F.array(field))


def _all_tests(names: dict[str, list[str]]) -> Column:
    """Every test {name, field, modifiers, kind, text} of a rule's selections."""
    tests = lambda i, f: F.transform(i["values"], lambda v: F.struct(_test_name(f, i["modifiers"], v).alias("name"), f.alias("field"), i["modifiers"].alias("modifiers"), v["kind"].alias("kind"), v["text"].alias("text")))
    items = lambda i: F.flatten(F.transform(_mapped(i["field"], names), lambda f: tests(i, f)))
    return F.flatten(F.transform("selections", lambda s: F.flatten(F.transform(s["alternatives"], lambda a: F.flatten(F.transform(a, items))))))


def _joined(parts: Column, sign: str | Column) -> Column:
    """The parts in brackets, joined by a word."""
    sign = F.lit(sign) if isinstance(sign, str) else sign
    # Without array_join's constant delimiter: the word may differ by row.
    inner = F.aggregate(F.transform(parts, lambda p, i: F.concat(F.when(i > 0, F.concat(F.lit(") "), sign, F.lit(" ("))).otherwise(""), p)), F.lit(""), lambda a, p: F.concat(a, p))
    return F.concat(F.lit("("), inner, F.lit(")"))


def _selection_texts(names: dict[str, list[str]]) -> Column:
    """Map of selection name to its text over test names."""
    named = lambda i, f: F.transform(i["values"], lambda v: F.concat(F.lit("{"), _test_name(f, i["modifiers"], v), F.lit("}")))
    sign = lambda i: F.when(F.array_contains(i["modifiers"], "all"), F.lit("and")).otherwise(F.lit("or"))
    item = lambda i: _joined(F.transform(_mapped(i["field"], names), lambda f: _joined(named(i, f), sign(i))), "or")
    alternative = lambda a: _joined(F.transform(a, item), "and")
    return F.map_from_entries(F.transform("selections", lambda s: F.struct(s["name"].alias("k"), _joined(F.transform(s["alternatives"], alternative), "or").alias("v"))))


# ---- conditions by columns -----------------------------------------------------------------------

COUNTED = rf"(?i)^(\d+|any|all){GLUE}of{GLUE}(.+)$"


def _words(condition: Column) -> Column:
    """Brackets, words and counts of a condition; a count such as `1 of sel*` is one word."""
    glued = F.regexp_replace(condition, r"(?i)\b(\d+|any|all)\s+of\s+([^\s()]+)", f"$1{GLUE}of{GLUE}$2")
    return F.regexp_extract_all(glued, F.lit(r"[()]|[^\s()]+"), F.lit(0))


def _chosen(word: Column, texts: Column) -> Column:
    """The selections that a count speaks of."""
    pattern = F.regexp_extract(word, COUNTED, 2)
    names = F.map_keys(texts)
    like = F.concat(F.lit("^\\Q"), F.replace(pattern, F.lit("*"), F.lit("\\E.*\\Q")), F.lit("\\E$"))
    return F.when(F.lower(pattern) == "them", F.filter(names, lambda n: ~n.startswith("_"))).otherwise(F.filter(names, lambda n: F.rlike(n, like)))


def _word_kind(word: Column, texts: Column) -> Column:
    """s selection, c count, b and/or, n not, brackets as they are, ? anything else."""
    return (
        F.when(F.map_contains_key(texts, word), "s").when(word.rlike(COUNTED), "c").when(F.lower(word).isin("and", "or"), "b")
        .when(F.lower(word) == "not", "n").when(word.isin("(", ")"), word).otherwise("?")
    )


def _word_sql(word: Column, kind: Column, wrap: Column, texts: Column) -> Column:
    held = lambda name: F.when(wrap, F.concat(F.lit("coalesce("), F.element_at(texts, name), F.lit(", false)"))).otherwise(F.concat(F.lit("("), F.element_at(texts, name), F.lit(")")))
    number = F.lower(F.regexp_extract(word, COUNTED, 1))
    listed = lambda sign: F.concat(F.lit("("), F.array_join(F.transform(_chosen(word, texts), held), sign), F.lit(")"))
    ones = F.transform(_chosen(word, texts), lambda n: F.concat(F.lit("if("), F.element_at(texts, n), F.lit(", 1, 0)")))
    least = F.concat(F.lit("("), F.array_join(ones, " + "), F.lit(" >= "), number, F.lit(")"))
    counted = F.when(number == "all", listed(" and ")).when(number.isin("any", "1"), listed(" or ")).otherwise(least)
    return F.when(kind == "s", held(word)).when(kind == "c", counted).otherwise(F.lower(word))


def _syntax_ok(kinds: Column) -> Column:
    """True if operands and signs take turns and brackets match."""
    start = F.struct(F.lit(True).alias("operand"), F.lit(0).alias("depth"), F.lit(True).alias("ok"))

    def step(a: Column, k: Column) -> Column:
        fits = F.when(a["operand"], k.isin("s", "c", "n", "(")).otherwise(k.isin("b", ")"))
        depth = a["depth"] + F.when(k == "(", 1).when(k == ")", -1).otherwise(0)
        return F.struct(k.isin("b", "n", "(").alias("operand"), depth.alias("depth"), (a["ok"] & fits & (depth >= 0)).alias("ok"))

    return F.aggregate(kinds, start, step, lambda a: a["ok"] & ~a["operand"] & (a["depth"] == 0))


def condition_result(condition: Column, texts: Column) -> Column:
    """{sql, error} of one condition over a map of selection texts.

    A negated selection is wrapped so that an event without the field satisfies the negation; others stay bare so that the
    scan can use them. Any word that is no selection, count, sign or bracket is refused.
    """

    def judged(words: Column, kinds: Column) -> Column:
        # A count is a bracket: what is negated may be any selection in it.
        wrap_all = F.exists(F.arrays_zip(kinds.alias("k"), F.slice(kinds, 2, F.size(kinds)).alias("l")), lambda p: (p["k"] == "n") & p["l"].isin("(", "c"))
        wrap = lambda i: F.coalesce(wrap_all, F.lit(False)) | F.coalesce(F.get(kinds, i - 1) == "n", F.lit(False))
        sql = F.array_join(F.transform(words, lambda w, i: _word_sql(w, F.get(kinds, i), wrap(i), texts)), " ")
        lonely = F.get(F.filter(words, lambda w: w.rlike(COUNTED) & (F.size(_chosen(w, texts)) == 0)), F.lit(0))
        odd = F.get(F.filter(words, lambda w, i: F.get(kinds, i) == "?"), F.lit(0))
        error = (
            F.when(F.size(words) == 0, "condition is empty")
            .when(lonely.isNotNull(), F.concat(F.lit("no selection matches: "), F.replace(lonely, F.lit(GLUE), F.lit(" "))))
            .when(odd.isNotNull(), F.concat(F.lit("unknown word in condition: "), odd))
            .when(~_syntax_ok(kinds), F.concat(F.lit("[PARSE_SYNTAX_ERROR] condition is not well formed: "), condition))
        )
        return F.struct(sql.alias("sql"), error.alias("error"))

    return once(_words(condition), lambda words: once(F.transform(words, lambda w: _word_kind(w, texts)), lambda kinds: judged(words, kinds)))


def condition_sql(condition: str, selections: dict[str, str]) -> str:
    """Put the selections into the condition text. A ValueError says what is wrong with it."""
    spark = SparkSession.active()
    texts = F.from_json(F.lit(json.dumps(selections)), "map<string,string>")
    found = spark.range(1).select(condition_result(F.lit(condition), texts).alias("r")).first().r
    if found.error:
        raise ValueError(found.error)
    return found.sql


def _route(known_columns: Iterable[str], routes: dict) -> tuple[Column, Column]:
    """(SQL or NULL, error or NULL) of the routing condition of a rule's log source."""
    tests, errors = [], []
    for part, (name, values) in routes.items():
        wanted = F.try_variant_get("doc", f"$.logsource.{part}", "string")
        given = F.coalesce(wanted, F.lit("")) != ""
        known = F.coalesce(F.element_at(F.from_json(F.lit(json.dumps(values)), "map<string,string>"), wanted), wanted)
        quoted = F.concat(F.lit("'"), F.replace(F.replace(known, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))
        tests.append(F.when(given, F.concat(F.lit(f"{column(name)} = "), quoted)))
        if name not in known_columns:
            errors.append(F.when(given, F.lit(f"unknown routing column: {name}")))
    none = F.lit(None).cast("string")
    sql = F.array_join(F.array_compact(F.array(*tests)), " and ") if tests else F.lit("")
    return F.when(sql != "", sql), F.coalesce(*errors, none) if errors else none


@lru_cache(maxsize=64)
def _facts(application: str, names: str, route: str, known: tuple[str, ...]) -> list[dict[str, Column]]:
    """Steps of columns over rule_parts, the last of them (problem, unmet, tests, text, late, timeframe, targets) of each rule.

    Of the errors `problem` comes first, then those of patterns, `unmet`, those of tests, and `late`. The columns name no table, so they are
    made once per field map and routing.
    """
    mapped = json.loads(names)
    condition = F.try_variant_get("doc", "$.detection.condition", "variant")
    conditions = F.transform(_list_of(condition), lambda c: c.try_cast("string"))
    whole = F.schema_of_variant("doc")
    targets = F.try_variant_get("doc", "$.conversion_targets", "variant")
    given = targets.isNotNull() & (F.schema_of_variant(targets) != "VOID")
    listed = targets.try_cast("array<string>")
    problem = (
        F.when(F.col("doc").isNull(), "rule is not JSON")
        .when((whole != "VOID") & ~whole.startswith("OBJECT") & ~F.col("rule_json").rlike(r'^\s*(\[\s*\]|""|0|false)\s*$'), "rule must be a mapping")
        .when(given & listed.isNull(), "conversion_targets must be a list")
    )
    missing = F.col("selections").isNull() | condition.isNull() | F.coalesce(~F.exists("said", lambda c: ~c.isin("", "false", "0")), F.lit(True))
    results = F.transform("said", lambda c: condition_result(c, F.col("texts")))
    route_sql, route_error = _route(known, json.loads(route))
    body = _joined(F.transform("results", lambda r: r["sql"]), "or")
    late = F.coalesce(F.get(F.transform(F.filter("results", lambda r: r["error"].isNotNull()), lambda r: r["error"]), F.lit(0)), route_error)
    clean = F.filter(F.transform(listed, lambda t: F.lower(F.trim(t))), lambda t: t != "")
    return [
        {"texts": _selection_texts(mapped), "tests": _all_tests(mapped), "said": F.array_compact(conditions), "problem": problem},
        {"missing": missing},
        {"results": F.when(~F.col("missing") & F.col("problem").isNull(), results), "route": route_sql},
        {
            "unmet": F.when(F.col("missing"), "detection must have a condition"),
            "text": F.when(F.col("route").isNull(), body).otherwise(F.concat("route", F.lit(" and ("), body, F.lit(")"))),
            "late": late,
            "timeframe": F.coalesce(F.try_variant_get("doc", "$.detection.timeframe", "string"), F.lit("")),
            "targets": F.when(given, clean),
        },
    ]


FACTS = ["no", "problem", "unmet", "tests", "text", "late", "timeframe", "targets"]


# ---- the dictionary ------------------------------------------------------------------------------


def _halving(check, things: list) -> list[str]:
    """What `check` says of each thing, '' if nothing; it is asked about many at once and halves those it refuses."""
    said = check(things)
    if not said:
        return [""] * len(things)
    if len(things) == 1:
        return [said]
    half = len(things) // 2
    return _halving(check, things[:half]) + _halving(check, things[half:])


def _bad_patterns(spark: SparkSession, patterns: list[str]) -> dict[str, str]:
    """Patterns that are no regular expression for the engine that runs them."""

    def check(some: list[str]) -> str:
        try:
            local_table(spark, [(p,) for p in some], "p string").select(F.rlike(F.lit(""), F.col("p"))).collect()
        except PySparkException:
            return f"bad regular expression: {some[0]}"
        return ""

    return {p: e for p, e in zip(patterns, _halving(check, patterns) if patterns else [], strict=True) if e}


def _analysis_errors(events: DataFrame, texts: list[str]) -> list[str]:
    """What the analyser says of each test; '' if it binds."""

    def check(some: list[str]) -> str:
        try:
            events.select(*[F.expr(t).cast("boolean").alias(f"t{i}") for i, t in enumerate(some)]).schema
        except (AnalysisException, ParseException) as exc:
            return str(exc).strip().split("\n")[0]
        return ""

    chunks = [texts[i : i + TESTS_PER_ANALYSIS] for i in range(0, len(texts), TESTS_PER_ANALYSIS)]
    return [e for chunk in chunks for e in _halving(check, chunk)]


def _dictionary(events: DataFrame, rows: list, profile: Profile) -> tuple[dict[str, Test], dict[str, str], dict[str, str]]:
    """(tests, errors of patterns, other errors) by name, from the different tests of a rule set."""
    spark, schema = events.sparkSession, events.schema
    bad = _bad_patterns(spark, sorted({r["text"] or "" for r in rows if "re" in r["modifiers"]}))
    patterns = {r["name"]: bad[r["text"] or ""] for r in rows if "re" in r["modifiers"] and (r["text"] or "") in bad}
    made, errors = {}, {}
    for r in rows:
        try:
            made[r["name"]] = make_test(r["field"], r["modifiers"], r["kind"], r["text"], schema, profile)
        except ValueError as exc:
            errors[r["name"]] = str(exc)
    names = [n for n in made if n not in patterns]
    errors |= {n: e for n, e in zip(names, _analysis_errors(events, [made[n].sql for n in names]), strict=True) if e}
    return made, patterns, errors


def _first(names: Iterable[str], errors: dict[str, str]) -> str | None:
    return next((errors[n] for n in names if n in errors), None) if errors else None


def _spelled(texts: list[str], tests: dict[str, Test]) -> list[str]:
    """The texts with every test name replaced by the test, in one pass over all of them."""
    return NAMED.sub(lambda m: tests[m[1]].sql if m[1] in tests else "null", "\u0000".join(texts)).split("\u0000") if texts else []


def compile_rules(rules: DataFrame, events: DataFrame, profile: Profile = Profile(), field_map: DataFrame | None = None) -> list[CompiledRule]:
    """Every rule as one predicate over the event columns, in rule_id order.

    A rule that cannot be bound has an `error` and no SQL, and harms no other: a missing document (with the rule
    table's own `error` if it has one), a bad pattern, an unknown modifier, an id that other rules have too. Rules
    are configuration and are brought to the driver whole; no job reads events.
    """
    spark = events.sparkSession
    said = F.col("error") if "error" in rules.columns else F.lit(None).cast("string")
    given = sorted((tuple(r) for r in rules.select("rule_id", "rule_json", said).collect()), key=lambda r: (r[0] or "", r[1] or ""))
    ids = [r[0] for r in given]
    times = {i: ids.count(i) for i in {a for a, b in zip(ids, ids[1:], strict=False) if a == b}}
    names: dict[str, list[str]] = {}
    if field_map is not None:
        wanted = field_map.where(F.col("profile") == profile.name).select("rule_field", "event_field").distinct()
        for rule_field, event_field in sorted(map(tuple, wanted.collect())):
            names.setdefault(rule_field, []).append(event_field)
    # Rows are told apart by their number, so that rules with one id never mix.
    parts = rule_parts(local_table(spark, [(i, r[1]) for i, r in enumerate(given)], "no int, rule_json string"))
    known = tuple(name for name, _ in profile.route.values() if name in events.columns)
    for step in _facts(spark.sparkContext.applicationId, json.dumps(names), json.dumps(profile.route), known):
        parts = parts.withColumns(step)
    facts = sorted(parts.select(*FACTS).collect(), key=lambda r: r["no"])
    rows = {t["name"]: t for r in facts for t in r["tests"] or ()}
    tests, bad_patterns, bad_tests = _dictionary(events, list(rows.values()), profile)
    columns = events.columns
    under = {f: tuple(c for c in columns if f in ("", c) or f.startswith(f"{c}.")) for f in {t["field"] for t in rows.values()}}
    compiled = []
    for (rule_id, text, problem), fact, sql in zip(given, facts, _spelled([r["text"] or "" for r in facts], tests), strict=True):
        own = [t["name"] for t in fact["tests"] or ()]
        if rule_id is None:
            error = "rule id is missing"
        elif text is None:
            error = problem or "rule document is missing"
        elif rule_id in times:
            error = f"rule id is used {times[rule_id]} times: {rule_id}"
        else:
            error = fact["problem"] or _first(own, bad_patterns) or fact["unmet"] or _first(own, bad_tests) or fact["late"] or ""
        used = {c for n in own for c in under[rows[n]["field"]]}
        kept = tuple(dict.fromkeys((n, tests[n]) for n in own)) if not error else ()
        targets = None if fact["targets"] is None else tuple(fact["targets"])
        compiled.append(CompiledRule(rule_id, "" if error else sql, error, tuple(c for c in columns if c in used), "" if error else fact["text"], kept, fact["timeframe"], targets))
    return compiled


def shared_documents(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, members) of a rule table: the different documents as rules named by their digest, and (rule_id, document) per rule.

    Rules of equal documents differ by their ids alone, so `compile_rules` needs each document once; only these reach the driver,
    and `count_members` gives every rule its document's count.
    """
    said = ["error"] if "error" in rules.columns else []
    named = rules.select("rule_id", "rule_json", *said, F.md5(F.to_json(F.struct("rule_json", *said))).alias("document"))
    documents = named.select(F.col("document").alias("rule_id"), "rule_json", *said).distinct()
    return documents, named.select("rule_id", "document")


def conversion_results(spark: SparkSession, compiled: list[CompiledRule], backend: str = "spark") -> DataFrame:
    """(rule_id, backend, status, query, error, skipped_reason) of a compile run."""
    rows = []
    for rule in compiled:
        if rule.error:
            rows.append((rule.rule_id, backend, "failed", "", rule.error, ""))
        elif rule.targets is not None and backend not in rule.targets:
            rows.append((rule.rule_id, backend, "skipped", "", "", "target not selected"))
        else:
            rows.append((rule.rule_id, backend, "success", rule.sql, "", ""))
    schema = "rule_id string, backend string, status string, query string, error string, skipped_reason string"
    return local_table(spark, rows, schema)
