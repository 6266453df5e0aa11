"""Checks of the rule corpus. Each check is one array<string> column of messages over a rules table.

Rules arrive as (path, rule_json, error); the document stays VARIANT so that an absent key, a JSON
null and an empty value remain three different things.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import collect_errors, file_name, parent_name
from nightglass.functions.versions import is_bumped

# Vocabulary and patterns that the checks report against.
CATEGORIES = ("endpoint", "cloud", "macos", "network", "web")
STATUSES = ("deprecated", "experimental", "stable", "test")
LEVELS = ("critical", "high", "informational", "low", "medium")
REQUIRED = (
    "title", "id", "status", "description", "author", "date", "references", "tags",
    "logsource", "detection", "level", "falsepositives", "version",
)
TARGETS = ("kql", "splunk", "elasticsearch")
NAME_PATTERN = r"^([a-z]+)_([a-z0-9_]+)\.(yml|yaml)$"
DATE_PATTERN = r"^\p{Nd}{4}[-/]\p{Nd}{2}[-/]\p{Nd}{2}$"
VERSION_PATTERN = r"^\p{Nd}+\.\p{Nd}+\.\p{Nd}+$"
TECHNIQUE_PATTERN = r"^attack\.t\p{Nd}{4}(\.\p{Nd}{3})?$"
WORD_PATTERN = r"[\p{L}\p{N}_'’-]+"
TRANSIENT = (429, 503)

# The texts that the checks report.
SAY = {
    "logsource_not_map": "logsource must be a dictionary",
    "logsource_no_key": "logsource must have either 'category' or 'product'",
    "detection_not_map": "detection must be a dictionary",
    "no_condition_key": "detection must have 'condition'",
    "no_selection": "detection must include at least one selection block",
    "id_not_text": "id must be a string",
    "id_not_uuid": "id should be a UUID format: ",
    "yaml": "YAML parsing error: ",
    "empty": "Rule file is empty",
    "not_map": "Rule file must deserialize to a YAML mapping/object",
    "missing": "Missing required metadata field: ",
    "date": "date must be in YYYY/MM/DD or YYYY-MM-DD format",
    "references_not_list": "references must be a list",
    "tags_not_list": "tags must be a list",
    "no_tactic": "tags must include at least one attack.* tag",
    "no_technique": "tags must include at least one ATT&CK technique tag (attack.t####)",
    "falsepositives_not_list": "falsepositives must be a list",
    "version": "version must follow semantic versioning (e.g., 1.2.3)",
    "targets_not_list": "conversion_targets must be a list",
    "targets_unknown": "conversion_targets entries must be 'kql', 'splunk', and/or 'elasticsearch'",
    "no_source": "logsource must include product, category, or service",
    "no_condition": "detection must include a condition",
    "no_falsepositives": "falsepositives must be populated with known benign scenarios",
    "no_tags": "tags must include ATT&CK mappings and detection context",
    "short_name": "Descriptive name must be at least 3 characters long",
    "edge_underscore": "Descriptive name cannot start or end with underscore",
    "double_underscore": "Descriptive name cannot contain consecutive underscores",
    "name_pattern": "' does not match pattern: <category>_<descriptive_name>.yml\n  Example: endpoint_suspicious_powershell.yml",
}

# Fixed values: (field, required, type, least length) of the two document contracts.
RULE_CONTRACT = (
    ("title", True, "string", 3),
    ("id", True, "string", 0),
    ("status", True, "string", 0),
    ("description", True, "string", 10),
    ("author", True, "string", 0),
    ("date", True, "string", 0),
    ("logsource", True, "object", 0),
    ("detection", True, "object", 0),
    ("level", True, "string", 0),
    ("version", True, "string", 0),
    ("modified", False, "string", 0),
    ("references", False, "strings", 0),
    ("tags", False, "strings", 0),
    ("falsepositives", False, "strings", 0),
    ("conversion_targets", False, "strings", 0),
)
META_CONTRACT = (
    ("version", True, "string", 0),
    ("owner", True, "string", 0),
    ("status", True, "string", 0),
    ("last_modified", False, "string", 0),
)


def with_document(rules: DataFrame) -> DataFrame:
    """Adds the VARIANT `doc`."""
    return rules.withColumn("doc", F.try_parse_json("rule_json"))


def part(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "variant")


def text(doc: Column, name: str) -> Column:
    return F.try_variant_get(doc, f"$.{name}", "string")


def kind(doc: Column, name: str) -> Column:
    """Type text of a key: NULL if absent, VOID for a JSON null."""
    return F.schema_of_variant(part(doc, name))


def is_object(k: Column) -> Column:
    return F.coalesce(k.startswith("OBJECT"), F.lit(False))


def is_list(k: Column) -> Column:
    return F.coalesce(k.startswith("ARRAY"), F.lit(False))


def truthy(value: Column) -> Column:
    """Python's truth value of a VARIANT."""
    k, t = F.schema_of_variant(value), value.try_cast("string")
    filled = (
        F.when(k == "VOID", False)
        .when(k == "STRING", t != "")
        .when(k == "BOOLEAN", t == "true")
        .when(k.startswith("ARRAY"), t != "[]")
        .when(k.startswith("OBJECT"), t != "{}")
        .otherwise(t.try_cast("double") != 0)
    )
    return F.coalesce(filled, F.lit(False))


def keys(block: Column) -> Column:
    return F.map_keys(block.try_cast("map<string,variant>"))


def _selections(doc: Column) -> Column:
    return F.array_except(keys(part(doc, "detection")), F.array(F.lit("condition"), F.lit("timeframe")))


def _has(found: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(found, name), F.lit(False))


def naming_errors(path: Column) -> Column:
    """File name against <category>_<name>.yml and its folder. A name off the pattern has that error only."""
    name = file_name(path)
    category = F.regexp_extract(name, NAME_PATTERN, 1)
    rest = F.regexp_extract(name, NAME_PATTERN, 2)
    off = F.concat(
        F.lit("Filename '"), name,
        F.lit(SAY["name_pattern"]),
    )
    folder = parent_name(path)
    wrong_folder = F.concat(F.lit("Category '"), category, F.lit("' in filename does not match directory '"), folder, F.lit("'"))
    wrong_category = F.concat(F.lit("Category '"), category, F.lit(f"' is not valid. Must be one of: {', '.join(CATEGORIES)}"))
    found = collect_errors(
        (category != folder, wrong_folder),
        (~category.isin(*CATEGORIES), wrong_category),
        (F.length(rest) < 3, SAY["short_name"]),
        (rest.startswith("_") | rest.endswith("_"), SAY["edge_underscore"]),
        (rest.contains("__"), SAY["double_underscore"]),
    )
    return F.when(~name.rlike(NAME_PATTERN), F.array(off)).otherwise(found)


def structure_errors(doc: Column, error: Column) -> Column:
    """Shape by key presence. Absent blocks pass; the metadata check asks for them."""
    root = F.schema_of_variant(doc)
    log_kind, log_keys = kind(doc, "logsource"), keys(part(doc, "logsource"))
    det_kind, det_keys = kind(doc, "detection"), keys(part(doc, "detection"))
    rule_id = text(doc, "id")
    id_kind = kind(doc, "id")
    no_key = ~(_has(log_keys, "category") | _has(log_keys, "product") | _has(log_keys, "service"))
    bad_id = (F.length(rule_id) != 36) | (F.regexp_count(rule_id, F.lit("-")) != 4)
    found = collect_errors(
        (log_kind.isNotNull() & ~is_object(log_kind), SAY["logsource_not_map"]),
        (is_object(log_kind) & no_key, SAY["logsource_no_key"]),
        (det_kind.isNotNull() & ~is_object(det_kind), SAY["detection_not_map"]),
        (is_object(det_kind) & ~_has(det_keys, "condition"), SAY["no_condition_key"]),
        (is_object(det_kind) & (F.size(_selections(doc)) == 0), SAY["no_selection"]),
        (id_kind.isNotNull() & (id_kind != "STRING"), SAY["id_not_text"]),
        ((id_kind == "STRING") & bad_id, F.concat(F.lit(SAY["id_not_uuid"]), rule_id)),
    )
    return (
        F.when(error.isNotNull(), F.array(F.concat(F.lit(SAY["yaml"]), error)))
        .when(~truthy(doc), F.array(F.lit(SAY["empty"])))
        .when(~is_object(root), F.array(F.lit(SAY["not_map"])))
        .otherwise(found)
    )


def metadata_errors(doc: Column) -> Column:
    """Required keys by presence, then values of keys that are not empty."""
    missing = F.array_except(F.array(*[F.lit(n) for n in REQUIRED]), F.coalesce(keys(doc), F.array().cast("array<string>")))
    missing = F.transform(missing, lambda n: F.concat(F.lit(SAY["missing"]), n))
    filled = lambda n: truthy(part(doc, n))
    given = lambda n: kind(doc, n).isNotNull() & (kind(doc, n) != "VOID")
    items = lambda n: F.try_variant_get(doc, f"$.{n}", "array<string>")
    tags = F.transform(items("tags"), F.lower)
    has_tactic = F.exists(tags, lambda t: F.coalesce(t.startswith("attack."), F.lit(False)))
    has_technique = F.exists(tags, lambda t: F.coalesce(t.rlike(TECHNIQUE_PATTERN), F.lit(False)))
    known = lambda t: F.coalesce(F.lower(t).isin(*TARGETS), F.lit(False))
    found = collect_errors(
        (filled("status") & ~text(doc, "status").isin(*STATUSES), f"status must be one of: {', '.join(STATUSES)}"),
        (filled("level") & ~text(doc, "level").isin(*LEVELS), f"level must be one of: {', '.join(LEVELS)}"),
        (filled("date") & ~text(doc, "date").rlike(DATE_PATTERN), SAY["date"]),
        (given("references") & ~is_list(kind(doc, "references")), SAY["references_not_list"]),
        (given("tags") & ~is_list(kind(doc, "tags")), SAY["tags_not_list"]),
        (is_list(kind(doc, "tags")) & ~has_tactic, SAY["no_tactic"]),
        (is_list(kind(doc, "tags")) & ~has_technique, SAY["no_technique"]),
        (given("falsepositives") & ~is_list(kind(doc, "falsepositives")), SAY["falsepositives_not_list"]),
        (filled("version") & ~text(doc, "version").rlike(VERSION_PATTERN), SAY["version"]),
        (given("conversion_targets") & ~is_list(kind(doc, "conversion_targets")), SAY["targets_not_list"]),
        (
            is_list(kind(doc, "conversion_targets")) & ~F.forall(items("conversion_targets"), known),
            SAY["targets_unknown"],
        ),
    )
    return F.concat(missing, found)


def quality_errors(doc: Column) -> Column:
    """Filled values, where the structure check asks only for keys."""
    filled = lambda block, n: truthy(F.try_variant_get(doc, f"$.{block}.{n}", "variant"))
    log_ok, det_ok = is_object(kind(doc, "logsource")), is_object(kind(doc, "detection"))
    any_source = filled("logsource", "product") | filled("logsource", "category") | filled("logsource", "service")
    return collect_errors(
        (~log_ok, SAY["logsource_not_map"]),
        (log_ok & ~any_source, SAY["no_source"]),
        (~det_ok, SAY["detection_not_map"]),
        (det_ok & (F.size(_selections(doc)) == 0), SAY["no_selection"]),
        (det_ok & ~filled("detection", "condition"), SAY["no_condition"]),
        (~truthy(part(doc, "falsepositives")), SAY["no_falsepositives"]),
        (~truthy(part(doc, "tags")), SAY["no_tags"]),
    )


def _shown(value: Column) -> Column:
    k, t = F.schema_of_variant(value), value.try_cast("string")
    return (
        F.when(k == "VOID", "None")
        .when(k == "STRING", F.concat(F.lit("'"), t, F.lit("'")))
        .when(k == "BOOLEAN", F.when(t == "true", "True").otherwise("False"))
        .otherwise(t)
    )


def contract_errors(doc: Column, contract=RULE_CONTRACT) -> Column:
    """Required keys in contract order, then types, least lengths and list items by field name.

    A file that could not be read counts as None.
    """
    none = F.array().cast("array<string>")
    off = lambda value, wanted: F.concat(_shown(value), F.lit(f" is not of type '{wanted}'"))
    groups = [
        collect_errors(*[(kind(doc, n).isNull(), f"'{n}' is a required property") for n, needed, _, _ in contract if needed])
    ]
    for name, _, wanted, least in sorted(contract):
        value, k = part(doc, name), kind(doc, name)
        if wanted == "strings":
            wrong = F.filter(value.try_cast("array<variant>"), lambda v: F.schema_of_variant(v) != "STRING")
            items = F.transform(wrong, lambda v: off(v, "string"))
            groups.append(F.when(is_list(k), items).when(k.isNotNull(), F.array(off(value, "array"))).otherwise(none))
            continue
        right = is_object(k) if wanted == "object" else F.coalesce(k == "STRING", F.lit(False))
        short = F.concat(_shown(value), F.lit(" is too short"))
        groups.append(
            collect_errors((k.isNotNull() & ~right, off(value, wanted)), (right & (F.length(text(doc, name)) < least), short))
            if least
            else collect_errors((k.isNotNull() & ~right, off(value, wanted)))
        )
    return F.when(is_object(F.schema_of_variant(doc)), F.concat(*groups)).otherwise(F.array(F.concat(F.coalesce(_shown(doc), F.lit("None")), F.lit(" is not of type 'object'"))))


def checked(rules: DataFrame) -> DataFrame:
    """(path, checks): every check of a rule by itself over rules(path, rule_json, error), in one row per rule.

    The corpus is read once and the document parsed once.
    """
    doc, error = F.col("doc"), F.col("error")
    checks = F.array(
        *[
            F.struct(F.lit(name).alias("check"), errors.alias("errors"))
            for name, errors in (
                ("naming", naming_errors(F.col("path"))),
                ("structure", structure_errors(doc, error)),
                ("metadata", metadata_errors(doc)),
                ("quality", quality_errors(doc)),
                ("schema", contract_errors(doc)),
            )
        ]
    )
    return with_document(rules).select("path", checks.alias("checks"))


def validate(rules: DataFrame) -> DataFrame:
    """Every check over rules(path, rule_json, error): one row per (path, check) with its errors.

    The outer form of explode: for the plain one Spark would filter on the list's size, and write every check out in that filter.
    """
    return checked(rules).select("path", F.explode_outer("checks").alias("c")).select("path", "c.check", "c.errors")


def as_check(rows: DataFrame, name: str, error: str = "error") -> DataFrame:
    """(path, check, errors) of rows(path, error) that have at most one error each, such as version changes."""
    return rows.select("path", F.lit(name).alias("check"), F.array_compact(F.array(error)).alias("errors"))


def link_errors(references: DataFrame, fetched: DataFrame) -> DataFrame:
    """(path, check, errors) of references(path, refs array<string>): the http links whose fetch failed, in order.

    Links meet their outcome as rows; a path without links stays and has no error.
    """
    links = references.select("path", F.explode_outer(F.array_distinct(F.filter("refs", lambda r: r.startswith("http")))).alias("link"))
    bad = fetched.where(F.col("outcome") == "failed").select("link", F.concat(F.lit("Broken link: "), "link").alias("error")).distinct()
    found = links.join(bad, "link", "left").groupBy("path").agg(F.sort_array(F.collect_list("error")).alias("errors"))
    return found.select("path", F.lit("links").alias("check"), "errors")


def spelling_errors(texts: DataFrame, dictionary: DataFrame, allowed: DataFrame) -> DataFrame:
    """(path, check, errors) of texts(path, text): each misspelt word with its correction."""
    said = misspellings(texts, dictionary, allowed).select("path", F.concat("word", F.lit(" ==> "), "correction").alias("error"))
    every = texts.select("path", F.lit(None).cast("string").alias("error")).unionByName(said)
    return every.groupBy("path").agg(F.sort_array(F.collect_list("error")).alias("errors")).select("path", F.lit("spelling").alias("check"), "errors")


def gate(results: DataFrame) -> DataFrame:
    """Rules, failing rules and status per check, with the overall gate as check `all`."""
    counts = results.rollup("check").agg(
        F.count("*").alias("checked"), F.count_if(F.size("errors") > 0).alias("failing")
    )
    return counts.select(
        F.coalesce("check", F.lit("all")).alias("check"),
        "checked",
        "failing",
        F.when(F.col("failing") > 0, "failure").otherwise("success").alias("status"),
    )


def gate_matrix(results: DataFrame, checks: list[str]) -> DataFrame:
    """One row per rule of `checked` rows, one column per check with its number of errors. No row is moved."""

    def errors(name: str) -> Column:
        return F.size(F.filter("checks", lambda c: c["check"] == name)[0]["errors"]).alias(name)

    return results.select("path", *[errors(name) for name in checks])


def is_changed_rule(path: Column, root: str = "sigma-rules/") -> Column:
    """Rule files below the root, side metadata left out."""
    return path.startswith(root) & F.lower(path).rlike(r"\.(yml|yaml)$") & ~path.endswith(".meta.yml")


def version_changes(base: DataFrame | None, current: DataFrame) -> DataFrame:
    """base(path, version) against current(path, version): state and, if wrong, a message.

    A version that is not given counts as 0.0.0. States: new, deleted, bumped, not bumped, unreadable.
    Without a base to compare with, every rule is skipped.
    """
    if base is None:
        none = F.lit(None).cast("string")
        version = F.coalesce("version", F.lit("0.0.0")).alias("current_version")
        return current.select("path", none.alias("base_version"), version, F.lit("skipped").alias("state"), none.alias("error"))
    b = base.select("path", F.struct(F.coalesce("version", F.lit("0.0.0")).alias("v")).alias("b"))
    c = current.select("path", F.struct(F.coalesce("version", F.lit("0.0.0")).alias("v")).alias("c"))
    old, new = F.col("b.v"), F.col("c.v")
    later = is_bumped(old, new)
    state = (
        F.when(F.col("c").isNull(), "deleted")
        .when(F.col("b").isNull(), "new")
        .when(later.isNull(), "unreadable")
        .when(later, "bumped")
        .otherwise("not bumped")
    )
    message = F.concat(F.lit("version not bumped ("), old, F.lit(" -> "), new, F.lit(")"))
    unreadable = F.concat(F.lit("version is not numeric ("), old, F.lit(" -> "), new, F.lit(")"))
    joined = b.join(c, "path", "full_outer").withColumn("state", state)
    error = F.when(F.col("state") == "not bumped", message).when(F.col("state") == "unreadable", unreadable)
    return joined.select("path", old.alias("base_version"), new.alias("current_version"), "state", error.alias("error"))


def link_set(references: DataFrame) -> DataFrame:
    """references(refs array<string>) to the distinct http links. Duplicates are dropped before the shuffle."""
    links = references.select(F.explode("refs").alias("link")).where(F.col("link").startswith("http"))
    return links.distinct()


def rule_references(rules: DataFrame) -> DataFrame:
    """`refs` of rules with a document: the entries that are strings."""
    refs = F.try_variant_get("doc", "$.references", "array<variant>")
    strings = F.filter(refs, lambda r: F.schema_of_variant(r) == "STRING")
    return rules.select(F.transform(strings, lambda r: r.try_cast("string")).alias("refs"))


def link_status(fetches: DataFrame) -> DataFrame:
    """fetches(link, head_status, get_status, error) with code and outcome: ok, transient or failed."""
    code = F.when(F.col("head_status") == 405, F.col("get_status")).otherwise(F.col("head_status"))
    outcome = (
        F.when(F.col("error").isNotNull() | F.col("code").isNull(), "failed")
        .when(F.col("code").isin(*TRANSIENT), "transient")
        .when(F.col("code") >= 400, "failed")
        .otherwise("ok")
    )
    return fetches.withColumn("code", code).withColumn("outcome", outcome)


def misspellings(texts: DataFrame, dictionary: DataFrame, allowed: DataFrame) -> DataFrame:
    """(path, word, correction, times) for words of texts(path, text) that the dictionary lists.

    dictionary(word, correction) and allowed(word) are compared in lower case. The whole text is read.
    """
    lower = lambda df: df.withColumn("word", F.lower("word"))
    listed = lower(dictionary).join(lower(allowed).select("word").distinct(), "word", "left_anti").dropDuplicates(["word"])
    words = texts.select("path", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD_PATTERN), F.lit(0))).alias("word"))
    found = words.join(listed, "word")
    counted = found.groupBy("path", "word").agg(F.min("correction").alias("correction"), F.count("*").alias("times"))
    return counted.select("path", "word", "correction", "times")
