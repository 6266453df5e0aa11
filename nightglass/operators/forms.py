"""Rule submissions: flat form rows to rule rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.functions.text import is_blank, present, slug, text_lines
from nightglass.sources.files import parse_yaml
from nightglass.operators.validate import CATEGORIES

# What a submission gets for fields left empty.
DEFAULT_TARGETS = ("kql", "splunk")
DEFAULT_DETECTION = '{"selection":{"example":"value"},"condition":"selection"}'
DEFAULT_VERSION = "0.1.0"


def or_default(given: Column, default: Column) -> Column:
    return F.when(present(given), given).otherwise(default)


def logsource(product: Column, category: Column, service: Column) -> Column:
    """Map of the parts that are filled."""
    parts = F.create_map(F.lit("product"), product, F.lit("category"), category, F.lit("service"), service)
    return F.map_filter(parts, lambda _, v: F.coalesce(v, F.lit("")) != "")


def targets(kql: Column, splunk: Column, elasticsearch: Column) -> Column:
    """Ticked back ends in this order, or the default pair."""
    ticked = F.array_compact(
        F.array(*[F.when(present(c), F.lit(n)) for n, c in (("kql", kql), ("splunk", splunk), ("elasticsearch", elasticsearch))])
    )
    return F.when(F.size(ticked) > 0, ticked).otherwise(F.array(*[F.lit(t) for t in DEFAULT_TARGETS]))


def rule_path(category: Column, given: Column, name: Column, title: Column) -> Column:
    built = F.concat(F.lit("sigma-rules/"), category, F.lit("/"), category, F.lit("_"), form_slug(name, title), F.lit(".yml"))
    return or_default(given, built)


def form_slug(name: Column, title: Column) -> Column:
    return slug(or_default(name, F.coalesce(title, F.lit(""))))


def reject_reason(category: Column, name: Column, title: Column) -> Column:
    allowed = F.coalesce(category.isin(*CATEGORIES), F.lit(False))
    return F.when(~allowed, "Invalid category").when(form_slug(name, title) == "", "Filename or title required")


def with_detection(forms: DataFrame) -> DataFrame:
    """Form rows with `detection` as a JSON text, from the YAML or JSON that was given or the default, and `bad_detection` where it is
    neither or no mapping."""
    given = F.when(~is_blank(F.col("detection")), F.col("detection"))
    parsed = parse_yaml(forms.withColumn("text", F.coalesce(given, F.lit(DEFAULT_DETECTION))))
    whole = F.coalesce(F.schema_of_variant(F.try_parse_json("rule_json")).startswith("OBJECT"), F.lit(False))
    return parsed.withColumn("detection", F.when(given.isNull(), DEFAULT_DETECTION).otherwise(F.col("rule_json"))).withColumn("bad_detection", ~whole).drop("text", "rule_json", "error")


def submissions(forms: DataFrame, today: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rules, rejects) of form rows. `today` defaults to the current date. A rule's detection is JSON text, given or not."""
    day = F.date_format(F.current_date() if today is None else today, "yyyy/MM/dd")
    c = F.col
    reason = F.coalesce(reject_reason(c("category"), c("filename"), c("title")), F.when(c("bad_detection"), "Detection is not a mapping"))
    judged = with_detection(forms).withColumn("reason", reason)
    rules = judged.where("reason is null").select(
        rule_path(c("category"), c("rule_path"), c("filename"), c("title")).alias("path"),
        "title",
        or_default(c("rule_id"), F.uuid()).alias("id"),
        "status",
        "description",
        text_lines(c("references")).alias("references"),
        "author",
        or_default(c("date"), day).alias("date"),
        day.alias("modified"),
        text_lines(c("tags")).alias("tags"),
        targets(c("conversion_kql"), c("conversion_splunk"), c("conversion_elasticsearch")).alias("conversion_targets"),
        logsource(c("logsource_product"), c("logsource_category"), c("logsource_service")).alias("logsource"),
        "detection",
        text_lines(c("falsepositives")).alias("falsepositives"),
        "level",
        F.lit(DEFAULT_VERSION).alias("version"),
    )
    return rules, judged.where("reason is not null").select("title", "category", "reason")
