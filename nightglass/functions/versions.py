"""Version numbers of any public form (1.2.3, 1!2.0rc1, 1.0.post2.dev3+local.7) as values that sort as versions do."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from nightglass.functions.text import once

# The parts of a version, and how the names of its phases may be spelled.
RELEASE = r"(?:([0-9]+)!)?([0-9]+(?:\.[0-9]+)*)"
PRE = r"(?:[-_.]?(a|alpha|b|beta|c|rc|pre|preview)[-_.]?([0-9]*))?"
POST = r"((?:-[0-9]+)|(?:[-_.]?(?:post|rev|r)[-_.]?[0-9]*))?"
DEV = r"([-_.]?dev[-_.]?[0-9]*)?"
LOCAL = r"(?:\+([a-z0-9]+(?:[-_.][a-z0-9]+)*))?"
VERSION = rf"(?i)^\s*v?{RELEASE}{PRE}{POST}{DEV}{LOCAL}\s*\z"


def number_key(digits: Column) -> Column:
    """Digits of any length as a value that sorts by number; no digits count as 0."""
    bare = F.regexp_replace(F.coalesce(digits, F.lit("")), "^0+", "")
    return F.struct(F.length(bare).alias("n"), bare.alias("digits"))


def version_key(text: Column) -> Column:
    """A struct that sorts as versions do; NULL for text that is no version.

    Epoch first, then the release without trailing zeros. Of one release, development versions of it come first, then alpha, beta and
    candidate, the release itself, and post releases; a development version comes before what it leads to, a version with a
    local part after the same without.
    """
    group = lambda i: F.regexp_extract(F.lower(text), VERSION, i)
    numbers = F.transform(F.split(F.regexp_replace(group(2), r"(\.0+)+$", ""), r"\."), number_key)
    has_pre, has_post, has_dev = (group(i) != "" for i in (3, 5, 6))
    phase = (
        F.when(has_pre, F.when(group(3).startswith("a"), 1).when(group(3).startswith("b"), 2).otherwise(3))
        .when(~has_post & has_dev, 0).otherwise(4)
    )
    digits = lambda i: number_key(F.regexp_extract(group(i), "([0-9]*)$", 1))
    words = F.split(group(7), "[-_.]")
    local = F.transform(words, lambda w: once(w.rlike("^[0-9]+$"), lambda n: F.struct(n.alias("is_number"), number_key(F.when(n, w)).alias("number"), F.when(n, "").otherwise(w).alias("word"))))
    none = F.slice(local, 1, 0)
    key = F.struct(
        number_key(group(1)).alias("epoch"), numbers.alias("release"), phase.alias("phase"), number_key(group(4)).alias("pre"),
        has_post.alias("is_post"), digits(5).alias("post"), (~has_dev).alias("is_not_dev"), digits(6).alias("dev"), F.when(group(7) == "", none).otherwise(local).alias("local"),
    )
    return F.when(text.rlike(VERSION), key)


def is_bumped(old: Column, new: Column) -> Column:
    """True if new is strictly later than old; NULL when either is no version."""
    return version_key(new) > version_key(old)
