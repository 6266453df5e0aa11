from datetime import datetime

import pytest
from pyspark.sql import functions as F

from nightglass.functions import text, times, versions
from nightglass.operators.catalog import normalise_type, type_symbol


@pytest.mark.parametrize("raw, want", [(" My Rule! ", "my_rule"), ("__a--b__c", "a_b_c"), ("é é", ""), ("", ""), ("A_1", "a_1")])
def test_slug(value, raw, want):
    assert value(text.slug(F.lit(raw))) == want


@pytest.mark.parametrize("raw", ["  a b\t", "\u00a0x\u2003\n", "\x1f\x85y", "", " \r\n", "no"])
def test_strip_and_blank_follow_python(value, raw):
    assert value(text.strip(F.lit(raw))) == raw.strip()
    assert value(text.is_blank(F.lit(raw))) == (not raw.strip())


def test_blank_of_null(value):
    assert value(text.is_blank(F.lit(None).cast("string"))) is True


@pytest.mark.parametrize("raw", ["a\r\nb\rc\x0bd\x1ce\u2028f\n", "", "\n\n", "x"])
def test_lines_follow_python(value, raw):
    assert value(text.text_lines(F.lit(raw))) == [x.strip() for x in raw.splitlines() if x.strip()]


def test_normalise_query(value):
    assert value(text.normalise_query(F.lit("  a b\n# note\n\n\t| c  \n  #x"))) == "a b | c"


def test_comments(value):
    assert value(text.strip_markup_comments(F.lit("a<!-- x\ny -->b<!---->"))) == "ab"
    assert value(text.strip_slash_comments(F.lit("a // x\nb /* c\nd */ e http://f"))) == "a \nb  e http:"


def test_unescape(value):
    assert value(text.unescape(F.lit("\\\\powershell.exe"))) == "\\powershell.exe"
    assert value(text.unescape(F.lit("\\powershell.exe"))) == "\\powershell.exe"
    assert value(text.unescape(F.lit("a\\*b\\?"))) == "a*b?"


def test_snippet_is_clipped(value):
    q = "0123456789" * 5 + "\r\nend"
    for start, end in ((0, 3), (20, 25), (50, 55), (55, 55)):
        want = q[max(start - 15, 0) : min(end + 15, len(q))].replace("\r", " ").replace("\n", " ")
        assert value(text.snippet(F.lit(q), F.lit(start), F.lit(end))) == want


def test_paths(value):
    for path, name, folder, stem in (
        ("a/b/c.meta.yml", "c.meta.yml", "a/b", "c.meta"), ("c.yml", "c.yml", ".", "c"), ("/c", "c", "/", "c"), ("a/.hidden", ".hidden", "a", ".hidden"),
    ):
        got = [value(f(F.lit(path))) for f in (text.file_name, text.parent_path, text.stem)]
        assert got == [name, folder, stem]


def test_capitalise(value):
    assert value(text.capitalise(F.lit("maCOS web"))) == "Macos web"


@pytest.mark.parametrize(
    "old, new, want",
    [("1.0.0", "1.0.1", True), ("1.2.0", "1.2.0", False), ("1.0", "1.0.0", False), ("1.9.0", "1.10.0", True), ("2.0.0", "1.9.9", False),
     ("1.0.0.0", "1.0.0", False), ("1.0.0", "1.0.0.1", True), ("1.0.0", "x", None), ("0.0.0", "0.0.1", True)],
)
def test_is_bumped(value, old, new, want):
    assert value(versions.is_bumped(F.lit(old), F.lit(new))) is want


@pytest.mark.parametrize("bucket, start, end", [
    ("day", "2026-03-27", "2026-03-28"), ("week", "2026-03-23", "2026-03-30"), ("month", "2026-03-01", "2026-04-01"), ("quarter", "2026-01-01", "2026-04-01"),
])
def test_buckets(value, bucket, start, end):
    first = times.bucket_start(times.parse_offset_time(F.lit("2026-03-27T15:30:00Z")), bucket)
    assert value(F.date_format(first, "yyyy-MM-dd")) == start
    assert value(F.date_format(times.bucket_end(first, bucket), "yyyy-MM-dd")) == end


def test_bucket_follows_the_offset(value):
    ts = times.parse_offset_time(F.lit("2026-03-31T23:30:00-04:00"))
    assert value(F.date_format(times.bucket_start(ts, "month"), "yyyy-MM")) == "2026-04"


def test_unknown_bucket():
    with pytest.raises(ValueError):
        times.bucket_start(F.lit(datetime(2026, 1, 1)), "year")


@pytest.mark.parametrize("raw, want, symbol", [("BigInt", "long", "long"), ("URI", "string", "string"), (" Date Time ", "datetime", "datetime"), ("curie", "cstringe", "unknown")])
def test_types(value, raw, want, symbol):
    assert value(normalise_type(F.lit(raw))) == want
    assert value(type_symbol(F.lit(raw))) == symbol


# In the order of versions; those of a line are equal.
VERSIONS = [
    ["0", "0.0"], ["0.9"], ["1.0.dev0", "1.0.dev", "1.0-DEV"], ["1.0.dev3"], ["1.0a1.dev2"], ["1.0a1", "1.0alpha1", "1.0-a.1", "v1.0_ALPHA-1"], ["1.0a2"], ["1.0b1", "1.0beta1"], ["1.0rc1", "1.0c1", "1.0pre1", "1.0-preview_1"], ["1.0rc10"],
    ["1", "1.0", "1.0.0", " 1.0 ", "01.0"], ["1.0+abc"], ["1.0+abc.x"], ["1.0+abc.5"], ["1.0+5"], ["1.0+10"], ["1.0.post0.dev1", "1.0.post.dev1"], ["1.0.post0", "1.0.post", "1.0-0"], ["1.0.post2", "1.0-2", "1.0rev2", "1.0r2"],
    ["1.0.1"], ["1.9"], ["1.10"], ["99999999999999999999999999999999999999999999.1"], ["1!0.1"],
]


def test_version_order(spark):
    listed = [(i, v) for i, same in enumerate(VERSIONS) for v in same]
    table = spark.createDataFrame(listed, "rank int, v string").select("rank", "v", versions.version_key(F.col("v")).alias("k"))
    pairs = table.alias("a").join(table.alias("b"), F.col("a.rank") <= F.col("b.rank")).selectExpr("a.v AS v", "b.v AS w", "a.rank = b.rank AS same", "a.k < b.k AS less", "a.k = b.k AS equal").collect()
    assert [r for r in pairs if (r.less, r.equal) != (not r.same, r.same)] == []


@pytest.mark.parametrize("text_", ["", "x", "1..2", "1.0 0", "1.0+", "1.0+a..b", "1.0-", None, "a1", "1.0\n1"])
def test_no_version(value, text_):
    assert value(versions.version_key(F.lit(text_).cast("string"))) is None
