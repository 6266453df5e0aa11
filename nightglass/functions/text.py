"""String expressions. All are built-in Spark functions and stay inside code generation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# The characters that Python's str.strip and str.splitlines act on, since the rule
# tooling this replaces is defined by them. Java's \s and \R cover fewer.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_BREAK = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029]"


SPACE_CHARACTERS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c) with c evaluated a single time however often `use` names it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns through a generator: a later filter on them does not evaluate them a second time."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACE_CHARACTERS))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of white space only."""
    return ~F.coalesce(c, F.lit("")).rlike(rf"[^{SPACE[1:]}")


def text_lines(c: Column) -> Column:
    """Trimmed, non-empty lines of a text."""
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), LINE_BREAK), strip)
    return F.filter(lines, lambda line: line != "")


def normalise_query(c: Column) -> Column:
    """Join the lines of a query by one blank, without blank lines and # comments."""
    return F.array_join(F.filter(text_lines(c), lambda line: ~line.startswith("#")), " ")


def strip_markup_comments(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->", "")


def strip_slash_comments(c: Column) -> Column:
    """Drop // to the line end, then /* */. A URL's // is cut as well; this is intended."""
    return F.regexp_replace(F.regexp_replace(c, r"(?md)//.*?$", ""), r"(?s)/\*.*?\*/", "")


def count_of(c: Column, piece: str) -> Column:
    """Number of occurrences of a one-character piece."""
    return F.length(c) - F.length(F.replace(c, F.lit(piece), F.lit("")))


def unescape(c: Column) -> Column:
    r"""Rule value to plain text: \\ \* and \? lose their back-slash, any other back-slash is itself."""
    return F.regexp_replace(c, r"\\([\\*?])", "$1")


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(strip(c)), r"[^a-zA-Z0-9]+", "_"), F.lit("_"))


def capitalise(c: Column) -> Column:
    """First character upper, rest lower. initcap would raise every word."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, F.lit(2), F.length(c))))


def snippet(text: Column, start: Column, end: Column, margin: int = 15) -> Column:
    """The text from `margin` characters before start to `margin` after end, on one line."""
    first = F.greatest(start - margin, F.lit(0))
    last = F.least(end + margin, F.length(text))
    piece = F.substring(text, (first + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int"))
    return F.translate(piece, "\r\n", "  ")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_path(path: Column) -> Column:
    """Directory part; '.' for a bare name."""
    cut = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(~path.contains("/"), F.lit(".")).when(cut == "", F.lit("/")).otherwise(cut)


def parent_name(path: Column) -> Column:
    """Name of the directory that holds the file; '' for a bare name."""
    return F.coalesce(F.get(F.reverse(F.split(path, "/")), F.lit(1)), F.lit(""))


def stem(path: Column) -> Column:
    """File name without its last suffix. A name that starts with its only dot keeps it."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def present(c: Column) -> Column:
    """Truthy text: neither NULL nor empty."""
    return F.coalesce(c, F.lit("")) != ""


def collect_errors(*checks: tuple[Column, Column | str]) -> Column:
    """The messages of the checks that hold, in order. A check that is NULL does not hold."""
    cases = [F.when(cond, msg if isinstance(msg, Column) else F.lit(msg)) for cond, msg in checks]
    return F.array_compact(F.array(*cases))
