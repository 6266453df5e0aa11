"""One test of a rule: a field, modifiers and a value, as Spark SQL text."""

from __future__ import annotations

import base64
import itertools
import re
from dataclasses import dataclass, field, replace

from pyspark.sql.types import NumericType, StringType, StructType, VariantType

from nightglass.functions.addresses import in_network_sql
from nightglass.operators.fields import Field, column, quote, resolve

TEXT_MATCHES = ("contains", "startswith", "endswith")
NUMBER_MATCHES = {"gt": ">", "gte": ">=", "lt": "<", "lte": "<="}
REGEX_FLAGS = ("i", "m", "s")
DASHES = ("-", "/", "–", "—", "―")
# How a text becomes bytes before it is written in base 64.
CHARSETS = {"wide": "utf-16-le", "utf16le": "utf-16-le", "utf16be": "utf-16-be", "utf16": "utf-16"}
ENCODINGS = ("base64", "base64offset")
KNOWN_MODIFIERS = {*TEXT_MATCHES, *NUMBER_MATCHES, *REGEX_FLAGS, *CHARSETS, *ENCODINGS, "all", "re", "cidr", "cased", "exists", "fieldref", "windash", "expand"}
# Prefix of the helper columns that hold an event field in lower case; the bare prefix holds all text.
LOWERED = "_lower:"
# Prefix of the helper columns that hold the values of a field inside VARIANT values.
VALUES = "_values:"


@dataclass(frozen=True)
class Profile:
    """How rules meet events.

    case: `insensitive` lowers both sides; `exact` compares as is; `lowered` says the event columns
    already hold lower-case text, so only the rule value is lowered and the test reaches the file scan.
    missing: `null` makes an absent field never match; `error` fails the rule.
    route: logsource part to (event column, {rule value: column value}); empty means no routing.
    placeholders: values for `%name%` in values with the modifier `expand`.
    """

    name: str = "none"
    case: str = "insensitive"
    missing: str = "null"
    route: dict = field(default_factory=dict)
    placeholders: dict = field(default_factory=dict)


def pieces(value: str) -> list[str]:
    return [p for p in re.split(r"(\\[\\*?]|[*?])", value) if p]


def has_wildcard(value: str) -> bool:
    return any(part in ("*", "?") for part in pieces(value))


def plain(value: str) -> str:
    return re.sub(r"\\([\\*?])", r"\1", value)


def like_pattern(value: str) -> str:
    """Rule wildcards as a LIKE pattern with escape character `!`."""
    marks = {"*": "%", "?": "_"}
    return "".join(marks.get(p) or re.sub(r"([!%_])", r"!\1", plain(p)) for p in pieces(value))


def base64_forms(data: bytes, offsets: int) -> list[str]:
    """Base 64 text of the data behind 0, 1 .. bytes of another text: the characters that hold bits of the data alone."""
    forms = []
    for before in range(offsets):
        text = base64.b64encode(bytes(before) + data).decode()
        forms.append(text[-(-8 * before // 6) : 8 * (before + len(data)) // 6])
    return forms


def dash_forms(text: str) -> list[str]:
    """A value with every dash or slash before a word in each of the ways to write it."""
    return list(dict.fromkeys(re.sub(r"(?<!\w)[-/–—―](?=\w)", lambda _, d=dash: d, text) for dash in DASHES))


def expanded(text: str, placeholders: dict) -> list[str]:
    """The text with every %name% replaced by each of its values."""
    parts = re.split(r"%([A-Za-z0-9_.-]+)%", text)
    for name in parts[1::2]:
        if name not in placeholders:
            raise ValueError(f"unknown placeholder: {name}")
    choices = [[p] if i % 2 == 0 else [str(v) for v in placeholders[p]] for i, p in enumerate(parts)]
    return ["".join(c) for c in itertools.product(*choices)]


def value_forms(text: str, modifiers: list[str], profile: Profile) -> list[str]:
    """The texts that a value stands for; any of them may match. Encoded ones come without wildcards."""
    forms = expanded(text, profile.placeholders) if "expand" in modifiers else [text]
    if "windash" in modifiers:
        forms = [x for f in forms for x in dash_forms(f)]
    charset = [m for m in modifiers if m in CHARSETS]
    encoding = [m for m in modifiers if m in ENCODINGS]
    if len(charset) > 1 or len(encoding) > 1:
        raise ValueError(f"more than one encoding: {', '.join(charset + encoding)}")
    if charset and not encoding:
        raise ValueError(f"{charset[0]} needs base64 or base64offset")
    if not encoding:
        return forms
    if any(has_wildcard(f) for f in forms):
        raise ValueError(f"wildcard in an encoded value: {text}")
    made = [plain(f).encode(CHARSETS[charset[0]] if charset else "utf-8") for f in forms]
    if encoding[0] == "base64":
        return [base64.b64encode(d).decode() for d in made]
    return list(dict.fromkeys(x for d in made for x in base64_forms(d, 3)))


def _regex(text: str, modifiers: list[str]) -> str:
    flags = "".join(m for m in REGEX_FLAGS if m in modifiers)
    return quote(f"(?{flags}){text}" if flags else text)


def _text_sql(source: str, value: str, modifiers: list[str]) -> str:
    """A text comparison of a source that is in the right case already."""
    match = next((m for m in TEXT_MATCHES if m in modifiers), "equals")
    if has_wildcard(value):
        pattern = like_pattern(value)
        pattern = {"contains": f"%{pattern}%", "startswith": f"{pattern}%", "endswith": f"%{pattern}"}.get(match, pattern)
        return f"{source} like {quote(pattern)} escape '!'"
    return f"{source} = {quote(plain(value))}" if match == "equals" else f"{match}({source}, {quote(plain(value))})"


@dataclass(frozen=True)
class Test:
    """`sql` stands alone. `scan_sql` is the same test over helper columns, which tests share: the field `lowered`, None if there is none,
    and the values of the fields `values`. `pushable`: a file scan can evaluate it on its statistics."""

    sql: str
    scan_sql: str
    lowered: str | None = None
    pushable: bool = False
    values: tuple = ()


def open_values_sql(schema: StructType, name: str) -> str | None:
    """The values of a field inside VARIANT values, which cost more to look up than to test; None for any other field."""
    found = resolve(schema, name) if name else None
    return found.sql if found and found.many and isinstance(found.kind, VariantType) else None


def lowered_sql(schema: StructType, name: str) -> str:
    """The helper column of a field: its text, or texts, in lower case; all text of the event for the empty name. It reads the field's values."""
    if not name:
        return all_text_sql(schema)
    found = resolve(schema, name)
    source = column(VALUES + name) if open_values_sql(schema, name) else found.sql
    return f"transform({source}, v -> lower(try_cast(v as string)))" if found.many else f"lower({_as_text(found.sql, found)})"


def _as_text(source: str, found: Field) -> str:
    if isinstance(found.kind, StringType):
        return source
    return f"try_cast({source} as string)" if isinstance(found.kind, VariantType) else f"cast({source} as string)"


def make_test(name: str, modifiers: list[str], kind: str, text: str | None, schema: StructType, profile: Profile) -> Test:
    """The test of one value; a ValueError says what is wrong with it."""
    test = _test(name, modifiers, kind, text, schema, profile)
    for read in dict.fromkeys([name, text] if "fieldref" in modifiers else [name]):
        found = open_values_sql(schema, read)
        if found and (found in test.scan_sql or test.lowered == read):
            test = replace(test, scan_sql=test.scan_sql.replace(found, column(VALUES + read)), values=(*test.values, read))
    return test


def _test(name: str, modifiers: list[str], kind: str, text: str | None, schema: StructType, profile: Profile) -> Test:
    unknown = [m for m in modifiers if m not in KNOWN_MODIFIERS or m in REGEX_FLAGS and "re" not in modifiers]
    if unknown:
        raise ValueError(f"unsupported modifier: {', '.join(unknown)}")
    found = resolve(schema, name) if name else None
    if name and found is None and profile.missing == "error" and "exists" not in modifiers:
        raise ValueError(f"unknown field: {name}")
    if kind == "EMPTY":
        raise ValueError(f"no value for field: {name}")
    if not name:
        return _keyword(schema, modifiers, kind, text, profile)
    many = found is not None and found.many
    found = found or Field("cast(null as string)", StringType())
    # Tests are written for one value; those of a field with many ask whether any element passes.
    one = Field("v", found.kind) if many else found
    any_of = (lambda test, source=found.sql: f"exists({source}, v -> {test})") if many else (lambda test, source=None: test)
    if "exists" in modifiers or kind == "VOID" or text is None:
        absent = "exists" not in modifiers or str(text).lower() == "false"
        held = any_of(f"{_as_text(one.sql, one) if many else one.sql} is not null")
        sql = (f"not coalesce({held}, false)" if absent else held) if many else f"{one.sql} is {'null' if absent else 'not null'}"
        return Test(sql, sql, pushable=not many)
    for modifier, sign in NUMBER_MATCHES.items():
        if modifier in modifiers:
            sql = any_of(f"try_cast({one.sql} as double) {sign} {float(text)!r}D")
            return Test(sql, sql, pushable=isinstance(found.kind, NumericType))
    as_text = _as_text(one.sql, one)
    exact = profile.case == "exact" or "cased" in modifiers
    if "fieldref" in modifiers:
        sql = _reference(found, text, schema, exact, modifiers)
        return Test(sql, sql)
    if "cidr" in modifiers:
        sql = any_of(in_network_sql(as_text, text))
        return Test(sql, sql)
    if "re" in modifiers:
        sql = any_of(f"{as_text} rlike {_regex(text, modifiers)}")
        return Test(sql, sql)
    is_number = re.fullmatch(r"-?[0-9]{1,18}", text) and not set(modifiers) & {*TEXT_MATCHES, *ENCODINGS}
    if isinstance(found.kind, NumericType) and is_number:
        sql = any_of(f"{one.sql} = {text}")
        return Test(sql, sql, pushable=not many)
    forms = value_forms(text, modifiers, profile)
    either = lambda tests: tests[0] if len(tests) == 1 else "(" + " or ".join(tests) + ")"
    if exact or profile.case == "lowered":
        forms = forms if exact else [f.lower() for f in forms]
        test = either([_text_sql(as_text, f, modifiers) for f in forms])
        sql = any_of(f"({test} or {_variant_number(kind, text)})" if is_number and isinstance(found.kind, VariantType) and kind != "STRING" else test)
        return Test(sql, sql, pushable=not many and isinstance(found.kind, StringType) and not any(has_wildcard(f) for f in forms))
    forms = [f.lower() for f in forms]
    test = lambda source: either([_text_sql(source, f, modifiers) for f in forms])
    number = f" or exists({found.sql}, v -> {_variant_number(kind, text)})" if is_number and isinstance(found.kind, VariantType) and kind != "STRING" else ""
    sql = any_of(test(f"lower({as_text})")) + number
    if resolve(schema, name) is None:
        return Test(sql, sql)
    helper = column(LOWERED + name)
    scan = any_of(test("v"), helper) if many else test(helper)
    return Test(f"({sql})" if number else sql, f"({scan}{number})" if number else scan, name)


def _variant_number(kind: str, text: str) -> str:
    """A rule's number equals a number in any form, such as 7.0; a text or a truth value meets it as text only."""
    return f"(schema_of_variant(v) not in ('STRING', 'BOOLEAN') and try_cast(v as double) = {float(text)!r}D)"


def _reference(found: Field, other_name: str, schema: StructType, exact: bool, modifiers: list[str]) -> str:
    other = resolve(schema, other_name) or Field("cast(null as string)", StringType())
    match = next((m for m in TEXT_MATCHES if m in modifiers), None)
    left = _as_text("v" if found.many else found.sql, found)
    right = _as_text("w" if other.many else other.sql, other)
    left, right = (left, right) if exact else (f"lower({left})", f"lower({right})")
    test = f"{match}({left}, {right})" if match else f"{left} = {right}"
    if other.many:
        test = f"exists({other.sql}, w -> {test})"
    return f"exists({found.sql}, v -> {test})" if found.many else test


def _text_columns(schema: StructType) -> list[str]:
    return [column(f.name) for f in schema.fields if isinstance(f.dataType, StringType)]


def all_text_sql(schema: StructType, lower: bool = True) -> str:
    """All text columns of an event, kept apart by a character that no keyword holds; in lower case if asked."""
    joined = f"concat_ws('\\u0001', {', '.join(f"coalesce({c}, '')" for c in _text_columns(schema))})"
    return f"lower({joined})" if lower else joined


def _keyword(schema: StructType, modifiers: list[str], kind: str, text: str | None, profile: Profile) -> Test:
    """A keyword is looked for in every text column; patterns are tested column by column."""
    if kind == "VOID" or text is None:
        raise ValueError("keyword must not be null")
    odd = [m for m in modifiers if m in (*NUMBER_MATCHES, "cidr", "exists", "fieldref")]
    if odd:
        raise ValueError(f"not for keywords: {', '.join(odd)}")
    columns = _text_columns(schema) or ["cast(null as string)"]
    if "re" in modifiers:
        sql = "(" + " or ".join(f"coalesce({c} rlike {_regex(text, modifiers)}, false)" for c in columns) + ")"
        return Test(sql, sql)
    exact = profile.case == "exact" or "cased" in modifiers
    alone, shared, uses = [], [], False
    for form in value_forms(text, modifiers, profile):
        form = form if exact else form.lower()
        if has_wildcard(form):
            pattern = quote(f"%{like_pattern(form)}%")
            sides = columns if exact else [f"lower({c})" for c in columns]
            alone.append("(" + " or ".join(f"coalesce({c} like {pattern} escape '!', false)" for c in sides) + ")")
            shared.append(alone[-1])
        else:
            alone.append(f"contains({all_text_sql(schema, not exact)}, {quote(plain(form))})")
            shared.append(alone[-1] if exact else f"contains({column(LOWERED)}, {quote(plain(form))})")
            uses |= not exact
    sql, scan = (x[0] if len(x) == 1 else "(" + " or ".join(x) + ")" for x in (alone, shared))
    return Test(sql, scan, "" if uses else None)
