"""Fields of an event by name: columns, paths into structs, maps, VARIANT values, and arrays of any of them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType


@dataclass(frozen=True)
class Field:
    """`sql` gives the field's value or, with `many`, an array of its values; `kind` is the type of one value."""

    sql: str
    kind: DataType
    many: bool = False


def quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# A column, also inside a struct, or the variable of a lambda.
NAME = re.compile(r"(?:`(?:[^`]|``)*`|\w+)(?:\.(?:`(?:[^`]|``)*`|\w+))*")


def resolve(schema: StructType, name: str) -> Field | None:
    """The field of that name; None if the schema rules out that any event has it.

    A column of the whole name comes first, then paths into the column with the longest name that leads it. Dots may be part of a key: in maps
    and VARIANT values every way to cut the rest of the name into keys is looked up, and what any of them finds is a value of the
    field. An array stands for its elements, at any depth. A VARIANT value says its type itself.
    """
    return _in_struct(schema, "", name)


def _in_struct(schema: StructType, prefix: str, name: str) -> Field | None:
    kinds = {f.name: f.dataType for f in schema.fields}
    parts = name.split(".")
    for cut in range(len(parts), 0, -1):
        head, rest = ".".join(parts[:cut]), ".".join(parts[cut:])
        if head in kinds:
            found = _below(kinds[head], prefix + column(head), rest)
            if found:
                return found
    return None


def _below(kind: DataType, sql: str, rest: str, depth: int = 0) -> Field | None:
    """What `rest` names inside a value of a type; the value itself where nothing is left of the name."""
    if isinstance(kind, ArrayType):
        return _each(sql, lambda x: _below(kind.elementType, x, rest, depth + 1), depth)
    if isinstance(kind, VariantType):
        return Field(_variant_values(sql, rest.split(".") if rest else [], depth), kind, True)
    if not rest:
        return Field(sql, kind)
    if isinstance(kind, StructType):
        return _in_struct(kind, f"{sql}.", rest)
    if isinstance(kind, MapType) and isinstance(kind.keyType, StringType):
        return _in_map(kind, sql, rest.split("."), depth)
    return None


def _each(sql: str, inside, depth: int) -> Field | None:
    """The values of all elements of an array; one without any adds none."""
    x = f"x{depth}"
    found = inside(x)
    if found is None:
        return None
    if found.many:
        return Field(f"flatten(transform({sql}, {x} -> coalesce({found.sql}, array())))", found.kind, True)
    return Field(sql if found.sql == x else f"transform({sql}, {x} -> {found.sql})", found.kind, True)


def _in_map(kind: MapType, sql: str, parts: list[str], depth: int) -> Field | None:
    ways = []
    for cut in range(len(parts), 0, -1):
        value = f"element_at({sql}, {quote('.'.join(parts[:cut]))})"
        found = _below(kind.valueType, value, ".".join(parts[cut:]), depth + 1)
        if found:
            ways.append(found)
    # A whole struct or map is no value where a longer path leads into it.
    if len(parts) > 1:
        ways = [w for w in ways if not isinstance(w.kind, (StructType, MapType))]
    if len(ways) < 2:
        return ways[0] if ways else None
    lists = [f"coalesce({w.sql}, array())" if w.many else f"array({w.sql})" for w in ways]
    return Field(f"concat({', '.join(lists)})", ways[0].kind, True)


def _variant_values(sql: str, parts: list[str], depth: int) -> str:
    """All values of a path in a VARIANT value, as an array of VARIANT. A key that is not there gives one NULL, whatever follows it.

    `sql` is named twice below, so anything but a name is bound to one first: else each key of a path would double the work.
    """
    y = sql if NAME.fullmatch(sql) else f"y{depth}"
    found = f"coalesce(try_variant_get({y}, '$', 'array<variant>'), array({y}))"
    if parts:
        x, ways = f"x{depth}", []
        for cut in range(len(parts), 0, -1):
            key = ".".join(parts[:cut]).replace("\\", "\\\\").replace("'", "\\'")
            value = f"try_variant_get({x}, {quote(f"$['{key}']")}, 'variant')"
            ways.append(_variant_values(value, parts[cut:], depth + 1))
        found = f"flatten(transform({found}, {x} -> {ways[0] if len(ways) == 1 else f"concat({', '.join(ways)})"}))"
    return found if y == sql else f"flatten(transform(array({sql}), {y} -> if({y} is null, array({y}), {found})))"
