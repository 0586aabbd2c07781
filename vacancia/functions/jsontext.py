"""Guards and readers for JSON-text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs: dict) -> Column:
    """A constant map, parsed in one go."""
    def lit(x) -> str:
        return sql_text(x) if isinstance(x, str) else str(x)
    return F.expr("map(" + ", ".join(f"{lit(k)}, {lit(v)}" for k, v in pairs.items()) + ")")


def is_json_array(c: Column) -> Column:
    """True only for a JSON array. ``from_json`` alone would wrap an object."""
    return F.json_array_length(c).isNotNull()


def array_items(c: Column, item_ddl: str) -> Column:
    """Array elements as structs; NULL unless the text is a JSON array."""
    return F.when(is_json_array(c), F.from_json(c, f"array<struct<{item_ddl}>>"))


def json_kind(c: Column) -> Column:
    """Shape of a function field: dict, list, str, int, float, bool or NoneType."""
    t = F.trim(c)
    parsed = F.try_parse_json(t)
    return (
        F.when(c.isNull() | (t == "null"), "NoneType")
        .when(t.startswith("{") & parsed.isNotNull(), "dict")
        .when(t.startswith("[") & parsed.isNotNull(), "list")
        .when(t.rlike(r"^-?\d+$"), "int")
        .when(t.rlike(r"^-?\d+\.\d+$"), "float")
        .when(t.isin("true", "false"), "bool")
        .otherwise("str")
    )


def blank_to_null(c: Column) -> Column:
    """'' becomes NULL; blanks are kept (a plain nullif)."""
    return F.nullif(c, F.lit(""))


def is_filled(c: Column) -> Column:
    """Neither NULL nor ''. A string of blanks counts as filled."""
    return F.coalesce(c != "", F.lit(False))


def is_non_blank(c: Column) -> Column:
    """Not NULL and not only spaces."""
    return F.coalesce(F.trim(c) != "", F.lit(False))
