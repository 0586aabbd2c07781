"""JSON-LD blocks of a page, as VARIANT values and typed fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = r"""(?s)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""


def blocks(html: Column, ignore_case: bool = False) -> Column:
    """Readable JSON-LD documents of a page, in page order; broken ones are dropped."""
    pattern = _BLOCK.replace("(?s)", "(?si)") if ignore_case else _BLOCK
    texts = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.filter(F.transform(texts, lambda t: F.try_parse_json(F.trim(t))), lambda v: v.isNotNull())


def objects_of_type(html: Column, kind: str, arrays: bool = True, ignore_case: bool = False) -> Column:
    """Documents (or members of array documents) whose @type is ``kind``."""
    docs = blocks(html, ignore_case)
    if arrays:
        docs = F.flatten(F.transform(
            docs, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))
        ))
    return F.filter(docs, lambda v: F.coalesce(text(v, "$['@type']") == kind, F.lit(False)))


def first_of_type(html: Column, kind: str, arrays: bool = True, ignore_case: bool = False) -> Column:
    return F.get(objects_of_type(html, kind, arrays, ignore_case), F.lit(0))


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def kind_of(v: Column, path: str) -> Column:
    """OBJECT, ARRAY, STRING, NUMBER, BOOLEAN, VOID or NULL (field absent)."""
    name = F.schema_of_variant(field(v, path))
    return (
        F.when(name.startswith("OBJECT"), "OBJECT").when(name.startswith("ARRAY"), "ARRAY")
        .when(name == "STRING", "STRING").when(name == "BOOLEAN", "BOOLEAN").when(name == "VOID", "VOID")
        .when(name.isNotNull(), "NUMBER")
    )


def text(v: Column, path: str) -> Column:
    """Scalar as text (any scalar type)."""
    return F.try_variant_get(v, path, "string")


def only_text(v: Column, path: str) -> Column:
    """Value only when it is a JSON string."""
    return F.when(kind_of(v, path) == "STRING", text(v, path))


def only_number(v: Column, path: str) -> Column:
    """Value only when it is a JSON number."""
    return F.when(kind_of(v, path) == "NUMBER", F.try_variant_get(v, path, "double"))


def filled_text(v: Column, path: str) -> Column:
    """Scalar text, '' as NULL."""
    return F.nullif(text(v, path), F.lit(""))


def items(v: Column, path: str) -> Column:
    """Members of an array field."""
    return F.try_variant_get(v, path, "array<variant>")
