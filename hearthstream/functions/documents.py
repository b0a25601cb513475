"""Schemaless JSON on Spark's VARIANT type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however many later steps use it.

    A generator is a border for the optimizer: neither a filter nor a projection above
    repeats the expression.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def enveloped(text: Column) -> Column:
    """The text parsed inside ``{"v":[text],"end":true}``, NULL on a syntax error.

    The parser stops after the first value, so text such as ``{"a":1} tail``
    would pass on its own.  In front of a closing marker any remainder is a
    syntax error, or a second element.
    """
    return F.try_parse_json(F.concat(F.lit('{"v":['), text, F.lit('],"end":true}')))


def only_value(envelope: Column) -> Column:
    """The single value of an :func:`enveloped` text, else NULL."""
    whole = F.try_variant_get(envelope, "$.end", "boolean") & F.try_variant_get(
        envelope, "$.v[1]", "variant"
    ).isNull()
    return F.when(whole, F.try_variant_get(envelope, "$.v[0]", "variant"))


def parse_json_value(text: Column) -> Column:
    """One whole JSON value as VARIANT, NULL when the text is not exactly that."""
    return bound(enveloped(text), only_value)


def value_kind(value: Column) -> Column:
    """``number``, ``boolean``, ``string``, ``null``, ``object`` or ``array``."""
    shape = F.schema_of_variant(value)
    return (
        F.when(shape == "STRING", "string")
        .when(shape == "VOID", "null")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape.isNotNull(), "number")
    )


def tag_type(kind: Column) -> Column:
    """The type a tag gets from the kind of its first value."""
    return (
        F.when(kind.isin("number", "boolean"), "numeric")
        .when(kind == "null", "null")
        .when(kind.isNotNull(), "text")
    )


def as_number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def is_json_null(value: Column) -> Column:
    return F.is_variant_null(value)


# How the schema text of a value starts, by kind.
_SHAPES = {
    "string": r"\ASTRING",
    "boolean": r"\ABOOLEAN",
    "number": r"\A(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)",
    "object": r"\AOBJECT",
    "array": r"\AARRAY",
}


def is_kind(value: Column, kind: str) -> Column:
    """Whether a value has one kind; NULL for no value."""
    return F.schema_of_variant(value).rlike(_SHAPES[kind])


def field(document: Column, name: str, kind: str, spark_type: str) -> Column:
    """A top-level field, only if it has the wanted JSON kind; otherwise NULL."""
    value = F.try_variant_get(document, f"$.{name}", "variant")
    return F.when(is_kind(value, kind), F.try_variant_get(document, f"$.{name}", spark_type))


def has_kind_or_none(document: Column, name: str, kind: str) -> Column:
    """Whether a field is absent, JSON null, or of the wanted kind."""
    value = F.try_variant_get(document, f"$.{name}", "variant")
    return value.isNull() | F.is_variant_null(value) | F.coalesce(is_kind(value, kind), F.lit(False))


def is_text_list(document: Column, name: str) -> Column:
    """Whether a field is absent, JSON null, or an array of strings and nulls."""
    value = F.try_variant_get(document, f"$.{name}", "variant")
    items = F.try_variant_get(value, "$", "array<variant>")
    plain = F.forall(
        items, lambda x: x.isNull() | F.is_variant_null(x) | F.coalesce(is_kind(x, "string"), F.lit(False))
    )
    listed = F.coalesce(is_kind(value, "array"), F.lit(False)) & F.coalesce(plain, F.lit(False))
    return value.isNull() | F.is_variant_null(value) | listed


def is_whole_or_none(document: Column, name: str) -> Column:
    """Whether a field is absent, JSON null, or a number without fraction that fits 64 bits."""
    value = F.try_variant_get(document, f"$.{name}", "variant")
    whole = F.schema_of_variant(value).rlike(r"\A(BIGINT|INT|SMALLINT|TINYINT)")
    return value.isNull() | F.is_variant_null(value) | F.coalesce(whole, F.lit(False))


def merge_json(base: Column, overlay: Column) -> Column:
    """Two map<string,variant> as one JSON object with sorted keys.

    The overlay wins on equal keys and may be NULL.
    """
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(overlay, k))
    merged = F.when(overlay.isNull(), base).otherwise(F.map_concat(kept, overlay))
    names = F.array_sort(F.map_keys(merged))
    return F.to_json(
        F.map_from_arrays(names, F.transform(names, lambda k: F.try_element_at(merged, k)))
    )
