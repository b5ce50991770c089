"""Free-form metadata with its types kept: VARIANT columns, which parquet holds as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_or_string(text: Column) -> Column:
    """A JSON text as what it says (number, boolean, object, array, null), any other text as a string; null stays null."""
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def entries_to_variants(entries: Column) -> Column:
    """(label, text, int_value, float_value, bool_value, json) entries to a map of variants: the value whose field is set, with its type.

    ``json`` is read by :func:`json_or_string`. Later labels win, entries without a label are passed over, one with no value set is null.
    """
    as_variant = lambda c: c.cast("variant")
    value = lambda e: F.coalesce(as_variant(e["text"]), as_variant(e["int_value"]), as_variant(e["float_value"]), as_variant(e["bool_value"]), json_or_string(e["json"]))
    named = F.filter(entries, lambda e: e["label"].isNotNull())
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.greatest(F.size(named), F.lit(1))), lambda later: later["label"] == e["label"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["label"].alias("key"), value(e).alias("value"))))


def overlay(base: Column, more: Column) -> Column:
    """Two maps of variants as one VARIANT object; keys of ``base`` win, a null map is empty."""
    empty = F.create_map().cast("map<string,variant>")
    low, high = F.coalesce(base, empty), F.coalesce(more, empty)
    return F.to_variant_object(F.map_concat(low, F.map_filter(high, lambda k, _: ~F.map_contains_key(low, k))))


def typed_fields(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, field, kind and one filled column of int_value, float_value, bool_value, text and json for each field of an object column.

    Kinds: ``int``, ``float``, ``bool``, ``text``, ``json`` (objects, arrays and other values, as JSON) and ``null`` with none filled.
    A value that is no object has no fields. Numbers with a point or exponent are floats, whole ones beyond 64 bits too.
    """
    fields = df.select(key, F.explode(F.try_variant_get(F.col(column), "$", "map<string,variant>")).alias("field", "_value"))
    kind = F.schema_of_variant("_value")
    named = (
        F.when(F.col("_value").isNull() | F.is_variant_null("_value"), "null")
        .when(kind == "BIGINT", "int")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "float")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "STRING", "text")
        .otherwise("json")
    )
    only = lambda name, made: F.when(F.col("kind") == name, made)
    get = lambda t: F.try_variant_get(F.col("_value"), "$", t)
    return fields.withColumn("kind", named).select(
        key, "field", "kind", only("int", get("bigint")).alias("int_value"), only("float", get("double")).alias("float_value"), only("bool", get("boolean")).alias("bool_value"),
        only("text", get("string")).alias("text"), only("json", F.to_json("_value")).alias("json"),
    )
