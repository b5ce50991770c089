"""Scalar expressions over columns; all stay in whole-stage code generation or built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_trailing_tab(line: Column) -> Column:
    """The line without its carriage return and without exactly one trailing tab."""
    return F.regexp_replace(F.regexp_replace(line, r"\r$", ""), r"\t$", "")


def tab_fields(line: Column) -> Column:
    return F.split(without_trailing_tab(line), "\t", -1)


def file_stem(name: Column) -> Column:
    """The last path segment without its last extension."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.when(base.rlike(r"^.+\.[^.]+$"), F.regexp_extract(base, r"^(.+)\.[^.]+$", 1)).otherwise(base)


def date_in_name(name: Column) -> Column:
    """The first ``yyyy-mm-dd`` in a file name as a date; null without one or if it is no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")), "yyyy-MM-dd")


def partition_date(name: Column, first_time: Column, modified: Column) -> Column:
    """A file's day: in its name, else of its first row, else when it was changed (UTC)."""
    return F.coalesce(date_in_name(name), F.to_date(first_time), F.to_date(modified))


def epoch_to_time(value: Column, unit: str | None = None) -> Column:
    """Seconds since 1970, or milliseconds for values over 1e10; a known ``unit``, ``s`` or ``ms``, holds for all values."""
    if unit not in (None, "s", "ms"):
        raise ValueError(f"unknown unit {unit!r}")
    seconds, millis = F.timestamp_seconds(value), F.timestamp_millis(value.cast("long"))
    return {"s": seconds, "ms": millis}.get(unit, F.when(value > 1e10, millis).otherwise(seconds))


def month_key(time: Column) -> Column:
    return F.date_format(time, "yyyyMM").cast("int")


def is_integral(value: Column) -> Column:
    return value == F.floor(value)


def byte_or_null(value: Column) -> Column:
    """A whole number in 0 to 255 as a short, anything else null instead of wrapped around."""
    return F.when(value.between(0, 255) & is_integral(value), value.cast("short"))


def decimal_text(value: Column, places: int = 4) -> Column:
    """Exact text of a decimal with a fixed number of places (doubles print differently from engine to engine)."""
    return value.cast(f"decimal(38,{places})").cast("string")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def json_or_text(text: Column) -> Column:
    """Canonical JSON if the text parses, else the text as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def entries_to_map(entries: Column) -> Column:
    """(label, text, int_value, float_value, bool_value) entries to a map of texts: the value whose type is set; later labels win."""
    value = lambda e: F.coalesce(e["text"], e["int_value"].cast("string"), e["float_value"].cast("string"), e["bool_value"].cast("string"))
    pairs = F.transform(entries, lambda e: F.struct(e["label"].alias("key"), value(e).alias("value")))
    last = F.filter(pairs, lambda p: p["key"].isNotNull())
    return F.aggregate(last, F.create_map().cast("map<string,string>"), lambda acc, p: F.map_concat(F.map_filter(acc, lambda k, _: k != p["key"]), F.create_map(p["key"], p["value"])))


def overlay(base: Column, more: Column) -> Column:
    """Both maps as one; keys of ``base`` win."""
    return F.map_concat(base, F.map_filter(more, lambda k, _: ~F.map_contains_key(base, k)))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole run time in seconds, to a tenth; null if either end is missing."""
    return F.round((F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6, 1)


def joined_text(items: Column) -> Column:
    return F.array_join(items, ", ")
