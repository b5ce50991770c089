"""Predicates of browse queries, as columns that Catalyst pushes to the scan."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq, "!=": operator.ne}


def all_of(parts: Iterable[Column]) -> Column:
    """The conjunction; true if there is nothing to check."""
    return reduce(operator.and_, parts, F.lit(True))


def time_range(time: Column, start: datetime | None = None, end: datetime | None = None) -> list[Column]:
    """Both ends inclusive and optional, at full precision."""
    return [time >= F.lit(start)] * (start is not None) + [time <= F.lit(end)] * (end is not None)


def day_range(day: Column, start: datetime | None = None, end: datetime | None = None) -> list[Column]:
    """The same range for a date column, so that day partitions are pruned."""
    return [day >= F.lit(start.date())] * (start is not None) + [day <= F.lit(end.date())] * (end is not None)


def on_day(time: Column, day: str) -> Column:
    """In [day, day + 1); a null time is not on any day."""
    first = F.to_timestamp(F.lit(day))
    return (time >= first) & (time < first + F.expr("INTERVAL 1 DAY"))


def one_of(column: Column, values: Sequence | None) -> list[Column]:
    return [column.isin(list(values))] if values else []


def value_filters(df: DataFrame, specs: Iterable[dict]) -> list[Column]:
    """Predicates from {column, op, value} or {column, op: between, low, high}.

    An unknown column or operator, or a null value, drops the predicate. Swapped bounds are put right.
    """
    out: list[Column] = []
    for spec in specs:
        name, op = spec.get("column"), spec.get("op")
        if name not in df.columns:
            continue
        if op == "between":
            low, high = spec.get("low"), spec.get("high")
            if low is not None and high is not None:
                out.append(F.col(name).between(min(low, high), max(low, high)))
        elif op in OPERATORS and spec.get("value") is not None:
            out.append(OPERATORS[op](F.col(name), F.lit(spec["value"])))
    return out


def active(status: Column) -> Column:
    """Alerts that are still open."""
    return F.coalesce(status == "FAILURE", F.lit(False))


def not_blank(column: Column) -> Column:
    return F.trim(column) != ""


def contains(column: Column, pattern: str) -> Column:
    """Case-insensitive regular expression; null does not match."""
    return F.coalesce(column.rlike(f"(?i){pattern}"), F.lit(False))


def recent(time: Column, window: str, now: Column) -> Column:
    """``hour``: the hour up to now; ``day``: the same UTC day; ``all``: everything."""
    if window == "hour":
        return (time >= now - F.expr("INTERVAL 1 HOUR")) & (time <= now)
    if window == "day":
        return F.to_date(time) == F.to_date(now)
    if window == "all":
        return F.lit(True)
    raise ValueError(f"unknown window {window!r}")


def telemetry_filter(df: DataFrame, start: datetime | None = None, end: datetime | None = None, classes: Sequence[str] | None = None, flights: Sequence[str] | None = None, values: Iterable[dict] = ()) -> Column:
    """Time range, class list, flight list and value predicates together; a day column, if there is one, is bounded too."""
    parts = time_range(F.col("time"), start, end) + one_of(F.col("class"), classes) + one_of(F.col("flight_id"), flights) + value_filters(df, values)
    if "event_date" in df.columns:
        parts += day_range(F.col("event_date"), start, end)
    return all_of(parts)


def history_filter(assets: Sequence[str] | None = None, flights: Sequence[str] | None = None, first: str | None = None, last: str | None = None) -> Column:
    """Predicates over materialisation history, each optional."""
    parts = one_of(F.col("asset_key"), assets) + one_of(F.col("flight_id"), flights)
    if first is not None:
        parts.append(F.col("partition_date") >= F.lit(first).cast("date"))
    if last is not None:
        parts.append(F.col("partition_date") <= F.lit(last).cast("date"))
    return all_of(parts)
