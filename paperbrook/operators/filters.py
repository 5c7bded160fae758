"""Run-time filters: a list of ``{"key": ..., "value": ...}`` items, all of which must hold, as one Column.

Key forms: ``year``, ``year NOT``, ``year <``, ``<=``, ``>``, ``>=``, ``title LIKE``, ``colour1 OR colour2``.
A list as value means any of them for the plain, NOT and OR forms. A row with a null field never matches.
"""

from __future__ import annotations

import datetime as dt
import operator
import re
from collections.abc import Callable
from decimal import Decimal
from functools import reduce
from typing import Any

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperbrook.functions.text import TOKEN

COMPARISONS: dict[str, Callable[[Column, Any], Column]] = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}

# The columns a question about the corpus may filter by, and their domains.
CORPUS_DOMAINS: dict[str, Any] = {
    "category": ["Construction", "Housing"],
    "year": (1900, 2100),
    "month": (1, 12),
}

# Python types a literal may have for a column type.
LITERALS: list[tuple[type, tuple[type, ...]]] = [
    (T.StringType, (str,)),
    (T.BooleanType, (bool,)),
    (T.IntegralType, (int,)),
    (T.NumericType, (int, float, Decimal)),
    (T.DateType, (dt.date, str)),
    (T.TimestampType, (dt.datetime, dt.date, str)),
    (T.TimestampNTZType, (dt.datetime, dt.date, str)),
]


def parse_key(key: str) -> tuple[list[str], str]:
    """Column names and operator (``=`` when none is written)."""
    if not isinstance(key, str) or not key.strip():
        raise ValueError(f"filter key must be a column name with an optional operator, got {key!r}")
    names = re.split(r"\s+OR\s+", key.strip())
    if len(names) > 1:
        return names, "OR"
    match = re.fullmatch(r"(.*?)\s*(<=|>=|<|>|\sNOT|\sLIKE)", key.strip())
    return ([match[1]], match[2].strip()) if match else ([key.strip()], "=")


def _check_value(name: str, data_type: T.DataType, value: Any) -> None:
    for column_type, literal_types in LITERALS:
        if isinstance(data_type, column_type):
            if isinstance(value, bool) and column_type is not T.BooleanType:
                break
            if isinstance(value, literal_types):
                return
            break
    raise ValueError(f"filter on {name}: {value!r} does not fit {data_type.simpleString()}")


def validate_filters(
    filters: list[dict[str, Any]],
    schema: T.StructType,
    allowed: list[str] | None = None,
    domains: dict[str, Any] | None = None,
) -> None:
    """Raise ValueError for an unknown key, a wrong operator, a value of the wrong type or out of its domain.

    ``allowed`` limits the columns; ``domains`` maps a column to a (low, high) range or a list of values.
    """
    fields = {f.name: f.dataType for f in schema}
    for item in filters:
        if not isinstance(item, dict) or set(item) != {"key", "value"}:
            raise ValueError(f"a filter has exactly a key and a value, got {item!r}")
        names, op = parse_key(item["key"])
        value = item["value"]
        values = list(value) if isinstance(value, (list, tuple)) else [value]
        if not values:
            raise ValueError(f"filter {item['key']!r} has no value")
        if len(values) > 1 and op in (*COMPARISONS, "LIKE") or isinstance(value, (list, tuple)) and op in COMPARISONS:
            raise ValueError(f"filter {item['key']!r} takes a single value")
        for name in names:
            if name not in fields or (allowed is not None and name not in allowed):
                raise ValueError(f"unknown filter column {name!r}")
            if op == "LIKE" and not isinstance(fields[name], T.StringType):
                raise ValueError(f"LIKE needs a string column, {name} is {fields[name].simpleString()}")
            for one in values:
                _check_value(name, fields[name], one)
                domain = (domains or {}).get(name)
                if isinstance(domain, tuple) and not domain[0] <= one <= domain[1]:
                    raise ValueError(f"filter on {name}: {one!r} is outside {domain[0]} to {domain[1]}")
                if isinstance(domain, (list, set)) and one not in domain:
                    raise ValueError(f"filter on {name}: {one!r} is not one of {sorted(domain)}")


def has_tokens(text: Column, value: str) -> Column:
    """Every token of ``value`` occurs as a whole token of ``text``, in any case.

    The plain substring test rules most rows out before the pattern looks at token borders, and no
    token array is built.
    """
    wanted = list(dict.fromkeys(regex.findall(TOKEN, value.lower())))
    if not wanted:
        raise ValueError(f"LIKE needs at least one letter or digit, got {value!r}")
    lowered = F.lower(text)
    tests = [
        F.contains(lowered, F.lit(token)) & lowered.rlike(rf"(?<![\p{{L}}\p{{N}}]){token}(?![\p{{L}}\p{{N}}])")
        for token in wanted
    ]
    return reduce(operator.and_, tests)


def compile_filter(key: str, value: Any) -> Column:
    names, op = parse_key(key)
    columns = [F.col(f"`{name}`") for name in names]
    values = list(value) if isinstance(value, (list, tuple)) else [value]
    if op in COMPARISONS:
        return COMPARISONS[op](columns[0], value)
    if op == "LIKE":
        return has_tokens(columns[0], values[0])
    if op == "NOT":
        return ~columns[0].isin(values) if len(values) > 1 else columns[0] != values[0]
    return reduce(operator.or_, [c.isin(values) if len(values) > 1 else c == values[0] for c in columns])


def compile_filters(filters: list[dict[str, Any]] | None) -> Column | None:
    """All filters joined by AND, or None without any."""
    if not filters:
        return None
    return reduce(operator.and_, [compile_filter(f["key"], f["value"]) for f in filters])


def apply_filters(
    df: DataFrame, filters: list[dict[str, Any]] | None, allowed: list[str] | None = None,
    domains: dict[str, Any] | None = None,
) -> DataFrame:
    """Validate against the schema, then filter; comparisons and IN reach the Parquet scan."""
    validate_filters(filters or [], df.schema, allowed, domains)
    predicate = compile_filters(filters)
    return df if predicate is None else df.where(predicate)
