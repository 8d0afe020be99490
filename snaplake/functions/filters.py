"""Structured filters: nested AND/OR groups of conditions, compiled to Spark columns.

A filter is the JSON shape a request carries::

    {"logic": "and",
     "conditions": [{"field": "status", "op": "eq", "value": "paid"}],
     "groups": [{"logic": "or", "conditions": [...]}]}

``to_column`` is the way to use one: Spark pushes the resulting predicate into parquet and JDBC scans.
``to_sql`` renders the same filter for a source-side subquery.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timezone
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.sources.dialects import Dialect

# Fixed value: what a field name may look like.
FIELD_PATTERN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")

ONE, MANY, PAIR, NOTHING = "one value", "a non-empty list", "a list of exactly two values", "no value"


@dataclass(frozen=True)
class Operator:
    takes: str
    column: Callable[[Column, list[Column]], Column]
    sql: str  # {c} the column, {0} and {1} the literals, {all} every literal


# The operators a filter may name.
OPERATORS: dict[str, Operator] = {
    "eq": Operator(ONE, lambda c, v: c == v[0], "{c} = {0}"),
    "ne": Operator(ONE, lambda c, v: c != v[0], "{c} <> {0}"),
    "gt": Operator(ONE, lambda c, v: c > v[0], "{c} > {0}"),
    "gte": Operator(ONE, lambda c, v: c >= v[0], "{c} >= {0}"),
    "lt": Operator(ONE, lambda c, v: c < v[0], "{c} < {0}"),
    "lte": Operator(ONE, lambda c, v: c <= v[0], "{c} <= {0}"),
    "like": Operator(ONE, lambda c, v: F.like(c, v[0]), "{c} LIKE {0}"),
    "in": Operator(MANY, lambda c, v: c.isin(v), "{c} IN ({all})"),
    "between": Operator(PAIR, lambda c, v: c.between(v[0], v[1]), "{c} BETWEEN {0} AND {1}"),
    "is_null": Operator(NOTHING, lambda c, v: c.isNull(), "{c} IS NULL"),
    "is_not_null": Operator(NOTHING, lambda c, v: c.isNotNull(), "{c} IS NOT NULL"),
}

LOGIC: dict[str, Callable[[Column, Column], Column]] = {"and": operator.and_, "or": operator.or_}


def _values(condition: Mapping[str, Any]) -> list[Any]:
    """The condition's literals as a list, after checking they fit the operator."""
    op, value = condition["op"], condition.get("value")
    takes = OPERATORS[op].takes
    fits = {
        ONE: value is not None and not isinstance(value, list),
        MANY: isinstance(value, list) and len(value) > 0,
        PAIR: isinstance(value, list) and len(value) == 2,
        NOTHING: value is None,
    }[takes]
    if not fits:
        raise ValueError(f"'{op}' takes {takes}, got {value!r}")
    values = value if isinstance(value, list) else [] if takes == NOTHING else [value]
    if op == "like" and not isinstance(value, str):
        raise ValueError("'like' takes a string pattern")
    return values


def validate_filter(group: Mapping[str, Any]) -> None:
    """Raise ``ValueError`` for a malformed filter, before any job starts."""
    if not isinstance(group, Mapping):
        raise ValueError("a filter group must be an object")
    if str(group.get("logic", "and")).lower() not in LOGIC:
        raise ValueError(f"unknown logic {group.get('logic')!r}; use one of {list(LOGIC)}")
    conditions, children = group.get("conditions") or [], group.get("groups") or []
    if not conditions and not children:
        raise ValueError("a filter group needs a condition or a child group")
    for condition in conditions:
        if not isinstance(condition, Mapping) or not {"field", "op"} <= condition.keys():
            raise ValueError(f"a condition needs a field and an op, got {condition!r}")
        if condition["op"] not in OPERATORS:
            raise ValueError(f"unknown operator {condition['op']!r}; use one of {list(OPERATORS)}")
        if not FIELD_PATTERN.fullmatch(str(condition["field"])):
            raise ValueError(f"not a column name: {condition['field']!r}")
        for value in _values(condition):
            if value is not None and not isinstance(value, (bool, int, float, Decimal, date, str)):
                raise ValueError(f"unsupported filter value of type {type(value).__name__}")
    for child in children:
        validate_filter(child)


def _fold(group: Mapping[str, Any], leaf: Callable[[Mapping[str, Any]], Any], join: Callable[[str, list], Any]) -> Any:
    parts = [leaf(c) for c in group.get("conditions") or []]
    parts += [_fold(g, leaf, join) for g in group.get("groups") or []]
    return join(str(group.get("logic", "and")).lower(), parts)


def to_column(group: Mapping[str, Any], schema: T.StructType) -> Column:
    """The filter as one boolean ``Column`` over rows of ``schema``.

    Literals take the type of their column, so a malformed date or number raises here, not inside a task.
    """
    validate_filter(group)
    exact = {f.name: f for f in schema.fields}
    loose = {f.name.lower(): f for f in schema.fields}

    def leaf(condition: Mapping[str, Any]) -> Column:
        name = str(condition["field"])
        field = exact.get(name) or loose.get(name.lower())
        if field is None:
            raise ValueError(f"no column {name!r}; the table has {sorted(exact)}")
        column, dtype = F.col(f"`{field.name}`"), field.dataType
        if condition["op"] == "like" and not isinstance(dtype, T.StringType):
            column, dtype = column.cast("string"), T.StringType()
        return OPERATORS[condition["op"]].column(column, [_literal(v, dtype) for v in _values(condition)])

    return _fold(group, leaf, lambda logic, parts: functools.reduce(LOGIC[logic], parts))


def to_sql(group: Mapping[str, Any], dialect: Dialect) -> str:
    """The filter as a WHERE text in the source's dialect."""
    validate_filter(group)

    def leaf(condition: Mapping[str, Any]) -> str:
        literals = [dialect.literal(v) for v in _values(condition)]
        template = OPERATORS[condition["op"]].sql
        return template.format(*literals, c=dialect.quote(str(condition["field"])), all=", ".join(literals))

    return _fold(group, leaf, lambda logic, parts: "(" + f" {logic.upper()} ".join(parts) + ")")


# --- literals -------------------------------------------------------------------------------------------


def _literal(value: Any, dtype: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    for kind, convert in _CONVERTERS:
        if isinstance(dtype, kind):
            return convert(value, dtype)
    raise ValueError(f"a {dtype.simpleString()} column can only be tested for null")


def _reject(value: Any, dtype: T.DataType) -> ValueError:
    return ValueError(f"{value!r} does not fit a {dtype.simpleString()} column")


def _text(value: Any, dtype: T.DataType) -> Column:
    if isinstance(value, date):
        return F.lit(value.isoformat())
    if not isinstance(value, str):
        raise _reject(value, dtype)
    return F.lit(value)


def _number(value: Any, dtype: T.DataType) -> Column:
    if isinstance(value, date):
        raise _reject(value, dtype)
    try:
        number = Decimal(int(value)) if isinstance(value, bool) else Decimal(str(value).strip())
    except InvalidOperation:
        raise _reject(value, dtype) from None
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.lit(float(number))
    if not number.is_finite():
        raise _reject(value, dtype)
    if number == number.to_integral_value() and abs(number) < 2**63:
        return F.lit(int(number))
    # A fraction against an integer column: compared exactly, not truncated and not through a double.
    sign, digits, exponent = number.as_tuple()
    scale = max(-exponent, 0)
    if max(len(digits) + max(exponent, 0), scale) > 38:
        return F.lit(float(number))
    return F.lit(number)


def _boolean(value: Any, dtype: T.DataType) -> Column:
    words = {"true": True, "t": True, "1": True, "false": False, "f": False, "0": False}
    known = words.get(str(value).lower())
    if known is None:
        raise _reject(value, dtype)
    return F.lit(known)


def _moment(value: Any, dtype: T.DataType) -> Column:
    try:
        if isinstance(value, str):
            value = datetime.fromisoformat(value.strip())
        elif isinstance(value, date) and not isinstance(value, datetime):
            value = datetime(value.year, value.month, value.day)
    except ValueError:
        raise _reject(value, dtype) from None
    if not isinstance(value, datetime):
        raise _reject(value, dtype)
    if value.tzinfo:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(dtype, T.DateType):
        if value.time() == datetime.min.time():
            return F.lit(value.date())
        dtype = T.TimestampNTZType()  # a date compared with a moment of a day
    return F.lit(value.isoformat(sep=" ")).cast(dtype)


_CONVERTERS: list[tuple[type | tuple[type, ...], Callable[[Any, T.DataType], Column]]] = [
    (T.StringType, _text),
    (T.BooleanType, _boolean),
    (T.NumericType, _number),
    ((T.DateType, T.TimestampType, T.TimestampNTZType), _moment),
    (T.BinaryType, lambda v, t: _text(v, t).cast("binary")),
]
