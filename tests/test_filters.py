import datetime as dt
from decimal import Decimal

import pytest

from snaplake import MYSQL, POSTGRESQL, to_column, to_sql, validate_filter

ROWS = [
    (1, 5, 1.5, "it's", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), True, Decimal("1.10")),
    (2, -7, -2.0, "back\\slash", dt.datetime(2024, 1, 2, 12), dt.date(2024, 1, 2), False, Decimal("2.20")),
    (3, 2**53 + 1, 0.0, "100%", dt.datetime(2024, 2, 1), dt.date(2024, 2, 1), True, Decimal("0.00")),
    (4, 0, 9.25, "a_b", dt.datetime(2025, 1, 1), dt.date(2025, 1, 1), False, Decimal("9.99")),
    (5, None, None, None, None, None, None, None),
    (6, 6, 6.0, "ABC", dt.datetime(2024, 1, 1, 0, 0, 1), dt.date(2024, 1, 3), True, Decimal("6.00")),
    (7, 7, 7.0, "abc", dt.datetime(2023, 12, 31), dt.date(2023, 12, 31), False, Decimal("7.00")),
]
SCHEMA = "id int, i bigint, d double, s string, t timestamp_ntz, day date, b boolean, m decimal(10,2)"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def ids(df, group):
    return sorted(r["id"] for r in df.filter(to_column(group, df.schema)).select("id").collect())


def one(field, op, value=None):
    return {"conditions": [{"field": field, "op": op, "value": value}]}


@pytest.mark.parametrize(
    "field, op, value, expected",
    [
        ("i", "eq", 5, [1]),
        ("i", "ne", 5, [2, 3, 4, 6, 7]),
        ("i", "gt", 5.5, [3, 6, 7]),
        ("i", "eq", float(2**53), []),  # exact: a double would call 2^53 + 1 equal
        ("i", "eq", "6", [6]),
        ("i", "lte", "0", [2, 4]),
        ("i", "in", [0, 7, None], [4, 7]),
        ("i", "between", [7, 5], []),
        ("i", "between", [5, 7], [1, 6, 7]),
        ("i", "between", [None, 7], []),
        ("i", "eq", True, []),
        ("d", "gte", 6, [4, 6, 7]),
        ("d", "lt", "0", [2]),
        ("d", "in", [1.5, 9.25], [1, 4]),
        ("m", "gt", 6.0, [4, 7]),
        ("m", "eq", 1.1, [1]),
        ("s", "eq", "it's", [1]),
        ("s", "eq", "back\\slash", [2]),
        ("s", "eq", "abc", [7]),
        ("s", "like", "a%", [4, 7]),
        ("s", "like", "a_b", [4]),
        ("s", "like", "%\\%", [3]),
        ("s", "like", "___", [4, 6, 7]),
        ("s", "ne", "abc", [1, 2, 3, 4, 6]),
        ("i", "like", "%7", [2, 7]),
        ("t", "gte", "2024-01-02", [2, 3, 4]),
        ("t", "eq", "2024-01-01", [1]),
        ("t", "lt", dt.date(2024, 1, 1), [7]),
        ("t", "between", ["2024-01-01", "2024-01-31T00:00:00"], [1, 2, 6]),
        ("t", "eq", "2024-01-01T00:00:01Z", [6]),
        ("day", "lte", "2024-01-01", [1, 7]),
        ("day", "gt", "2024-01-01 10:00:00", [2, 3, 4, 6]),
        ("day", "in", [dt.date(2025, 1, 1)], [4]),
        ("b", "eq", True, [1, 3, 6]),
        ("b", "ne", 1, [2, 4, 7]),
        ("s", "is_null", None, [5]),
        ("t", "is_not_null", None, [1, 2, 3, 4, 6, 7]),
        ("ID", "eq", 3, [3]),
    ],
)
def test_operators(df, field, op, value, expected):
    assert ids(df, one(field, op, value)) == expected


def test_nesting_and_default_logic(df):
    group = {
        "conditions": [{"field": "id", "op": "lte", "value": 6}],
        "groups": [
            {
                "logic": "or",
                "conditions": [{"field": "s", "op": "is_null"}],
                "groups": [
                    {
                        "logic": "and",
                        "conditions": [
                            {"field": "i", "op": "gt", "value": 0},
                            {"field": "d", "op": "lt", "value": 6},
                        ],
                    }
                ],
            }
        ],
    }
    assert ids(df, group) == [1, 3, 5]


@pytest.mark.parametrize(
    "group",
    [
        one("i", "is_null", 1),
        one("i", "eq"),
        one("i", "in", []),
        one("i", "in", 3),
        one("i", "between", [1, 2, 3]),
        one("i", "gt", [1]),
        one("i", "matches", 1),
        one("i", "like", 3),
        one("a;b", "eq", 1),
        one("i", "eq", b"bytes"),
        {},
        {"conditions": [], "groups": []},
        {"logic": "xor", "conditions": [{"field": "i", "op": "is_null"}]},
        {"conditions": ["i = 1"]},
        {"conditions": [{"op": "eq", "value": 1}]},
        {"groups": [{}]},
        {"groups": ["x"]},
    ],
)
def test_malformed_filters_are_refused(group):
    with pytest.raises(ValueError):
        validate_filter(group)


@pytest.mark.parametrize(
    "field, value",
    [
        ("missing", 1), ("i", "abc"), ("t", "yesterday"), ("s", 5), ("t", 5), ("b", "maybe"), ("day", "2024-13-01"),
        ("i", dt.date(2024, 1, 1)),
    ],
)
def test_misfits_are_refused_before_a_job(df, field, value):
    with pytest.raises(ValueError):
        to_column(one(field, "eq", value), df.schema)


def test_only_null_tests_on_nested_columns(spark):
    nested = spark.createDataFrame([([1],)], "a array<int>")
    assert nested.filter(to_column(one("a", "is_not_null"), nested.schema)).count() == 1
    with pytest.raises(ValueError):
        to_column(one("a", "eq", 1), nested.schema)


def test_source_text():
    group = {
        "logic": "or",
        "conditions": [
            {"field": "s", "op": "eq", "value": "it's a \\"},
            {"field": "n", "op": "in", "value": [1, None, True]},
            {"field": "t", "op": "between", "value": [dt.date(2024, 1, 1), "2024-02-01"]},
        ],
        "groups": [{"conditions": [{"field": "s", "op": "is_not_null"}, {"field": "n", "op": "ne", "value": 1.5}]}],
    }
    assert to_sql(group, MYSQL) == (
        "(`s` = 'it''s a \\\\' OR `n` IN (1, NULL, TRUE) OR `t` BETWEEN '2024-01-01' AND '2024-02-01'"
        " OR (`s` IS NOT NULL AND `n` <> 1.5))"
    )
    assert to_sql(group, POSTGRESQL) == (
        "(\"s\" = 'it''s a \\' OR \"n\" IN (1, NULL, TRUE) OR \"t\" BETWEEN '2024-01-01' AND '2024-02-01'"
        ' OR ("s" IS NOT NULL AND "n" <> 1.5))'
    )


def test_filter_text_and_column_agree(spark, df):
    """The MySQL text is also valid Spark SQL, so both renderings can be run over the same rows."""
    group = {
        "logic": "or",
        "conditions": [{"field": "s", "op": "like", "value": "%b%"}, {"field": "i", "op": "gt", "value": 6}],
        "groups": [{"conditions": [{"field": "b", "op": "eq", "value": True}, {"field": "d", "op": "lt", "value": 2}]}],
    }
    text = sorted(r["id"] for r in df.filter(to_sql(group, MYSQL)).collect())
    assert text == ids(df, group)


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    group = {
        "conditions": [
            {"field": "o_orderstatus", "op": "eq", "value": "F"},
            {"field": "o_orderdate", "op": "gte", "value": "1996-01-01"},
            {"field": "o_orderpriority", "op": "like", "value": "1-%"},
        ]
    }
    plan = orders.filter(to_column(group, orders.schema))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(o_orderstatus,F)" in pushed
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in pushed
    assert "StringStartsWith(o_orderpriority,1-)" in pushed
