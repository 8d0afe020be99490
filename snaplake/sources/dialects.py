"""What differs between the relational sources: names, quoting, hashing and catalog rules, as data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal
from typing import Any


@dataclass(frozen=True)
class Dialect:
    name: str
    driver: str
    url_template: str
    session_statement: str
    quote_char: str
    bucket_template: str
    integer_types: tuple[str, ...]
    system_namespaces: tuple[str, ...]
    system_prefix: str | None
    lists_views: bool
    unknown_age_is_stale: bool
    rounds_age: bool
    text_keys: bool
    physical_pages: bool
    backslash_escapes: bool

    def url(self, host: str, port: int | str, database: str = "") -> str:
        return self.url_template.format(host=host, port=port, database=database)

    def quote(self, name: str) -> str:
        q = self.quote_char
        return q + name.replace(q, q * 2) + q

    def table(self, namespace: str, table: str) -> str:
        return f"{self.quote(namespace)}.{self.quote(table)}"

    def in_bucket(self, column: str, buckets: int, bucket: int) -> str:
        """Text that holds for the rows of one hash bucket of an already quoted column; nulls are in bucket 0."""
        test = f"{self.bucket_template.format(column=column, buckets=buckets)} = {bucket}"
        return f"({test} OR {column} IS NULL)" if bucket == 0 else test

    def literal(self, value: Any) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return str(value).upper()
        if isinstance(value, (int, float, Decimal)):
            return str(value)
        if isinstance(value, date):
            value = value.isoformat()
        if not isinstance(value, str):
            raise ValueError(f"unsupported filter value of type {type(value).__name__}")
        if self.backslash_escapes:
            value = value.replace("\\", "\\\\")
        return "'" + value.replace("'", "''") + "'"


# Driver classes, session statements, key types, system namespaces and bucket functions of the
# two servers. The MySQL url asks for a server-side cursor: without one the driver holds a task's whole result
# in memory, whatever the fetch size.
MYSQL = Dialect(
    name="mysql",
    driver="com.mysql.cj.jdbc.Driver",
    url_template="jdbc:mysql://{host}:{port}/{database}?serverTimezone=UTC&useCursorFetch=true",
    session_statement="START TRANSACTION WITH CONSISTENT SNAPSHOT",
    quote_char="`",
    bucket_template="MOD(CRC32({column}), {buckets})",
    integer_types=("tinyint", "smallint", "mediumint", "int", "bigint"),
    system_namespaces=("information_schema", "performance_schema", "mysql", "sys"),
    system_prefix=None,
    lists_views=True,
    unknown_age_is_stale=False,
    rounds_age=False,
    text_keys=True,
    physical_pages=False,
    backslash_escapes=True,
)

POSTGRESQL = Dialect(
    name="postgresql",
    driver="org.postgresql.Driver",
    url_template="jdbc:postgresql://{host}:{port}/{database}",
    session_statement="SET SESSION CHARACTERISTICS AS TRANSACTION ISOLATION LEVEL REPEATABLE READ",
    quote_char='"',
    bucket_template="MOD(ABS(HASHTEXT(({column})::text)::bigint), {buckets})",
    integer_types=("smallint", "integer", "bigint"),
    system_namespaces=("information_schema", "pg_catalog", "pg_toast", "pg_temp_1", "pg_toast_temp_1"),
    system_prefix="pg_",
    lists_views=False,
    unknown_age_is_stale=True,
    rounds_age=True,
    text_keys=False,
    physical_pages=True,
    backslash_escapes=False,
)

DIALECTS: dict[str, Dialect] = {d.name: d for d in (MYSQL, POSTGRESQL)}


def dialect_of(name: str) -> Dialect:
    try:
        return DIALECTS[name.lower()]
    except KeyError:
        raise ValueError(f"unsupported source {name!r}; use one of {sorted(DIALECTS)}") from None
