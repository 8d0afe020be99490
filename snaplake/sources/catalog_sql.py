"""Catalog queries of the two servers: what each sends for every catalog frame, as plain text."""

from __future__ import annotations

_MYSQL = {
    "namespaces": "SELECT schema_name AS ns FROM information_schema.schemata",
    "tables": (
        "SELECT table_schema AS ns, table_name AS `table`, table_type AS table_type FROM information_schema.tables"
    ),
    "constraints": (
        "SELECT table_schema AS ns, table_name AS `table`, constraint_name AS constraint_name,"
        " constraint_type AS constraint_type FROM information_schema.table_constraints"
    ),
    "key_usage": (
        "SELECT table_schema AS ns, table_name AS `table`, constraint_name AS constraint_name,"
        " column_name AS `column`, ordinal_position AS ordinal FROM information_schema.key_column_usage"
    ),
    "columns": (
        "SELECT table_schema AS ns, table_name AS `table`, column_name AS `column`, data_type AS data_type"
        " FROM information_schema.columns"
    ),
    "relations": (
        "SELECT table_schema AS ns, table_name AS `table`, CAST(table_rows AS SIGNED) AS `rows`,"
        " CAST(0 AS SIGNED) AS pages FROM information_schema.tables"
    ),
    "column_stats": (
        "SELECT table_schema AS ns, table_name AS `table`, column_name AS `column`, CAST(NULL AS SIGNED) AS avg_width"
        " FROM information_schema.columns WHERE 1 = 0"
    ),
    "stats_times": (
        "SELECT t.table_schema AS ns, t.table_name AS `table`, s.last_update AS last_update,"
        " t.update_time AS update_time, t.create_time AS create_time FROM information_schema.tables t"
        " LEFT JOIN mysql.innodb_table_stats s ON s.database_name = t.table_schema AND s.table_name = t.table_name"
    ),
}

_POSTGRESQL = {
    "namespaces": "SELECT schema_name::text AS ns FROM information_schema.schemata",
    "tables": (
        'SELECT table_schema::text AS ns, table_name::text AS "table", table_type::text AS table_type'
        " FROM information_schema.tables"
    ),
    "constraints": (
        'SELECT table_schema::text AS ns, table_name::text AS "table", constraint_name::text AS constraint_name,'
        " constraint_type::text AS constraint_type FROM information_schema.table_constraints"
    ),
    "key_usage": (
        'SELECT table_schema::text AS ns, table_name::text AS "table", constraint_name::text AS constraint_name,'
        ' column_name::text AS "column", ordinal_position::int AS ordinal FROM information_schema.key_column_usage'
    ),
    "columns": (
        'SELECT table_schema::text AS ns, table_name::text AS "table", column_name::text AS "column",'
        " data_type::text AS data_type FROM information_schema.columns"
    ),
    "relations": (
        'SELECT n.nspname::text AS ns, c.relname::text AS "table", c.reltuples::bigint AS rows,'
        " c.relpages::bigint AS pages FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace"
        " WHERE c.relkind IN ('r', 'p', 'm')"
    ),
    "column_stats": (
        'SELECT schemaname::text AS ns, tablename::text AS "table", attname::text AS "column",'
        " avg_width::int AS avg_width FROM pg_stats"
    ),
    "stats_times": (
        'SELECT schemaname::text AS ns, relname::text AS "table", last_autoanalyze AS last_update,'
        " last_analyze AS update_time, NULL::timestamptz AS create_time FROM pg_stat_all_tables"
    ),
}

CATALOG_SQL: dict[str, dict[str, str]] = {"mysql": _MYSQL, "postgresql": _POSTGRESQL}
