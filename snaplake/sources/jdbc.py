"""Tables of a MySQL or PostgreSQL server, read by Spark's JDBC source.

Every partition of a read is one connection with its own transaction: the session statement makes each of
them consistent in itself, not all of them together. For PostgreSQL a caller that holds an exported snapshot
open can pass ``session_statement`` to import it in every reader.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.config import DEFAULT_CONNECTIONS, DEFAULT_FETCH_SIZE
from snaplake.frames import local_frame
from snaplake.functions.filters import to_column, to_sql
from snaplake.plans.catalog import pages_of
from snaplake.plans.load_plan import PROFILE_COLUMNS, plan_frame
from snaplake.plans.slices import (
    balanced_predicates, boundaries_text, is_uneven, plan_slices, predicates, reader_intervals, widened,
)
from snaplake.sources.base import Catalog, combine
from snaplake.sources.catalog_sql import CATALOG_SQL
from snaplake.sources.dialects import Dialect


#: Jobs in which a table is read at most, slices that are planned at a time, and keys that a source ranks for boundaries.
MAX_WAVES, SLICES_AT_ONCE, SAMPLED_KEYS = 1_000, 1_024, 200_000


class JdbcSource:
    def __init__(
        self,
        spark: SparkSession,
        dialect: Dialect,
        host: str,
        port: int | str,
        *,
        user: str,
        password: str,
        database: str = "",
        fetch_size: int = DEFAULT_FETCH_SIZE,
        session_statement: str | None = None,
        options: Mapping[str, str] | None = None,
        connections: int = DEFAULT_CONNECTIONS,
        even_reads: bool = True,
        tables_per_profile: int = 50,
    ):
        self.spark = spark
        self.dialect = dialect
        self.database = database or ("postgres" if dialect.physical_pages else "")
        self.even_reads = even_reads
        self.connections = connections  # per table; what the server bears, not what the cluster could open
        self.tables_per_profile = tables_per_profile
        statement = dialect.session_statement if session_statement is None else session_statement
        self.options = {
            "url": dialect.url(host, port, self.database),
            "driver": dialect.driver,
            "user": user,
            "password": password,
            "fetchsize": str(fetch_size),
            "preferTimestampNTZ": "true",
            **({"sessionInitStatement": statement} if statement else {}),
            **(options or {}),
        }

    # --- reads ------------------------------------------------------------------------------------------

    def _load(self, dbtable: str, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**{**self.options, "dbtable": dbtable, **options}).load()

    def scan(self, ns: str, table: str) -> DataFrame:
        """The whole table through one connection."""
        return self._load(self.dialect.table(ns, table))

    def scan_by_key(self, ns: str, table: str, key: str, lo: int, hi: int, parts: int) -> DataFrame:
        """The whole table through ``parts`` connections; the bounds set the stride and drop nothing."""
        if parts <= 1 or hi <= lo:
            return self.scan(ns, table)
        return self._load(
            self.dialect.table(ns, table),
            partitionColumn=key, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(parts),
        )

    def scan_where(self, ns: str, table: str, group: Mapping[str, Any], *, entry: Row | None = None) -> DataFrame:
        """Rows that pass a filter. Spark pushes the predicate to every reader of the plan entry, if given.

        Where the source reads a back-slash in a literal as an escape, a filter with one goes to it as text of our
        own: the text that Spark would push means something else there.
        """
        texts = self._texts(entry) if entry is not None else ["1 = 1"]
        if not self._escapes(group):
            df = self._load_where(ns, table, texts)
            return df.filter(to_column(group, df.schema))
        to_column(group, self.scan(ns, table).schema)  # raises for what doesn't fit the table
        where = to_sql(group, self.dialect)
        return self._load_where(ns, table, [f"({t}) AND {where}" for t in texts])

    def layout(self, entry: Row) -> str | None:
        """The boundaries between a table's readers, where the source has to be asked for them: what a load that goes on
        later needs to cut the table the same way."""
        if not self._asks(entry):
            return None
        found = self._boundaries(entry)
        return json.dumps(found) if found else None

    def waves(
        self, entry: Row, group: Mapping[str, Any] | None = None, first: int = 0, layout: str | None = None
    ) -> Iterator[DataFrame]:
        """The table, or its rows that pass a filter, in parts of ``connections`` readers, from wave ``first`` on: one
        after the other, they never open more. Each reader stays a partition, and so a task, of its own.

        Waves are made as they are taken: a frame is opened, and its readers' predicates are computed, when it is its
        turn. There are at most ``MAX_WAVES``; readers of a table that would have more take more rows each.
        """
        where, condition = "", None
        if group is not None:
            schema = self.scan(entry["ns"], entry["table"]).schema
            condition = to_column(group, schema)
            where = to_sql(group, self.dialect) if self._escapes(group) else ""
        texts = (t for _, some in self._slices(entry, layout) for t in some)
        texts = itertools.islice(texts, first * self.connections, None)
        while some := list(itertools.islice(texts, self.connections)):
            df = self._load_where(entry["ns"], entry["table"], [f"({t}) AND {where}" for t in some] if where else some)
            yield df if condition is None or where else df.filter(condition)

    def _escapes(self, group: Mapping[str, Any]) -> bool:
        """Whether a literal of the filter has a back-slash that the source would read as an escape."""
        values = [c.get("value") for c in group.get("conditions", ())]
        flat = [v for value in values for v in (value if isinstance(value, (list, tuple)) else (value,))]
        here = any(isinstance(v, str) and "\\" in v for v in flat)
        return self.dialect.backslash_escapes and (here or any(self._escapes(g) for g in group.get("groups", ())))

    def scan_where_at_source(self, ns: str, table: str, group: Mapping[str, Any]) -> DataFrame:
        """The same rows through a source-side subquery, for filters the source must evaluate its own way."""
        text = f"(SELECT * FROM {self.dialect.table(ns, table)} WHERE {to_sql(group, self.dialect)}) AS filtered"
        return self._load(text)

    def read(self, entry: Row) -> DataFrame:
        """The whole table as its plan entry says: every reader of every slice is a partition of one job, which opens
        as many connections as the cluster has cores for it. Loads go by ``waves``, which bound them."""
        if entry["strategy"] == "key_partitioned" and not (self.even_reads and is_uneven(entry)):
            return self.scan_by_key(*(entry[c] for c in ("ns", "table", "key_column", "lo", "hi", "parts")))
        return self._load_where(entry["ns"], entry["table"], self._texts(entry))

    def _texts(self, entry: Row) -> list[str]:
        return [t for _, some in self._slices(entry) for t in some]

    def step_entry(self, entry: Row) -> Row:
        """As planned: the server bears one slice at a time."""
        return entry

    def pieces(self, entry: Row) -> Iterator[Row]:
        for n, texts in self._slices(entry):
            yield Row(slice_no=n, predicates=texts)

    def read_slice(self, entry: Row, piece: Row) -> DataFrame:
        return self._load_where(entry["ns"], entry["table"], piece["predicates"])

    def _load_where(self, ns: str, table: str, texts: list[str]) -> DataFrame:
        """One partition per predicate."""
        if texts == ["1 = 1"]:
            return self.scan(ns, table)
        properties = {k: v for k, v in self.options.items() if k != "url"}
        return self.spark.read.jdbc(self.options["url"], self.dialect.table(ns, table), predicates=texts, properties=properties)

    def _asks(self, entry: Row) -> bool:
        return self.even_reads and (entry["strategy"] == "hash_batches" or self._is_uneven_key(entry))

    def _slices(self, entry: Row, layout: str | None = None) -> Iterator[tuple[int, list[str]]]:
        """Number and predicates of each slice, ``parts`` readers for each batch of rows, made as they are taken.

        Slices of equal key width suit dense keys. Other numeric keys and text keys are read between boundaries
        the source finds among its keys. Hash buckets would have the source scan the whole table once per bucket; they
        are left for keys whose values cannot be written as text.
        """
        if entry["strategy"] == "single":
            yield 0, ["1 = 1"]
            return
        boundaries = json.loads(layout) if layout else self._boundaries(entry) if self._asks(entry) else []
        if boundaries:
            texts = balanced_predicates(boundaries, entry, self.dialect)
            for n in range(0, len(texts), entry["parts"]):
                yield n // entry["parts"], texts[n : n + entry["parts"]]
            return
        entry = widened(entry, self.connections * MAX_WAVES)
        plan = plan_frame(self.spark, [entry])
        for start in range(0, entry["batches"], SLICES_AT_ONCE):
            texts = predicates(reader_intervals(plan_slices(plan, start, SLICES_AT_ONCE)), self.dialect)
            rows = texts.select("slice_no", "part_no", "predicate").orderBy("slice_no", "part_no").collect()
            for n, some in itertools.groupby(rows, key=lambda r: r["slice_no"]):
                yield n, [r["predicate"] for r in some]

    @staticmethod
    def _is_uneven_key(entry: Row) -> bool:
        return entry["strategy"] in ("range_batches", "key_partitioned") and is_uneven(entry)

    def _boundaries(self, entry: Row) -> list[tuple[Any, int]]:
        """Every n-th key with its copies, in the source's order: as many as the table gets readers.

        Of a large table, the source ranks about ``SAMPLED_KEYS`` of its keys, always the same ones. The step between
        boundaries stands for the planned rows of a reader, so a table that has grown gets more readers, not larger ones.
        """
        readers = max(1, min(entry["batches"] * entry["parts"], self.connections * MAX_WAVES))
        width = max(1, -(-entry["rows"] // readers))
        one_of = max(1, min(entry["rows"] // SAMPLED_KEYS, width))
        found = self._load(f"({boundaries_text(entry, self.dialect, max(1, width // one_of), one_of)}) AS boundaries")
        if not isinstance(found.schema["k"].dataType, (T.StringType, T.IntegralType)):
            return []
        return [(r["k"], r["copies"]) for r in found.orderBy("r").collect()]

    # --- catalog ----------------------------------------------------------------------------------------

    def catalog(self) -> Catalog:
        frames = {name: self._load(f"({text}) AS catalog_rows") for name, text in CATALOG_SQL[self.dialect.name].items()}
        tagged = {name: df.withColumn("source", F.lit(self.dialect.name)) for name, df in frames.items()}
        return Catalog(**tagged)

    def profile(self, keys: Sequence[Row]) -> DataFrame:
        """Row counts and key bounds, computed by the source; only one row per table travels.

        ``keys`` may carry ``rows``, ``pages`` and ``row_width`` from the catalog. Rows are counted where it has no
        estimate, and then pages are at least what so many rows take: the catalog's figure may be as old.
        """
        groups = [keys[i : i + self.tables_per_profile] for i in range(0, len(keys), self.tables_per_profile)]
        texts = [" UNION ALL ".join(self.profile_text(k) for k in g) for g in groups]
        profiled = combine([self._load(f"({t}) AS profile_rows") for t in texts], DataFrame.unionByName)
        known = local_frame(
            self.spark,
            [
                tuple(k[c] for c in PROFILE_COLUMNS[:6])
                + (self._known(k, "pages"), self._known(k, "row_width"), self._known(k, "rows") <= 0 and self.dialect.physical_pages)
                for k in keys
            ],
            "source string, ns string, table string, key_column string, salt_column string, key_kind string,"
            " known_pages bigint, row_width bigint, counted boolean",
        )
        taken = F.when(F.col("counted") & (F.col("rows") > 0), pages_of(F.col("rows"), F.col("row_width"))).otherwise(F.lit(0))
        measured = profiled.select(
            F.col("ns"), F.col("tbl").alias("table"),
            *[F.coalesce(F.col(f"{c}_v").cast("bigint"), F.lit(0)).alias(c) for c in ("rows", "lo", "hi")],
        )
        profile = known.join(measured, ["ns", "table"])
        return profile.withColumn("pages", F.greatest("known_pages", taken)).select(*PROFILE_COLUMNS)

    @staticmethod
    def _known(key: Row, name: str) -> int:
        return int((key[name] if name in key else 0) or 0)

    def profile_text(self, key: Row) -> str:
        d = self.dialect
        rows = str(self._known(key, "rows")) if self._known(key, "rows") > 0 else "COUNT(*)"
        lo = hi = "0"
        if key["key_kind"] == "numeric":
            column = d.quote(key["key_column"])
            lo, hi = f"MIN({column})", f"MAX({column})"
        head = f"SELECT {d.literal(key['ns'])} AS ns, {d.literal(key['table'])} AS tbl"
        measures = f"{rows} AS rows_v, {lo} AS lo_v, {hi} AS hi_v"
        if rows != "COUNT(*)" and lo == "0":
            return f"{head}, {measures}"
        return f"{head}, {measures} FROM {d.table(key['ns'], key['table'])}"
