"""Tables kept as files. Spark cuts files into even byte ranges by itself, so a whole read needs no slicing."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.frames import local_frame
from snaplake.functions.expressions import hash_bucket
from snaplake.functions.filters import to_column
from snaplake.plans.catalog import salts_of
from snaplake.plans.even import even_boundaries, in_slice, tie_bits, tie_of
from snaplake.plans.load_plan import BATCHED, PROFILE_COLUMNS, PROFILE_SCHEMA, plan_frame
from snaplake.plans.slices import in_bucket, in_key_slice, in_page_slice, plan_slices, widened
from snaplake.sources.base import Catalog, combine
from snaplake.sources.dialects import Dialect
from snaplake.sources.profiles import ProfileCache, folder_state
from snaplake.sql import quote, text
from snaplake.workspace import shared_dir

_SQL_TYPES = {
    T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "integer", T.LongType: "bigint",
}


#: Steps of an incremental load: each may open all of a table's files again, so their number must not grow with its rows.
MAX_STEPS = 16


@dataclass(frozen=True)
class FileTable:
    path: str
    key_columns: tuple[str, ...] = ()
    format: str = "parquet"
    schema: T.StructType | None = None


def _id(table: tuple[str, str]) -> str:
    return ".".join(part.replace("\\", "\\\\").replace(".", "\\.") for part in table)


class FileSource:
    """Declared tables over files: files carry no constraints, so the key columns are given."""

    def __init__(
        self,
        spark: SparkSession,
        dialect: Dialect,
        tables: Mapping[tuple[str, str], FileTable],
        *,
        database: str = "postgres",
        rows_per_page: int = 1_000,
        profile_from_footers: bool = True,
        slice_by: str = "files",
        profiles: str | None = None,
    ):
        self.spark = spark
        self.dialect = dialect
        self.tables = dict(tables)
        self.database = database
        self.rows_per_page = rows_per_page
        self.profile_from_footers = profile_from_footers  # off for files written without column statistics
        if slice_by not in ("files", "plan", "even"):
            raise ValueError(f"slice_by is files, plan or even, not {slice_by!r}")
        self.slice_by = slice_by
        self.profiles = profiles  # a file that keeps profiles of unchanged tables for later sessions
        self._zones: dict[tuple[str, str, str], DataFrame] = {}
        self._pages: dict[tuple[str, str], DataFrame] = {}
        self._listings: dict[tuple[str, str, int], DataFrame] = {}
        self._footers: SparkSession | None = None

    def scan(self, ns: str, table: str) -> DataFrame:
        return self._scan_in(self.spark, ns, table)

    def _scan_in(self, spark: SparkSession, ns: str, table: str) -> DataFrame:
        t = self.tables[ns, table]
        reader = spark.read.format(t.format)
        df = (reader.schema(t.schema) if t.schema else reader).load(t.path)
        if t.schema is None:  # inferring it takes a job, so once is enough
            self.tables[ns, table] = dataclasses.replace(t, schema=df.schema)
        return df

    def read(self, entry: Row) -> DataFrame:
        return self.scan(entry["ns"], entry["table"])

    def scan_where(self, ns: str, table: str, group: Mapping[str, Any], *, entry: Row | None = None) -> DataFrame:
        """Rows that pass a filter, which Spark pushes into the file scan."""
        df = self.scan(ns, table)
        return df.filter(to_column(group, df.schema))

    def layout(self, entry: Row) -> str | None:
        return None

    def waves(
        self, entry: Row, group: Mapping[str, Any] | None = None, first: int = 0, layout: str | None = None
    ) -> Iterator[DataFrame]:
        """Files bear as many readers as there are: one frame."""
        if first == 0:
            yield self.read(entry) if group is None else self.scan_where(entry["ns"], entry["table"], group)

    def paged(self, ns: str, table: str, page: str = "page") -> DataFrame:
        """The table with each row's page. Pages are blocks of ``rows_per_page`` rows of a file; files follow each other
        in the order of their paths. The files' row counts are read first, a row for each file."""
        df = self.scan(ns, table)
        return self._numbered(df, self._first_pages(df), page)

    def _first_pages(self, df: DataFrame) -> DataFrame:
        """(path, first, pages) of the files: the first page of each, and how many it has."""
        place = F.struct(F.col("_metadata.file_path").alias("path"), "_metadata.row_index")
        rows = df.select(place.alias("at")).groupBy("at.path").agg((F.max("at.row_index") + 1).alias("n"))
        pages = F.ceil(F.col("n") / self.rows_per_page).cast("bigint")
        before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        return rows.select("path", F.coalesce(F.sum(pages).over(before), F.lit(0)).alias("first"), pages.alias("pages"))

    def _numbered(self, df: DataFrame, files: DataFrame, page: str) -> DataFrame:
        """The rows of some files with their pages. There is a row for each file, which a scan's own list of files has
        too: it is broadcast, else the table would be shuffled, and all of a file to one task."""
        first = F.broadcast(files.select(F.col("path").alias("__file"), F.col("first").alias("__first")))
        block = F.call_function("div", F.col("_metadata.row_index"), F.lit(self.rows_per_page).cast("bigint"))
        numbered = df.withColumns({"__of": F.col("_metadata.file_path"), "__block": block})
        joined = numbered.join(first, F.col("__of") == F.col("__file"))
        return joined.select(*df.columns, (F.col("__first") + F.col("__block")).alias(page))

    def step_entry(self, entry: Row) -> Row:
        """With slices so wide that there are at most ``MAX_STEPS``: Spark reads any of them with as many tasks as it needs."""
        return widened(entry, MAX_STEPS * entry["parts"])

    def pieces(self, entry: Row) -> list[Row]:
        """Slices of the table, a small row each. Which files a slice reads is looked up when it is read.

        By default a slice is a group of whole files of about as many bytes as the others, as many groups as the plan has
        slices if there are enough files. With ``slice_by="plan"`` the pieces are the plan's own slices; with "even",
        slices of a numeric key that have about equal rows. Those read the files whose keys overlap theirs and no other.
        """
        self._pages.pop((entry["ns"], entry["table"]), None)  # each load lists the files anew
        if self.slice_by == "even" and entry["key_kind"] == "numeric" and entry["strategy"] in BATCHED:
            return self._even_pieces(entry)
        if self.slice_by in ("plan", "even"):
            return plan_slices(plan_frame(self.spark, [entry])).orderBy("slice_no").collect()
        groups = self._groups(entry).select("group").distinct().orderBy("group").collect()
        return [Row(unit="files", slice_no=i, slices=len(groups), group=g["group"]) for i, g in enumerate(groups)] or [
            Row(unit="table", slice_no=0, slices=1)
        ]

    def _groups(self, entry: Row) -> DataFrame:
        """(path, group) of the table's files: listed once, by Spark, and dealt by running bytes in the order of their paths."""
        key = (entry["ns"], entry["table"], entry["batches"])
        if key not in self._listings:
            t = self.tables[entry["ns"], entry["table"]]
            listed = self.spark.read.format("binaryFile").options(recursiveFileLookup="true").load(t.path).select("path", "length").filter("length > 0")
            upto = F.sum("length").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow))
            whole = F.sum("length").over(Window.partitionBy(F.lit(0)))
            middle = (upto - F.col("length") / 2) * entry["batches"] / whole
            self._listings[key] = self._kept(listed.select("path", F.floor(middle).alias("group")), "listing")
        return self._listings[key]

    def _kept(self, frame: DataFrame, name: str) -> DataFrame:
        """A table of files, a row for each, in the shared folder."""
        folder = shared_dir(self.spark, "files", name)
        frame.write.parquet(folder)
        return self.spark.read.schema(frame.schema).parquet(folder)

    def zones(self, ns: str, table: str, key: str) -> DataFrame:
        """(path, rows, lo, hi, nulls): the key's bounds in each file of the table, from one pass over the key column."""
        if (ns, table, key) not in self._zones:
            k = F.col(quote(key))
            rows = self.scan(ns, table).select(F.col("_metadata.file_path").alias("path"), k.alias("k"))
            bounds = rows.groupBy("path").agg(
                F.count(F.lit(1)).alias("rows"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.count_if(F.col("k").isNull()).alias("nulls")
            )
            self._zones[ns, table, key] = self._kept(bounds, "zones")
        return self._zones[ns, table, key]

    def _even_pieces(self, entry: Row) -> list[Row]:
        others = salts_of(entry["salt_column"])
        rows = self.scan(entry["ns"], entry["table"])
        bounds = even_boundaries(rows, entry["key_column"], entry["lo"], entry["hi"], entry["batches"], others)
        edges = [None, *bounds, None]
        return [Row(unit="even", slice_no=n, slices=len(edges) - 1, low=edges[n], high=edges[n + 1]) for n in range(len(edges) - 1)]

    def _overlapping(self, entry: Row, lo: int | None, hi: int | None) -> DataFrame:
        """The table's files that have keys from ``lo`` to ``hi``; None is open, and what is open below takes nulls."""
        z = self.zones(entry["ns"], entry["table"], entry["key_column"])
        inside = F.lit(True)
        if lo is not None:
            inside &= F.col("hi") >= lo
        if hi is not None:
            inside &= F.col("lo") <= hi
        inside = F.coalesce(inside, F.lit(False))
        return self._of(entry, z.filter(inside | (F.col("nulls") > 0) if lo is None else inside))

    def _of(self, entry: Row, files: DataFrame) -> DataFrame:
        """The rows of some of the table's files: those of one slice."""
        paths = [unquote(r["path"]) for r in files.select("path").collect()]
        return self._open(entry, paths) if paths else self.scan(entry["ns"], entry["table"]).limit(0)

    def _open(self, entry: Row, paths: list[str]) -> DataFrame:
        t = self.tables[entry["ns"], entry["table"]]
        schema = t.schema or self.scan(entry["ns"], entry["table"]).schema
        return self.spark.read.format(t.format).schema(schema).load(paths)

    def _page_slice(self, entry: Row, piece: Row) -> DataFrame:
        """From the files that have pages of the slice. The table's pages are numbered once, so those of its slices agree."""
        key = entry["ns"], entry["table"]
        if key not in self._pages:
            self._pages[key] = self._kept(self._first_pages(self.scan(*key)), "pages")
        end = F.col("first") + F.col("pages")
        there = self._pages[key].filter((end > piece["lo"]) & (F.lit(piece["open_high"]) | (F.col("first") < piece["hi"])))
        paths = [unquote(r["path"]) for r in there.select("path").collect()]
        if not paths:
            return self.scan(*key).limit(0)
        paged = self._numbered(self._open(entry, paths), there, "__page")
        return paged.filter(in_page_slice(F.col("__page"), piece["lo"], piece["hi"], piece["open_high"])).drop("__page")

    def read_slice(self, entry: Row, piece: Row) -> DataFrame:
        if piece["unit"] == "files":
            return self._of(entry, self._groups(entry).filter(F.col("group") == piece["group"]))
        if piece["unit"] == "page":
            return self._page_slice(entry, piece)
        if piece["unit"] == "table":
            return self.scan(entry["ns"], entry["table"])
        key = F.col(quote(entry["key_column"]))
        if piece["unit"] == "bucket":
            if salts := salts_of(entry["salt_column"]):
                key = F.concat_ws("|", key, *[F.col(quote(s)) for s in salts])
            return self.scan(entry["ns"], entry["table"]).filter(in_bucket(key, piece["lo"], piece["slices"]))
        if piece["unit"] == "even":
            low, high = piece["low"], piece["high"]
            tie = tie_of(salts_of(entry["salt_column"]), tie_bits(entry["lo"], entry["hi"]))
            return self._overlapping(entry, low and low.key, high and high.key).filter(in_slice(key, tie, low, high))
        lo, hi = None if piece["open_low"] else piece["lo"], None if piece["open_high"] else piece["hi"]
        return self._overlapping(entry, lo, hi).filter(in_key_slice(key, piece["lo"], piece["hi"], piece["open_low"], piece["open_high"]))

    def catalog(self) -> Catalog:
        d = self.dialect.name
        make = functools.partial(local_frame, self.spark)
        ids = sorted(self.tables)
        schemas = self._schemas(ids)
        fields = [(ns, t, f) for (ns, t), schema in zip(ids, schemas) for f in schema.fields]
        keys = [(ns, t, i, c) for ns, t in ids for i, c in enumerate(self.tables[ns, t].key_columns, 1)]
        head = "source string, ns string, table string"
        return Catalog(
            namespaces=make([(d, ns) for ns in sorted({ns for ns, _ in ids})], "source string, ns string"),
            tables=make([(d, ns, t, "BASE TABLE") for ns, t in ids], f"{head}, table_type string"),
            constraints=make(
                [(d, ns, t, "PRIMARY", "PRIMARY KEY") for ns, t in ids if self.tables[ns, t].key_columns],
                f"{head}, constraint_name string, constraint_type string",
            ),
            key_usage=make(
                [(d, ns, t, "PRIMARY", c, i) for ns, t, i, c in keys],
                f"{head}, constraint_name string, column string, ordinal int",
            ),
            columns=make(
                [(d, ns, t, f.name, self._sql_type(f.dataType)) for ns, t, f in fields],
                f"{head}, column string, data_type string",
            ),
            relations=make([], f"{head}, rows bigint, pages bigint"),
            column_stats=make([], f"{head}, column string, avg_width int"),
            stats_times=make([], f"{head}, last_update timestamp, update_time timestamp, create_time timestamp"),
        )

    def _sql_type(self, dtype: T.DataType) -> str:
        name = _SQL_TYPES.get(type(dtype), dtype.simpleString())
        return "int" if name == "integer" and "integer" not in self.dialect.integer_types else name

    def profile(self, keys: Sequence[Row]) -> DataFrame:
        """Rows and key bounds of every table in one job, answered from file footers where the format allows.

        With ``profiles``, only tables whose files have changed since are profiled: the others' figures are kept there.
        """
        if self.profiles is None:
            return self._profiled(keys)
        kept, states = self._cache().load(), self._states([(k["ns"], k["table"]) for k in keys])
        wanted = {(k["ns"], k["table"]): [states[k["ns"], k["table"]], *[k[c] for c in ("key_column", "salt_column", "key_kind")], self.rows_per_page] for k in keys}
        known = {i: kept["profiles"][_id(i)]["row"] for i, w in wanted.items() if w[0] and kept["profiles"].get(_id(i), {}).get("of") == w}
        new = [k for k in keys if (k["ns"], k["table"]) not in known]
        rows = [tuple(r) for r in known.values()]
        if new:
            found = [tuple(r) for r in self._profiled(new).select(*PROFILE_COLUMNS).collect()]
            rows += found
            self._cache().add("profiles", {_id((r[1], r[2])): {"of": wanted[r[1], r[2]], "row": list(r)} for r in found})
        return local_frame(self.spark, rows, PROFILE_SCHEMA)

    def _cache(self) -> ProfileCache:
        return ProfileCache(self.spark, self.profiles)

    def _states(self, ids: Sequence[tuple[str, str]]) -> dict[tuple[str, str], list | None]:
        with ThreadPoolExecutor(max_workers=8) as pool:
            return dict(zip(ids, pool.map(lambda i: folder_state(self.spark, self.tables[i].path), ids)))

    def _schemas(self, ids: Sequence[tuple[str, str]]) -> list[T.StructType]:
        """Inferring a schema is a small job of its own, so those of unchanged tables are kept too."""
        if self.profiles is not None:
            kept, states = self._cache().load()["schemas"], self._states(ids)
            for i in ids:
                if self.tables[i].schema is None and states[i] and kept.get(_id(i), {}).get("of") == states[i]:
                    schema = T.StructType.fromJson(kept[_id(i)]["schema"])
                    self.tables[i] = dataclasses.replace(self.tables[i], schema=schema)
        new = [i for i in ids if self.tables[i].schema is None]
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(lambda i: self.scan(*i), new))
        if self.profiles is not None and new:
            self._cache().add("schemas", {_id(i): {"of": states[i], "schema": self.tables[i].schema.jsonValue()} for i in new})
        return [self.tables[i].schema for i in ids]

    def _profiled(self, keys: Sequence[Row]) -> DataFrame:
        with ThreadPoolExecutor(max_workers=8) as pool:
            return combine(list(pool.map(self._profile_one, keys)), DataFrame.union)

    def _profile_one(self, key: Row) -> DataFrame:
        lo, hi = "0L", "0L"
        if key["key_kind"] == "numeric":
            column = quote(key["key_column"])
            lo, hi = (f"coalesce(CAST({f}({column}) AS bigint), 0L)" for f in ("min", "max"))
        known = {"source": self.dialect.name} | {c: key[c] for c in ("ns", "table", "key_column", "salt_column", "key_kind")}
        return self._scan_in(self._footer_session(), key["ns"], key["table"]).selectExpr(
            *[f"CAST({'NULL' if v is None else text(v)} AS string) AS {quote(c)}" for c, v in known.items()],
            "count(*) AS rows", f"{lo} AS lo", f"{hi} AS hi",
            f"(count(*) + {self.rows_per_page - 1}) div {self.rows_per_page} AS pages",
        )

    def _footer_session(self) -> SparkSession:
        """A session of its own, so the aggregate push-down settings touch no other query."""
        if not self.profile_from_footers:
            return self.spark
        if self._footers is None:
            self._footers = self.spark.newSession()
            self._footers.conf.set("spark.sql.sources.useV1SourceList", "")
            self._footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
            self._footers.conf.set("spark.sql.orc.aggregatePushdown", "true")
        return self._footers
