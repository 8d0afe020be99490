"""How far loads of several waves have come, as a table: what a driver that takes over a load needs to know.

A load has a row when it starts, with the plan entry and the layout by which its table is cut, one for each wave that is
written, and one when it is published. Tables that come in one wave leave none.
"""

from __future__ import annotations

import json
import threading
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snaplake.frames import local_frame
from snaplake.plans.load_plan import PLAN_COLUMNS
from snaplake.sinks.base import Sink, Target, Written

PROGRESS_SCHEMA = (
    "run_id string, source string, ns string, table string, token string, step string, wave int, rows bigint, "
    "digest string, ts timestamp, entry string, layout string, columns string"
)

# The steps of a load.
STARTED, WROTE, PUBLISHED = "started", "wrote", "published"


@dataclass
class Started:
    """A load that was begun and not published: the cut of its table and what its waves wrote."""

    token: str
    entry: Row
    layout: str | None
    columns: str
    waves: dict[int, Written] = field(default_factory=dict)

    @property
    def first(self) -> int:
        """The first wave that is not known to be written."""
        return next(n for n in range(len(self.waves) + 1) if n not in self.waves)


class LoadProgress:
    """The table, and what this driver knows of it. ``max_age_seconds`` bounds how old a load may be to be gone on with:
    its waves are all of about one time."""

    def __init__(
        self, spark: SparkSession, sink: Sink, run_id: str = "", target: Target = Target(("ledger",), "load_progress"),
        max_age_seconds: int = 86_400,
    ):
        self.spark, self.sink, self.target, self.run_id = spark, sink, target, run_id
        self.max_age = timedelta(seconds=max_age_seconds)
        self._lock = threading.Lock()
        self._open: dict[tuple[str, str, str], Started] | None = None

    def rows(self) -> DataFrame:
        return self.sink.read(self.target) if self.sink.exists(self.target) else local_frame(self.spark, [], PROGRESS_SCHEMA)

    def _loads(self) -> dict[tuple[str, str, str], Started]:
        """The open loads of all tables, read once: some rows for each load that was not published."""
        if self._open is None:
            since = datetime.now(timezone.utc) - self.max_age
            rows = self.rows()
            done = rows.filter(F.col("step") == PUBLISHED).select("token").distinct()
            recent = rows.filter((F.col("step") == STARTED) & (F.col("ts") >= F.lit(since))).select("token").distinct()
            self._open = {}
            for r in rows.join(done, "token", "left_anti").join(recent, "token", "left_semi").orderBy("ts", "wave").collect():
                key = (r["source"], r["ns"], r["table"])
                if r["step"] == STARTED:
                    said = json.loads(r["entry"])
                    self._open[key] = Started(r["token"], Row(**{c: said[c] for c in PLAN_COLUMNS}), r["layout"], r["columns"])
                elif key in self._open and self._open[key].token == r["token"]:
                    self._open[key].waves[r["wave"]] = Written(r["rows"], None if r["digest"] is None else int(r["digest"]))
        return self._open

    def open_load(self, entry: Row) -> Started | None:
        with self._lock:
            return self._loads().get(_key(entry))

    def start(self, entry: Row, layout: str | None, columns: str) -> Started:
        begun = Started(uuid.uuid4().hex, Row(**{c: entry[c] for c in PLAN_COLUMNS}), layout, columns)
        self._record(begun, STARTED)
        with self._lock:
            self._loads()[_key(entry)] = begun
        return begun

    def wrote(self, load: Started, wave: int, written: Written) -> None:
        self._record(load, WROTE, wave, written)
        load.waves[wave] = written

    def published(self, load: Started) -> None:
        self._record(load, PUBLISHED)
        with self._lock:
            self._loads().pop(_key(load.entry), None)

    def _record(self, load: Started, step: str, wave: int | None = None, written: Written | None = None) -> None:
        e, begins = load.entry, step == STARTED
        row = (
            self.run_id, e["source"], e["ns"], e["table"], load.token, step, wave,
            written and written.rows, None if written is None or written.digest is None else str(written.digest),
            datetime.now(timezone.utc), json.dumps(e.asDict()) if begins else None, load.layout if begins else None,
            load.columns if begins else None,
        )
        event = local_frame(self.spark, [row], PROGRESS_SCHEMA).coalesce(1)
        token = f"{load.token}-{step}-{wave or 0}"  # a row that is written again is there once
        with self._lock:
            if self.sink.exists(self.target):
                self.sink.append(event, self.target, token)
            else:
                self.sink.replace(event, self.target)


def _key(entry: Row) -> tuple[str, str, str]:
    return entry["source"], entry["ns"], entry["table"]
