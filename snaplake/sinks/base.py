"""What a load needs from the place it writes to."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from snaplake.functions.digest import rows_digest


@dataclass(frozen=True)
class Target:
    """A table to land: namespace levels, outermost first, and the table's name."""

    namespace: tuple[str, ...]
    table: str

    @classmethod
    def of(cls, source: str, ns: str, table: str, database: str = "postgres") -> Target:
        levels = (source, database, ns) if source == "postgresql" else (source, ns)
        return cls(levels, table)

    @property
    def path(self) -> str:
        return "/".join((*self.namespace, self.table))


@dataclass(frozen=True)
class Written:
    """What a write saw of its own rows; the digest only where the sink takes one."""

    rows: int = 0
    digest: int | None = None

    def __add__(self, other: Written) -> Written:
        both = self.digest is not None and other.digest is not None
        return Written(self.rows + other.rows, self.digest + other.digest if both else None)


class Stage(Protocol):
    """A new version of a table, written wave by wave and then published in one step.

    It is known by its token: another stage of the same token, also in another application, goes on with the same
    version. A wave that is complete is not written again.
    """

    token: str

    def write(self, wave: int, df: DataFrame) -> Written:
        """Write wave ``wave``, counted from 0 on."""

    def publish(self) -> None:
        """Put the version in the table's place."""


class Sink(Protocol):
    def stage(self, target: Target, token: str | None = None) -> Stage:
        """Begin a new version of a table, or go on with the one of ``token``."""

    def replace(self, df: DataFrame | Iterable[DataFrame], target: Target, token: str | None = None) -> int:
        """Create the table or replace it in one step; returns the rows written. Several frames of one schema are
        taken and written one after the other and published together. Repeated with one token it is done once."""

    def append(self, df: DataFrame, target: Target, token: str | None = None) -> int:
        """Add rows to an existing table; returns the rows written. Repeated with one token they are added once."""

    def written(self, target: Target) -> Written | None:
        """What the writes of the table's current version saw, if this is known."""

    def compact(self, target: Target) -> None:
        """Rewrite files into files of about the target size: small ones together, large ones in parts."""

    def refresh_statistics(self, target: Target) -> None:
        """Bring the table's statistics up to date, from what its writes saw where this is known."""

    def exists(self, target: Target) -> bool: ...

    def read(self, target: Target) -> DataFrame: ...


def frames_of(df: DataFrame | Iterable[DataFrame]) -> Iterator[DataFrame]:
    return iter([df] if isinstance(df, DataFrame) or hasattr(df, "writeTo") else df)


def counted(df: DataFrame, digest: bool = False) -> tuple[DataFrame, Observation]:
    """The frame, with its rows counted, and digested if asked for, by the write itself."""
    seen = Observation()
    more = [rows_digest(df.schema).alias("digest")] if digest else []
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *more), seen


def written_of(seen: Observation, digest: bool) -> Written:
    got = seen.get
    return Written(got["rows"], int(got["digest"] or 0) if digest else None)
