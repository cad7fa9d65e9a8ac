"""K1/K2: tables and yearly layers whose writes are commits.

Layout under one root::

    <root>/_commits/0000000012.json      names the folder of every table of version 12
    <root>/<table>/v12-<id>/             a flat table as some commit wrote it
    <root>/v=12-<id>/<year_col>=2021/    a year's leaf as some commit wrote it

A write goes to a fresh folder that no one reads, and the commit is one small file under
a number that did not exist before. Readers take the highest number whose file is whole,
so a write stopped at any step (data half written, data without a commit, half a commit
file) leaves the version before it in place, and several tables change together. Two
writers that start from the same version ask for the same number; the second fails.

The folders of the version before the current one stay until the next commit, for
readers that resolved it; older ones, and those of attempts that were never committed and
whose number has passed, go with ``clean``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.session import unsorted_leaves
from tierlake.sinks.parquet import CODEC, WriteReport, _observed
from tierlake.sources.fs import create_small_text, delete, exists, list_dir, read_small_text
from tierlake.sources.layers import union_schema
from tierlake.spec import YEAR_COL

COMMITS = "_commits"
_ATTEMPT = re.compile(r"(?:v=|v)(\d+)-[0-9a-f]+$")


class CommitConflict(RuntimeError):
    """Another writer committed since this one read its base version."""


@dataclass(frozen=True)
class Commit:
    """What a version holds: folder by table name (relative to the root), folder by year,
    and the writer's own notes."""

    version: int = 0
    tables: Mapping[str, str] = field(default_factory=dict)
    years: Mapping[int, str] = field(default_factory=dict)
    meta: Mapping[str, object] = field(default_factory=dict)

    def to_json(self) -> str:
        body = {"version": self.version, "tables": dict(self.tables), "years": {str(y): p for y, p in self.years.items()}, "meta": dict(self.meta)}
        return json.dumps({**body, "whole": True}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Commit | None:
        """None for a file that its writer did not finish."""
        try:
            got = json.loads(text)
        except ValueError:
            return None
        if not isinstance(got, dict) or got.get("whole") is not True:
            return None
        return Commit(got["version"], got["tables"], {int(y): p for y, p in got["years"].items()}, got["meta"])

    def folders(self) -> set[str]:
        return {*self.tables.values(), *(p.split("/", 1)[0] for p in self.years.values())}


class VersionedTables:
    """Flat tables and one yearly layer under ``root``, read and written by commits."""

    def __init__(self, spark: SparkSession, root: str, year_col: str = YEAR_COL):
        self.spark, self.root, self.year_col = spark, root.rstrip("/"), year_col

    # -- reading ------------------------------------------------------------------
    def _numbers(self) -> list[int]:
        names = [e.name for e in list_dir(self.spark, f"{self.root}/{COMMITS}")]
        return sorted((int(n[:-5]) for n in names if re.fullmatch(r"\d{10}\.json", n)), reverse=True)

    def _path(self, version: int) -> str:
        return f"{self.root}/{COMMITS}/{version:010d}.json"

    def commits(self, most: int | None = None) -> list[Commit]:
        """Whole commits, the newest first; files whose writer stopped midway do not count."""
        out = []
        for n in self._numbers():
            if most is not None and len(out) >= most:
                break
            got = Commit.from_json(read_small_text(self.spark, self._path(n)))
            if got is not None:
                out.append(got)
        return out

    def current(self) -> Commit | None:
        return next(iter(self.commits(1)), None)

    def _at(self, version: int | None) -> Commit:
        got = self.current() if version is None else next((c for c in self.commits() if c.version == version), None)
        if got is None:
            raise FileNotFoundError(f"no commit {'' if version is None else version} under {self.root}")
        return got

    def tables(self) -> list[str]:
        now = self.current()
        return sorted(now.tables) if now else []

    def read(self, table: str, version: int | None = None) -> DataFrame:
        commit = self._at(version)
        if table not in commit.tables:
            raise FileNotFoundError(f"no table {table!r} in version {commit.version} of {self.root}")
        return self.spark.read.parquet(f"{self.root}/{commit.tables[table]}")

    def read_years(self, years: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
        """The layer; other years' leaves than ``years`` are not even listed. Columns are
        the by-name union of the leaves' own."""
        commit = self._at(version)
        wanted = sorted(commit.years if years is None else {int(y) for y in years} & set(commit.years))
        paths = [f"{self.root}/{commit.years[y]}" for y in wanted]
        if not paths:
            if not commit.years:
                raise FileNotFoundError(f"no years in version {commit.version} of {self.root}")
            return self.read_years(sorted(commit.years)[:1], commit.version).limit(0)
        schema = union_schema([self.spark.read.option("mergeSchema", "false").parquet(p).schema for p in paths], self.year_col)
        # The folder of the attempt reads as a partition column, v; it is left out again.
        names = [f.name for f in schema.fields]
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths).select(*names)

    # -- writing ------------------------------------------------------------------
    def _attempt(self, base: Commit | None) -> str:
        return f"{(base.version if base else 0) + 1}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, table: str, metrics: Mapping[str, Column] | None = None) -> WriteReport:
        """Writes ``df`` into a fresh folder; nothing reads it before ``commit``."""
        observed, obs = _observed(df, table, metrics)
        path = f"{self.root}/{table}/v{self._attempt(self.current())}"
        observed.write.option("compression", CODEC).parquet(path)
        got = dict(obs.get)
        return WriteReport(table, path, "staged", None, int(got.pop("rows")), got)

    def stage_years(self, df: DataFrame, years: Sequence[int], table: str = "layer", metrics: Mapping[str, Column] | None = None) -> WriteReport:
        """Writes the rows of ``years`` into a fresh folder, a leaf for each year."""
        years = [int(y) for y in years]
        by_year = {f"_rows_{y}": F.sum((F.col(self.year_col) == y).cast("long")) for y in years}
        observed, obs = _observed(df.where(F.col(self.year_col).isin(years)), table, {**(metrics or {}), **by_year})
        path = f"{self.root}/v={self._attempt(self.current())}"
        with unsorted_leaves(self.spark):
            observed.write.option("compression", CODEC).partitionBy(self.year_col).parquet(path)
        got = dict(obs.get)
        rows = {y: int(got.pop(f"_rows_{y}") or 0) for y in years}
        return WriteReport(table, path, "staged", None, int(got.pop("rows")), got, rows)

    def commit(
        self,
        staged: Sequence[WriteReport],
        base: Commit | None,
        drop: Sequence[str] = (),
        drop_years: Sequence[int] = (),
        meta: Mapping[str, object] | None = None,
    ) -> Commit:
        """Makes staged writes the next version after ``base`` (None: the first). Tables and
        years that were not staged stay as they are; a staged year without rows leaves."""
        tables = {t: p for t, p in (base.tables if base else {}).items() if t not in set(drop)}
        years = {y: p for y, p in (base.years if base else {}).items() if y not in set(drop_years)}
        for report in staged:
            folder = report.path[len(self.root) + 1 :]
            if report.year_rows:
                for y, n in report.year_rows.items():
                    years.pop(y, None)
                    if n:
                        years[y] = f"{folder}/{self.year_col}={y}"
            else:
                tables[report.table] = folder
        now = self.current()
        if (now.version if now else 0) != (base.version if base else 0):
            raise CommitConflict(f"{self.root} is at version {now.version if now else 0}, not {base.version if base else 0}")
        # Numbers of attempts that stopped midway are passed over.
        number = max(self._numbers(), default=0) + 1
        commit = Commit(number, tables, years, dict(meta if meta is not None else base.meta if base else {}))
        if not create_small_text(self.spark, self._path(number), commit.to_json()):
            raise CommitConflict(f"version {number} of {self.root} was written by another writer")
        return commit

    def write(self, df: DataFrame, table: str, metrics: Mapping[str, Column] | None = None) -> WriteReport:
        """Stage, commit and clean one table."""
        base = self.current()
        report = self.stage(df, table, metrics)
        self.commit([report], base)
        self.clean()
        report.action = "written"
        return report

    def write_years(self, df: DataFrame, years: Sequence[int], table: str = "layer", metrics: Mapping[str, Column] | None = None) -> WriteReport:
        base = self.current()
        report = self.stage_years(df, years, table, metrics)
        self.commit([report], base)
        self.clean()
        report.action = "written"
        return report

    def clean(self, keep: int = 2) -> list[str]:
        """Removes what the newest ``keep`` versions do not name: folders of older versions
        and of attempts whose number has passed. A running attempt has a later number."""
        kept = self.commits(keep)
        if not kept:
            return []
        named = set().union(*(c.folders() for c in kept))
        gone = []
        for top in list_dir(self.spark, self.root):
            if top.name == COMMITS or not top.is_dir:
                continue
            nested = [] if top.name.startswith("v=") else [(f"{top.name}/{e.name}", e) for e in list_dir(self.spark, top.path)]
            for folder, entry in nested or [(top.name, top)]:
                hit = _ATTEMPT.match(entry.name)
                if hit and folder not in named and int(hit[1]) <= kept[0].version:
                    delete(self.spark, entry.path)
                    gone.append(folder)
        for n in self._numbers():
            if n < kept[-1].version:
                delete(self.spark, self._path(n))
        return sorted(gone)


def is_versioned(spark: SparkSession, root: str) -> bool:
    return exists(spark, f"{root.rstrip('/')}/{COMMITS}")


__all__ = ["Commit", "CommitConflict", "VersionedTables", "is_versioned"]
