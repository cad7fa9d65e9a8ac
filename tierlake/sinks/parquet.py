"""K1/K2/K4/K5: Parquet writes that report what they wrote.

Counts come from an ``Observation`` attached to the written DataFrame: the metrics
are computed by the write job itself, so nothing is re-read or re-computed to
report them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierlake.session import unsorted_leaves
from tierlake.sources.fs import delete, exists, swap, write_small_text
from tierlake.sources.layers import COMMIT_FILE, leaf_path, leaf_years, mark_commit
from tierlake.spec import YEAR_COL

CODEC = "snappy"


@dataclass
class WriteReport:
    """What one write did: table, path, action, year (for leaves), rows and the
    extra observed metrics."""

    table: str
    path: str
    action: str  # "written" | "skipped"
    year: int | None = None
    rows: int | None = None
    metrics: dict = field(default_factory=dict)
    year_rows: dict = field(default_factory=dict)


def _observed(df: DataFrame, name: str, metrics: Mapping[str, Column] | None) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in (metrics or {}).items()]
    return df.observe(obs, *exprs), obs


def write_leaf(
    df: DataFrame,
    root: str,
    year: int,
    year_col: str = YEAR_COL,
    table: str = "",
    metrics: Mapping[str, Column] | None = None,
) -> WriteReport:
    """Overwrite one year's leaf ``<root>/<year_col>=<yyyy>`` (no year column inside;
    the folder name carries it). The committed leaf holds ``_SUCCESS``."""
    path = leaf_path(root, year, year_col)
    observed, obs = _observed(df.drop(year_col) if year_col in df.columns else df, f"{table}:{year}", metrics)
    observed.write.mode("overwrite").option("compression", CODEC).parquet(path)
    mark_commit(df.sparkSession, path)
    got = dict(obs.get)
    return WriteReport(table, path, "written", int(year), int(got.pop("rows")), got)


def write_partitioned(
    df: DataFrame,
    root: str,
    year_col: str = YEAR_COL,
    table: str = "",
    metrics: Mapping[str, Column] | None = None,
    years: Sequence[int] = (),
) -> WriteReport:
    """One job for all years, ``partitionBy(year)``; dynamic partition overwrite
    replaces only the years present in ``df`` and leaves the others intact.

    No shuffle by year first: that would send a whole year to one task. Each task
    writes the years its rows belong to (a file open for each, ``unsorted_leaves``), and
    scan splits rarely span years, so a task opens few leaves. With ``years``, rows
    are counted for each of them, and the leaf of a year without rows is removed."""
    by_year = {f"_rows_{int(y)}": F.sum((F.col(year_col) == int(y)).cast("long")) for y in years}
    observed, obs = _observed(df, table or root, {**(metrics or {}), **by_year})
    with unsorted_leaves(df.sparkSession):
        (
            observed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(year_col)
            .parquet(root)
        )
    got = dict(obs.get)
    rows = {int(y): int(got.pop(f"_rows_{int(y)}") or 0) for y in years}
    for y, n in rows.items():
        if not n:
            delete(df.sparkSession, leaf_path(root, y, year_col))
    # Overwriting took the old marks of the leaves that this job wrote with it.
    spark = df.sparkSession
    for y in leaf_years(spark, root, year_col):
        leaf = leaf_path(root, y, year_col)
        if not exists(spark, f"{leaf}/{COMMIT_FILE}"):
            mark_commit(spark, leaf)
            write_small_text(spark, f"{leaf}/_SUCCESS", "")
    return WriteReport(table, root, "written", None, int(got.pop("rows")), got, rows)


def write_table(
    df: DataFrame,
    path: str,
    table: str = "",
    metrics: Mapping[str, Column] | None = None,
) -> WriteReport:
    """Overwrite a flat (unpartitioned) table: written beside, then swapped in, so a
    failed write keeps the old table and ``df`` may read the table that it replaces."""
    observed, obs = _observed(df, table or path, metrics)
    new = f"{path.rstrip('/')}._new"
    observed.write.mode("overwrite").option("compression", CODEC).parquet(new)
    swap(df.sparkSession, new, path)
    got = dict(obs.get)
    return WriteReport(table, path, "written", None, int(got.pop("rows")), got)


def reports_frame(spark, reports: Sequence[WriteReport], year_col: str = YEAR_COL) -> DataFrame:
    """The reports as a small DataFrame (one row per write)."""
    rows = [(r.table, r.year, r.action, r.rows, r.path) for r in reports]
    return spark.createDataFrame(rows, f"table string, {year_col} int, action string, rows long, path string")
