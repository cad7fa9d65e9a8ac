"""L1: raw yearly text -> bronze Parquet, one leaf per year, incremental.

Each year is its own read (headers may differ between years) and its own leaf
write. A year whose leaf is committed (``_SUCCESS``) is skipped unless
``mode="overwrite"``; a leaf left half-written by a crashed job has no marker and
is ingested again. Years are independent jobs, so a few are submitted at once to
keep the cluster busy while small years finish.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tierlake.sinks.parquet import WriteReport, write_leaf
from tierlake.sources.csv import discover_years, read_year_csv
from tierlake.sources.fs import is_complete
from tierlake.sources.layers import leaf_path
from tierlake.spec import LakeSpec

log = logging.getLogger(__name__)


def build_bronze(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    spec: LakeSpec,
    mode: str = "skip",
    parallel_years: int = 8,
) -> list[WriteReport]:
    """Ingest every year found under ``raw_root`` into ``<bronze_root>/<year_col>=<yyyy>``;
    returns one report per year (written with its row count, or skipped)."""
    if mode not in ("skip", "overwrite"):
        raise ValueError("mode must be 'skip' or 'overwrite'")
    todo, reports = [], []
    for year, path in discover_years(spark, raw_root, spec):
        leaf = leaf_path(bronze_root, year, spec.year_col)
        if mode == "skip" and is_complete(spark, leaf):
            log.info("year %s already in bronze, skipped", year)
            reports.append(WriteReport(spec.name, leaf, "skipped", year))
        else:
            todo.append((year, path))

    def ingest(item: tuple[int, str]) -> WriteReport:
        year, path = item
        df = read_year_csv(spark, path, spec.dialect)
        return write_leaf(df, bronze_root, year, spec.year_col, table=spec.name)

    if todo:
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_years, len(todo)))) as pool:
            reports.extend(pool.map(ingest, todo))
    return sorted(reports, key=lambda r: r.year)
