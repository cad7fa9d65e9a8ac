"""L1 with quarantine: records that a permissive read would pad or cut go to a side table.

A year's whole records become its bronze leaf, the others rows (year, file, reason, text) of
the quarantine, so kept and quarantined rows together are the raw records. The pass that
writes the leaf counts them; only a year that has some is read a second time for the side
table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierlake.sinks.parquet import CODEC, WriteReport
from tierlake.sources.csv import discover_years
from tierlake.sources.fs import delete, exists, is_complete, list_dir, rename
from tierlake.sources.layers import leaf_path, mark_commit
from tierlake.sources.rescued import RESCUED, read_year_rescued, reason
from tierlake.spec import YEAR_COL, LakeSpec


def ingest_rescued(
    spark: SparkSession, raw_root: str, bronze_root: str, quarantine_root: str, spec: LakeSpec, mode: str = "skip", columns: Sequence[str] | None = None
) -> list[WriteReport]:
    """L1 with quarantine: each year's whole records become its bronze leaf, the others go to
    ``<quarantine_root>/<year_col>=<yyyy>`` as (file, reason, text). A finished year is
    skipped; one whose run ended early is read again, both sides of it. Reports count the
    kept rows and, as a metric, the quarantined ones."""
    if mode not in ("skip", "overwrite"):
        raise ValueError("mode must be 'skip' or 'overwrite'")
    y, reports = spec.year_col, []
    for year, path in discover_years(spark, raw_root, spec):
        leaf, side = leaf_path(bronze_root, year, y), leaf_path(quarantine_root, year, y)
        if mode == "skip" and is_complete(spark, leaf):
            reports.append(WriteReport(spec.name, leaf, "skipped", year))
            continue
        rows = read_year_rescued(spark, path, spec.dialect, columns)
        fields = [c for c in rows.columns if c != RESCUED]
        bad = F.col(RESCUED).isNotNull()
        obs = Observation(f"{spec.name}:{year}:rescued")
        counted = rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(bad.cast("long")).alias("bad"))
        # Always true: Spark reads the raw text of bad records only beside a column of the file.
        beside = F.coalesce(F.col(fields[0]), F.lit("")) >= ""
        staging = f"{bronze_root.rstrip('/')}._rescue/{y}={year}"
        counted.where(~bad).select(*fields).write.mode("overwrite").option("compression", CODEC).parquet(staging)
        n, n_bad = int(obs.get["rows"]), int(obs.get["bad"] or 0)
        delete(spark, side)
        if n_bad:
            found = rows.where(bad & beside).select(F.col("_metadata.file_name").alias("file"), reason(RESCUED, len(fields), spec.dialect).alias("reason"), F.col(RESCUED).alias("text"))
            found.write.option("compression", CODEC).parquet(side)
        # The leaf comes last, with its mark, so a year is done on both sides or read again.
        delete(spark, leaf)
        rename(spark, staging, leaf)
        mark_commit(spark, leaf)
        reports.append(WriteReport(spec.name, leaf, "written", year, n - n_bad, {"quarantined": n_bad}))
    return reports


def read_quarantine(spark: SparkSession, quarantine_root: str, year_col: str = YEAR_COL) -> DataFrame:
    """(year, file, reason, text) of all quarantined records."""
    schema = f"file string, reason string, text string, {year_col} int"
    if not exists(spark, quarantine_root) or not list_dir(spark, quarantine_root):
        return spark.createDataFrame([], schema).select(year_col, "file", "reason", "text")
    return spark.read.schema(schema).parquet(quarantine_root).select(year_col, "file", "reason", "text")


__all__ = ["ingest_rescued", "read_quarantine"]
