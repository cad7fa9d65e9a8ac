"""Yearly delimited text files.

Every column is read as a string (no inference, no schema); typing is silver's job.
Years are read file by file: one ``read.csv`` over files with different headers
would apply the first file's header to all of them and shift values silently.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tierlake.sources.fs import exists, list_dir
from tierlake.spec import CsvDialect, LakeSpec, year_from_name

log = logging.getLogger(__name__)


def read_year_csv(spark: SparkSession, path: str | Sequence[str], dialect: CsvDialect = CsvDialect()) -> DataFrame:
    """One year's raw file(s): header row, all-string, empty field -> NULL,
    short rows padded with NULL (permissive)."""
    reader = spark.read.options(**dialect.read_options())
    return reader.csv(path if isinstance(path, str) else list(path))


def discover_years(spark: SparkSession, raw_root: str, spec: LakeSpec) -> list[tuple[int, str]]:
    """(year, csv path) for each ``<anything>_<yyyy>`` folder of ``raw_root`` that holds
    ``<data_dir>/<stem>_<yyyy>.csv`` (or another listed extension).

    Loose files, folders without a 4-digit year suffix and folders without the file
    are skipped with a warning. Sorted by year.
    """
    found: dict[int, str] = {}
    for entry in list_dir(spark, raw_root):
        if not entry.is_dir:
            continue
        year = year_from_name(entry.name)
        if year is None:
            log.warning("skipping %s: no year suffix", entry.path)
            continue
        candidates = spec.raw_files(entry.path, year)
        path = next((c for c in candidates if exists(spark, c)), None)
        if path is None:
            log.warning("skipping year %s: none of %s", year, candidates)
            continue
        if year in found:
            log.warning("year %s found twice; keeping %s", year, found[year])
            continue
        found[year] = path
    return sorted(found.items())
