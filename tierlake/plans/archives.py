"""L4: many yearly zip archives -> one table tagged with the year, or -> bronze.

The zip source already aligns members by header name; for a typed load the
per-year presence map comes from the members' header lines (read on the driver,
one line per archive), so a score a year lacked stays NULL instead of being filled.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierlake.plans.silver import clean_columns
from tierlake.sinks.parquet import WriteReport, write_leaf
from tierlake.sources.fs import is_complete
from tierlake.sources.layers import leaf_path
from tierlake.sources.zipcsv import FORMAT, list_members, read_header, register
from tierlake.spec import LakeSpec


def archive_options(spec: LakeSpec, folder: str) -> dict[str, str]:
    d = spec.dialect
    return {
        "path": folder,
        "sep": d.sep,
        "encoding": d.encoding,
        "quote": d.quote,
        "escape": d.escape,
        "member_tokens": ",".join(spec.member_tokens),
        "member_suffix": spec.member_suffix,
        "year_col": spec.year_col,
    }


def load_archives(spark: SparkSession, folder: str, spec: LakeSpec, years=None) -> DataFrame:
    """All archives as one all-string DataFrame: the year column, then the union of
    the members' columns. With ``years``, only those years' archives are listed into
    the read (the year is in the archive name), so other archives are never opened.

    Each year is a read of its own with the year as a constant, and the whole their union:
    any filter on the year folds the other years away while the query is planned, also if
    the frame is used several times in one query with different years. (Spark 4.1 keeps a
    Python source's pushed filters at the source, not at the scan, so scans of one frame
    would take each other's.)"""
    register(spark)
    opts = archive_options(spec, folder)
    if years is not None:
        opts["years"] = ",".join(str(int(y)) for y in years)
    parts = list_members(opts)
    if not parts:
        return spark.read.format(FORMAT).options(**opts).load()  # says what was looked for
    with ThreadPoolExecutor(max_workers=max(1, min(16, len(parts)))) as pool:
        headers = list(pool.map(lambda p: read_header(p, opts), parts))
    y = spec.year_col
    names = dict.fromkeys(h for header in headers for h in header if h != y)
    schema = StructType([StructField(y, IntegerType())] + [StructField(n, StringType()) for n in names])
    by_year: dict[int, list[str]] = {}
    for part in parts:
        by_year.setdefault(part.year, []).append(part.archive)

    def one(year: int) -> DataFrame:
        of_year = {**opts, "path": ",".join(dict.fromkeys(by_year[year])), "years": ""}
        rows = spark.read.format(FORMAT).schema(schema).options(**of_year).load()
        return rows.select(F.lit(year).alias(y), *[F.col(f"`{n}`") for n in names])

    return reduce(DataFrame.unionByName, [one(year) for year in sorted(by_year)])


def archive_presence(folder: str, spec: LakeSpec) -> dict[int, list[str]]:
    """year -> kept columns its members' headers have (one header line per archive,
    read concurrently on the driver)."""
    opts = archive_options(spec, folder)
    parts = list_members(opts)
    with ThreadPoolExecutor(max_workers=max(1, min(16, len(parts)))) as pool:
        headers = list(pool.map(lambda p: read_header(p, opts), parts))
    out: dict[int, set[str]] = {}
    for part, header in zip(parts, headers):
        out.setdefault(part.year, set()).update(header)
    return {y: [c for c in spec.keep if c in cols] for y, cols in out.items()}


def load_archives_typed(spark: SparkSession, folder: str, spec: LakeSpec) -> DataFrame:
    """Archives cleaned as silver: allow-list, scores parsed and filled per year."""
    raw = load_archives(spark, folder, spec)
    presence = archive_presence(folder, spec)
    return raw.select(*clean_columns(raw, presence, spec), F.col(spec.year_col))


def build_bronze_from_archives(
    spark: SparkSession,
    folder: str,
    bronze_root: str,
    spec: LakeSpec,
    mode: str = "skip",
    parallel_years: int = 8,
) -> list[WriteReport]:
    """Raw zip archives -> bronze leaves, without unpacking to disk.

    Years come from the archive names; each year's archives are read together
    through the zip source (so a year's schema is its own header, and silver's
    presence map stays right) and written to that year's leaf. Committed leaves
    (``_SUCCESS``) are skipped unless ``mode="overwrite"``.
    """
    if mode not in ("skip", "overwrite"):
        raise ValueError("mode must be 'skip' or 'overwrite'")
    register(spark)
    by_year: dict[int, list[str]] = {}
    for part in list_members(archive_options(spec, folder)):
        by_year.setdefault(part.year, []).append(part.archive)
    reports, todo = [], []
    for year, archives in sorted(by_year.items()):
        leaf = leaf_path(bronze_root, year, spec.year_col)
        if mode == "skip" and is_complete(spark, leaf):
            reports.append(WriteReport(spec.name, leaf, "skipped", year))
        else:
            todo.append((year, archives))

    def ingest(item: tuple[int, list[str]]) -> WriteReport:
        year, archives = item
        opts = archive_options(spec, ",".join(archives))
        df = spark.read.format(FORMAT).options(**opts).load()
        return write_leaf(df, bronze_root, year, spec.year_col, table=spec.name)

    if todo:
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_years, len(todo)))) as pool:
            reports.extend(pool.map(ingest, todo))
    return sorted(reports, key=lambda r: r.year)
