"""Parquet layers partitioned by year (``<root>/<year_col>=<yyyy>/``)."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tierlake.sources.fs import exists, first_data_file, is_complete, list_dir, listing_digest, read_small_text, write_small_text
from tierlake.spec import YEAR_COL
from tierlake.widening import fitted, widened_schema


def leaf_path(root: str, year: int, year_col: str = YEAR_COL) -> str:
    return f"{root.rstrip('/')}/{year_col}={int(year)}"


def read_layer(
    spark: SparkSession,
    root: str,
    years: Sequence[int] | None = None,
    year_col: str = YEAR_COL,
    merge_schema: bool = True,
    schemas: dict[int, StructType] | None = None,
    widen: bool = False,
) -> DataFrame:
    """The whole layer with its year partition column; with ``years`` the filter on
    the partition column prunes the other leaves at planning time.

    With ``merge_schema`` the schema is the by-name union of the leaves' schemas,
    one footer per year (``leaf_schemas``), handed to the reader: Spark's own
    ``mergeSchema`` would instead run a job reading the footer of every file.
    ``schemas`` passes leaf schemas the caller has already read. A column whose type drifts
    over the years is an error, or, with ``widen``, takes the widest of its types: years of
    one schema are then read together, each group cast, and joined by name."""
    if not exists(spark, root):
        raise FileNotFoundError(f"layer not found: {root}")
    if widen:
        return _read_widened(spark, root, years, year_col, schemas if schemas is not None else leaf_schemas(spark, root, year_col))
    if merge_schema:
        schemas = schemas if schemas is not None else leaf_schemas(spark, root, year_col)
        if not schemas:
            raise FileNotFoundError(f"layer has no year leaves: {root}")
        df = spark.read.schema(union_schema(schemas.values(), year_col)).parquet(root)
    else:
        df = spark.read.parquet(root)
    if years is not None:
        df = df.where(F.col(year_col).isin([int(y) for y in years]))
    return df


def _read_widened(spark: SparkSession, root: str, years: Sequence[int] | None, year_col: str, schemas: dict[int, StructType]) -> DataFrame:
    """Each group of years with one set of column types is one scan of its leaves only."""
    if not schemas:
        raise FileNotFoundError(f"layer has no year leaves: {root}")
    year = StructField(year_col, IntegerType(), True)
    bare = {y: StructType([f for f in s.fields if f.name != year_col]) for y, s in schemas.items()}
    whole = StructType([*widened_schema(bare[y] for y in sorted(bare)).fields, year])
    wanted = sorted(schemas) if years is None else sorted({int(y) for y in years} & set(schemas))
    groups: dict[tuple, list[int]] = {}
    for y in wanted:
        groups.setdefault(tuple((f.name, f.dataType.json()) for f in bare[y].fields), []).append(y)
    parts = []
    for of in groups.values():
        own = StructType([*bare[of[0]].fields, year])
        rows = spark.read.schema(own).option("basePath", root.rstrip("/")).parquet(*[leaf_path(root, y, year_col) for y in of])
        parts.append(fitted(rows, whole))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], whole)


def union_schema(schemas, year_col: str = YEAR_COL) -> StructType:
    """By-name union of leaf schemas in first-seen order, plus the year partition
    column. The same name with two types is an error, never a silent cast."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            if f.name == year_col:
                continue
            seen = fields.get(f.name)
            if seen is None:
                fields[f.name] = StructField(f.name, f.dataType, True)
            elif seen.dataType != f.dataType:
                raise TypeError(f"column {f.name} is {seen.dataType} in one year and {f.dataType} in another")
    return StructType([*fields.values(), StructField(year_col, IntegerType(), True)])


def layer_years(spark: SparkSession, root: str, year_col: str = YEAR_COL) -> DataFrame:
    """Years with a leaf, ascending, header-only ones too: from the folder names, without
    a scan. A missing layer raises."""
    if not exists(spark, root):
        raise FileNotFoundError(f"layer not found: {root}")
    years = [(y,) for y in leaf_years(spark, root, year_col)]
    return spark.createDataFrame(years, StructType([StructField(year_col, IntegerType())]))


#: A leaf's own commit id; written beside its data when the write has succeeded.
COMMIT_FILE = "_commit_id"
STREAM_LOG = "_spark_metadata"


def mark_commit(spark: SparkSession, leaf: str) -> str:
    """Give a written leaf a commit id of its own."""
    commit = uuid.uuid4().hex
    write_small_text(spark, f"{leaf.rstrip('/')}/{COMMIT_FILE}", commit)
    return commit


def leaf_versions(spark: SparkSession, root: str, year_col: str = YEAR_COL) -> dict[int, str]:
    """year -> version of its committed leaf, from what it holds and never from times.

    A leaf that a stream wrote has the digest of its files in the stream's own log; one
    that a batch wrote has its commit id, or, without one, the digest of its listing. A
    leaf is committed by its own ``_SUCCESS``, by the root's, or by the stream's log; one
    that is not raises."""
    by_root = is_complete(spark, root)
    logged = stream_versions(spark, root, year_col)
    out, open_ = {}, []
    for y in leaf_years(spark, root, year_col):
        leaf = leaf_path(root, y, year_col)
        if y in logged:
            out[y] = logged[y]
        elif not (by_root or is_complete(spark, leaf)):
            open_.append(y)
        elif exists(spark, f"{leaf}/{COMMIT_FILE}"):
            out[y] = read_small_text(spark, f"{leaf}/{COMMIT_FILE}")
        else:
            out[y] = listing_digest(spark, leaf)
    if open_:
        raise ValueError(f"years {open_} under {root} were not committed; ingest them again")
    return out


def stream_files(spark: SparkSession, root: str, year_col: str = YEAR_COL) -> list[tuple[int, str]]:
    """(year, name) of the files that a stream committed under ``root``: those of its own
    log, which is what Spark's reader of such a folder goes by. Listing only, no job."""
    files = spark.read.schema(StructType([StructField(year_col, IntegerType())])).parquet(root).inputFiles()
    hits = (re.search(rf"/{re.escape(year_col)}=(\d+)/([^/]+)$", f) for f in files)
    return sorted((int(h[1]), h[2]) for h in hits if h)


def stream_versions(spark: SparkSession, root: str, year_col: str = YEAR_COL) -> dict[int, str]:
    """year -> digest of the files that the stream's log names for it; file names are of
    one write each, so the digest changes with the content."""
    if not exists(spark, f"{root.rstrip('/')}/{STREAM_LOG}"):
        return {}
    by_year: dict[int, list[str]] = {}
    for y, name in stream_files(spark, root, year_col):
        by_year.setdefault(y, []).append(name)
    return {y: f"stream:{len(names)}:{hashlib.sha1('/'.join(names).encode()).hexdigest()}" for y, names in by_year.items()}


def _leaf_files(spark: SparkSession, root: str, year_col: str) -> dict[int, str]:
    """year -> one data file of that year's leaf (listing only, no job)."""
    prefix = f"{year_col}="
    out = {}
    for e in list_dir(spark, root):
        if e.is_dir and e.name.startswith(prefix) and e.name[len(prefix):].isdigit():
            first = first_data_file(spark, e.path)
            if first is not None:
                out[int(e.name[len(prefix):])] = first
    return out


def leaf_years(spark: SparkSession, root: str, year_col: str = YEAR_COL) -> list[int]:
    """Years with a leaf folder holding data files (listing only, no job)."""
    return sorted(_leaf_files(spark, root, year_col))


def leaf_schemas(spark: SparkSession, root: str, year_col: str = YEAR_COL) -> dict[int, StructType]:
    """Each year's leaf schema from the footer of one of its files (a leaf is written
    by one job, so its files agree; reading a single file also skips listing the
    whole leaf). The reads are independent and run side by side."""
    files = _leaf_files(spark, root, year_col)
    years = sorted(files)

    def schema(y: int) -> StructType:
        return spark.read.option("mergeSchema", "false").parquet(files[y]).schema

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(years)))) as pool:
        return dict(zip(years, pool.map(schema, years)))
