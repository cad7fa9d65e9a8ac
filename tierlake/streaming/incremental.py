"""Incremental raw -> bronze ingest as a Structured Streaming job.

An alternative to ``build_bronze`` for sources whose header is stable across
years: the file stream source remembers in its checkpoint which raw files were
already ingested, so re-running picks up only new files (new years, or a file added
to a year), exactly once, and the Parquet file sink commits through its metadata
log, so a crashed run leaves nothing half-visible. ``availableNow`` processes what
is there and stops, so it runs as a batch job on a schedule.

The header is checked against the schema (``enforceSchema`` off): a year whose
columns differ fails loudly instead of being read by position. Lakes whose years
drift use ``build_bronze``, which reads each year with its own header.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.sources.csv import discover_years, read_year_csv
from tierlake.spec import LakeSpec


def header_schema(spark: SparkSession, raw_root: str, spec: LakeSpec) -> StructType:
    """All-string schema from the first year's header."""
    years = discover_years(spark, raw_root, spec)
    if not years:
        raise FileNotFoundError(f"no raw years under {raw_root}")
    cols = read_year_csv(spark, years[0][1], spec.dialect).columns
    return StructType([StructField(c, StringType(), True) for c in cols])


def ingest_stream(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    checkpoint: str,
    spec: LakeSpec,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> dict:
    """Ingest every raw file not seen before into ``bronze_root`` (partitioned by
    year) and stop. Returns the last progress report."""
    schema = schema or header_schema(spark, raw_root, spec)
    opts = dict(spec.dialect.read_options())
    opts.pop("inferSchema", None)
    reader = (
        spark.readStream.schema(schema)
        .options(**opts)
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # Only the spec's own files, as the batch ingest finds them; other files may lie beside.
    exts = ",".join(spec.file_exts)
    folder = f"{raw_root.rstrip('/')}/*_[0-9][0-9][0-9][0-9]" + (f"/{spec.data_dir}" if spec.data_dir else "")
    source = f"{folder}/{spec.file_stem}_[0-9][0-9][0-9][0-9]{{{exts}}}"
    after = (spec.data_dir + "/") if spec.data_dir else ""
    year = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{4})/" + after, 1)
    stream = reader.csv(source).withColumn(spec.year_col, year.cast("int"))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .partitionBy(spec.year_col)
        .trigger(availableNow=True)
        .start(bronze_root)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query.lastProgress or {}
