"""Zip archives that arrive over time: the ``zipcsv`` source as a stream (S3, K3).

Offsets are the names of the archives seen, so an archive is read once whenever it comes,
whatever its name sorts after, and also after a restart from the checkpoint. Each member of
a new archive is one partition, read as the batch source reads it.

The schema is the one the stream was started with. An archive with other columns fails, by
name, instead of losing them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tierlake.plans.archives import archive_options
from tierlake.sources.zipcsv import FORMAT, register
from tierlake.spec import LakeSpec


def ingest_archives_stream(
    spark: SparkSession, folder: str, bronze_root: str, checkpoint: str, spec: LakeSpec, schema: StructType | None = None, members: str = "first"
) -> dict:
    """Ingest every archive of ``folder`` not seen before into ``bronze_root`` (partitioned
    by year, committed by the sink's log) and stop. Returns the last progress report."""
    register(spark)
    reader = spark.readStream.format(FORMAT).options(**archive_options(spec, folder), members=members)
    if schema is not None:
        reader = reader.schema(schema)
    query = (
        reader.load()
        .writeStream.format("parquet")
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


__all__ = ["ingest_archives_stream"]
