"""S1 with rescue: permissive reading that tells which records it could not read.

A record whose field count differs from the header's is padded or cut by a permissive read.
Here its raw text comes along in a column of its own.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.sources.csv import read_year_csv
from tierlake.spec import CsvDialect

RESCUED = "_rescued"
SHORT, LONG, OTHER = "short", "long", "malformed"


def read_year_rescued(
    spark: SparkSession, path: str | Sequence[str], dialect: CsvDialect = CsvDialect(), columns: Sequence[str] | None = None, rescued: str = RESCUED
) -> DataFrame:
    """One year's raw files as ``read_year_csv`` gives them, and ``rescued``: the raw text of
    a record whose number of fields is not the header's, else NULL. ``columns`` is the
    header, if the files' own first lines are not to be asked."""
    columns = list(columns) if columns is not None else read_year_csv(spark, path, dialect).columns
    if rescued in columns:
        raise ValueError(f"the file has a column {rescued} of its own")
    schema = StructType([StructField(c, StringType()) for c in [*columns, rescued]])
    # Without pruning off, a query of few columns would not count the fields of a record.
    reader = spark.read.schema(schema).options(**dialect.read_options()).option("columnNameOfCorruptRecord", rescued).option("columnPruning", "false")
    return reader.csv(path if isinstance(path, str) else list(path))


def field_count(text: str | Column, dialect: CsvDialect) -> Column:
    """Fields of a raw record; separators inside quotes do not count."""
    text = F.col(text) if isinstance(text, str) else text
    q, e = re.escape(dialect.quote), re.escape(dialect.escape)
    inside = f"{q}(?:{e}.|[^{q}])*{q}" if dialect.escape and dialect.escape != dialect.quote else f"{q}[^{q}]*{q}"
    bare = F.regexp_replace(text, F.lit(f"(?s){inside}"), F.lit(""))
    return (F.length(bare) - F.length(F.replace(bare, F.lit(dialect.sep), F.lit("")))) / len(dialect.sep) + 1


def reason(text: str | Column, fields: int, dialect: CsvDialect) -> Column:
    """Why a record was rescued."""
    n = field_count(text, dialect)
    return F.when(n < fields, SHORT).when(n > fields, LONG).otherwise(OTHER)


__all__ = ["RESCUED", "field_count", "read_year_rescued", "reason"]
