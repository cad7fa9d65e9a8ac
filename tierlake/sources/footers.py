"""O1-O3, K4: what Parquet footers say about a table: order of its rows and codecs.

A footer holds, for every row group and column, the codec, the number of values and the
least and greatest one. Footers are read by tasks, some files each, without any data; so
order and codec of a table of any size are checked by a query over a row for each (file, row
group, column).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.session import ship_package
from tierlake.sources.fs import data_files, list_dir

FOOTERS = "path string, file int, row_group int, rows long, column string, codec string, nulls long, low string, high string, low_number double, high_number double, bytes long"


def table_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a folder and of its partition folders, in the order of their names,
    which is the order in which a sorted write numbers them."""
    path = path.rstrip("/")
    out = [f"{path}/{name}" for name, _ in data_files(spark, path)]
    for e in list_dir(spark, path):
        if e.is_dir and not e.name.startswith(("_", ".")):
            out += table_files(spark, e.path)
    return sorted(out)


def footers(spark: SparkSession, path: str, per_task: int = 200) -> DataFrame:
    """(path, file, row_group, rows, column, codec, nulls, low, high, low_number,
    high_number, bytes) of a Parquet table; ``file`` numbers the files in order. Bounds
    are NULL where the footer has none; numbers are given as such, too."""
    ship_package(spark)
    files = table_files(spark, path)
    if not files:
        return spark.createDataFrame([], FOOTERS)
    names = spark.createDataFrame(list(enumerate(files)), "file int, path string").repartition(-(-len(files) // per_task), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        from tierlake.sources.zipcsv import _filesystem

        for batch in batches:
            for r in batch.to_pylist():
                fs, at = _filesystem(r["path"])
                with fs.open_input_file(at) as f:
                    meta = pq.ParquetFile(f).metadata
                rows = []
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        col = group.column(c)
                        s = col.statistics
                        low, high = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
                        numbers = [float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None for v in (low, high)]
                        nulls = s.null_count if s is not None and s.has_null_count else None
                        text = [None if v is None else str(v) for v in (low, high)]
                        rows.append((r["path"], r["file"], g, group.num_rows, col.path_in_schema, col.compression, nulls, *text, *numbers, col.total_compressed_size))
                if rows:
                    schema = pa.schema(
                        [("path", pa.string()), ("file", pa.int32()), ("row_group", pa.int32()), ("rows", pa.int64()), ("column", pa.string()), ("codec", pa.string())]
                        + [("nulls", pa.int64()), ("low", pa.string()), ("high", pa.string()), ("low_number", pa.float64()), ("high_number", pa.float64()), ("bytes", pa.int64())]
                    )
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return names.select("path", "file").mapInArrow(run, FOOTERS)


def codec_report(found: DataFrame) -> DataFrame:
    """(codec, columns, files, row_groups, rows): how much of a table each codec holds."""
    groups = F.countDistinct("file", "row_group")
    return found.groupBy("codec").agg(F.countDistinct("column").alias("columns"), F.countDistinct("file").alias("files"), groups.alias("row_groups"))


def order_report(found: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """(row_groups, rows, ordered): do the row groups' bounds of the leading sort column
    follow one another, file by file? ``ordered`` is 0 if a group begins before the one
    before it ends, or if a bound is unknown. Groups of NULLs alone hold no bound and are
    left out."""
    mine = found.where((F.col("column") == column) & (F.coalesce("nulls", F.lit(-1)) < F.col("rows")))
    number = F.col("low_number").isNotNull() & F.col("high_number").isNotNull()
    begin, end = ("high", "low") if descending else ("low", "high")
    # A row for each row group of the table.
    before = Window.orderBy("file", "row_group")
    last_number, last_text = F.lag(f"{end}_number").over(before), F.lag(end).over(before)

    def follows(a: Column, b: Column) -> Column:
        return (a <= b) if descending else (a >= b)

    right = F.when(last_text.isNull(), True).when(number, follows(F.col(f"{begin}_number"), last_number)).otherwise(follows(F.col(begin), last_text))
    steps = mine.select("rows", F.coalesce(right & F.col("low").isNotNull(), F.lit(False)).alias("right"))
    return steps.agg(F.count(F.lit(1)).alias("row_groups"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.min(F.col("right").cast("int")), F.lit(1)).alias("ordered"))


def sorted_within(spark: SparkSession, path: str, order: Sequence[tuple[str, bool]]) -> DataFrame:
    """(rows, breaks): pairs of neighbouring rows, within a file, that break the whole order
    ``(column, descending)``; where bounds touch, footers cannot tell. Each task reads whole
    files in their own order, no shuffle but of counts."""
    columns = [c for c, _ in order]
    rows = spark.read.parquet(path).select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    downs = [d for _, d in order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, breaks, last = 0, 0, None
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if last is not None and last[-2:] == r[-2:]:
                    for a, b, down in zip(last, r, downs):
                        if a == b:
                            continue
                        # NULLs come first when ascending, last when descending.
                        up = a is None or (b is not None and a < b)
                        breaks += up == down
                        break
                last = r
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([breaks], pa.int64())], names=["rows", "breaks"])

    return rows.mapInArrow(run, "rows long, breaks long").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("breaks"), F.lit(0)).alias("breaks"))


__all__ = ["codec_report", "footers", "order_report", "sorted_within"]
