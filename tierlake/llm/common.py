"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

#: Code points of text that a Python task holds as word lists at one time.
CHUNK_CHARS = 1 << 20


#: How to clear what operators remember beyond a task in a Python worker.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remembers(name: str, clear: Callable[[], None]) -> None:
    """An operator's memory, by the operator's name."""
    _REMEMBERED[name] = clear


def give_back(but: str = "") -> None:
    """At a task's end: Spark goes on with its Python workers, so what other operators than
    ``but`` remember in this one goes, and freed memory goes back to the system."""
    for name, clear in _REMEMBERED.items():
        if name != but:
            clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns, cast: ``pick(df, doc_id="long", text="string")``.

    Columns are taken by position after an exact match of the name, so extra columns
    (also ones that differ in case only) cannot clash. A column that is absent is null.
    """
    names = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = []
    for name, kind in wanted.items():
        hit = names.index(name) if name in names else None
        col = F.col(f"c{hit}") if hit is not None else F.lit(None)
        out.append(col.cast(kind).alias(name))
    return flat.select(*out)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) over a batch, at most ``limit`` code points each unless one
    text alone is longer. Null texts come as empty ones."""
    texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
    at, size, part = 0, 0, []
    for i, t in enumerate(texts):
        t = t or ""
        if part and size + len(t) > limit:
            yield at, part
            at, size, part = i, 0, []
        part.append(t)
        size += len(t)
    if part:
        yield at, part


def _mapped(df: DataFrame, column: str, kind, arrow: pa.DataType, change) -> DataFrame:
    schema = StructType([StructField(f.name, kind, True) if f.name == column else f for f in df.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            columns = list(batch.columns)
            columns[at] = pa.array([None if v is None else change(v) for v in columns[at].to_pylist()], arrow)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        give_back()

    return df.mapInArrow(run, schema)


def pack(text: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(text.encode("utf-8", "surrogatepass"))


def unpack(data: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass")


def packed(df: DataFrame, column: str = "text") -> DataFrame:
    """A text column compressed, for shuffles that carry whole texts; equal texts stay equal."""
    return _mapped(df, column, BinaryType(), pa.binary(), pack)


def unpacked(df: DataFrame, column: str = "text") -> DataFrame:
    return _mapped(df, column, StringType(), pa.string(), unpack)
