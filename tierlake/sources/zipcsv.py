"""S3: delimited text inside zip archives, as a Spark Python Data Source.

``spark.read.format("zipcsv").option("path", folder).load()`` yields one row per
record of the first matching member of every ``*_<yyyy>.zip`` archive in the folder,
tagged with the year from the archive name. DEFLATE streams cannot be split, so the
unit of parallelism is the member: one input partition per (archive, member), read
as a stream (never unpacked to disk, never held whole in memory) and handed to
Spark as Arrow record batches.

Columns are aligned by header name, not position: the output schema is the union
of all members' headers in first-seen order, and a member lacking a column yields
NULL there. Every value is a string, as in bronze, and an empty field (quoted or
not) is NULL, as Spark's CSV reader gives it.
"""

from __future__ import annotations

import csv
import io
import logging
import zipfile
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, In, InputPartition
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierlake.spec import YEAR_COL, year_from_name

FORMAT = "zipcsv"
log = logging.getLogger(__name__)


def _filesystem(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file://"):
        return pafs.LocalFileSystem(), path[len("file://"):]
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path[len("file:"):]
    if path.startswith(("s3a://", "s3n://")):
        path = "s3://" + path.split("://", 1)[1]  # Hadoop's names of the same store
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _csv_kwargs(options: dict) -> dict:
    sep = options.get("sep", ",")
    quote = options.get("quote", '"')
    escape = options.get("escape", "\\")
    kw = {"delimiter": sep, "quotechar": quote, "quoting": csv.QUOTE_NOTNULL, "strict": False}
    if escape == quote:
        kw.update(doublequote=True, escapechar=None)
    else:
        kw.update(doublequote=False, escapechar=escape or None)
    return kw


def _member_filter(options: dict):
    tokens = [t for t in options.get("member_tokens", "").split(",") if t]
    suffix = options.get("member_suffix", ".csv")
    return lambda name: all(t in name for t in tokens) and name.endswith(suffix)


@dataclass
class MemberPartition(InputPartition):
    archive: str
    member: str
    year: int


def list_archives(options: dict) -> list[tuple]:
    """(file system, path on it, URI, year) of each archive whose name ends in
    ``_<yyyy>.zip``, by listing alone; with ``years`` of those years only."""
    import pyarrow.fs as pafs

    roots = [p for p in options.get("path", "").split(",") if p]
    wanted = {int(y) for y in options.get("years", "").split(",") if y.strip()}
    found = []
    for root in roots:
        fs, base = _filesystem(root)
        info = fs.get_file_info(base)
        single = info.type == pafs.FileType.File
        files = [info] if single else fs.get_file_info(pafs.FileSelector(base, recursive=False))
        for f in sorted(files, key=lambda i: i.path):
            if f.type != pafs.FileType.File or not f.base_name.lower().endswith(".zip"):
                continue
            year = year_from_name(f.base_name)
            if year is None or (wanted and year not in wanted):
                continue  # the year is in the name: unwanted archives are never opened
            # The archive's URI in the form the caller gave (scheme and authority kept).
            full = root if single else root.rstrip("/") + "/" + f.path[len(base.rstrip("/")):].lstrip("/")
            found.append((fs, f.path, full, year))
    return found


def list_members(options: dict, archives: set[str] | None = None) -> list[MemberPartition]:
    """First matching member of each archive (of ``archives``, if given); with
    ``members=all`` every matching member. Members left out are warned of."""
    found = [item for item in list_archives(options) if archives is None or item[2] in archives]
    matches = _member_filter(options)
    every = options.get("members", "first") == "all"

    def members(item) -> list[MemberPartition]:
        fs, path, full, year = item
        # Reads only the archive's central directory, not its data.
        with fs.open_input_file(path) as handle, zipfile.ZipFile(handle) as zf:
            names = [n for n in zf.namelist() if matches(n)]
        if len(names) > 1 and not every:
            log.warning("%s: reading %s only, not %s; members=all reads them", full, names[0], names[1:])
        return [MemberPartition(full, n, year) for n in (names if every else names[:1])]

    with ThreadPoolExecutor(max_workers=max(1, min(16, len(found)))) as pool:
        return [m for ms in pool.map(members, found) for m in ms]


def _open_records(part: MemberPartition, options: dict):
    fs, path = _filesystem(part.archive)
    handle = fs.open_input_file(path)
    zf = zipfile.ZipFile(handle)
    raw = zf.open(part.member)
    text = io.TextIOWrapper(raw, encoding=options.get("encoding", "UTF-8"), newline="")
    return (handle, zf, raw, text), csv.reader(text, **_csv_kwargs(options))


def _names(record: list) -> list[str]:
    """Column names of a header record, without a byte order mark."""
    return [(h or "").removeprefix("\ufeff") if i == 0 else (h or "") for i, h in enumerate(record)]


def read_header(part: MemberPartition, options: dict) -> list[str]:
    closers, records = _open_records(part, options)
    try:
        return _names(next(records, []))
    finally:
        for c in reversed(closers):
            c.close()


class ZipCsvReader(DataSourceReader):
    """Reads one member per partition. The default parser is ``pyarrow.csv``'s
    streaming reader (vectorised, Arrow batches straight through); rows whose field
    count differs from the header are handed back by its invalid-row hook and
    re-parsed here, padded with NULL or cut, as Spark's permissive CSV mode does.
    ``parser=python`` uses the standard-library reader for every row."""

    def __init__(self, options: dict, schema: StructType):
        self.options = dict(options)
        self.schema = schema

    def partitions(self):
        return list_members(self.options)

    def read(self, partition: MemberPartition | None):
        if partition is None:  # no archive matches; Spark then asks for one absent partition
            return
        header = read_header(partition, self.options)
        if not header:
            return
        if self.options.get("parser", "arrow") == "python" or len(set(header)) != len(header):
            yield from self._read_python(partition)
            return
        import pyarrow as pa

        done = 0
        try:
            for batch in self._read_arrow(partition, header):
                done += batch.num_rows
                yield batch
        except pa.ArrowInvalid:
            # A record longer than the parse block: the row parser goes on after the
            # records that were handed out, wherever the long one stands.
            yield from self._read_python(partition, skip=done)

    def pushFilters(self, filters):
        """Takes equality and IN on the year: archives of other years are not opened."""
        year_col = self.options.get("year_col", YEAR_COL)
        asked = None
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == (year_col,) and all(isinstance(v, int) for v in values):
                asked = set(values) if asked is None else asked & set(values)
            else:
                yield f
        if asked is not None:
            given = {int(y) for y in self.options.get("years", "").split(",") if y.strip()}
            asked = asked & given if given else asked
            self.options["years"] = ",".join(map(str, sorted(asked))) or "-1"

    # -- shared -------------------------------------------------------------------
    def _layout(self):
        import pyarrow as pa

        names = [f.name for f in self.schema.fields]
        year_col = self.options.get("year_col", YEAR_COL)
        arrow_schema = pa.schema([pa.field(n, pa.int32() if n == year_col else pa.string()) for n in names])
        return names, year_col, arrow_schema

    def _batch(self, partition, columns: dict, count: int):
        """Arrow batch in the output schema from ``columns`` (name -> values)."""
        import numpy as np
        import pyarrow as pa

        names, year_col, arrow_schema = self._layout()
        arrays = []
        for n in names:
            if n == year_col:
                arrays.append(pa.array(np.full(count, partition.year, dtype=np.int32)))
            elif n in columns:
                col = columns[n]
                arrays.append(col if isinstance(col, (pa.Array, pa.ChunkedArray)) else pa.array(col, pa.string()))
            else:
                arrays.append(pa.nulls(count, pa.string()))
        arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    def _rows_batch(self, partition, header: list[str], rows: list[list]):
        width = len(header)
        cols = {h: [] for h in header}
        for row in rows:
            for i, h in enumerate(header):
                cols[h].append((row[i] or None) if i < len(row) else None)
        return self._batch(partition, cols, len(rows)) if rows and width else None

    # -- pyarrow ------------------------------------------------------------------
    def _read_arrow(self, partition: MemberPartition, header: list[str]):
        import pyarrow as pa
        import pyarrow.csv as pacsv

        sep = self.options.get("sep", ",")
        quote = self.options.get("quote", '"')
        escape = self.options.get("escape", "\\")
        odd: list[str] = []

        def on_invalid(row) -> str:
            odd.append(row.text)
            return "skip"

        parse = pacsv.ParseOptions(
            delimiter=sep,
            quote_char=quote,
            double_quote=escape == quote,
            escape_char=False if (not escape or escape == quote) else escape,
            newlines_in_values=True,
            ignore_empty_lines=True,
            invalid_row_handler=on_invalid,
        )
        read = pacsv.ReadOptions(
            encoding=self.options.get("encoding", "UTF-8"),
            block_size=int(self.options.get("block_bytes", str(16 << 20))),
            use_threads=False,
        )
        convert = pacsv.ConvertOptions(
            column_types={h: pa.string() for h in header},
            strings_can_be_null=True,
            quoted_strings_can_be_null=True,
            null_values=[""],
        )
        kw = _csv_kwargs(self.options)
        fs, path = _filesystem(partition.archive)
        with fs.open_input_file(path) as handle, zipfile.ZipFile(handle) as zf, zf.open(partition.member) as raw:
            for batch in pacsv.open_csv(raw, read_options=read, parse_options=parse, convert_options=convert):
                names = _names(batch.schema.names)
                if set(names) != set(header):
                    raise ValueError(f"{partition.archive}!{partition.member}: parsed columns {names} are not the header {header}")
                if batch.num_rows:
                    yield self._batch(partition, dict(zip(names, batch.columns)), batch.num_rows)
                if odd:
                    rows = [next(csv.reader(io.StringIO(t), **kw), []) for t in odd]
                    odd.clear()
                    extra = self._rows_batch(partition, header, [r for r in rows if r])
                    if extra is not None:
                        yield extra
            if odd:
                rows = [next(csv.reader(io.StringIO(t), **kw), []) for t in odd]
                extra = self._rows_batch(partition, header, [r for r in rows if r])
                if extra is not None:
                    yield extra

    # -- standard library ------------------------------------------------------------
    def _read_python(self, partition: MemberPartition, skip: int = 0):
        batch_rows = int(self.options.get("batch_rows", "8192"))
        closers, records = _open_records(partition, self.options)
        try:
            header = next(records, None)
            if header is None:
                return
            header = _names(header)
            first: dict[str, int] = {}
            for i, h in enumerate(header):
                first.setdefault(h, i)
            names, year_col, _ = self._layout()
            value_names = [n for n in names if n != year_col]
            index = [first.get(n, -1) for n in value_names]
            buf: list[list] = [[] for _ in value_names]
            count = 0
            for row in records:
                if not row:
                    continue
                if skip:
                    skip -= 1
                    continue
                width = len(row)
                for j, i in enumerate(index):
                    buf[j].append((row[i] or None) if 0 <= i < width else None)
                count += 1
                if count >= batch_rows:
                    yield self._batch(partition, dict(zip(value_names, buf)), count)
                    buf = [[] for _ in value_names]
                    count = 0
            if count:
                yield self._batch(partition, dict(zip(value_names, buf)), count)
        finally:
            for c in reversed(closers):
                c.close()


class ZipCsvStreamReader(DataSourceStreamReader):
    """Archives as a stream: an offset is the set of archives seen, so one that comes late
    is read whatever its name sorts after, and none is read twice."""

    def __init__(self, options: dict, schema: StructType):
        self.batch = ZipCsvReader(options, schema)

    def initialOffset(self) -> dict:
        return {"archives": []}

    def latestOffset(self) -> dict:
        return {"archives": sorted(item[2] for item in list_archives(self.batch.options))}

    def partitions(self, start: dict, end: dict) -> list[MemberPartition]:
        new = set(end["archives"]) - set(start["archives"])
        return list_members(self.batch.options, new) if new else []

    def read(self, partition: MemberPartition | None):
        if partition is None:
            return
        known = {f.name for f in self.batch.schema.fields}
        unknown = [h for h in read_header(partition, self.batch.options) if h not in known]
        if unknown:
            raise ValueError(f"{partition.archive}!{partition.member} has columns {unknown} that the stream was not started with")
        yield from self.batch.read(partition)


class ZipCsvDataSource(DataSource):
    """Options: ``path`` (folder, archive, or comma list), ``sep``, ``encoding``,
    ``quote``, ``escape``, ``member_tokens`` (comma list of substrings the member
    name must contain), ``member_suffix``, ``year_col``, ``years`` (comma list: read
    only those years' archives; others are not opened), ``parser`` (``arrow`` or
    ``python``), ``block_bytes`` (arrow block; from a longer record on, a member is read
    by the row parser), ``batch_rows`` (python parser), ``members`` (``first`` or ``all``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        year_col = self.options.get("year_col", YEAR_COL)
        seen: dict[str, None] = {}
        parts = list_members(self.options)
        if not parts:
            raise FileNotFoundError(
                f"no archive member matches under {self.options.get('path')!r} "
                f"(tokens {self.options.get('member_tokens', '')!r}, suffix {self.options.get('member_suffix', '.csv')!r}"
                + (f", years {self.options['years']}" if self.options.get("years") else "")
                + ")"
            )
        with ThreadPoolExecutor(max_workers=max(1, min(16, len(parts)))) as pool:
            headers = list(pool.map(lambda p: read_header(p, self.options), parts))
        for header in headers:
            for h in header:
                if h != year_col:
                    seen.setdefault(h, None)
        return StructType(
            [StructField(year_col, IntegerType(), True)] + [StructField(h, StringType(), True) for h in seen]
        )

    def reader(self, schema: StructType) -> ZipCsvReader:
        return ZipCsvReader(self.options, schema)

    def streamReader(self, schema: StructType) -> ZipCsvStreamReader:
        return ZipCsvStreamReader(self.options, schema)


def register(spark) -> None:
    """Make ``format("zipcsv")`` available in this session (idempotent); the
    reader runs in the Python workers, so the package is shipped to them."""
    from tierlake.session import ship_package

    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # the year reaches the listing
    spark.dataSource.register(ZipCsvDataSource)
