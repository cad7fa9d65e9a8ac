"""Raw-lake fixtures derived from the driver's tables by Spark jobs.

The lake stages read yearly text files; these helpers write such files from a
DataFrame (whole table, every row), so the stage queries scale with the input:

* ``lineitem_raw``: lineitem as an all-string survey with absent (empty) and
  malformed (``x``) score text, year = ship year;
* ``documents_raw``: documents as all-string text, year from the source number;
* ``write_raw_csv``: one ``<prefix>_<yyyy>/<data_dir>/<stem>_<yyyy>.csv`` per year,
  from one partitioned write per distinct column set plus folder renames;
* ``write_raw_zips``: one zip archive per (task, year), written inside the tasks.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.scores import year_of
from tierlake.session import ship_package, unsorted_leaves
from tierlake.sources.fs import list_dir, rename
from tierlake.spec import LakeSpec, YEAR_COL

LINEITEM_SCORES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def raw_score_text(c: str) -> F.Column:
    """Line 7 carries unparsable text, a zero value is written as an empty field."""
    return (
        F.when(F.col("l_linenumber") == 7, F.lit("x"))
        .otherwise(F.when(F.col(c) != 0, F.col(c).cast("string")))
        .alias(c)
    )


def lineitem_raw(lineitem: DataFrame, year_col: str = YEAR_COL) -> DataFrame:
    """lineitem as raw survey text: every column a string, year = ship year."""
    return lineitem.select(
        year_of("l_shipdate").alias(year_col),
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        "l_returnflag",
        "l_linestatus",
        *[raw_score_text(c) for c in LINEITEM_SCORES],
    )


def exam_raw(lineitem: DataFrame, year_col: str = YEAR_COL) -> DataFrame:
    """lineitem under the exam source's column names, as raw text, so the exam spec
    itself runs over a whole driver table, all of its columns filled: place = return
    flag, sex = line status, age band = line number, the four measures and the tax (as
    essay) are scores, the mathematics score is the discount in percent; race, marital
    status, school and trial taker come from the part, supplier and order keys."""
    text = {c: raw_score_text(c) for c in LINEITEM_SCORES}
    part = lambda c, k: (F.col(c) % k).cast("string")
    return lineitem.withColumn("l_math", F.round(F.col("l_discount") * 100, 0)).select(
        year_of("l_shipdate").alias(year_col),
        F.col("l_orderkey").cast("string").alias("NU_INSCRICAO"),
        F.col("l_linenumber").cast("string").alias("TP_FAIXA_ETARIA"),
        F.col("l_linestatus").alias("TP_SEXO"),
        part("l_suppkey", 5).alias("TP_ESTADO_CIVIL"),
        part("l_partkey", 6).alias("TP_COR_RACA"),
        part("l_suppkey", 3).alias("TP_ESCOLA"),
        part("l_orderkey", 2).alias("IN_TREINEIRO"),
        F.col("l_returnflag").alias("SG_UF_PROVA"),
        text["l_quantity"].alias("NU_NOTA_CN"),
        text["l_extendedprice"].alias("NU_NOTA_CH"),
        text["l_discount"].alias("NU_NOTA_LC"),
        raw_score_text("l_math").alias("NU_NOTA_MT"),
        text["l_tax"].alias("NU_NOTA_REDACAO"),
    )


def documents_raw(documents: DataFrame, year_col: str = YEAR_COL) -> DataFrame:
    """documents as raw text, year = 2000 + the number in its source name."""
    year = (F.lit(2000) + F.regexp_extract("source", r"(\d+)$", 1).cast("int")).cast("int")
    return documents.select(
        year.alias(year_col),
        F.col("doc_id").cast("string").alias("doc_id"),
        "text",
        "lang",
        "source",
        F.col("n_chars").cast("string").alias("n_chars"),
    )


def write_raw_csv(
    spark: SparkSession,
    df: DataFrame,
    raw_root: str,
    spec: LakeSpec,
    prefix: str,
    drop: Mapping[int, Sequence[str]] | None = None,
    years: Sequence[int] | None = None,
    max_records_per_file: int = 0,
) -> list[int]:
    """Write ``df`` (with the year column) as yearly raw CSV folders. ``drop`` removes
    columns in some years (schema drift); ``years`` limits which years are written
    (an incremental-arrival fixture). Returns the years written."""
    y = spec.year_col
    drop = {int(k): list(v) for k, v in (drop or {}).items()}
    if years is None:
        years = sorted(int(r[0]) for r in df.select(y).distinct().collect())
    years = [int(v) for v in years]
    groups: dict[tuple[str, ...], list[int]] = {}
    for yr in years:
        groups.setdefault(tuple(drop.get(yr, [])), []).append(yr)
    staging = f"{raw_root.rstrip('/')}_staging"
    for n, (dropped, group_years) in enumerate(sorted(groups.items())):
        part = df.where(F.col(y).isin(group_years)).drop(*dropped)
        out = f"{staging}/g{n}"
        writer = part.write.mode("overwrite").options(**spec.dialect.write_options())
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
        with unsorted_leaves(spark):
            writer.partitionBy(y).csv(out)
        for e in list_dir(spark, out):
            if e.is_dir and e.name.startswith(f"{y}="):
                yr = int(e.name.split("=", 1)[1])
                dest = spec.raw_files(f"{raw_root.rstrip('/')}/{prefix}_{yr}", yr)[0]
                rename(spark, e.path, dest)
    return years


def write_raw_lines(spark: SparkSession, lines: DataFrame, header: Sequence[str], raw_root: str, spec: LakeSpec, prefix: str) -> None:
    """Write (year, line) as yearly raw files of these very lines below the header, so that
    lines which do not fit the header can be among them."""
    y, staging = spec.year_col, f"{raw_root.rstrip('/')}_staging"
    # One column named as the header, in a dialect that quotes and separates nothing.
    whole = lines.select(y, F.col("line").alias(spec.dialect.sep.join(header)))
    options = {"header": "true", "sep": "\u0001", "quote": "", "escape": "", "encoding": spec.dialect.encoding}
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}
    with unsorted_leaves(spark):
        whole.write.mode("overwrite").options(**options, **keep).partitionBy(y).csv(staging)
    for e in list_dir(spark, staging):
        if e.is_dir and e.name.startswith(f"{y}="):
            yr = int(e.name.split("=", 1)[1])
            rename(spark, e.path, spec.raw_files(f"{raw_root.rstrip('/')}/{prefix}_{yr}", yr)[0])


def broken_lines(raw: DataFrame, spec: LakeSpec) -> DataFrame:
    """(year, line): the raw records as lines, those of line number 6 cut behind their fourth
    field and those of line number 5 with two fields too many."""
    names = [c for c in raw.columns if c != spec.year_col]
    texts = [F.coalesce(F.col(c), F.lit("")) for c in names]
    sep = spec.dialect.sep
    n = F.col("l_linenumber")
    line = F.when(n == "6", F.concat_ws(sep, *texts[:4])).when(n == "5", F.concat_ws(sep, *texts, F.lit("more"), F.lit(""))).otherwise(F.concat_ws(sep, *texts))
    return raw.select(spec.year_col, line.alias("line"))


def _zip_writer(cols: list[str], year_col: str, folder: str, prefix: str, spec: LakeSpec):
    def run(batches):
        from pyspark import TaskContext

        from tierlake.sources.zipcsv import _filesystem

        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        open_: dict[int, tuple] = {}
        counts: dict[int, int] = {}
        d = spec.dialect
        kw = {"delimiter": d.sep, "quotechar": d.quote, "lineterminator": "\n"}
        if d.escape == d.quote:
            kw.update(doublequote=True)
        else:
            kw.update(doublequote=False, escapechar=d.escape)
        try:
            for pdf in batches:
                for year, g in pdf.groupby(year_col, sort=False):
                    year = int(year)
                    if year not in open_:
                        path = f"{base}/{prefix}-p{pid:05d}_{year}.zip"
                        # Each attempt writes its own hidden file and moves it into
                        # place when complete: a retried or speculative attempt never
                        # shares a half-written archive with another.
                        stream = fs.open_output_stream(f"{base}/.{prefix}-p{pid:05d}_{year}.a{attempt}")
                        zf = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
                        member = zf.open(spec.member_name(year), "w", force_zip64=True)
                        text = io.TextIOWrapper(member, encoding=d.encoding, newline="")
                        w = csv.writer(text, **kw)
                        w.writerow(cols)
                        open_[year] = (stream, zf, member, text, w, path)
                        counts[year] = 0
                    w = open_[year][4]
                    for row in g[cols].itertuples(index=False, name=None):
                        w.writerow(["" if v is None or (isinstance(v, float) and pd.isna(v)) else v for v in row])
                    counts[year] += len(g)
        finally:
            for year, (stream, zf, member, text, _w, _p) in open_.items():
                text.flush()
                text.detach()
                member.close()
                zf.close()
                stream.close()
        for year, entry in open_.items():
            fs.move(f"{base}/.{prefix}-p{pid:05d}_{year}.a{attempt}", entry[5])
        if open_:  # a task that received no rows writes nothing and reports nothing
            yield pd.DataFrame(
                {
                    "archive": [open_[y][5] for y in open_],
                    year_col: pd.Series(list(open_), dtype="int32"),
                    "rows": pd.Series([counts[y] for y in open_], dtype="int64"),
                }
            )

    return run


def write_raw_zips(df: DataFrame, folder: str, spec: LakeSpec, prefix: str) -> DataFrame:
    """Write ``df`` (string columns plus the year column) as zip archives, one per
    (input partition, year), each holding one member the spec's zip filter accepts.
    No shuffle: each task writes the rows it already has. Returns the small
    (archive, year, rows) listing after running the job."""
    ship_package(df.sparkSession)
    y = spec.year_col
    cols = [c for c in df.columns if c != y]
    fn = _zip_writer(cols, y, folder, prefix, spec)
    out = df.select(*[F.col(c).cast("string") for c in cols], F.col(y).cast("int")).mapInPandas(
        fn, f"archive string, {y} int, rows long"
    )
    return out
