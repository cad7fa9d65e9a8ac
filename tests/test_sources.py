"""Zip source, CSV source and streaming ingest."""

import io
import os
import zipfile
from types import SimpleNamespace

from conftest import write_text
from pyspark.sql import functions as F

from tierlake import fixtures as fx
from tierlake.plans import build_bronze, load_archives, load_archives_typed
from tierlake.sources import read_year_csv
from tierlake.sources import read_layer
from tierlake.spec import DOCUMENTS_SPEC, EXAM_SPEC as S, LINEITEM_SPEC
from tierlake.streaming import ingest_stream

SF = "/root/testdata/sf0.001"


def make_zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in members:
            zf.writestr(name, text.encode("ISO-8859-1"))
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_source_aligns_headers_and_picks_first_member(spark, workdir):
    make_zip(
        f"{workdir}/survey_2021.zip",
        [
            ("LEIA-ME.txt", "x"),
            ("DADOS/RESULTADOS_2021.csv", "SG_UF_PROVA;NU_NOTA_CN\nSP;1.5\nRJ;\n"),
            ("DADOS/RESULTADOS_2021_b.csv", "SG_UF_PROVA;NU_NOTA_CN\nXX;9\n"),
        ],
    )
    make_zip(f"{workdir}/survey_2022.zip", [("DADOS/RESULTADOS_2022.csv", "NU_NOTA_MT;SG_UF_PROVA\n7;São\n")])
    make_zip(f"{workdir}/sem_ano.zip", [("DADOS/RESULTADOS_X.csv", "SG_UF_PROVA\nZZ\n")])
    make_zip(f"{workdir}/outro_2023.zip", [("DADOS/OUTRO_2023.csv", "SG_UF_PROVA\nZZ\n")])
    df = load_archives(spark, workdir, S)
    assert df.columns == ["ano", "SG_UF_PROVA", "NU_NOTA_CN", "NU_NOTA_MT"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [(2021, "RJ", None, None), (2021, "SP", "1.5", None), (2022, "São", None, "7")]
    typed = {(r["ano"], r["SG_UF_PROVA"]): r for r in load_archives_typed(spark, workdir, S).collect()}
    assert typed[(2021, "RJ")]["NU_NOTA_CN"] == 0.0
    assert typed[(2021, "RJ")]["NU_NOTA_MT"] is None  # 2021 had no MT: not filled
    assert typed[(2022, "São")]["NU_NOTA_MT"] == 7.0


def test_zip_path_equals_csv_path(spark, workdir):
    raw = fx.documents_raw(spark.read.parquet(f"{SF}/documents.parquet"))
    fx.write_raw_zips(raw.repartition(3), f"{workdir}/zips", DOCUMENTS_SPEC, "docs").collect()
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", DOCUMENTS_SPEC, "docs", max_records_per_file=50)
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", DOCUMENTS_SPEC)
    via_zip = load_archives(spark, f"{workdir}/zips", DOCUMENTS_SPEC)
    via_csv = read_layer(spark, f"{workdir}/bronze").select(*via_zip.columns)
    assert via_zip.count() == raw.count()
    assert via_zip.exceptAll(via_csv).count() == 0 and via_csv.exceptAll(via_zip).count() == 0
    assert raw.select(*via_zip.columns).exceptAll(via_zip).count() == 0


def test_latin1_csv_and_quoted_newlines(spark, workdir):
    text = 'id;txt\n1;"linha um\nlinha ""dois"""\n2;ação\n'
    write_text(f"{workdir}/raw/docs_2020/DADOS/MICRODADOS_DOCS_2020.csv", text)
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", DOCUMENTS_SPEC)
    got = {r["id"]: r["txt"] for r in read_layer(spark, f"{workdir}/bronze").collect()}
    assert got == {"1": 'linha um\nlinha "dois"', "2": "ação"}


def test_stream_ingest_is_incremental_and_exactly_once(spark, workdir):
    raw = fx.lineitem_raw(spark.read.parquet(f"{SF}/lineitem.parquet"))
    years = sorted(r[0] for r in raw.select("ano").distinct().collect())
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", LINEITEM_SPEC, "lineitem", years=years[:3])
    ingest_stream(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/_ckpt", LINEITEM_SPEC)
    first = spark.read.parquet(f"{workdir}/bronze").count()
    assert first == raw.where(F.col("ano").isin(years[:3])).count()
    ingest_stream(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/_ckpt", LINEITEM_SPEC)
    assert spark.read.parquet(f"{workdir}/bronze").count() == first  # nothing new, nothing twice
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", LINEITEM_SPEC, "lineitem", years=years[3:])
    ingest_stream(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/_ckpt", LINEITEM_SPEC)
    out = spark.read.parquet(f"{workdir}/bronze")
    assert out.select(*raw.columns).exceptAll(raw).count() == 0 and raw.exceptAll(out.select(*raw.columns)).count() == 0
    # Silver reads a stream-written bronze like any other (through its commit log).
    from tierlake.plans import build_silver

    rep = build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", LINEITEM_SPEC)
    assert rep.rows == raw.count() == read_layer(spark, f"{workdir}/silver").count()


def test_archives_to_bronze_keep_each_years_header(spark, workdir):
    from tierlake.plans import build_bronze_from_archives, build_silver

    os.makedirs(f"{workdir}/z", exist_ok=True)
    make_zip(f"{workdir}/z/survey_2021.zip", [("DADOS/RESULTADOS_2021.csv", "SG_UF_PROVA;NU_NOTA_CN\nSP;10\nRJ;\n")])
    make_zip(f"{workdir}/z/survey_2022.zip", [("DADOS/RESULTADOS_2022.csv", "NU_NOTA_MT;SG_UF_PROVA\n7;SP\n")])
    first = build_bronze_from_archives(spark, f"{workdir}/z", f"{workdir}/bronze", S)
    assert [(r.year, r.action, r.rows) for r in first] == [(2021, "written", 2), (2022, "written", 1)]
    again = build_bronze_from_archives(spark, f"{workdir}/z", f"{workdir}/bronze", S)
    assert [r.action for r in again] == ["skipped", "skipped"]
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S)
    got = {(r["ano"], r["SG_UF_PROVA"]): r for r in read_layer(spark, f"{workdir}/silver").collect()}
    assert got[(2021, "RJ")]["NU_NOTA_CN"] == 0.0 and got[(2021, "RJ")]["NU_NOTA_MT"] is None
    assert got[(2022, "SP")]["NU_NOTA_MT"] == 7.0 and got[(2022, "SP")]["NU_NOTA_CN"] is None


def test_stream_ingest_refuses_a_drifted_header(spark, workdir):
    import pytest

    write_text(f"{workdir}/raw/x_2020/DADOS/MICRODADOS_ENEM_2020.csv", "SG_UF_PROVA;NU_NOTA_CN\nSP;1\n")
    write_text(f"{workdir}/raw/x_2021/DADOS/MICRODADOS_ENEM_2021.csv", "NU_NOTA_CN;SG_UF_PROVA\n2;RJ\n")
    with pytest.raises(Exception) as err:
        ingest_stream(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/_ckpt", S)
    message = str(err.value)
    # The drifted year's file is the one refused, and the failed batch commits nothing.
    assert "x_2021/DADOS/MICRODADOS_ENEM_2021.csv" in message
    assert "Current Committed Offsets: {}" in message


EDGE = (
    "K;SG_UF_PROVA;NU_NOTA_CN;TXT\n"
    "1;SP;650.5;plain\n"
    "2;SP;;\n"  # unquoted empties -> NULL
    '3;RJ;"";""\n'  # quoted empties -> NULL as well (Spark's CSV reader agrees)
    "4;RJ\n"  # short row -> padded with NULL
    "5;MG;1;x;extra;more\n"  # long row -> extra fields dropped
    '6;"A;B";2;"line one\nline two"\n'  # quoted separator and newline
    "7;São;3;ação\n"
    '8;BA;4;"say ""hi"""\n'  # doubled quote inside quotes
    "\n"
    "9;AC;5;last\n"
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_zip_parsers_agree_with_each_other_and_with_spark_csv(spark, workdir):
    from tierlake.plans.archives import archive_options
    from tierlake.sources.zipcsv import FORMAT, register
    from dataclasses import replace

    spec = S.with_(dialect=replace(S.dialect, escape='"', multi_line=True))
    os.makedirs(f"{workdir}/z", exist_ok=True)
    make_zip(f"{workdir}/z/survey_2020.zip", [("DADOS/RESULTADOS_2020.csv", EDGE)])
    register(spark)
    opts = archive_options(spec, f"{workdir}/z")
    arrow = spark.read.format(FORMAT).options(**opts, parser="arrow").load()
    python = spark.read.format(FORMAT).options(**opts, parser="python").load()
    assert arrow.columns == python.columns == ["ano", "K", "SG_UF_PROVA", "NU_NOTA_CN", "TXT"]
    assert _rows(arrow) == _rows(python)
    got = {r["K"]: r for r in arrow.collect()}
    assert got["2"]["NU_NOTA_CN"] is None and got["2"]["TXT"] is None
    assert got["4"]["NU_NOTA_CN"] is None and got["4"]["SG_UF_PROVA"] == "RJ"
    assert got["5"]["TXT"] == "x"
    assert got["6"]["SG_UF_PROVA"] == "A;B" and got["6"]["TXT"] == "line one\nline two"
    assert got["7"]["SG_UF_PROVA"] == "São" and got["8"]["TXT"] == 'say "hi"'
    assert len(got) == 9
    # Spark's own CSV reader on the same text, same dialect.
    write_text(f"{workdir}/csv/x_2020/DADOS/MICRODADOS_ENEM_2020.csv", EDGE)
    via_csv = read_year_csv(spark, f"{workdir}/csv/x_2020/DADOS/MICRODADOS_ENEM_2020.csv", spec.dialect)
    assert _rows(arrow.drop("ano")) == _rows(via_csv.where("K is not null"))


def test_load_archives_for_some_years_opens_only_those(spark, workdir):
    os.makedirs(f"{workdir}/z", exist_ok=True)
    make_zip(f"{workdir}/z/survey_2021.zip", [("DADOS/RESULTADOS_2021.csv", "SG_UF_PROVA;NU_NOTA_CN\nSP;1\n")])
    make_zip(f"{workdir}/z/survey_2022.zip", [("DADOS/RESULTADOS_2022.csv", "SG_UF_PROVA;NU_NOTA_MT\nRJ;2\n")])
    with open(f"{workdir}/z/broken_2023.zip", "wb") as f:  # never opened when 2023 is not asked for
        f.write(b"not a zip")
    df = load_archives(spark, f"{workdir}/z", S, years=[2022])
    assert df.columns == ["ano", "SG_UF_PROVA", "NU_NOTA_MT"]
    assert [tuple(r) for r in df.collect()] == [(2022, "RJ", "2")]


def test_single_archive_path_and_no_match_is_an_error(spark, workdir):
    import pytest

    os.makedirs(f"{workdir}/z", exist_ok=True)
    make_zip(f"{workdir}/z/survey_2024.zip", [("LEIA-ME.txt", "x"), ("DADOS/RESULTADOS_2024.csv", "SG_UF_PROVA\nSP\n")])
    make_zip(f"{workdir}/z/survey_2023.zip", [("DADOS/OTHER_2023.csv", "SG_UF_PROVA\nRJ\n")])
    one = load_archives(spark, f"{workdir}/z/survey_2024.zip", S)
    assert [tuple(r) for r in one.collect()] == [(2024, "SP")]
    with pytest.raises(Exception, match="no archive member matches"):
        load_archives(spark, f"{workdir}/z/survey_2023.zip", S).collect()


def test_crlf_line_endings_leave_no_carriage_returns(spark, workdir):
    text = "SG_UF_PROVA;NU_NOTA_CN;TP_SEXO\r\nSP;1.5;F\r\nRJ;;M\r\n"
    write_text(f"{workdir}/raw/x_2020/DADOS/MICRODADOS_ENEM_2020.csv", text)
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", S)
    via_csv = sorted(tuple(r) for r in read_layer(spark, f"{workdir}/bronze").select("SG_UF_PROVA", "NU_NOTA_CN", "TP_SEXO").collect())
    os.makedirs(f"{workdir}/z", exist_ok=True)
    make_zip(f"{workdir}/z/survey_2020.zip", [("DADOS/RESULTADOS_2020.csv", text)])
    via_zip = sorted(tuple(r) for r in load_archives(spark, f"{workdir}/z", S).select("SG_UF_PROVA", "NU_NOTA_CN", "TP_SEXO").collect())
    assert via_csv == via_zip == [("RJ", None, "M"), ("SP", "1.5", "F")]


def test_record_longer_than_the_arrow_block_falls_back_to_the_row_parser(spark, workdir):
    from tierlake.plans.archives import archive_options
    from tierlake.sources.zipcsv import FORMAT, register

    long_text = "x" * 5000
    os.makedirs(f"{workdir}/z", exist_ok=True)
    make_zip(f"{workdir}/z/survey_2020.zip", [("DADOS/RESULTADOS_2020.csv", f'K;TXT\n1;"{long_text}"\n2;short\n')])
    register(spark)
    df = spark.read.format(FORMAT).options(**archive_options(S, f"{workdir}/z"), block_bytes="1024").load()
    got = {r["K"]: r["TXT"] for r in df.collect()}
    assert got == {"1": long_text, "2": "short"}


def test_stream_ingest_in_several_micro_batches_writes_each_row_once(spark, workdir):
    raw = fx.lineitem_raw(spark.read.parquet(f"{SF}/lineitem.parquet"))
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", LINEITEM_SPEC, "lineitem")
    ingest_stream(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/_ckpt", LINEITEM_SPEC, max_files_per_trigger=1)
    out = spark.read.parquet(f"{workdir}/bronze").select(*raw.columns)
    assert out.count() == raw.count()
    assert out.exceptAll(raw).count() == 0 and raw.exceptAll(out).count() == 0


def _zip_frame(spark, workdir, **options):
    from tierlake.plans.archives import archive_options
    from tierlake.sources.zipcsv import FORMAT, register

    register(spark)
    return spark.read.format(FORMAT).options(**{**archive_options(S, f"{workdir}/z"), **options}).load()


def test_zip_header_with_a_byte_order_mark(spark, workdir):
    os.makedirs(f"{workdir}/z")
    with zipfile.ZipFile(f"{workdir}/z/survey_2020.zip", "w") as zf:
        zf.writestr("DADOS/RESULTADOS_2020.csv", "\ufeffNU_INSCRICAO;V\n1;a\n2;b\n".encode())
    for parser in ("arrow", "python"):
        df = _zip_frame(spark, workdir, encoding="UTF-8", parser=parser)
        assert df.columns == ["ano", "NU_INSCRICAO", "V"]
        assert sorted((r["NU_INSCRICAO"], r["V"]) for r in df.collect()) == [("1", "a"), ("2", "b")]


def test_a_long_record_at_any_place(spark, workdir):
    os.makedirs(f"{workdir}/z")
    for where in (0, 150, 299):
        rows = [f"{i};{'x' * (9000 if i == where else 20)}" for i in range(300)]
        rows[60] = "60"  # a short row, padded
        make_zip(f"{workdir}/z/survey_2020.zip", [("DADOS/RESULTADOS_2020.csv", "K;TXT\n" + "\n".join(rows) + "\n")])
        got = {r["K"]: r["TXT"] for r in _zip_frame(spark, workdir, block_bytes="1024").collect()}
        assert len(got) == 300 and len(got[str(where)]) == 9000 and got["60"] is None
        assert _zip_frame(spark, workdir, block_bytes="1024").count() == 300


def test_year_filter_reaches_the_listing(spark, workdir):
    os.makedirs(f"{workdir}/z")
    for y in (2020, 2021):
        make_zip(f"{workdir}/z/survey_{y}.zip", [(f"DADOS/RESULTADOS_{y}.csv", f"K\n{y}\n")])
    df = _zip_frame(spark, workdir)
    with open(f"{workdir}/z/survey_2021.zip", "wb") as f:
        f.write(b"no archive any more")  # would fail if it were opened
    assert [r["K"] for r in df.where(F.col("ano") == 2020).collect()] == ["2020"]
    assert [r["K"] for r in df.where(F.col("ano").isin(2019, 2020)).collect()] == ["2020"]


def test_further_members_are_warned_of_or_read(spark, workdir, caplog):
    from tierlake.plans.archives import archive_options
    from tierlake.sources.zipcsv import list_members

    os.makedirs(f"{workdir}/z")
    make_zip(f"{workdir}/z/survey_2020.zip", [("DADOS/RESULTADOS_a.csv", "K\n1\n"), ("DADOS/RESULTADOS_b.csv", "K\n2\n")])
    assert len(list_members(archive_options(S, f"{workdir}/z"))) == 1
    assert "RESULTADOS_b.csv" in caplog.text
    assert sorted(r["K"] for r in _zip_frame(spark, workdir, members="all").collect()) == ["1", "2"]


def test_hadoop_names_of_the_object_store(monkeypatch):
    import pyarrow.fs as pafs

    from tierlake.sources.zipcsv import _filesystem

    asked = []
    monkeypatch.setattr(pafs, "FileSystem", SimpleNamespace(from_uri=lambda uri: asked.append(uri) or (None, uri)))
    _filesystem("s3a://bucket/a.zip")
    assert asked == ["s3://bucket/a.zip"]


def test_stream_takes_the_specs_files_only(spark, workdir):
    write_text(f"{workdir}/raw/x_2020/DADOS/MICRODADOS_ENEM_2020.csv", "SG_UF_PROVA;NU_NOTA_CN\nSP;1\n")
    write_text(f"{workdir}/raw/x_2020/DADOS/ITENS_PROVA_2020.csv", "CO_ITEM;TX\n9;z\n")
    write_text(f"{workdir}/raw/x_2020/README.csv", "other\n1\n")
    ingest_stream(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/_ckpt", S)
    assert [tuple(r) for r in spark.read.parquet(f"{workdir}/bronze").collect()] == [("SP", "1", 2020)]
