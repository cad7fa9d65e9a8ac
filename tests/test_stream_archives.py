"""Archives as a stream: each once, whenever it comes, also after a restart."""

import zipfile

import pytest

from tierlake.sources.zipcsv import FORMAT, register
from tierlake.spec import EXAM_SPEC as S
from tierlake.streaming import ingest_archives_stream
from tierlake.plans.archives import archive_options

HEADER = "SG_UF_PROVA;NU_NOTA_CN"


def archive(folder, name, rows, header=HEADER):
    y = name[-8:-4]
    with zipfile.ZipFile(f"{folder}/{name}", "w") as zf:
        zf.writestr(S.member_name(y), "\n".join([header, *rows]) + "\n")


def test_each_archive_once(spark, workdir):
    args = (workdir, f"{workdir}/bronze", f"{workdir}/ckpt", S)
    archive(workdir, "m_2021.zip", ["SP;1", "RJ;2"])
    ingest_archives_stream(spark, *args)
    # One that sorts before the first, one of the same year, one with its columns in another order.
    archive(workdir, "a_2020.zip", ["BA;3"])
    archive(workdir, "z_2021.zip", ["4;AC"], header="NU_NOTA_CN;SG_UF_PROVA")
    archive(workdir, "no-year.zip", ["x;9"])
    ingest_archives_stream(spark, *args)
    ingest_archives_stream(spark, *args)
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{workdir}/bronze").select("ano", "SG_UF_PROVA", "NU_NOTA_CN").collect())
    assert rows == [(2020, "BA", "3"), (2021, "AC", "4"), (2021, "RJ", "2"), (2021, "SP", "1")]


def test_unknown_columns_fail_by_name(spark, workdir):
    args = (workdir, f"{workdir}/bronze", f"{workdir}/ckpt", S)
    archive(workdir, "m_2021.zip", ["SP;1"])
    ingest_archives_stream(spark, *args)
    schema = spark.read.parquet(f"{workdir}/bronze").schema
    archive(workdir, "n_2022.zip", ["SP;1;2"], header=HEADER + ";NEW")
    with pytest.raises(Exception, match="NEW"):
        ingest_archives_stream(spark, *args, schema=schema)


@pytest.mark.parametrize("asked,rows", [("ano = 2999", 0), ("ano in (2999, 2021)", 1), ("ano = 2021 and ano = 2020", 0), ("ano is not null", 2)])
def test_a_year_without_archive(spark, workdir, asked, rows):
    register(spark)
    archive(workdir, "m_2021.zip", ["SP;1"])
    archive(workdir, "m_2020.zip", ["SP;1"])
    df = spark.read.format(FORMAT).options(**archive_options(S, workdir)).load()
    assert df.where(asked).count() == rows


def test_years_of_one_frame_twice_in_a_query(spark, workdir):
    from tierlake.plans.archives import load_archives

    archive(workdir, "m_2021.zip", ["SP;1"])
    archive(workdir, "m_2020.zip", ["RJ;2"])
    df = load_archives(spark, workdir, S)
    both = df.where("ano = 2999").unionByName(df.where("ano in (2999, 2020)")).unionByName(df.where("ano = 2021")).unionByName(df)
    assert sorted(r.ano for r in both.collect()) == [2020, 2020, 2021, 2021]
    plan = df.where("ano = 2020 and NU_NOTA_CN is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1  # the other year is folded away
