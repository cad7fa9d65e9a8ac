"""Incremental runs equal a rebuild, whatever ended early or changed (each case by hand)."""

import os
import shutil

import pytest
from conftest import write_text

from tierlake.plans import build_bronze, build_gold, build_lake, build_silver
from tierlake.sources import layer_years, read_layer
from tierlake.spec import EXAM_SPEC as S

HEADER = "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO"
TABLES = (S.mean_table, S.profile_table, S.rank_table)


def year(raw, y, rows, header=HEADER):
    write_text(f"{raw}/survey_{y}/DADOS/MICRODADOS_ENEM_{y}.csv", header + "\n" + "".join(r + "\n" for r in rows))


def gold(spark, root):
    return {t: (spark.read.parquet(f"{root}/{t}").columns, spark.read.parquet(f"{root}/{t}").collect()) if os.path.exists(f"{root}/{t}") else None for t in TABLES}


def check(spark, workdir):
    """The lake's silver and gold against ones built anew from its bronze."""
    lake = f"{workdir}/lake"
    fresh = f"{workdir}/fresh-{len(os.listdir(workdir))}"
    build_silver(spark, f"{lake}/bronze/{S.name}", f"{fresh}/silver", S)
    build_gold(spark, f"{fresh}/silver", f"{fresh}/gold", S)
    assert gold(spark, f"{lake}/gold/{S.name}") == gold(spark, f"{fresh}/gold")
    rows = lambda p: sorted(map(repr, read_layer(spark, p).collect()))
    assert rows(f"{lake}/silver/{S.name}") == rows(f"{fresh}/silver")


@pytest.fixture
def raw(spark, workdir):
    raw = f"{workdir}/raw"
    year(raw, 2020, ["SP;F;10;500", "RJ;M;;0"])
    year(raw, 2021, ["SP;M;30;700", "BA;F;5;900"])
    build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    return raw


def test_a_run_that_ended_after_bronze_is_caught_up(spark, workdir, raw):
    year(raw, 2022, ["SP;F;1;800"])
    build_lake(spark, raw, f"{workdir}/lake", S, stages=["bronze"])
    out = build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    assert {r.action for r in out["bronze"]} == {"skipped"} and out["silver"][0].rows == 1
    check(spark, workdir)


def test_first_gold_holds_every_year(spark, workdir, raw):
    shutil.rmtree(f"{workdir}/lake/gold/{S.name}")
    year(raw, 2022, ["SP;F;1;800"])
    build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    assert {r["ano"] for r in gold(spark, f"{workdir}/lake/gold/{S.name}")[S.mean_table][1]} == {2020, 2021, 2022}
    check(spark, workdir)


def test_one_missing_gold_table_is_built_for_all_years(spark, workdir, raw):
    shutil.rmtree(f"{workdir}/lake/gold/{S.name}/{S.rank_table}")
    build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    check(spark, workdir)


@pytest.mark.parametrize("incremental", [True, False])
def test_an_emptied_year_leaves(spark, workdir, raw, incremental):
    year(raw, 2021, [])
    build_lake(spark, raw, f"{workdir}/lake", S, mode="overwrite", incremental=incremental)
    assert {r["ano"] for r in read_layer(spark, f"{workdir}/lake/silver/{S.name}").collect()} == {2020}
    assert {r["ano"] for r in gold(spark, f"{workdir}/lake/gold/{S.name}")[S.mean_table][1]} == {2020}
    assert [r[0] for r in layer_years(spark, f"{workdir}/lake/bronze/{S.name}").collect()] == [2020, 2021]
    check(spark, workdir)


def test_a_year_removed_from_bronze_leaves(spark, workdir, raw):
    shutil.rmtree(f"{workdir}/lake/bronze/{S.name}/ano=2020")
    build_lake(spark, raw, f"{workdir}/lake", S, stages=["silver", "gold"], incremental=True)
    assert {r["ano"] for r in gold(spark, f"{workdir}/lake/gold/{S.name}")[S.profile_table][1]} == {2021}
    check(spark, workdir)


def test_a_year_that_lost_its_place_leaves_the_place_tables(spark, workdir, raw):
    year(raw, 2021, ["M;30;700"], header="TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO")
    build_lake(spark, raw, f"{workdir}/lake", S, mode="overwrite", incremental=True)
    got = gold(spark, f"{workdir}/lake/gold/{S.name}")
    assert {r["ano"] for r in got[S.mean_table][1]} == {2020} and {r["ano"] for r in got[S.profile_table][1]} == {2020, 2021}
    check(spark, workdir)


def test_a_table_that_no_year_supports_is_removed(spark, workdir, raw):
    for y in (2020, 2021):
        year(raw, y, ["M;30;700"], header="TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO")
    build_lake(spark, raw, f"{workdir}/lake", S, mode="overwrite", incremental=True)
    got = gold(spark, f"{workdir}/lake/gold/{S.name}")
    assert got[S.mean_table] is None and got[S.rank_table] is None and len(got[S.profile_table][1]) == 2


def test_an_uncommitted_year_is_named(spark, workdir, raw):
    os.remove(f"{workdir}/lake/bronze/{S.name}/ano=2021/_SUCCESS")
    with pytest.raises(ValueError, match="2021"):
        build_silver(spark, f"{workdir}/lake/bronze/{S.name}", f"{workdir}/other", S)


def test_listing_years_starts_no_scan(spark, workdir, raw):
    plan = layer_years(spark, f"{workdir}/lake/silver/{S.name}")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
