"""Schema drift between years and lake layout edge cases (FIXTURES §5)."""

import os

from conftest import write_text

from tierlake.plans import build_bronze, build_gold, build_silver
from tierlake.sources import discover_years, read_layer
from tierlake.spec import EXAM_SPEC as S


def csv_year(raw, year, header, rows, folder=None, ext=".csv"):
    folder = folder or f"survey_{year}"
    write_text(f"{raw}/{folder}/DADOS/MICRODADOS_ENEM_{year}{ext}", header + "\n" + "\n".join(rows) + ("\n" if rows else ""))


def lake(spark, workdir):
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", S)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S)
    build_gold(spark, f"{workdir}/silver", f"{workdir}/gold", S)
    return {
        t: spark.read.parquet(f"{workdir}/gold/{t}").collect() if os.path.exists(f"{workdir}/gold/{t}") else None
        for t in (S.mean_table, S.profile_table, S.rank_table)
    }


def test_missing_score_gives_null_mean_not_zero(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;10", "SP;20"])
    csv_year(raw, 2022, "SG_UF_PROVA;NU_NOTA_CN;NU_NOTA_MT", ["SP;30;40", "SP;;"])
    means = {r["ano"]: r for r in lake(spark, workdir)[S.mean_table]}
    assert means[2021]["MEDIA_MT"] is None
    assert means[2021]["MEDIA_CN"] == 15.0
    assert means[2022]["MEDIA_MT"] == 20.0  # 40 and a filled 0


def test_same_count_other_names_and_reordered_header(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;10"])
    csv_year(raw, 2022, "SG_UF_PROVA;NU_NOTA_MT", ["SP;30"])
    csv_year(raw, 2023, "NU_NOTA_MT;SG_UF_PROVA;NU_NOTA_CN", ["7;RJ;8"])
    means = {(r["ano"], r["SG_UF_PROVA"]): r for r in lake(spark, workdir)[S.mean_table]}
    assert means[(2021, "SP")]["MEDIA_CN"] == 10.0 and means[(2021, "SP")]["MEDIA_MT"] is None
    assert means[(2022, "SP")]["MEDIA_MT"] == 30.0 and means[(2022, "SP")]["MEDIA_CN"] is None
    assert means[(2023, "RJ")]["MEDIA_CN"] == 8.0 and means[(2023, "RJ")]["MEDIA_MT"] == 7.0


def test_missing_place_drops_year_from_place_tables_null_place_is_a_group(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "TP_SEXO;NU_NOTA_REDACAO", ["M;500"])
    csv_year(raw, 2022, "SG_UF_PROVA;TP_SEXO;NU_NOTA_REDACAO", ["SP;F;600", ";F;700"])
    got = lake(spark, workdir)
    assert {r["ano"] for r in got[S.mean_table]} == {2022}
    assert {r["ano"] for r in got[S.rank_table]} == {2022}
    assert {r["ano"] for r in got[S.profile_table]} == {2021, 2022}
    places = {r["SG_UF_PROVA"]: r["MEDIA_REDACAO"] for r in got[S.rank_table]}
    assert places == {"SP": 600.0, None: 700.0}


def test_header_only_year_and_layout_rules(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2020, "SG_UF_PROVA;NU_NOTA_CN", [])  # header only
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;1"], ext=".CSV")  # upper-case extension
    os.makedirs(f"{raw}/survey_2019/DADOS")  # no CSV in folder
    write_text(f"{raw}/loose_2018.csv", "a\n")  # loose file
    csv_year(raw, 2017, "SG_UF_PROVA;NU_NOTA_CN", ["SP;2"], folder="microdados_extra")  # non-year folder
    years = [y for y, _ in discover_years(spark, raw, S)]
    assert years == [2020, 2021]
    got = lake(spark, workdir)
    silver = read_layer(spark, f"{workdir}/silver")
    assert dict(silver.dtypes)["ano"] == "int"
    assert {r["ano"] for r in got[S.mean_table]} == {2021}


def test_skip_finished_year_reingest_half_written(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;1"])
    csv_year(raw, 2022, "SG_UF_PROVA;NU_NOTA_CN", ["SP;2"])
    first = build_bronze(spark, raw, f"{workdir}/bronze", S)
    assert [r.action for r in first] == ["written", "written"]
    # Simulate a crash during 2022: its leaf loses the commit marker.
    os.remove(f"{workdir}/bronze/ano=2022/_SUCCESS")
    again = build_bronze(spark, raw, f"{workdir}/bronze", S)
    assert [(r.year, r.action) for r in again] == [(2021, "skipped"), (2022, "written")]
    forced = build_bronze(spark, raw, f"{workdir}/bronze", S, mode="overwrite")
    assert [r.action for r in forced] == ["written", "written"]
    assert read_layer(spark, f"{workdir}/bronze").count() == 2


def test_silver_rerun_of_one_year_keeps_others(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;1"])
    csv_year(raw, 2022, "SG_UF_PROVA;NU_NOTA_MT", ["SP;2"])
    build_bronze(spark, raw, f"{workdir}/bronze", S)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S, years=[2022])
    silver = read_layer(spark, f"{workdir}/silver")
    assert silver.count() == 2
    from tierlake.plans import load_presence

    pres = load_presence(spark, f"{workdir}/silver")
    assert {y: set(c) for y, c in pres.items()} == {2021: {"SG_UF_PROVA", "NU_NOTA_CN"}, 2022: {"SG_UF_PROVA", "NU_NOTA_MT"}}


def test_year_without_profile_columns_left_out_of_profile_table(spark, workdir):
    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;1"])  # no profile column at all
    csv_year(raw, 2022, "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN", ["SP;F;2", "SP;M;3"])
    got = lake(spark, workdir)
    assert {r["ano"] for r in got[S.profile_table]} == {2022}
    assert {r["ano"] for r in got[S.mean_table]} == {2021, 2022}
    # Only the profile columns some year had become keys.
    assert set(got[S.profile_table][0].asDict()) == {"ano", "TP_SEXO", "TOTAL_CANDIDATOS"}


def test_build_lake_runs_stages_in_order_and_skips_finished_years(spark, workdir):
    from tierlake.plans import build_lake, layer_path

    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_REDACAO", ["SP;500", "RJ;0"])
    first = build_lake(spark, raw, f"{workdir}/lake", S)
    assert [r.action for r in first["bronze"]] == ["written"]
    assert first["silver"][0].rows == 2
    assert {r.table for r in first["gold"]} == {S.mean_table, S.rank_table}
    again = build_lake(spark, raw, f"{workdir}/lake", S, stages=["bronze"])
    assert [r.action for r in again["bronze"]] == ["skipped"] and set(again) == {"bronze"}
    ranking = spark.read.parquet(f"{layer_path(f'{workdir}/lake', 'gold', S)}/{S.rank_table}").collect()
    assert [(r["SG_UF_PROVA"], r["TOTAL_PARTICIPANTES"]) for r in ranking] == [("SP", 1)]


def test_incremental_gold_for_new_years_equals_full_rebuild(spark, workdir):
    raw = f"{workdir}/raw"
    header = "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO"
    csv_year(raw, 2021, header, ["SP;F;10;500", "RJ;M;;0", "SP;M;30;700"])
    csv_year(raw, 2022, header, ["SP;F;20;600", "BA;F;5;900"])
    build_bronze(spark, raw, f"{workdir}/bronze", S)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S)
    build_gold(spark, f"{workdir}/silver", f"{workdir}/gold", S)
    # A new year arrives, with a score column the earlier years lacked.
    csv_year(raw, 2023, "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_MT;NU_NOTA_REDACAO", ["SP;F;1;2;800", "RJ;F;3;;0"])
    reports = build_bronze(spark, raw, f"{workdir}/bronze", S)
    assert [(r.year, r.action) for r in reports] == [(2021, "skipped"), (2022, "skipped"), (2023, "written")]
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S, years=[2023])
    build_gold(spark, f"{workdir}/silver", f"{workdir}/gold", S, years=[2023])
    # The same lake rebuilt from scratch.
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver_full", S)
    build_gold(spark, f"{workdir}/silver_full", f"{workdir}/gold_full", S)
    for table in (S.mean_table, S.profile_table, S.rank_table):
        inc = spark.read.parquet(f"{workdir}/gold/{table}")
        full = spark.read.parquet(f"{workdir}/gold_full/{table}")
        assert inc.columns == full.columns, table
        assert [tuple(r) for r in inc.collect()] == [tuple(r) for r in full.collect()], table
    means = {(r["ano"], r["SG_UF_PROVA"]): r for r in spark.read.parquet(f"{workdir}/gold/{S.mean_table}").collect()}
    assert means[(2021, "SP")]["MEDIA_MT"] is None and means[(2023, "SP")]["MEDIA_MT"] == 2.0


def test_build_lake_incremental_touches_only_new_years(spark, workdir):
    from tierlake.plans import build_lake

    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;10", "RJ;20"])
    build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    nothing_new = build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    assert {r.action for s in nothing_new.values() for r in s} == {"skipped"}  # no new year: nothing is run
    csv_year(raw, 2022, "SG_UF_PROVA;NU_NOTA_CN", ["SP;30"])
    out = build_lake(spark, raw, f"{workdir}/lake", S, incremental=True)
    assert out["silver"][0].rows == 1  # only the new year was rebuilt
    means = sorted(tuple(r) for r in spark.read.parquet(f"{workdir}/lake/gold/{S.name}/{S.mean_table}").collect())
    assert means == [(2021, "RJ", 20.0), (2021, "SP", 10.0), (2022, "SP", 30.0)]


def test_generic_spec_with_a_flat_layout(spark, workdir):
    from tierlake.spec import CsvDialect, LakeSpec

    spec = LakeSpec(
        name="generic",
        keep=("region", "score"),
        scores=("score",),
        place="region",
        profile=("region",),
        rank_score="score",
        dialect=CsvDialect(),  # Spark's defaults: comma, UTF-8
    )
    write_text(f"{workdir}/raw/batch_2020/data_2020.csv", "region,score,extra\nN,1.5,x\nS,,y\n", encoding="utf-8")
    write_text(f"{workdir}/raw/batch_2021/data_2021.csv", "score,region\n4,N\n", encoding="utf-8")
    assert [y for y, _ in discover_years(spark, f"{workdir}/raw", spec)] == [2020, 2021]
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", spec)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", spec)
    got = sorted(tuple(r) for r in read_layer(spark, f"{workdir}/silver", year_col="year").collect())
    assert got == [("N", 1.5, 2020), ("N", 4.0, 2021), ("S", 0.0, 2020)]


def test_command_line_runs_the_chosen_stages(spark, workdir):
    from tierlake.__main__ import main

    raw = f"{workdir}/raw"
    csv_year(raw, 2021, "SG_UF_PROVA;NU_NOTA_CN", ["SP;10"])
    first = main(["--raw", raw, "--lake", f"{workdir}/lake", "--stages", "bronze"])
    assert set(first) == {"bronze"} and first["bronze"][0][2] == "written"
    rest = main(["--raw", raw, "--lake", f"{workdir}/lake", "--stages", "silver,gold"])
    assert set(rest) == {"silver", "gold"} and rest["silver"][0][3] == 1
