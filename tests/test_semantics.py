"""Edge rows of the cleaning and gold rules, from hand-made raw CSV (FIXTURES §4)."""

import math

from conftest import write_text

from tierlake.plans import build_bronze, build_gold, build_silver, gold_tables, load_presence
from tierlake.sources import read_layer
from tierlake.spec import EXAM_SPEC as S

HEADER = "NU_INSCRICAO;SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO\n"
ROWS = [
    # id; place; sex; CN; essay      expected silver CN / essay
    "1;SP;M;650.5;700",  # normal
    "2;SP;F;;",  # absent -> 0.0, 0.0
    "3;SP;F",  # short row -> trailing fields NULL -> 0.0
    "4;RJ;M;0;0",  # real zero
    "5;RJ;F;0.4;0.4",  # below one
    "6;RJ;M;abc;7,5",  # malformed -> NULL
    "7;MG;F; 5.5 ; ",  # padded -> 5.5 ; blank -> NULL
    "8;MG;M;NaN;900",  # NaN text
    '9;"A;B";F;100;200',  # quoted separator: one field
    "10;São;F;300;400",  # accents kept
]


def build(spark, workdir, rows=ROWS, header=HEADER, year=2020):
    raw = f"{workdir}/raw"
    write_text(f"{raw}/survey_{year}/DADOS/MICRODADOS_ENEM_{year}.csv", header + "\n".join(rows) + "\n")
    build_bronze(spark, raw, f"{workdir}/bronze", S)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S)
    return read_layer(spark, f"{workdir}/silver")


def test_silver_rules(spark, workdir):
    silver = {r["NU_INSCRICAO"]: r for r in build(spark, workdir).collect()}
    cn = {k: r["NU_NOTA_CN"] for k, r in silver.items()}
    essay = {k: r["NU_NOTA_REDACAO"] for k, r in silver.items()}
    assert cn["1"] == 650.5 and essay["1"] == 700.0
    assert cn["2"] == 0.0 and essay["2"] == 0.0
    assert cn["3"] == 0.0 and essay["3"] == 0.0
    assert cn["4"] == 0.0 and cn["5"] == 0.4
    assert cn["6"] is None and essay["6"] is None
    assert cn["7"] == 5.5 and essay["7"] is None
    assert math.isnan(cn["8"])
    assert silver["9"]["SG_UF_PROVA"] == "A;B"
    assert silver["10"]["SG_UF_PROVA"] == "São"
    assert silver["1"]["ano"] == 2020
    assert set(silver["1"].asDict()) == {"NU_INSCRICAO", "TP_SEXO", "SG_UF_PROVA", "NU_NOTA_CN", "NU_NOTA_REDACAO", "ano"}


def test_silver_column_order_follows_allow_list(spark, workdir):
    cols = build(spark, workdir).columns
    assert cols == ["NU_INSCRICAO", "TP_SEXO", "SG_UF_PROVA", "NU_NOTA_CN", "NU_NOTA_REDACAO", "ano"]


def test_gold_means_and_ranking(spark, workdir):
    build(spark, workdir)
    build_gold(spark, f"{workdir}/silver", f"{workdir}/gold", S)
    means = {r["SG_UF_PROVA"]: r for r in spark.read.parquet(f"{workdir}/gold/{S.mean_table}").collect()}
    # SP: CN 650.5, 0, 0 -> mean includes absentees
    assert means["SP"]["MEDIA_CN"] == round((650.5 + 0 + 0) / 3, 2)
    # RJ: CN 0, 0.4, NULL -> NULL skipped
    assert means["RJ"]["MEDIA_CN"] == 0.2
    # MG: 5.5 and NaN -> NaN poisons
    assert math.isnan(means["MG"]["MEDIA_CN"])
    rank = {r["SG_UF_PROVA"]: r for r in spark.read.parquet(f"{workdir}/gold/{S.rank_table}").collect()}
    # SP: only 700 is > 0
    assert rank["SP"]["MEDIA_REDACAO"] == 700.0 and rank["SP"]["TOTAL_PARTICIPANTES"] == 1
    # RJ: 0 dropped, 0.4 kept, NULL dropped
    assert rank["RJ"]["TOTAL_PARTICIPANTES"] == 1 and rank["RJ"]["MEDIA_REDACAO"] == 0.4
    assert rank["MG"]["TOTAL_PARTICIPANTES"] == 1 and rank["MG"]["MEDIA_REDACAO"] == 900.0
    prof = spark.read.parquet(f"{workdir}/gold/{S.profile_table}")
    assert prof.columns == ["ano", "TP_SEXO", "TOTAL_CANDIDATOS"]
    assert sum(r["TOTAL_CANDIDATOS"] for r in prof.collect()) == len(ROWS)


def test_ranking_order_and_tie_break(spark, workdir):
    rows = ["1;BA;M;1;500", "2;AC;M;1;500", "3;SP;M;1;800", "4;RJ;M;1;100"]
    silver = build(spark, workdir, rows=rows)
    plan = gold_tables(silver, load_presence(spark, f"{workdir}/silver"), S)
    got = [(r["SG_UF_PROVA"], r["MEDIA_REDACAO"]) for r in plan.tables[S.rank_table].collect()]
    assert got == [("SP", 800.0), ("AC", 500.0), ("BA", 500.0), ("RJ", 100.0)]
    means = [r["SG_UF_PROVA"] for r in plan.tables[S.mean_table].collect()]
    assert means == sorted(means)


def test_quality_report(spark, workdir):
    raw = f"{workdir}/raw"
    write_text(f"{raw}/x_2020/DADOS/MICRODADOS_ENEM_2020.csv", HEADER + "\n".join(ROWS) + "\n")
    build_bronze(spark, raw, f"{workdir}/bronze", S)
    rep = build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S)
    assert rep.rows == len(ROWS)
    assert rep.metrics["filled_NU_NOTA_CN"] == 2  # empty + short row
    assert rep.metrics["malformed_NU_NOTA_CN"] == 1  # abc (" 5.5 " parses)
    assert rep.metrics["nan_NU_NOTA_CN"] == 1
    assert rep.metrics["malformed_NU_NOTA_REDACAO"] == 2  # 7,5 and blank


def test_nan_essay_is_ranked_and_poisons_its_mean(spark, workdir):
    rows = ["1;SP;M;1;NaN", "2;SP;F;1;700", "3;RJ;M;1;600"]
    build(spark, workdir, rows=rows)
    build_gold(spark, f"{workdir}/silver", f"{workdir}/gold", S)
    rank = {r["SG_UF_PROVA"]: r for r in spark.read.parquet(f"{workdir}/gold/{S.rank_table}").collect()}
    assert rank["SP"]["TOTAL_PARTICIPANTES"] == 2 and math.isnan(rank["SP"]["MEDIA_REDACAO"])
    assert rank["RJ"]["MEDIA_REDACAO"] == 600.0
