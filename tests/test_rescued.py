"""Records that do not fit the header are told apart, and quarantined whole."""

from conftest import write_text
import pytest

from tierlake.plans import build_silver
from tierlake.plans.quarantine import ingest_rescued, read_quarantine
from tierlake.sources import read_layer
from tierlake.sources.rescued import RESCUED, field_count, read_year_rescued
from tierlake.spec import CsvDialect, EXAM_SPEC as S

HEADER = "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO"
GOOD = ["SP;F;10;500", "RJ;M;;0", 'BA;"F;x";5;900', ";;;"]
BAD = [("RJ;M;5", "short"), ("SP;F;1;2;3", "long"), ('X;"a;b";1', "short"), ("São", "short"), ("a;b;c;d;;", "long")]


def raw(workdir, lines, y=2020):
    path = f"{workdir}/raw/survey_{y}/DADOS/MICRODADOS_ENEM_{y}.csv"
    write_text(path, "\n".join([HEADER, *lines]) + "\n")
    return path


def test_rescued_text_stands_beside_permissive_columns(spark, workdir):
    path = raw(workdir, [GOOD[0], *[b for b, _ in BAD], *GOOD[1:]])
    rows = read_year_rescued(spark, path, S.dialect)
    assert sorted(r[RESCUED] for r in rows.collect() if r[RESCUED]) == sorted(b for b, _ in BAD)
    # A query of one column finds the same records.
    assert rows.select("TP_SEXO").count() == len(GOOD) + len(BAD)
    assert sum(r[1] is not None for r in rows.select("TP_SEXO", RESCUED).collect()) == len(BAD)
    with pytest.raises(ValueError):
        read_year_rescued(spark, path, S.dialect, columns=["a", RESCUED])


@pytest.mark.parametrize("dialect,text,fields", [
    (CsvDialect(sep=";"), 'a;"b;c";d', 3),
    (CsvDialect(sep=";"), r'a;"b\";c";d', 3),
    (CsvDialect(sep=";", escape='"'), 'a;"b"";c";d', 3),
    (CsvDialect(sep="|"), "a|b||", 4),
    (CsvDialect(sep=";"), "", 1),
])
def test_field_count(spark, dialect, text, fields):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(field_count("t", dialect)).first()[0] == fields


def test_kept_and_quarantined_are_the_raw_records(spark, workdir):
    raw(workdir, [GOOD[0], *[b for b, _ in BAD], *GOOD[1:]])
    raw(workdir, GOOD, 2021)
    raw(workdir, [b for b, _ in BAD], 2022)
    out = ingest_rescued(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/side", S)
    assert [(r.year, r.rows, r.metrics["quarantined"]) for r in out] == [(2020, 4, 5), (2021, 4, 0), (2022, 0, 5)]
    side = read_quarantine(spark, f"{workdir}/side", S.year_col)
    assert sorted((r.ano, r.text, r.reason) for r in side.collect()) == sorted((y, t, w) for y in (2020, 2022) for t, w in BAD)
    assert {r.file for r in side.collect()} == {"MICRODADOS_ENEM_2020.csv", "MICRODADOS_ENEM_2022.csv"}
    bronze = read_layer(spark, f"{workdir}/bronze")
    assert bronze.columns == [*HEADER.split(";"), "ano"] and bronze.where("ano = 2020").count() == 4
    assert build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", S).rows == 8
    again = ingest_rescued(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/side", S)
    assert {r.action for r in again} == {"skipped"}
    # A mended year loses its old quarantine.
    raw(workdir, GOOD[:2])
    ingest_rescued(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/side", S, mode="overwrite")
    assert {r.ano for r in read_quarantine(spark, f"{workdir}/side", S.year_col).collect()} == {2022}


def test_no_quarantine(spark, workdir):
    raw(workdir, GOOD)
    ingest_rescued(spark, f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/side", S)
    assert read_quarantine(spark, f"{workdir}/side", S.year_col).count() == 0
