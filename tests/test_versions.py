"""Tables by commits, and leaf versions that come from content."""

import glob
import os

import pytest
from conftest import write_text
from pyspark.sql import functions as F

from tierlake.plans import build_gold, build_lake, build_silver, read_gold
from tierlake.sinks import CommitConflict, VersionedTables, write_leaf, write_partitioned
from tierlake.sources.fs import create_small_text
from tierlake.sources.layers import leaf_versions
from tierlake.spec import EXAM_SPEC as S
from tierlake.streaming import ingest_stream

HEADER = "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO"
TABLES = (S.mean_table, S.profile_table, S.rank_table)


def year(raw, y, rows, name=None):
    path = f"{raw}/survey_{y}/DADOS/MICRODADOS_ENEM_{y}.csv"
    write_text(f"{path}/{name}" if name else path, HEADER + "\n" + "".join(r + "\n" for r in rows))


def values(df):
    return sorted(r[0] for r in df.collect())


def test_a_write_stopped_at_any_step_leaves_the_old_rows(spark, workdir):
    store = VersionedTables(spark, f"{workdir}/t")
    with pytest.raises(FileNotFoundError):
        store.read("a")
    store.write(spark.range(5), "a")
    # 1. stopped while data is written: files without a commit, not even a whole folder
    write_text(f"{workdir}/t/a/v2-00ff/part-0.parquet", "half a file")
    assert values(store.read("a")) == list(range(5))
    # 2. stopped after the data
    store.stage(spark.range(3), "a")
    assert values(store.read("a")) == list(range(5))
    # 3. stopped within the commit file
    text = store.current().to_json().replace('"version": 1', '"version": 2')
    create_small_text(spark, f"{workdir}/t/_commits/0000000002.json", text[: len(text) // 2])
    assert values(store.read("a")) == list(range(5)) and store.current().version == 1
    # 4. stopped before the clean-up
    base = store.current()
    assert store.commit([store.stage(spark.range(7), "a")], base).version == 3
    assert values(store.read("a")) == list(range(7)) and values(store.read("a", 1)) == list(range(5))
    store.write(spark.range(2), "a")
    assert values(store.read("a")) == [0, 1] and values(store.read("a", 3)) == list(range(7))
    # The two newest versions stay, all else is gone.
    assert len(glob.glob(f"{workdir}/t/a/v*")) == 2 and len(glob.glob(f"{workdir}/t/_commits/*.json")) == 2


def test_a_reader_of_the_last_version_goes_on(spark, workdir):
    store = VersionedTables(spark, f"{workdir}/t")
    store.write(spark.range(5), "a")
    reading = store.read("a")
    store.write(reading.where("id > 1"), "a")  # reads the table that it replaces
    assert values(reading) == list(range(5)) and values(store.read("a")) == [2, 3, 4]


def test_of_two_writers_one_fails(spark, workdir):
    store = VersionedTables(spark, f"{workdir}/t")
    store.write(spark.range(1), "a")
    base = store.current()
    mine, other = store.stage(spark.range(2), "a"), store.stage(spark.range(3), "a")
    store.commit([mine], base)
    with pytest.raises(CommitConflict):
        store.commit([other], base)
    assert values(store.read("a")) == [0, 1]


def test_tables_change_together_and_leave(spark, workdir):
    store = VersionedTables(spark, f"{workdir}/t")
    store.commit([store.stage(spark.range(1), "a"), store.stage(spark.range(2), "b")], None, meta={"n": 1})
    store.commit([store.stage(spark.range(3), "b")], store.current(), drop=["a"])
    assert store.tables() == ["b"] and store.current().meta == {"n": 1}
    with pytest.raises(FileNotFoundError):
        store.read("a")
    assert values(store.read("a", 1)) == [0]


def test_versioned_years(spark, workdir):
    store = VersionedTables(spark, f"{workdir}/t")
    df = spark.range(30).withColumn("ano", (F.lit(2000) + F.col("id") % 3).cast("int"))
    assert store.write_years(df, [2000, 2001, 2002]).rows == 30
    again = df.where("ano = 2001").withColumn("id", F.col("id") * 10).withColumn("more", F.lit("x"))
    store.stage_years(again.withColumn("id", -F.col("id")), [2001])  # never committed
    report = store.write_years(again, [2001, 2002])  # 2002 comes without rows and leaves
    assert report.year_rows == {2001: 10, 2002: 0}
    got = store.read_years()
    assert got.columns == ["id", "more", "ano"] and got.count() == 20
    assert values(store.read_years([2001]).select("id")) == [i * 10 for i in range(1, 30, 3)]
    assert {r.more for r in store.read_years([2000]).withColumn("more", F.lit(None)).collect()} == {None}
    assert store.read_years([1999]).count() == 0
    plan = store.read_years([2000])._jdf.queryExecution().toString()
    assert "ano=2001" not in plan


def test_versioned_gold_equals_plain_gold(spark, workdir):
    raw = f"{workdir}/raw"
    year(raw, 2020, ["SP;F;10;500", "RJ;M;;0"])
    year(raw, 2021, ["SP;M;30;700", "BA;F;5;900"])
    lake = f"{workdir}/lake"
    build_lake(spark, raw, lake, S, versioned=True)
    silver, gold = f"{lake}/silver/{S.name}", f"{lake}/gold/{S.name}"

    def same():
        plain = f"{workdir}/plain-{len(os.listdir(workdir))}"
        build_gold(spark, silver, plain, S)
        for t in TABLES:
            a, b = read_gold(spark, gold, t), read_gold(spark, plain, t)
            assert a.columns == b.columns and a.collect() == b.collect(), t

    same()
    assert {r.action for r in build_lake(spark, raw, lake, S, incremental=True)["gold"]} == {"skipped"}
    year(raw, 2022, ["SP;F;1;800"])
    # A run that ends between the gold tables: nothing of it shows.
    build_lake(spark, raw, lake, S, stages=["bronze", "silver"], incremental=True)
    before = {t: read_gold(spark, gold, t).collect() for t in TABLES}
    VersionedTables(spark, gold).stage(spark.range(1), S.mean_table)
    assert {t: read_gold(spark, gold, t).collect() for t in TABLES} == before
    out = build_lake(spark, raw, lake, S, incremental=True)["gold"]
    assert {r.action for r in out} == {"written"}
    same()


def test_versions_come_from_content(spark, workdir):
    df = spark.range(30).withColumn("ano", (F.lit(2000) + F.col("id") % 3).cast("int"))
    write_partitioned(df, f"{workdir}/t", "ano")
    first = leaf_versions(spark, f"{workdir}/t")
    write_partitioned(df.where("ano = 2001"), f"{workdir}/t", "ano")
    second = leaf_versions(spark, f"{workdir}/t")
    assert {y for y in first if first[y] != second[y]} == {2001}
    write_leaf(df.where("ano = 2002"), f"{workdir}/t", 2002)
    third = leaf_versions(spark, f"{workdir}/t")
    assert {y for y in first if second[y] != third[y]} == {2002}
    # Times alone change nothing; neither do they for a leaf that has no commit id.
    os.remove(f"{workdir}/t/ano=2000/_commit_id")
    listed = leaf_versions(spark, f"{workdir}/t")[2000]
    for f in glob.glob(f"{workdir}/t/**", recursive=True):
        os.utime(f, (1, 1))
    assert leaf_versions(spark, f"{workdir}/t") == {**third, 2000: listed}


def test_a_streamed_year_that_gains_a_file_is_rebuilt_with_equal_times(spark, workdir):
    raw, bronze, silver = f"{workdir}/raw", f"{workdir}/bronze", f"{workdir}/silver"

    def flat_times():
        for f in glob.glob(f"{bronze}/**", recursive=True):
            os.utime(f, (1_000_000_000, 1_000_000_000))

    year(raw, 2020, ["SP;F;10;500"], "a.csv")
    year(raw, 2021, ["RJ;M;20;600"], "a.csv")
    ingest_stream(spark, raw, bronze, f"{workdir}/ckpt", S)
    flat_times()
    first = leaf_versions(spark, bronze)
    build_silver(spark, bronze, silver, S, years=[])
    year(raw, 2021, ["BA;F;30;700"], "b.csv")
    ingest_stream(spark, raw, bronze, f"{workdir}/ckpt", S)
    flat_times()
    second = leaf_versions(spark, bronze)
    assert {y for y in first if first[y] != second[y]} == {2021}
    assert build_silver(spark, bronze, silver, S, years=[]).rows == 2  # the year 2021 alone
    assert build_silver(spark, bronze, silver, S, years=[]).action == "skipped"
