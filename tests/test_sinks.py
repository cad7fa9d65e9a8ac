"""Writes: codec, commit markers, dynamic overwrite, idempotence, equivalences."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tierlake import fixtures as fx
from tierlake.operators import count_by_group, mean_by_group, union_years
from tierlake.plans import build_bronze, build_gold, build_silver, gold_tables, load_presence
from tierlake.sinks import write_leaf, write_partitioned, write_table
from tierlake.sources import layer_years, read_layer
from tierlake.spec import LINEITEM_SPEC as LI

SF = "/root/testdata/sf0.001"


def test_snappy_and_success_marker(spark, workdir):
    df = spark.range(100).withColumn("ano", F.lit(2020))
    rep = write_leaf(df, f"{workdir}/t", 2020, table="t")
    assert rep.rows == 100 and rep.path.endswith("ano=2020")
    files = glob.glob(f"{workdir}/t/ano=2020/*.parquet")
    assert files and glob.glob(f"{workdir}/t/ano=2020/_SUCCESS")
    meta = pq.ParquetFile(files[0]).metadata
    assert meta.row_group(0).column(0).compression == "SNAPPY"
    assert "ano" not in pq.read_schema(files[0]).names  # the folder carries the year


def test_dynamic_overwrite_replaces_only_written_years(spark, workdir):
    df = spark.range(30).withColumn("ano", (F.lit(2000) + F.col("id") % 3).cast("int"))
    rep = write_partitioned(df, f"{workdir}/t", "ano")
    assert rep.rows == 30
    write_partitioned(df.where("ano = 2001").withColumn("id", F.col("id") * 10), f"{workdir}/t", "ano")
    back = read_layer(spark, f"{workdir}/t")
    assert back.count() == 30
    assert sorted(r[0] for r in back.where("ano = 2001").select("id").collect()) == [i * 10 for i in range(1, 30, 3)]
    assert [r[0] for r in layer_years(spark, f"{workdir}/t").collect()] == [2000, 2001, 2002]


def test_write_table_overwrites(spark, workdir):
    write_table(spark.range(5), f"{workdir}/g")
    write_table(spark.range(3), f"{workdir}/g")
    assert spark.read.parquet(f"{workdir}/g").count() == 3


def test_stages_are_idempotent(spark, workdir):
    raw = fx.lineitem_raw(spark.read.parquet(f"{SF}/lineitem.parquet"))
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", LI, "lineitem")
    outs = []
    for _ in range(2):
        build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", LI)
        build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", LI)
        build_gold(spark, f"{workdir}/silver", f"{workdir}/gold", LI)
        outs.append(sorted(tuple(r) for r in spark.read.parquet(f"{workdir}/gold/{LI.mean_table}").collect()))
    assert outs[0] == outs[1]
    assert read_layer(spark, f"{workdir}/silver").count() == raw.count()


def test_union_of_yearly_aggregates_equals_one_grouped_aggregate(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("ano", F.year("l_shipdate"))
    years = sorted(r[0] for r in li.select("ano").distinct().collect())
    yearly = union_years(
        [mean_by_group(li.where(F.col("ano") == y), ["ano", "l_returnflag"], LI.scores, 2, LI.mean_name) for y in years]
    )
    once = mean_by_group(li, ["ano", "l_returnflag"], LI.scores, 2, LI.mean_name)
    assert yearly.exceptAll(once).count() == 0 and once.exceptAll(yearly).count() == 0


def test_partitioning_does_not_change_results(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("ano", F.year("l_shipdate"))
    keys = ["ano", *LI.profile]
    a = sorted(tuple(r) for r in count_by_group(li.repartition(1), keys, "n").collect())
    b = sorted(tuple(r) for r in count_by_group(li.repartition(17, "l_orderkey"), keys, "n").collect())
    assert a == b


def test_profile_table_sorted_as_text(spark, workdir):
    raw = fx.lineitem_raw(spark.read.parquet(f"{SF}/lineitem.parquet"))
    fx.write_raw_csv(spark, raw, f"{workdir}/raw", LI, "lineitem")
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", LI)
    build_silver(spark, f"{workdir}/bronze", f"{workdir}/silver", LI)
    plan = gold_tables(read_layer(spark, f"{workdir}/silver"), load_presence(spark, f"{workdir}/silver"), LI)
    rows = [tuple(r)[:4] for r in plan.tables[LI.profile_table].collect()]
    assert rows == sorted(rows)  # line number is text in silver: "1" < "10" < "2"


def test_missing_layer_raises(spark, workdir):
    import pytest

    with pytest.raises(FileNotFoundError):
        read_layer(spark, f"{workdir}/nothing-here")
    with pytest.raises(FileNotFoundError):
        layer_years(spark, f"{workdir}/nothing-here")


def test_reports_frame_lists_each_write(spark, workdir):
    from tierlake.sinks import reports_frame

    df = spark.range(4).withColumn("ano", F.lit(2020))
    reports = [write_leaf(df, f"{workdir}/t", 2020, table="t"), write_table(spark.range(2), f"{workdir}/g", table="g")]
    rows = sorted((r["table"], r["ano"], r["action"], r["rows"]) for r in reports_frame(spark, reports).collect())
    assert rows == [("g", None, "written", 2), ("t", 2020, "written", 4)]
