"""Types that drift, footers that tell order and codec, and the quality gate."""

import pytest
from conftest import write_text
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType, TimestampType

from tierlake.operators import union_years
from tierlake.plans import build_bronze, read_gold
from tierlake.plans.gate import GateRule, QualityGate, breaches, quality_by_year
from tierlake.sinks import write_leaf
from tierlake.sources import read_layer
from tierlake.sources.footers import codec_report, footers, order_report, sorted_within
from tierlake.spec import EXAM_SPEC as S
from tierlake.widening import type_report, wider


@pytest.mark.parametrize("a,b,want", [
    (IntegerType(), LongType(), LongType()),
    (LongType(), DoubleType(), DoubleType()),
    (FloatType(), IntegerType(), DoubleType()),
    (DecimalType(10, 2), IntegerType(), DecimalType(12, 2)),
    (DecimalType(38, 2), DecimalType(38, 10), DoubleType()),
    (DateType(), TimestampType(), TimestampType()),
    (StringType(), DoubleType(), StringType()),
    (DateType(), LongType(), StringType()),
])
def test_wider(a, b, want):
    assert wider(a, b) == want == wider(b, a)


def test_no_common_type():
    with pytest.raises(TypeError):
        wider(StructType(), LongType())


def test_union_and_layer_with_drifting_types(spark, workdir):
    frames = {
        2020: spark.createDataFrame([(1, 5)], "k int, v int"),
        2021: spark.createDataFrame([(2**40, 5.5), (3, 7.0)], "k long, v double"),
        2022: spark.createDataFrame([(4, "abc", "x")], "k int, v string, more string"),
        2023: spark.createDataFrame([(5, 6)], "k int, v int"),
    }
    got = union_years(frames, widen=True)
    assert dict(got.dtypes) == {"k": "bigint", "v": "string", "more": "string", "ano": "int"}
    rows = sorted(map(tuple, got.select("ano", "k", "v", "more").collect()), key=repr)
    assert rows == [(2020, 1, "5", None), (2021, 2**40, "5.5", None), (2021, 3, "7", None), (2022, 4, "abc", "x"), (2023, 5, "6", None)]
    for y, df in frames.items():
        write_leaf(df, f"{workdir}/t", y)
    with pytest.raises(TypeError):
        read_layer(spark, f"{workdir}/t")
    layer = read_layer(spark, f"{workdir}/t", widen=True)
    assert sorted(map(tuple, layer.select("ano", "k", "v", "more").collect()), key=repr) == rows
    assert read_layer(spark, f"{workdir}/t", years=[2021], widen=True).count() == 2
    assert read_layer(spark, f"{workdir}/t", years=[1999], widen=True).count() == 0
    # Years of one schema are one scan.
    assert layer._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    assert ("v", 2020, "int", "string") in type_report({y: f.schema for y, f in frames.items()})


def test_footers_tell_order_and_codec(spark, workdir):
    df = spark.range(1000).withColumn("g", (F.col("id") % 7).cast("string")).withColumn("none", F.lit(None).cast("int"))
    df.orderBy("id").repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(f"{workdir}/good")
    found = footers(spark, f"{workdir}/good", per_task=1)
    assert [tuple(r) for r in codec_report(found).select("codec", "columns", "files").collect()] == [("SNAPPY", 3, 4)]
    assert order_report(found, "id").first().asDict() == {"row_groups": 4, "rows": 1000, "ordered": 1}
    assert order_report(found, "id", descending=True).first().ordered == 0
    assert order_report(found, "g").first().ordered == 0
    assert order_report(found, "none").first().asDict() == {"row_groups": 0, "rows": 0, "ordered": 1}
    assert tuple(sorted_within(spark, f"{workdir}/good", [("id", False)]).first()) == (1000, 0)
    assert sorted_within(spark, f"{workdir}/good", [("id", True)]).first().breaks == 996
    # The wrong order, and another codec, show.
    df.repartitionByRange(4, F.desc("id")).sortWithinPartitions("id").write.option("compression", "zstd").parquet(f"{workdir}/bad")
    bad = footers(spark, f"{workdir}/bad")
    assert order_report(bad, "id").first().ordered == 0
    assert {r.codec for r in codec_report(bad).collect()} == {"ZSTD"}


def test_sorted_within_knows_nulls_and_ties(spark, workdir):
    rows = [(None, 9), (1, 3), (1, 2), (2, 5)]
    spark.createDataFrame(rows, "a int, b int").coalesce(1).write.parquet(f"{workdir}/t")
    assert sorted_within(spark, f"{workdir}/t", [("a", False), ("b", True)]).first().breaks == 0
    assert sorted_within(spark, f"{workdir}/t", [("a", False), ("b", False)]).first().breaks == 1


HEADER = "SG_UF_PROVA;TP_SEXO;NU_NOTA_CN;NU_NOTA_REDACAO"


def year(raw, y, rows):
    write_text(f"{raw}/survey_{y}/DADOS/MICRODADOS_ENEM_{y}.csv", HEADER + "\n" + "".join(r + "\n" for r in rows))


def test_a_bad_year_does_not_reach_gold(spark, workdir):
    raw, layers = f"{workdir}/raw", (f"{workdir}/bronze", f"{workdir}/silver", f"{workdir}/gold")
    good = [f"SP;F;{i};{i}" for i in range(20)]
    for y in (2020, 2021, 2022):
        year(raw, y, [*good, "RJ;M;;1"])
    gate = QualityGate(spark, f"{workdir}/history", S)
    build_bronze(spark, raw, layers[0], S)
    assert gate.run(*layers)[1] == []
    means = lambda: sorted(map(tuple, read_gold(spark, layers[2], S.mean_table).collect()))
    before, accepted = means(), sorted(map(tuple, gate.history().collect()))
    # A new year of which a third of one score is no number, and an old one, suddenly empty.
    year(raw, 2023, [*good, *["SP;F;x;1"] * 10])
    year(raw, 2021, [f"SP;F;{i};" for i in range(20)])
    build_bronze(spark, raw, layers[0], S, mode="overwrite")
    reports, found = gate.run(*layers)
    assert [b[:3] for b in found] == [(2021, "NU_NOTA_REDACAO", "filled"), (2023, "NU_NOTA_CN", "malformed")]
    assert means() == before and sorted(map(tuple, gate.history().collect())) == accepted and len(reports) == 1
    # Mended, both arrive.
    year(raw, 2023, good)
    year(raw, 2021, good)
    build_bronze(spark, raw, layers[0], S, mode="overwrite")
    assert gate.run(*layers)[1] == []
    assert {m[0] for m in means()} == {2020, 2021, 2022, 2023} and means() != before


def test_a_first_run_is_judged_among_its_years(spark, workdir):
    raw, layers = f"{workdir}/raw", (f"{workdir}/bronze", f"{workdir}/silver", f"{workdir}/gold")
    for y in (2020, 2021):
        year(raw, y, [f"SP;F;{i};{i}" for i in range(10)])
    year(raw, 2022, ["SP;F;x;1"] * 10)
    build_bronze(spark, raw, layers[0], S)
    gate = QualityGate(spark, f"{workdir}/history", S)
    assert [b[:3] for b in gate.run(*layers)[1]] == [(2022, "NU_NOTA_CN", "malformed")]
    loose = QualityGate(spark, f"{workdir}/history", S, GateRule(margin=1.0))
    assert loose.run(*layers)[1] == []


def test_a_single_year_has_the_first_margin(spark, workdir):
    year(f"{workdir}/raw", 2020, ["SP;F;x;1", "SP;F;2;1", "SP;F;;1"])
    build_bronze(spark, f"{workdir}/raw", f"{workdir}/bronze", S)
    now = quality_by_year(spark, f"{workdir}/bronze", S)
    assert sorted(map(tuple, now.collect())) == [(2020, "NU_NOTA_CN", 3, 1, 1, 0), (2020, "NU_NOTA_REDACAO", 3, 0, 0, 0)]
    assert breaches(now.limit(0), now, S).count() == 0
    assert {r.kind for r in breaches(now.limit(0), now, S, GateRule(first_margin=0.2)).collect()} == {"filled", "malformed"}
