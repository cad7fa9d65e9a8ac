"""Writes of leaves without a sort of the task's rows, and one cast of each score."""

import pytest
from pyspark.sql import functions as F

from tierlake import fixtures as fx
from tierlake.functions.scores import is_malformed, is_nan, number, parse_score
from tierlake.plans.silver import clean_columns, quality_metrics, with_numbers
from tierlake.session import unsorted_leaves
from tierlake.sinks import VersionedTables, write_partitioned
from tierlake.sources import read_layer
from tierlake.spec import LINEITEM_SPEC as LI

CONF = "spark.sql.maxConcurrentOutputFileWriters"


def last_write(spark):
    """The physical plan of the last write."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [found.apply(i).physicalPlanDescription() for i in range(found.size())]
    return next(p for p in reversed(plans) if "InsertIntoHadoopFs" in p)


def rows(spark):
    return spark.range(0, 400, 1, 2).select(F.col("id").cast("string").alias("l_orderkey"), (2000 + F.col("id") % 7).cast("int").alias("ano"))


def test_partitioned_writes_do_not_sort(spark, workdir):
    fx.write_raw_csv(spark, rows(spark), f"{workdir}/raw", LI, "lineitem")
    assert "Sort" not in last_write(spark)
    write_partitioned(rows(spark), f"{workdir}/layer", "ano")
    assert "Sort" not in last_write(spark)
    VersionedTables(spark, f"{workdir}/store").stage_years(rows(spark), range(2000, 2007))
    assert "Sort" not in last_write(spark)
    assert sorted(map(tuple, read_layer(spark, f"{workdir}/layer").collect())) == sorted(map(tuple, rows(spark).collect()))


def test_more_leaves_than_open_files(spark, workdir):
    many = spark.range(0, 600, 1, 1).select("id", (1900 + F.col("id") % 50).cast("int").alias("ano"))
    write_partitioned(many, f"{workdir}/many", "ano")
    assert sorted(map(tuple, read_layer(spark, f"{workdir}/many").collect())) == sorted(map(tuple, many.collect()))


def test_the_sessions_own_setting_comes_back(spark):
    with unsorted_leaves(spark), unsorted_leaves(spark):
        assert spark.conf.get(CONF) != "0"
    assert spark.conf.get(CONF, "0") == "0"
    spark.conf.set(CONF, "3")
    try:
        with unsorted_leaves(spark):
            assert spark.conf.get(CONF) == "3"
        assert spark.conf.get(CONF) == "3"
    finally:
        spark.conf.unset(CONF)
    with pytest.raises(ZeroDivisionError), unsorted_leaves(spark):
        1 / 0
    assert spark.conf.get(CONF, "0") == "0"


TEXTS = [None, "", " ", "x", "n/a", "n", "650.5", " 5.5 ", "7,5", "0", "-0", ".5", "5.", "1e3", "1d", "0x1p3", "NaN", "nan", "+inf", "-Infinity", "infinit", "é", "٥", "--1"]


def test_a_number_is_what_the_cast_says(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, s string")
    cast = F.col("s").try_cast("double")
    for e, want in (
        (number("s"), cast),
        (parse_score("s"), F.when(F.col("s").isNull(), F.lit(0.0)).otherwise(cast)),
        (is_malformed("s"), F.col("s").isNotNull() & cast.isNull()),
        (is_nan("s"), F.isnan(cast)),
    ):
        got = df.select("i", e.alias("got"), want.alias("want")).orderBy("i").collect()
        assert [str(r.got) for r in got] == [str(r.want) for r in got]


def test_silver_casts_each_score_once(spark):
    raw = spark.createDataFrame([(1997, *["1"] * len(LI.keep))], f"ano int, {', '.join(f'{c} string' for c in LI.keep)}")
    presence = {1997: list(LI.keep)}
    df, numbers = with_numbers(raw, presence, LI)
    metrics = quality_metrics(presence, LI, numbers)
    silver = df.groupBy("ano").agg(*[e.alias(k) for k, e in metrics.items()], *[F.sum(c).alias(f"_{i}") for i, c in enumerate(clean_columns(df, presence, LI, numbers)) if LI.keep[i] in LI.scores])
    plan = silver._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double") + plan.count("AS DOUBLE") == len(LI.scores), plan
