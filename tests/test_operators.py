"""Operators against brute force on small fixtures."""

import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierlake.operators import (
    broadcast_if_small,
    density_by_group,
    exact_median,
    fill_scores,
    histogram_by_group,
    mean_median_by_group,
    preview,
    region_compare,
    select_present,
    union_years,
    value_counts,
)


def test_exact_median_matches_brute_force_with_a_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    # One group holds most rows (skew); others are small, one has an even count,
    # one has a single row, one has only NULLs, and keys include NULL.
    for _ in range(20000):
        rows.append(("hot", rnd.random() * 1000))
    for g, n in (("a", 10), ("b", 7), ("c", 1)):
        rows += [(g, float(rnd.randint(0, 5))) for _ in range(n)]
    rows += [("nulls", None), ("nulls", None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(13)
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        vals = [v for k, v in rows if k == g and v is not None]
        if vals:
            want[g] = statistics.median(vals)
    assert set(got) == set(want)
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-12)


def test_exact_median_with_a_dominant_value(spark):
    # A quarter-of-all-rows value (absentees at 0.0) inside a hot group, plus ties
    # straddling the middle: duplicates collapse before the sort.
    rnd = random.Random(11)
    rows = [("hot", 0.0)] * 6000 + [("hot", float(rnd.randint(1, 50))) for _ in range(6001)]
    rows += [("even", 1.0), ("even", 2.0), ("even", 2.0), ("even", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(9)
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    for g in ("hot", "even"):
        assert got[g] == statistics.median([v for k, v in rows if k == g])


def test_exact_median_reads_one_materialised_sort(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [("hot", float(i)) for i in range(4000)] + [("x", 1.0)]
        df = spark.createDataFrame(rows, "g string, v double").repartition(8)
        med = exact_median(df, ["g"], "v")
        assert {r["g"]: r["median"] for r in med.collect()}["hot"] == 1999.5
        # The range-sorted pairs were materialised once; the query reads them back
        # and never sorts them again.
        plan = med._jdf.queryExecution().executedPlan().toString()
        assert "ExistingRDD" in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_mean_median_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "g string, v double")
    out = mean_median_by_group(df, ["g"], ["v"])
    got = {r["g"]: (r["media_v"], r["mediana_v"]) for r in out.collect()}
    assert got == {"a": (2.0, 2.0), "b": (None, None)}


def test_mean_median_of_two_measures_without_keys_and_of_decimals(spark):
    rows = [(Decimal("1.50"), 3, float("nan")), (Decimal("2.50"), None, 1.0), (None, 8, 2.0)]
    df = spark.createDataFrame(rows, "d decimal(10,2), i int, f double")
    out = mean_median_by_group(df, [], ["d", "i", "f"])
    (r,) = out.collect()
    assert (float(r["media_d"]), r["mediana_d"], r["media_i"], r["mediana_i"], r["mediana_f"]) == (2.0, 2.0, 5.5, 5.5, 2.0)
    assert {t for n, t in out.dtypes if n.startswith("mediana_")} == {"double"}
    (e,) = mean_median_by_group(df.limit(0), [], ["d"]).collect()
    assert tuple(e) == (None, None)


def test_bins_of_large_and_missing_values(spark):
    df = spark.createDataFrame([("a", 1e12), ("a", float("nan")), ("a", float("inf")), ("a", None), ("a", 3.0), ("a", -3.0)], "g string, v double")
    got = {(r["g"], r["bin"]): r["total"] for r in histogram_by_group(df, "g", "v", 10).collect()}
    assert got == {("a", 100_000_000_000): 1, ("a", None): 2, ("a", 0): 1, ("a", -1): 1}
    shares = {r["bin"]: r["share"] for r in density_by_group(df, "g", "v", 10).collect()}
    assert shares == {100_000_000_000: 0.2, None: 0.4, 0: 0.2, -1: 0.2}


def test_region_compare_counts_every_fact_once(spark):
    facts = spark.createDataFrame([(1, 10.0), (2, 20.0), (None, 30.0), (9, 40.0), (1, None)], "k int, v double")
    places = spark.createDataFrame([(1, "ASIA"), (2, "EUROPE")], "p int, r string")
    got = {r["grupo"]: (r["media_v"], r["total"]) for r in region_compare(facts, "k", "v", places, "p", "r", "ASIA").collect()}
    assert got == {"ASIA": (10.0, 2), "OUTRAS": (30.0, 3)}
    with pytest.raises(ValueError, match="repeats"):
        region_compare(facts, "k", "v", places.union(places), "p", "r", "ASIA")


def test_union_years_aligns_by_name(spark):
    a = spark.createDataFrame([("k1", 1.0)], "k string, x double")
    b = spark.createDataFrame([(2.0, "k2", "z")], "x double, k string, extra string")
    got = sorted(tuple(r) for r in union_years({2001: a, 2002: b}).select("ano", "k", "x", "extra").collect())
    assert got == [(2001, "k1", 1.0, None), (2002, "k2", 2.0, "z")]


def test_select_present_is_exact_case_and_ordered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, C int")
    assert select_present(df, ["C", "zz", "a", "c"]).columns == ["C", "a"]


def test_fill_scores_only_touches_present_scores(spark):
    df = spark.createDataFrame([(None, "x"), ("1.5", None)], "s1 string, t string")
    out = fill_scores(df, ["s1", "s2"]).collect()
    assert [r["s1"] for r in out] == [0.0, 1.5]
    assert [r["t"] for r in out] == ["x", None]


def test_value_counts_and_preview_order(spark):
    df = spark.createDataFrame([(k,) for k in "abbcccd"] + [(None,)], "k string")
    assert [(r["k"], r["count"]) for r in value_counts(df, "k").collect()] == [("c", 3), ("b", 2), ("a", 1), ("d", 1)]
    assert [r["k"] for r in preview(df.where(F.col("k").isNotNull()), ["k"], 3).collect()] == ["a", "b", "b"]


def test_broadcast_only_when_bounded(spark):
    small = spark.range(10)
    big = spark.range(1000)
    facts = spark.range(5000).withColumn("id", F.col("id") % 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p1 = facts.join(broadcast_if_small(small, 100), "id")._jdf.queryExecution().executedPlan().toString()
        p2 = facts.join(broadcast_if_small(big, 100), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in p1
    assert "BroadcastHashJoin" not in p2


def test_broadcast_bound_counts_bytes_too(spark):
    from tierlake.operators.joins import bounded

    wide = spark.range(50).withColumn("pad", F.expr("repeat('x', 1000)"))
    assert bounded(wide, max_rows=100, max_bytes=1 << 20)
    assert not bounded(wide, max_rows=100, max_bytes=10_000)  # few rows, too many bytes
    assert not bounded(wide, max_rows=10)


def test_broadcast_probe_sends_sums_only(spark):
    from tierlake.operators import joins

    seen = []

    class Spy:
        """Stands for a DataFrame and keeps the plan of its aggregate."""

        def __init__(self, df):
            self.df, self.schema = df, df.schema

        def agg(self, *a):
            out = self.df.agg(*a)
            seen.append(out._jdf.queryExecution().executedPlan().toString())
            return out

    assert joins.bounded(Spy(spark.range(1000).withColumn("s", F.lit("x"))), 5000)
    below = seen[0].split("Exchange SinglePartition", 1)[1]
    assert "partial_count" in below and "Limit" not in seen[0]
