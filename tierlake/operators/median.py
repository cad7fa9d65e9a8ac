"""Exact per-group median that never gathers a group, or a value, into one task.

Spark's built-in exact ``median`` keeps, per group, a map of distinct value -> count
in one aggregation buffer: a group holding a third of a continuous measure would
put a third of all distinct values into one task. A plain sort of the rows has the
opposite weakness: range partitioning cannot split equal sort keys, and a score
column can hold one value (0.0 for absentees) in a quarter of all rows. So:

1. ``groupBy(keys, value).count()``: duplicates collapse map-side (partial
   aggregation), leaving distinct (group, value) pairs with their counts;
2. a global sort of the pairs: pairs are distinct, so the sampled range bounds cut
   a hot group across many partitions evenly;
3. ``monotonically_increasing_id`` after the sort gives each pair its (partition,
   position) in sorted order; a small table of (partition, group) -> count and a
   running sum over it per group (rows per group <= number of partitions) gives
   each group's rank offset in each partition;
4. the one or two middle ranks of each group are located in a (partition, group)
   chunk; only those chunks (each at most one sorted partition) get a running count
   per pair, which picks the pair covering each middle rank.

There is one path for every size and type of input. All measures of a call are unpivoted
to (measure, value) first, so they share the aggregate, the sort and the two checkpoints.
Values are taken as double.

The sorted, id-tagged pairs are checkpointed (reliably, to the shared checkpoint
folder) before they are used: range bounds are sampled, so a recomputation could
cut partitions differently and the ids would disagree. The target table (at most
two rows per group) is checkpointed too, so the pairs are scanned only twice. The
target and chunk tables are small; AQE broadcasts them when their runtime size is
under the broadcast threshold and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.session import shared_root

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _match(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``cols`` between ``left`` and ``right`` (whose copies of
    the columns carry ``prefix``)."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[prefix + c]) for c in cols])


def exact_medians(df: DataFrame, keys: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """(keys..., one column for each entry name -> measure of ``values``): medians per
    group, NULLs skipped; the mean of the two middle values when the count is even (same
    as linear interpolation). A group without a value in any measure has no row; without
    keys there is one row. NaN counts as the largest value."""
    keys = list(keys)
    names = list(values)
    pairs = F.array(*[F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("v")) for i, c in enumerate(values.values())])
    freq = (
        df.select(*keys, F.explode(pairs).alias("_p"))
        .select(*keys, F.col("_p.m").alias("_m"), F.col("_p.v").alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(*keys, "_m", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    picked = _picked(freq, [*keys, "_m"])
    middle = [F.avg(F.when(F.col("_m") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)]
    return picked.groupBy(*keys).agg(*middle)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """(keys..., name): the median of one measure."""
    return exact_medians(df, keys, {name: value})


def _picked(freq: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., _v): the one or two middle values of each group of (keys, _v, _c)."""
    # Materialised once (reliable checkpoint in the shared checkpoint folder): the
    # ids depend on the range bounds, which are sampled, so every later use must
    # see this one sort rather than recompute it.
    shared_root(freq.sparkSession)
    ordered = (
        freq.orderBy(*keys, "_v")
        .withColumn("_id", F.monotonically_increasing_id())
        .select(
            *keys,
            "_v",
            "_c",
            F.shiftright(F.col("_id"), _POS_BITS).alias("_part"),
            F.col("_id").bitwiseAND(F.lit(_POS_MASK)).alias("_pos"),
        )
        .checkpoint(eager=True)
    )
    chunks = ordered.groupBy("_part", *keys).agg(F.sum("_c").alias("_cnt"))
    by_group = Window.partitionBy(*keys).orderBy("_part")
    chunks = chunks.withColumns(
        {
            "_before": F.coalesce(F.sum("_cnt").over(by_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_n": F.sum("_cnt").over(Window.partitionBy(*keys)),
        }
    )
    # Middle ranks (0-based): floor((n-1)/2) and floor(n/2); equal when n is odd.
    middle = F.array_distinct(
        F.array(F.floor((F.col("_n") - 1) / 2).cast("long"), F.floor(F.col("_n") / 2).cast("long"))
    )
    targets = (
        chunks.withColumn("_rank", F.explode(middle))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_cnt")))
        .select(
            F.col("_part").alias("_t_part"),
            *[F.col(k).alias("_t_" + k) for k in keys],
            (F.col("_rank") - F.col("_before")).alias("_t_local"),
        )
        # At most two rows per group, used twice below: materialised so the large
        # checkpointed pairs are scanned twice in all (chunk counts, candidates).
        .checkpoint(eager=True)
    )
    in_target_chunk = (ordered["_part"] == targets["_t_part"]) & _match(ordered, targets, keys, "_t_")
    cand = ordered.join(targets.select("_t_part", *["_t_" + k for k in keys]).distinct(), in_target_chunk, "left_semi")
    in_chunk = Window.partitionBy("_part", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    cand = cand.withColumn("_hi", F.sum("_c").over(in_chunk)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    covers = (
        (cand["_part"] == targets["_t_part"])
        & _match(cand, targets, keys, "_t_")
        & (targets["_t_local"] >= cand["_lo"])
        & (targets["_t_local"] < cand["_hi"])
    )
    return cand.join(targets, covers, "inner").select(*[cand[k] for k in keys], cand["_v"])
