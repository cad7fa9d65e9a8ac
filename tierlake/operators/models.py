"""The predictive analyses, as Spark ML pipelines trained on the whole table.

Training is distributed by Spark ML itself (per-level split statistics for the
forest, per-iteration partial sums for k-means); nothing is collected but the
model, two class counts, and the categories of the features, whose number is checked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Categories of one feature that the forest takes; they are model state on the driver.
MAX_CATEGORIES = 10_000

#: Training rows in one part. Spark ML keeps the rows of a part as objects, some hundred
#: bytes each, in a cached block that a task reads whole in every pass; a part of the scan
#: may hold millions of rows, which take few bytes each in the file.
TRAINING_ROWS = 500_000


@contextmanager
def training_parts(rows: DataFrame, n: int, most: int = TRAINING_ROWS) -> Iterator[DataFrame]:
    """The ``n`` training rows in parts of about ``most`` at most, as they are if one would
    do. Rows are dealt by their place in the input, so equal rows do not meet in a part.
    They are kept within the block, as a fit plans its input several times."""
    parts = -(-n // most)
    if parts <= 1:
        yield rows
        return
    parts = max(parts, rows.sparkSession.sparkContext.defaultParallelism)
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.repartition(parts, "_place").drop("_place").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield dealt
    finally:
        dealt.unpersist()


def in_holdout(id_cols: Sequence[str], percent: int = 30) -> Column:
    """A fixed share of the rows by a digest of their ids, the same in every engine."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < percent


def category_counts(data: DataFrame, cats: Sequence[str], most: int) -> int:
    """The largest number of categories among the features; an error past ``most``."""
    row = data.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in cats]).first()
    # The estimate is off by 2 % one time in three; the indexer's own count is exact.
    wide = {c: int(row[c]) for c in cats if row[c] > most}
    if wide:
        raise ValueError(f"more than {most} categories: {wide}")
    return max([int(row[c] * 1.1) + 2 for c in cats] or [2])


def classify_top(
    df: DataFrame,
    id_cols: Sequence[str],
    features: Sequence[str],
    label: Column,
    num_trees: int = 20,
    max_depth: int = 5,
    seed: int = 42,
    train: Column | None = None,
    max_categories: int = MAX_CATEGORIES,
) -> DataFrame:
    """Random forest for a rare binary target from categorical profile columns.

    Categories are indexed as strings with an extra bucket for unseen/NULL values,
    and the positive class is up-weighted by negatives/positives so the rarity of
    the target does not make "never" the best answer. ``maxBins`` follows the categories
    of the data. With ``train`` the model is fitted on those rows only. Returns, per row,
    the label, the prediction and the probability of the positive class.
    """
    cats = [f"{c}_cat" for c in features]
    data = df.select(
        *id_cols,
        *[F.col(c).cast("string").alias(k) for c, k in zip(features, cats)],
        F.coalesce(label.cast("double"), F.lit(0.0)).alias("label"),
        (F.lit(True) if train is None else F.coalesce(train, F.lit(False))).alias("_train"),
    )
    bins = max(32, category_counts(data, cats, max_categories))
    counts = data.where("_train").agg(
        F.sum(F.when(F.col("label") == 1.0, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n")
    ).first()
    pos, n = int(counts["pos"] or 0), int(counts["n"] or 0)
    w_pos = float(n - pos) / pos if pos else 1.0
    data = data.withColumn("weight", F.when(F.col("label") == 1.0, F.lit(w_pos)).otherwise(F.lit(1.0)))
    idx_cols = [f"{c}_idx" for c in features]
    indexer = StringIndexer(inputCols=cats, outputCols=idx_cols, handleInvalid="keep").fit(data.where("_train"))
    assembler = VectorAssembler(inputCols=idx_cols, outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        weightCol="weight",
        numTrees=num_trees,
        maxDepth=max_depth,
        maxBins=bins,
        seed=seed,
    )
    training = indexer.transform(data.where("_train")).select(*idx_cols, "label", "weight")
    with training_parts(training, n) as rows:
        fitted = forest.fit(assembler.transform(rows))
    # Score with a copy of the forest: the copy carries no training summary, which
    # holds the session and cannot be shipped to tasks once the session has used an
    # Observation.
    scored = fitted.copy().transform(assembler.transform(indexer.transform(data)))
    return scored.select(
        *id_cols,
        "label",
        "prediction",
        # A forest that saw no positive row knows one class only.
        F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)).alias("p_positive"),
    )


def evaluate_top(
    df: DataFrame, id_cols: Sequence[str], features: Sequence[str], label: Column, percent: int = 30, **settings
) -> DataFrame:
    """One row: the classifier fitted without ``percent`` of the rows and judged on them.

    rows, positives, whether the confusion counts add up to them, and whether the ranking
    beats the majority answer (area under the curve above one half). The area is exact for
    the forest's probabilities: counts per probability, which are few, and running sums."""
    held = in_holdout(id_cols, percent)
    scored = classify_top(df, id_cols, features, label, train=~held, **settings).where(held)
    one, yes = F.col("label") == 1.0, F.col("prediction") == 1.0
    cell = lambda a, b: F.count(F.when(a & b, F.lit(1)))
    by_p = scored.groupBy(F.round("p_positive", 6).alias("p")).agg(
        F.count(F.when(one, F.lit(1))).alias("pos"),
        F.count(F.when(~one, F.lit(1))).alias("neg"),
        cell(one, yes).alias("tp"),
        cell(~one, yes).alias("fp"),
        cell(one, ~yes).alias("fn"),
        cell(~one, ~yes).alias("tn"),
    )
    below = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ranked = by_p.withColumn("under", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    total = ranked.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pos", "neg", "tp", "fp", "fn", "tn")],
        F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2)).alias("won"),
    )
    auc = F.col("won") / (F.col("pos") * F.col("neg"))
    adds_up = (F.col("tp") + F.col("fn") == F.col("pos")) & (F.col("fp") + F.col("tn") == F.col("neg"))
    return total.select(
        (F.col("pos") + F.col("neg")).alias("rows"),
        F.col("pos").alias("positives"),
        adds_up.alias("adds_up"),
        F.coalesce(auc > 0.5, F.lit(False)).alias("beats_majority"),
    )


def _clustered(df: DataFrame, id_cols: Sequence[str], scores: Sequence[str], k: int, seed: int):
    """Rows with their cluster (NULL where a score is NULL or NaN), and the fitted model."""
    complete = F.lit(True)
    for s in scores:
        complete = complete & F.col(s).isNotNull() & ~F.isnan(F.col(s))
    data = df.select(*id_cols, *scores)
    rows = data.where(complete)
    assembler = VectorAssembler(inputCols=list(scores), outputCol="raw")
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(assembler.transform(rows))
    means = KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed)
    with training_parts(rows.select(*scores), rows.count()) as training:
        fitted = means.fit(scaler.transform(assembler.transform(training)))
    placed = fitted.copy().transform(scaler.transform(assembler.transform(rows)))
    unplaced = data.where(~F.coalesce(complete, F.lit(False)))
    return placed, unplaced, fitted


def cluster_scores(
    df: DataFrame,
    id_cols: Sequence[str],
    scores: Sequence[str],
    k: int = 4,
    seed: int = 42,
) -> DataFrame:
    """k-means on standardised score columns, one cluster id per row; NULL for rows with a
    NULL or NaN score, which cannot be placed."""
    placed, unplaced, _ = _clustered(df, id_cols, scores, k, seed)
    keep = [*id_cols, *scores]
    return placed.select(*keep, F.col("cluster").cast("int").alias("cluster")).unionByName(
        unplaced.select(*keep, F.lit(None).cast("int").alias("cluster"))
    )


def evaluate_clusters(df: DataFrame, id_cols: Sequence[str], scores: Sequence[str], k: int = 4, seed: int = 42) -> DataFrame:
    """One row: rows, rows placed, clusters used, and rows that lie nearer to the centre of
    another cluster than to their own (0 for a right assignment)."""
    placed, unplaced, model = _clustered(df, id_cols, scores, k, seed)
    features = vector_to_array("features")
    far = []
    for centre in model.clusterCenters():
        values = F.array(*[F.lit(float(x)) for x in centre])
        far.append(F.aggregate(F.zip_with(features, values, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    distances = F.array(*far)
    own = F.element_at(distances, F.col("cluster") + 1)
    apart = F.when(own > F.array_min(distances) + 1e-9, 1).otherwise(0)
    n = placed.agg(F.count(F.lit(1)).alias("placed"), F.count_distinct("cluster").alias("clusters"), F.coalesce(F.sum(apart), F.lit(0)).alias("misplaced"))
    rest = unplaced.agg(F.count(F.lit(1)).alias("unplaced"))
    both = n.unionByName(rest, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("placed", "unplaced", "clusters", "misplaced")])
    return both.select((F.col("placed") + F.col("unplaced")).alias("rows"), "placed", "clusters", "misplaced")
