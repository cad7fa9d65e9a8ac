"""Quality by hierarchical empirical Bayes: document evidence over site posteriors.

1. Document classifier: a logistic regression on a few shape measures of the whole text,
   fitted on at most ``MAX_LABELLED`` labelled rows, those with the smallest hash of their
   id. It gives each document its evidence, the log odds of being good.
2. Sites: the expected number of good documents and the number of documents are summed for
   each (host, path) and host. Rates of hosts are shrunk towards the global rate, rates of
   paths towards their host's, each by the strength that the spread of the rates shows
   (method of moments): a site of few documents keeps little of its own.
3. A document's score is the probability from its evidence with the global prior odds
   exchanged for its path's. Documents below ``THRESHOLD`` are rejected.

The text is read twice; what is grouped and joined are numbers, pre-aggregated by host and
path, so a hot host is one row for each task. Sites are joined by an ordinary join, which
Spark broadcasts only while their table is small.

Cases: a null text is empty, null hosts and paths are the empty label; documents without a
label only get a score; contradicting labels of one document all count; without any label
(or with one class only) evidence is the site-free prior of 0.5 and nothing is rejected;
an empty table gives an empty result; input columns stay, those named like an output are
replaced by ``classify`` and stay in ``kept``; ``_q_``-names are reserved.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pick
from tierlake.session import run_dir

#: Bound on the labelled rows that the classifier is fitted on, and on what is broadcast.
MAX_LABELLED = 20_000
THRESHOLD = 0.5
RIDGE = 1.0
OUT = ["evidence", "host_rate", "path_rate", "score", "keep"]


def measures(text: Column) -> dict[str, Column]:
    """Shape measures of a text, each between 0 and about 1."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    words, lines = F.split(text, "[ \n]+"), F.split(text, "\n")
    return {
        "symbols": without(r"[\p{L}\p{N}\s.,'-]+") / size,
        "upper": F.least(F.lit(1.0), (F.length(text) - without(r"\p{Lu}+")) / size),
        "digits": (F.length(text) - without(r"\p{N}+")) / size,
        "word_length": F.least(F.lit(3.0), F.length(text) / (F.size(words) * 10)),
        "new_words": F.size(F.array_distinct(words)) / F.size(words),
        "new_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "length": F.log10(size + 1.0) / 5,
    }


def fit(rows: np.ndarray, good: np.ndarray, ridge: float = RIDGE, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale of the measures folded into (weights, intercept) of a ridge logistic fit."""
    mean, scale = rows.mean(0), rows.std(0) + 1e-9
    x = np.column_stack([(rows - mean) / scale, np.ones(len(rows))])
    w, hold = np.zeros(x.shape[1]), np.append(np.full(rows.shape[1], ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (good - p) - hold * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(hold)
        move = np.linalg.solve(bend, slope)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return w[:-1] / scale, np.array([w[-1] - (w[:-1] * mean / scale).sum()])


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(mean: float, spread: float, groups: float, rows: float) -> float:
    """Pseudo-documents of a prior whose rates spread as seen, less what chance explains."""
    noise = mean * (1 - mean)
    between = max(spread / max(rows, 1.0) - noise * groups / max(rows, 1.0), noise * 1e-6, 1e-12)
    return min(max(noise / between - 1, 1.0), 1e6)


def sites(scored: DataFrame) -> DataFrame:
    """(_q_host, _q_path, host_rate, path_rate) from rows with _q_host, _q_path, _q_p."""
    paths = scored.groupBy("_q_host", "_q_path").agg(F.count(F.lit(1)).alias("n"), F.sum("_q_p").alias("s"))
    folder = run_dir(scored.sparkSession, "quality-sites")
    paths.write.parquet(folder)
    paths = scored.sparkSession.read.parquet(folder)
    hosts = paths.groupBy("_q_host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    rows, good, groups = hosts.agg(F.sum("hn"), F.sum("hs"), F.count(F.lit(1))).first()
    if not rows:
        return paths.select("_q_host", "_q_path", F.lit(0.5).alias("host_rate"), F.lit(0.5).alias("path_rate"))
    mean = min(max(good / rows, 1e-6), 1 - 1e-6)
    (spread,) = hosts.agg(F.sum(F.col("hn") * F.pow(F.col("hs") / F.col("hn") - F.lit(mean), 2))).first()
    k = strength(mean, spread, groups, rows)
    hosts = hosts.select("_q_host", ((F.lit(k * mean) + F.col("hs")) / (F.lit(k) + F.col("hn"))).alias("host_rate"))
    paths = paths.join(hosts, "_q_host")
    apart, many = paths.agg(F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("host_rate"), 2)), F.count(F.lit(1))).first()
    k = strength(mean, apart, many, rows)
    return paths.select("_q_host", "_q_path", "host_rate", ((F.lit(k) * F.col("host_rate") + F.col("s")) / (F.lit(k) + F.col("n"))).alias("path_rate"))


def judged(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` with the columns of ``OUT`` under the prefix ``_q_``; all input columns stay."""
    spark = docs.sparkSession
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    keyed = docs.withColumns({"_q_host": F.coalesce(host.cast("string"), F.lit("")), "_q_path": F.coalesce(path.cast("string"), F.lit(""))})
    made = measures(F.col("text"))
    names = [f"_q_{m}" for m in made]
    folder = run_dir(spark, "quality-measures")
    keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "_q_host", "_q_path", *[c.alias(f"_q_{m}") for m, c in made.items()]).write.parquet(folder)
    rows = spark.read.parquet(folder)
    chosen = pick(labels, doc_id="long", quality="int").dropna().where("quality in (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled)
    # At most max_labelled rows of two numbers: bounded, so broadcast and then collected.
    known = rows.join(F.broadcast(chosen), "doc_id").select(*names, "quality").limit(2 * max_labelled).toPandas()
    good = known["quality"].to_numpy(float)
    if len(good) and 0 < good.sum() < len(good):
        weights, intercept = fit(known[names].to_numpy(float), good)
        base = math.log(good.mean() / (1 - good.mean()))
    else:
        weights, intercept, base = np.zeros(len(names)), np.zeros(1), 0.0
    score = lambda columns: sum((F.lit(float(w)) * c for w, c in zip(weights, columns)), F.lit(float(intercept[0])))
    evidence = F.greatest(F.least(score(made.values()), F.lit(30.0)), F.lit(-30.0))
    of_site = sites(rows.withColumn("_q_p", sigmoid(score([F.col(n) for n in names]))))
    of_site = of_site.withColumnsRenamed({c: f"_q_{c}" for c in ("host_rate", "path_rate")})
    out = keyed.withColumn("_q_evidence", evidence).join(of_site, ["_q_host", "_q_path"])
    out = out.withColumn("_q_score", sigmoid(F.col("_q_evidence") - F.lit(base) + logit(F.col("_q_path_rate"))))
    return out.withColumn("_q_keep", F.col("_q_score") >= F.lit(threshold))


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` with evidence, host_rate, path_rate, score and keep, in place of columns of
    these names. Host and path default to ``source`` and ``lang``; for web pages pass
    ``parse_url`` expressions."""
    out = judged(docs, labels, host, path, threshold, max_labelled)
    return out.select(*[c for c in docs.columns if c not in OUT], *[F.col(f"_q_{c}").alias(c) for c in OUT])


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with the columns and values of ``docs``."""
    return judged(docs, labels).where("_q_keep").select(*docs.columns)


__all__ = ["classify", "fit", "judged", "kept", "measures", "sites"]
