"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

Rows are sparse vectors of long weights. Candidates are dealt by a hash of their id into
blocks of bounded size; a block holds, for each term (dimension), a posting list of places
and weights. A query goes term by term through its nonzero weights and adds
weight x posting weight into a dense score array of the block; a partition selection keeps
the block's k best, and the blocks' lists are merged. Queries are dealt into blocks too, so
a task holds one block of each; nothing is broadcast or collected.

Cases: a vector that is null or holds a null or non-finite component takes no part; of
rows that share a vec_id one counts, that with the smallest vector; absent components
count as 0; ties go to the smaller vec_id; sums that leave the long range are held at its
ends; an empty table gives an empty result. The query's own vec_id is never its result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import pick
from tierlake.session import ship_package

#: Rows of a candidate block and of a query block.
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
LONG = np.iinfo(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one row for each id, vectors of finite doubles only."""
    rows = pick(vectors, vec_id="long", embedding="array<double>").where("vec_id is not null and embedding is not null")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad).groupBy("vec_id").agg(F.min("embedding").alias("v"))


def blocks_of(rows: DataFrame, queries: DataFrame, block_rows: int, query_rows: int) -> DataFrame:
    """Every candidate block beside every query block: (qb, cb, is_query, vec_id, v)."""
    n, m = (x.count() for x in (rows, queries))
    cbs, qbs = max(1, math.ceil(n / block_rows)), max(1, math.ceil(m / query_rows))
    place = lambda seed, k: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = rows.withColumn("cb", place(1, cbs)).withColumn("qb", every(qbs)).withColumn("is_query", F.lit(False))
    right = queries.withColumn("qb", place(2, qbs)).withColumn("cb", every(cbs)).withColumn("is_query", F.lit(True))
    columns = ["qb", "cb", "is_query", "vec_id", "v"]
    return left.select(columns).unionByName(right.select(columns))


def matrix(column: pa.Array, kind) -> np.ndarray:
    """Lists as the rows of a matrix; absent components are 0."""
    lengths = np.asarray(column.value_lengths())
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width).astype(kind)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, unordered; all if fewer."""
    if len(scores) <= k:
        return np.arange(len(scores))
    cut = np.partition(scores, len(scores) - k)[len(scores) - k]
    sure = np.flatnonzero(scores > cut)
    tied = np.flatnonzero(scores == cut)
    return np.append(sure, tied[np.argsort(ids[tied], kind="stable")[: k - len(sure)]])


def accumulate(cands: np.ndarray, queries: np.ndarray) -> Iterator[np.ndarray]:
    """For each query its dense scores over the block."""
    peak = lambda a: float(np.abs(a.astype(float)).max()) if a.size else 0.0
    wide = peak(cands) * peak(queries) * max(1, cands.shape[1]) >= 2.0**62
    kind = object if wide else np.int64
    postings = {}
    for term in range(cands.shape[1]):
        column = cands[:, term]
        places = np.flatnonzero(column)
        whole = len(places) == len(column)
        postings[term] = (slice(None) if whole else places, np.ascontiguousarray(column[places]).astype(kind))
    for query in queries:
        scores = np.zeros(len(cands), kind)
        for term in np.flatnonzero(query[: cands.shape[1]]):
            places, weights = postings[term]
            scores[places] += (int(query[term]) if wide else query[term]) * weights
        yield np.array([min(max(s, LONG.min), LONG.max) for s in scores], np.int64) if wide else scores


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """Merges the blocks' lists: at most k rows of each block for a query."""
    by_rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = hits.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, is_query: Column, k: int, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) over ``rows`` (vec_id, v array<long>)."""
    ship_package(rows.sparkSession)
    pairs = blocks_of(rows, rows.where(is_query), block_rows, query_rows)
    fields = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        asks = block.column("is_query").to_numpy()
        side = [block.filter(pa.array(mask)).sort_by("vec_id").combine_chunks() for mask in (~asks, asks)]
        if not all(x.num_rows for x in side):
            return fields.empty_table()
        (ids, cands), (qids, queries) = ((x.column("vec_id").to_numpy(), matrix(x.column("v").combine_chunks(), np.int64)) for x in side)
        out = []
        for qid, scores in zip(qids, accumulate(cands, queries)):
            at = best(scores, ids, k + 1)
            at = at[ids[at] != qid]
            out.append((np.full(len(at), qid), ids[at], scores[at]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], schema=fields)

    hits = pairs.groupBy("qb", "cb").applyInArrow(run, "query_id long, vec_id long, score long")
    return ranked(hits, k)


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale x component) as long, the component taken as double."""
    return usable(vectors).select("vec_id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("long")).alias("v"))


__all__ = ["scaled", "top_k", "usable", "blocks_of", "ranked", "matrix"]
