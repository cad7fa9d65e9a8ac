"""Approximate nearest neighbours by collision counting over single projections.

Vectors are brought to length 1, so nearness by cosine is nearness by distance. Each of
``projections`` random lines gives one sorted array of a block's projected values. A query
opens a window around its own value in every array and widens all of them together by
virtual rehashing (radius R, c R, c^2 R, ...): each widening reads only the new ends of
the windows and adds to each vector's number of collisions. A vector whose collisions
exceed the threshold is verified by its cosine on the original vectors. A query stops when
k vectors found so lie well within its radius R, or when the number of verified vectors
reaches k plus a share ``verify`` of the block. All vectors that pass the threshold
in a round are verified, so equal vectors stay together and ties are whole.

Every row is indexed and every block asked; the index of a block is made in its task, and
blocks and queries are dealt as in ``topk``. The lines depend on the seed only.

Cases: vectors that are null, zero or hold a null or non-finite component take no part;
of rows that share a vec_id one counts, that with the smallest vector; vectors shorter
than the longest in their block count as padded with zeros; ties go to the smaller vec_id;
fewer than k candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.topk import blocks_of, matrix, ranked, usable
from tierlake.session import ship_package

BLOCK_ROWS = 8192
QUERY_ROWS = 256
PROJECTIONS = 192
#: Share of the projections in which a vector has to collide, and half the width of a window
#: at radius 1. Along a line two vectors at distance d differ by a normal of deviation d, so a
#: vector at distance R falls into a window of radius R with probability 0.53.
THRESHOLD, HALF_WIDTH = 0.53, 0.72
#: First radius and growth of the windows, on vectors of length 1.
FIRST_RADIUS, GROWTH = 0.8, 1.1
#: Vectors within this share of the radius pass the threshold with near certainty.
REACH = 0.88
#: Share of a block that a query verifies before it may stop with vectors further away.
VERIFY = 0.06


def random_lines(projections: int, width: int, seed: int) -> np.ndarray:
    """Rows of random rotations, scaled so that a unit vector's values have variance 1."""
    rng, out = np.random.default_rng(seed), []
    while sum(map(len, out)) < projections and width:
        out.append(np.linalg.qr(rng.standard_normal((width, width)))[0] * np.sqrt(width))
    return np.concatenate([*out, np.empty((0, width))])[:projections]


class Block:
    """Sorted single-projection arrays of one block."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = 7):
        self.vectors = vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.lines = random_lines(projections, vectors.shape[1], seed)
        values = self.lines @ (vectors / self.norms[:, None]).T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.values = np.take_along_axis(values, self.order, 1)

    def cosine(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        # Row by row in one order of summation, so equal vectors get equal scores.
        dots = (self.vectors[places] * query).sum(1)
        return dots / (self.norms[places] * np.sqrt((query * query).sum()))

    def search(self, queries: np.ndarray, k: int, threshold: float = THRESHOLD, verify: float = VERIFY) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and cosines of all vectors that it verified."""
        n, m = len(self.vectors), len(self.values)
        need = max(1, int(np.ceil(threshold * m)))
        enough = min(n, k + int(np.ceil(verify * n)))
        at = self.lines @ (queries / np.sqrt((queries * queries).sum(1))[:, None]).T
        hits = np.zeros((len(queries), n), np.int16)
        found = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        active, radius, low, high = list(range(len(queries))), FIRST_RADIUS, None, None
        while active:
            half = HALF_WIDTH * radius
            wide_low = np.array([np.searchsorted(v, a - half, "left") for v, a in zip(self.values, at)])
            wide_high = np.array([np.searchsorted(v, a + half, "right") for v, a in zip(self.values, at)])
            if low is None:
                low = high = wide_low
            left = []
            for q in active:
                mine = hits[q]
                edges = zip(self.order, wide_low[:, q].tolist(), low[:, q].tolist(), high[:, q].tolist(), wide_high[:, q].tolist())
                ends = [part for order, a, b, c, d in edges for part in (order[a:b], order[c:d])]
                mine += np.bincount(np.concatenate(ends), minlength=n).astype(np.int16) if ends else 0
                places, scores = found[q]
                fresh = mine >= need
                fresh[places] = False
                fresh = np.flatnonzero(fresh)
                places = np.append(places, fresh)
                scores = np.append(scores, self.cosine(queries[q], fresh))
                found[q] = places, scores
                # Two vectors of length 1 at distance d have cosine 1 - d^2 / 2.
                near = 1 - (REACH * radius) ** 2 / 2
                if (scores >= near).sum() < k and len(places) < enough:
                    left.append(q)
            active, low, high = left, wide_low, wide_high
            radius *= GROWTH
        return found


def nearest(vectors: DataFrame, is_query: Column, k: int, projections: int = PROJECTIONS, threshold: float = THRESHOLD, verify: float = VERIFY, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query."""
    ship_package(vectors.sparkSession)
    rows = usable(vectors).where(F.exists("v", lambda x: x != 0))
    pairs = blocks_of(rows, rows.where(is_query), block_rows, query_rows)
    fields = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("is_query").to_numpy()
        side = [table.filter(pa.array(mask)).sort_by("vec_id").combine_chunks() for mask in (~asks, asks)]
        if not all(x.num_rows for x in side):
            return fields.empty_table()
        (ids, cands), (qids, queries) = ((x.column("vec_id").to_numpy(), matrix(x.column("v").combine_chunks(), np.float64)) for x in side)
        width = max(cands.shape[1], queries.shape[1])
        cands, queries = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (cands, queries))
        block, out = Block(cands, projections, seed), []
        for qid, (places, scores) in zip(qids, block.search(queries, k + 1, threshold, verify)):
            other = ids[places] != qid
            places, scores = places[other], scores[other]
            at = np.lexsort((ids[places], -scores))[:k]
            out.append((np.full(len(at), qid), ids[places[at]], scores[at]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], schema=fields)

    hits = pairs.groupBy("qb", "cb").applyInArrow(run, "query_id long, vec_id long, score double")
    return ranked(hits, k)


__all__ = ["Block", "nearest"]
