"""Exact top-k inner products by Fagin's threshold algorithm.

A block of candidates has a list per dimension, sorted by that component. A query walks down each
list, from the end that its own component favours, and scores every vector it meets in full. What
no list has shown yet can score at most the sum of the query's components times the values reached;
once the k-th best score is above that bound, the block is done. Queries meet the candidates block
by block, and the blocks' best k are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleledger.llm.common import cut

#: Vectors in a block of candidates, and queries that meet it at once.
BLOCK, QUERIES = 8192, 1024
#: Depth of the first step down the lists; each further one is twice as deep.
STEP = 8


def usable(vector: Column) -> Column:
    """Not null, and no component null, infinite or not a number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def best(candidates: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query's row, id, score) of the k best per query, ties to smaller ids, own id left out."""
    n, dims = candidates.shape
    order = np.argsort(candidates, axis=0, kind="stable")
    lists = np.take_along_axis(candidates, order, axis=0)
    # doubles hold these sums exactly up to 2^53; beyond that integers do
    large = float(np.abs(candidates).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(dims, 1)
    scoring = candidates.astype(np.float64) if large < 2**53 else candidates
    found = []
    for row, query in enumerate(queries):
        used = np.flatnonzero(query)
        up = query[used] < 0
        seen = ids == own[row]
        top_ids, top_scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, STEP
        while True:
            upto = min(n, depth + step)
            if len(used):
                near = np.concatenate([order[depth:upto, used[up]].ravel(), order[n - upto : n - depth, used[~up]].ravel()])
            else:
                near = np.arange(n)
            new = np.zeros(n, bool)
            new[near] = True
            new &= ~seen
            seen |= new
            rows = np.flatnonzero(new)
            scores = (scoring[rows] @ query.astype(scoring.dtype)).astype(np.int64)
            if len(top_scores) == k:  # only what can enter
                rows, scores = rows[scores >= top_scores[-1]], scores[scores >= top_scores[-1]]
            top_ids, top_scores = np.concatenate([top_ids, ids[rows]]), np.concatenate([top_scores, scores])
            rank = np.lexsort((top_ids, -top_scores))[:k]
            top_ids, top_scores = top_ids[rank], top_scores[rank]
            if upto == n or not len(used) or seen.all():
                break
            reached = np.where(up, lists[upto - 1, used], lists[n - upto, used])
            if len(top_scores) == k and top_scores[-1] > int(reached @ query[used]):
                break
            depth, step = upto, step * 2
        found += [(row, int(i), int(s)) for i, s in zip(top_ids, top_scores)]
    return found


def _block(k: int):
    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, same in frame.groupby("dims"):
            asks = same[same["asks"]]
            gives = same[~same["asks"]].sort_values("vec_id")
            if len(asks) and len(gives):
                ids, own = gives["vec_id"].to_numpy(np.int64), asks["vec_id"].to_numpy(np.int64)
                matrix = lambda part: np.stack([np.asarray(v, np.int64) for v in part["v"]])
                out += [(own[q], i, s) for q, i, s in best(matrix(gives), ids, matrix(asks), own, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``asks`` marks its k highest integer inner
    products with all other rows, components being floor(scale * x).

    ``vectors`` has vec_id and embedding. Vectors that are null or hold null or non-finite
    components take no part, nor do rows without a vec_id. Rows equal in vec_id and vector count once;
    other rows that share a vec_id are all candidates, and as queries they share one ranking.
    Vectors meet those of their own number of components. Ties go to the smaller vec_id. Scores
    must fit a signed 64-bit integer. Work is queries times vectors; a task holds one block of each.
    """
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).withColumn("_asks", asks)
    rows = rows.groupBy("vec_id", "embedding").agg(F.bool_or("_asks").alias("asks"))
    rows = cut(rows.select("vec_id", scaled.alias("v"), F.size("embedding").alias("dims"), "asks"))
    many = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks, parts = -(-many["n"] // BLOCK) or 1, -(-many["q"] // QUERIES) or 1

    def part(of: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(of)).cast("int")

    def every(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    gives = rows.select("vec_id", "v", "dims", F.lit(False).alias("asks"), part(blocks, 1).alias("block"), every(parts).alias("part"))
    asked = rows.filter("asks").select("vec_id", "v", "dims", F.lit(True).alias("asks"), every(blocks).alias("block"), part(parts, 2).alias("part"))
    found = gives.unionByName(asked).groupBy("block", "part").applyInPandas(_block(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
