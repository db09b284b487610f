"""Embedding near-duplicates by collision-counting projections.

Unit vectors at cosine t lie at distance sqrt(2 - 2t), so their projections on a Gaussian direction
differ by a normal variable of that deviation. Each of many projections is sorted; a pair collides
in one if either lies in the window around the other. Pairs that collide in at least the calibrated
count of projections are verified by their exact cosine. Window and count are calibrated so that a
pair exactly at the threshold passes with at least the wanted probability; closer pairs pass more
surely.

Copies of a vector are first reduced to one, so a vector that many rows share costs one. The cells
of the first projection are as wide as its window, so a vector meets only its own and the next
cells, in parts of bounded size. A pair of parts reports link counts and a forest, never its pairs.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.llm.common import cut
from sampleledger.llm.components import components
from sampleledger.llm.topk import usable

PROJECTIONS = 24
#: Half a window, in deviations of the projections of a pair at the threshold.
REACH = 4.0
RECALL = 0.9999
#: Distinct vectors in a part; two parts meet in one task.
PART = 2048
TILE = 256


def calibrated_count(recall: float = RECALL, projections: int = PROJECTIONS, reach: float = REACH) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``."""
    hit = erf(reach / sqrt(2))
    sure = 0.0
    for count in range(projections, 0, -1):
        sure += comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if sure >= recall:
            return count
    return 1


def directions(dims: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((dims, PROJECTIONS))


def _cells(width: float):
    def run(frames):
        for frame in frames:
            cells = []
            for vector in frame["v"]:
                x = np.asarray(vector, np.float64)
                x = x / np.abs(x).max()
                cells.append(int(np.floor(x @ directions_of(len(x))[:, 0] / np.sqrt(x @ x) / width)))
            yield frame.assign(cell=np.array(cells, "int32"), dims=np.array([len(v) for v in frame["v"]], "int32"))

    return run


_KNOWN: dict[int, np.ndarray] = {}


def directions_of(dims: int) -> np.ndarray:
    if dims not in _KNOWN:
        _KNOWN[dims] = directions(dims)
    return _KNOWN[dims]


def linked(units: np.ndarray, n_first: int, alone: bool, threshold: float, half: float, least: int):
    """Tiles of verified links (i, j) between the first rows and the others, or within all rows
    (i < j) if ``alone``, and nothing else."""
    places = units @ directions_of(units.shape[1])
    asks, gives = np.arange(n_first), np.arange(0 if alone else n_first, len(units))
    order = np.argsort(places[gives], axis=0, kind="stable")
    ranks = np.empty(order.shape, np.int32)
    np.put_along_axis(ranks, order, np.arange(len(gives), dtype=np.int32)[:, None], axis=0)
    ranks = ranks.astype(np.uint16)  # parts are smaller than 65,536
    low, high = np.empty((len(asks), PROJECTIONS), np.int64), np.empty((len(asks), PROJECTIONS), np.int64)
    for p in range(PROJECTIONS):
        row = places[gives[order[:, p]], p]
        low[:, p] = np.searchsorted(row, places[asks, p] - half, "left")
        high[:, p] = np.searchsorted(row, places[asks, p] + half, "right")
    start, length = low.astype(np.uint16), (high - low).astype(np.uint16)
    columns = np.ascontiguousarray(ranks.T)
    for at in range(0, len(asks), TILE):
        upto = min(len(asks), at + TILE)
        hits = np.zeros((upto - at, len(gives)), np.uint8)
        for p in range(PROJECTIONS):
            hits += (columns[p][None, :] - start[at:upto, p, None]) < length[at:upto, p, None]
        i, j = np.nonzero(hits >= least)
        i, j = asks[i + at], gives[j]
        if alone:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), 1 << 17):
            a, b = i[c : c + (1 << 17)], j[c : c + (1 << 17)]
            good = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
            yield a[good], b[good]


def _meet(threshold: float, half: float, least: int):
    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["second", "rep"]).reset_index(drop=True)
        alone = bool(frame["alone"].iloc[0])
        n_first = len(frame) if alone else int((~frame["second"]).sum())
        if n_first == 0 or (not alone and n_first == len(frame)):
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        x = np.stack([np.asarray(v, np.float64) for v in frame["v"]])
        x /= np.abs(x).max(axis=1, keepdims=True)
        units = x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
        reps, copies = frame["rep"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64)
        links, label = np.zeros(len(frame), np.int64), np.arange(len(frame))
        for i, j in linked(units, n_first, alone, threshold, half, least):
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            while len(i):  # the smallest label spreads until both ends of every link agree
                small = np.minimum(label[i], label[j])
                apart = label[i] != label[j]
                i, j, small = i[apart], j[apart], small[apart]
                target = np.arange(len(frame))
                np.minimum.at(target, label[i], small)
                np.minimum.at(target, label[j], small)
                label = target[label]
        root = np.full(len(frame), np.iinfo(np.int64).max)
        np.minimum.at(root, label, reps)
        some = links > 0
        return pd.DataFrame({"rep": reps[some], "links": links[some], "root": root[label][some]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row with columns vec_id and embedding.

    Vectors link at cosine ``threshold`` or more, in double precision, with those of their own
    number of components. Vectors that are null, zero or empty or hold null or non-finite
    components link with nothing and are their own component. Equal vectors are linked; each counts.
    Repeated rows with one vec_id count as vectors of their own. A null vec_id gets a null
    component if no linked vector has an id.

    The projections leave out a share of far pairs but not their growth: the work is quadratic in
    the distinct vectors, in blocks of bounded memory.
    """
    half = REACH * sqrt(2 - 2 * threshold)
    least = calibrated_count()
    size = F.exists("embedding", lambda x: x != 0)
    rows = cut(vectors.select("vec_id", F.when(usable(F.col("embedding")) & size, F.col("embedding")).alias("v")))
    classes = rows.filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
    # a number for each distinct vector, of its own even where vectors share an id; stored, so it is final
    classes = classes.withColumn("rep", F.monotonically_increasing_id())
    classes = cut(classes.select("rep", "first_id", "copies", "v"))
    celled = classes.select("rep", "copies", "v").mapInPandas(_cells(half), "rep long, copies long, v array<double>, cell int, dims int")
    celled = cut(celled)
    parts = celled.groupBy("dims", "cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    near = parts.select("dims", F.col("cell").alias("next"), F.col("parts").alias("next_parts"))
    meets = parts.join(near, "dims").filter("next BETWEEN cell AND cell + 1")
    own = meets.select("dims", "cell", "parts", "next", "next_parts")

    def placed(on: str, of: str):
        joined = celled.withColumnRenamed("cell", on).join(own, ["dims", on])
        return joined.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col(of)).cast("int"))

    first = placed("cell", "parts")
    second = placed("next", "next_parts")
    same = F.col("cell") == F.col("next")
    # within a cell part p meets the parts from p on; a part of the next cell meets all of this one
    a = first.withColumn("other", F.explode(F.sequence(F.when(same, F.col("mine")).otherwise(0), F.col("next_parts") - 1)))
    a = a.select("dims", "cell", "next", F.col("mine").alias("p"), F.col("other").alias("q"), F.lit(False).alias("second"), (same & (F.col("mine") == F.col("other"))).alias("alone"), "rep", "copies", "v")
    b = second.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(same, F.col("mine")).otherwise(F.col("parts") - 1))))
    b = b.filter(~(same & (F.col("mine") == F.col("other"))))
    b = b.select("dims", "cell", "next", F.col("other").alias("p"), F.col("mine").alias("q"), F.lit(True).alias("second"), F.lit(False).alias("alone"), "rep", "copies", "v")
    found = cut(a.unionByName(b).groupBy("dims", "cell", "next", "p", "q").applyInPandas(_meet(threshold, half, least), "rep long, links long, root long"))

    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found, "rep", "root").withColumnRenamed("node", "rep")
    named = classes.join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component"))
    known = named.join(smallest, "root").join(counts, "rep", "left").select("v", "copies", "component", "links")
    out = rows.join(known, "v", "left")
    component = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    out = out.select("vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
