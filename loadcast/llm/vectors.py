"""Embedding near-duplicates by an exact metric range join.

Vectors are scaled to unit length, where a cosine bound is a distance bound. Pivots cut the sphere into cells, each
vector's home is the cell of its nearest pivot. By the triangle inequality, a vector within ``r`` of one whose home is
cell c is at most ``2 r`` farther from c's pivot than from its own; since the space is Euclidean, the bound for the
plane halfway between two pivots is tighter, and both are used. Vectors are copied to every cell they can have a
partner in, so each home vector finds all its partners in its own cell, and cells join independently.

Cells are joined in blocks of bounded size, as matrix products in double precision. A block returns, per home vector,
how many partners it has, plus links enough to connect what the block connects: never all
pairs. Vectors equal in every component are joined once, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, python_ready
from .components import components, stars

COSINE = 0.9
MOST_PIVOTS = 256  # chosen from as many sampled vectors; what every task holds is bounded by this
CELL = 2000  # vectors that a cell should have, by which pivots are counted
BLOCK = 4096  # vectors of a side that a task joins at once
_TILE = 512
_BEYOND = 1 << 61  # nodes without an id of their own are numbered from here
_SLACK = 1e-6  # distances are rounded; copies may be too many, never too few


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that squares neither overflow nor vanish."""
    v = np.asarray(vectors, np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Spread over the sample: each next pivot is the vector farthest from those chosen."""
    chosen = [0]
    near = sample @ sample[0]
    for _ in range(1, min(n, len(sample))):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    return sample[np.unique(chosen)]


def cells_of(u: np.ndarray, pivots: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and a mask of the cells it must be in, its home among them."""
    r = np.sqrt(max(0.0, 2 - 2 * cosine)) + _SLACK
    c = u @ pivots.T
    home = c.argmax(axis=1)
    best = c[np.arange(len(u)), home][:, None]
    d, d_home = np.sqrt(np.maximum(0, 2 - 2 * c)), np.sqrt(np.maximum(0, 2 - 2 * best))
    gap = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))[home]
    # Distance to the plane between home pivot and pivot: (best - c) / gap.
    inside = (d - d_home <= 2 * r) & (best - c <= r * gap + _SLACK)
    inside[np.arange(len(u)), home] = True
    return home, inside


def _join_block(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """One block, home vectors (side 0) against vectors of the cell (side 1): partners (b = -1, n) and links (n = 0)."""
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    out = []
    if len(left) and len(right):
        a_id, b_id = left["id"].to_numpy(), right["id"].to_numpy()
        a, b = unit(np.stack(left["v"])), unit(np.stack(right["v"]))
        weight = right["copies"].to_numpy(np.int64)
        for k in range(0, len(a), _TILE):
            own = a_id[k : k + _TILE]
            links = (a[k : k + _TILE] @ b.T >= cosine) & (own[:, None] != b_id[None, :])
            if links.any():
                n = links @ weight
                out.append(pd.DataFrame({"a": own[n > 0], "b": -1, "n": n[n > 0]}))
                x, y = stars(own, b_id, links)
                out.append(pd.DataFrame({"a": x[x != y], "b": y[x != y], "n": 0}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")


def _join(nodes: DataFrame, n: int, cosine: float) -> DataFrame:
    """Partners and links among ``nodes`` (id, v, copies), all of one length; see :func:`_join_block`."""
    sample = nodes.orderBy("code1", "code2").limit(8 * MOST_PIVOTS).select("v").collect()
    pivots = _pivots(unit(np.array([r[0] for r in sample])), min(MOST_PIVOTS, max(1, n // CELL)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            home, inside = cells_of(unit(np.stack(b["v"])), pivots, cosine)
            yield pd.DataFrame({"id": b["id"], "home": home, "cells": [np.flatnonzero(x) for x in inside]})

    placed = keep(nodes.select("id", "v").mapInPandas(place, "id long, home int, cells array<int>"), "vec-cells")
    # A row per cell, so at most two per pivot: how many blocks each side of a cell is cut into.
    homes = {r[0]: r[1] for r in placed.groupBy("home").count().collect()}
    sizes = {r[0]: r[1] for r in placed.select(F.explode("cells").alias("c")).groupBy("c").count().collect()}
    cells = range(len(pivots))
    cuts_a = F.array(*[F.lit(-(-homes.get(c, 0) // BLOCK)) for c in cells])
    cuts_b = F.array(*[F.lit(-(-sizes.get(c, 0) // BLOCK)) for c in cells])
    whole = nodes.select("id", "v", "copies").join(placed, "id")
    spot = lambda cuts: F.pmod(F.xxhash64("id"), F.get(cuts, F.col("cell"))).cast("int")
    every = lambda cuts: F.explode(F.sequence(F.lit(0), F.get(cuts, F.col("cell")) - 1))
    left = whole.select("id", "v", "copies", F.col("home").alias("cell")).where(F.get(cuts_b, F.col("cell")) > 0)
    left = left.select("id", "v", "copies", "cell", F.lit(0).alias("side"), spot(cuts_a).alias("block_a"), every(cuts_b).alias("block_b"))
    right = whole.select("id", "v", "copies", F.explode("cells").alias("cell")).where(F.get(cuts_a, F.col("cell")) > 0)
    right = right.select("id", "v", "copies", "cell", F.lit(1).alias("side"), spot(cuts_b).alias("block_b"), every(cuts_a).alias("block_a"))
    blocks = left.unionByName(right).groupBy("cell", "block_a", "block_b")
    return blocks.applyInPandas(lambda rows: _join_block(rows, cosine), "a long, b long, n long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Links pairs with cosine >= ``cosine``. Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing: no links, themselves as component, kept. Vectors of different lengths are never linked. Rows of
    equal vec_id are vectors of their own. A row without vec_id counts as a link of others, but names no component: its
    own is the smallest id it reaches, null without one, and it is kept if it has no link. An empty table gives no rows.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    v = F.col("embedding")
    big = F.lit(float("inf"))
    sound = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists(v, lambda x: x != 0)
    good = F.coalesce(v.isNotNull() & sound, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(good, v).alias("v"))
    # 128 bits for a vector's components.
    rows = rows.select("vec_id", "v", *[F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(k), "v")).alias(f"code{k}") for k in (1, 2)])
    # Equal vectors once: the smallest id and the number stand for them. Rows without id are nodes beyond all ids.
    distinct = rows.where(F.col("v").isNotNull()).groupBy("code1", "code2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v")
    )
    beyond = F.lit(_BEYOND) + F.pmod(F.xxhash64("code1", "code2"), F.lit(_BEYOND))
    # Two vectors under one repeated id stay two nodes: only the first of an id goes by it.
    first = distinct.groupBy("least").agg(F.min(F.struct("code1", "code2")).alias("first")).withColumnRenamed("least", "of")
    named = distinct.join(first, F.col("least") == F.col("of"), "left")
    goes = F.col("least").isNotNull() & (F.struct("code1", "code2") == F.col("first"))
    nodes = keep(named.select("code1", "code2", "least", "copies", "v", F.when(goes, F.col("least")).otherwise(beyond).alias("id")), "vec-nodes")
    found = None
    for r in nodes.groupBy(F.size("v").alias("length")).count().collect():  # lengths of vectors: few
        one = keep(_join(nodes.where(F.size("v") == r["length"]), r["count"], cosine), "vec-links")
        found = one if found is None else found.union(one)
    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    twins = nodes.where(F.col("least").isNotNull()).select("id", "least")
    grouped = components(found.where(F.col("b") != -1).select("a", "b"))
    others = found.where(F.col("b") == -1).groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("others"))
    joined = twins.select("id").union(nodes.where(F.col("least").isNull()).select("id"))
    root = joined.join(grouped, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("root"))
    # The smallest id in a component, which a node beyond the ids can lead only if no other is there.
    low = root.join(twins, "id", "left").groupBy("root").agg(F.min("least").alias("low"))
    of_node = root.join(low, "root").select(F.col("id").alias("node"), "low")
    classes = nodes.select("code1", "code2", "id", "copies").join(others, F.col("id") == F.col("of"), "left")
    classes = classes.join(of_node, F.col("id") == F.col("node"), "left").select(
        F.col("code1").alias("c1"), F.col("code2").alias("c2"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), "low"
    )
    out = rows.drop("v").join(classes, (F.col("code1") == F.col("c1")) & (F.col("code2") == F.col("c2")), "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    own = F.when(F.col("code1").isNull(), F.col("vec_id")).otherwise(F.col("low"))
    kept = F.when(F.col("vec_id").isNull(), n == 0).otherwise(F.col("vec_id") == own)
    return out.select("vec_id", n.alias("n_links"), own.alias("component_id"), kept.alias("kept"))
