"""Connected components of a link table, by joins and aggregates over tables kept in the shared folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def stars(own: np.ndarray, met: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what ``links`` connects: each row and column that has one, with the smallest id it reaches.

    Smallest ids pass between rows and columns until nothing changes, so what comes out is no larger than the sides.
    """
    rows, cols = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    some = links[np.ix_(rows, cols)]
    row_id, col_id = own[rows], met[cols]
    row_low, col_low = row_id.copy(), col_id.copy()
    most = np.iinfo(np.int64).max
    while True:
        new_row = np.minimum(row_low, np.where(some, col_low[None, :], most).min(axis=1))
        new_col = np.minimum(col_low, np.where(some, new_row[:, None], most).min(axis=0))
        if (new_row == row_low).all() and (new_col == col_low).all():
            break
        row_low, col_low = new_row, new_col
    return np.concatenate([row_id, col_id]), np.concatenate([row_low, col_low])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable.

    Every node starts as its own component. Each round, a node learns the smallest component among its neighbours and
    tells its own root, then takes its root's root; a third of all links on one node is no harm, since minima combine
    before the shuffle. Ends when a round changes nothing; each round is one kept table.
    """
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select("a", "b")
    both = keep(known.union(known.select("b", "a")).distinct(), "cc-links")
    roots = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "cc-0")
    k = 0
    while True:
        k += 1
        label = roots.select(F.col("node").alias("of"), F.col("component").alias("seen"))
        heard = both.join(label, F.col("b") == F.col("of")).groupBy("a").agg(F.min("seen").alias("low"))
        own = roots.join(heard, F.col("node") == F.col("a"))
        told = own.select("node", "low").union(own.select(F.col("component"), F.col("low")))
        lowest = told.groupBy(F.col("node").alias("of")).agg(F.min("low").alias("low"))
        hooked = roots.join(lowest, F.col("node") == F.col("of"), "left").select(
            "node", F.col("component").alias("was"), F.least("component", "low").alias("component")
        )
        # The roots' roots: a component's name is a node, so it has a row.
        above = hooked.select(F.col("node").alias("of"), F.col("component").alias("above"))
        jumped = hooked.join(above, F.col("component") == F.col("of"), "left")
        after = keep(jumped.select("node", F.least("component", "above").alias("component"), "was"), f"cc-{k}")
        changed = not after.where(F.col("component") != F.col("was")).isEmpty()
        roots = after.select("node", "component")
        if not changed:
            return roots
