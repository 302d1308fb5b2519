"""Regression forests of many series in one job: trees are rows, fitted and read by Spark tasks.

``forest.py`` fits one series by one distributed job, for series too long for a task. Here the work is the other way
round: a series' binned rows are one packed row (one byte per row and feature, about a megabyte per year and 25
features), and every (series, fold, parameters, block of trees) is a task of its own. Any number of series, folds and
grid points is one plan, with no model on the driver.

Trees of a forest are independent, and a block of trees draws from its own seed. So the first 100 trees of a forest of
500 are the forest of 100, and one fit scores every number of trees of the grid.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s
from ..session import ship_package, stage
from .forest import FOLDS, PARAMS_SCHEMA, SERIES, ForestParams
from .ordered import GRID_CHUNK, chunk_of
from .splits import fold_contiguous, fold_expanding

# Values a feature is told apart by, and trees of a block, which is what one task grows.
BINS = 32
BLOCK_TREES = 50
MAX_DEPTH = 40
# Cells of the histograms that are looked at in one go, few enough for a core's cache.
GO_CELLS = 1 << 15
# Bits of the words that tell which leaves of a tree a row can still reach, and words looked at in one go.
WORD = 64
GO_WORDS = 1 << 16
# Trees of more nodes are walked down: their masks would be longer than their paths.
MASKED_NODES = 2 * 8 * WORD
# Time span of the rows that a task reads with its own copy of the trees: 10,752 quarter-hours.
READ_SPAN = 4 * GRID_CHUNK

_KEYS = "site_id string, target string"
TREE_SCHEMA = (
    f"{_KEYS}, tree int, features array<string>, feature array<int>, threshold array<double>, left array<int>, "
    "right array<int>, value array<double>, weight array<double>, gain array<double>"
)
_PACKED = f"{_KEYS}, features array<string>, n_rows int, bins binary, edges array<array<double>>, y binary, fold binary"


def edges_of(x: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins`` - 1 thresholds between the values of a feature: all of them, or quantiles."""
    known = np.unique(x)
    if len(known) <= bins:
        return (known[1:] + known[:-1]) / 2
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _pack(features: Sequence[str], bins: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_at")
        edges = [edges_of(rows[f].to_numpy(float), bins) for f in features]
        placed = np.column_stack([np.searchsorted(e, rows[f].to_numpy(float)) for e, f in zip(edges, features)]).astype(np.uint8)
        return pd.DataFrame(
            [[*key, list(features), len(rows), placed.tobytes(), [e.tolist() for e in edges],
              rows["y"].to_numpy("<f8").tobytes(), rows["fold"].to_numpy("<i1").tobytes()]],
            columns=[c.split()[0] for c in _PACKED.split(", ")],
        )

    return run


def packed_series(panel: DataFrame, features: Sequence[str], fold: str | None = None, ts: str = "ts", bins: int = BINS) -> DataFrame:
    """One row per series: its rows in time order as bins, targets and fold numbers.

    Bins come from the features of all rows given, targets take no part in them. Features and target must be known.
    """
    ship_package(panel.sparkSession)
    labels = F.lit(0) if fold is None else F.col(fold)
    rows = panel.select(*SERIES, epoch_s(ts).alias("_at"), F.col("y").cast("double").alias("y"), labels.cast("int").alias("fold"),
                        *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    return rows.groupBy(*SERIES).applyInPandas(_pack(list(features), bins), _PACKED)


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(row.bins, np.uint8).reshape(row.n_rows, len(row.features))
    return bins, np.frombuffer(row.y, "<f8"), np.frombuffer(row.fold, "<i1")


def features_drawn(rule: str, n: int) -> int:
    """Features that each split chooses from."""
    return {"all": n, "sqrt": max(1, int(np.sqrt(n))), "log2": max(1, int(np.log2(n)))}[rule]


def grow(bins: np.ndarray, y: np.ndarray, trees: int, draw: int, min_leaf: int, rng: np.random.Generator, n_bins: int = BINS) -> dict[str, np.ndarray]:
    """Regression trees on bootstrap samples of the rows, all trees level by level at once.

    Each split is the one of the drawn features and bins that leaves the smallest squared error with ``min_leaf`` rows on
    both sides. Nodes of all trees are numbered together: ``tree``, ``feature`` (-1 in a leaf), ``cut`` (last bin on the
    left), ``left``, ``right``, ``value``, ``weight`` (rows) and ``gain`` (squared error saved).
    """
    n, width = bins.shape
    center = y.mean() if n else 0.0
    drawn = rng.multinomial(n, np.full(n, 1 / n), size=trees)
    tree, row = np.nonzero(drawn)
    weight = drawn[tree, row].astype(float)
    error = weight * (y[row] - center)
    node = tree.copy()
    made: list[dict[str, np.ndarray]] = []
    first, of_tree, active = 0, np.arange(trees), np.ones(trees, bool)
    for depth in range(MAX_DEPTH + 1):
        count = len(of_tree)
        total = np.bincount(node - first, weight, count)
        summed = np.bincount(node - first, error, count)
        level = {
            "tree": of_tree, "feature": np.full(count, -1), "cut": np.full(count, -1), "left": np.full(count, -1), "right": np.full(count, -1),
            "value": center + summed / total, "weight": total, "gain": np.zeros(count),
        }
        made.append(level)
        open_nodes = np.flatnonzero(active & (total >= 2 * min_leaf))
        if depth == MAX_DEPTH or not len(open_nodes):
            break
        # Rows in node order, so that a stretch of nodes is a stretch of rows.
        place = np.full(count, -1)
        place[open_nodes] = np.arange(len(open_nodes))
        keep = place[node - first] >= 0
        node, row, weight, error = node[keep], row[keep], weight[keep], error[keep]
        at = place[node - first]
        order = np.argsort(at, kind="stable")
        at, node, row, weight, error = at[order], node[order], row[order], weight[order], error[order]
        chosen = np.argsort(rng.random((len(open_nodes), width)), axis=1)[:, :draw]
        best = [
            _best_splits(bins, chosen[a:b], at[i:j] - a, row[i:j], weight[i:j], error[i:j], min_leaf, n_bins)
            for a, b, i, j in _stretches(at, len(open_nodes), draw * n_bins)
        ]
        feature, cut, gain = (np.concatenate(x) for x in zip(*best))
        split = gain > 1e-12 * max(1.0, float(np.abs(y).max(initial=0.0))) ** 2
        nodes, below = open_nodes[split], first + count
        level["feature"][nodes], level["cut"][nodes], level["gain"][nodes] = feature[split], cut[split], gain[split]
        level["left"][nodes] = below + 2 * np.arange(len(nodes))
        level["right"][nodes] = level["left"][nodes] + 1
        if not len(nodes):
            break
        down = split[at]
        node, row, weight, error = node[down] - first, row[down], weight[down], error[down]
        right = bins[row, level["feature"][node]] > level["cut"][node]
        node = level["left"][node] + right
        first, of_tree = below, np.repeat(of_tree[nodes], 2)
        active = np.ones(len(of_tree), bool)
    return {k: np.concatenate([level[k] for level in made]) for k in made[0]}


def _stretches(at: np.ndarray, nodes: int, cells: int) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of nodes whose histograms have at most ``GO_CELLS`` cells, with their stretches of rows."""
    step = max(1, GO_CELLS // cells)
    for a in range(0, nodes, step):
        b = min(a + step, nodes)
        yield a, b, *np.searchsorted(at, [a, b]).tolist()


def _best_splits(bins, chosen, at, row, weight, error, min_leaf, n_bins):
    """Best (feature, cut, gain) of each node, by histograms of its rows over its drawn features."""
    nodes, draw = chosen.shape
    place = row[:, None] * bins.shape[1] + chosen[at]
    cell = ((at[:, None] * draw + np.arange(draw)) * n_bins + bins.ravel()[place]).ravel()
    shape = nodes, draw, n_bins
    left = np.bincount(cell, np.repeat(weight, draw), nodes * draw * n_bins).reshape(shape)
    moved = np.bincount(cell, np.repeat(error, draw), nodes * draw * n_bins).reshape(shape)
    np.cumsum(left, axis=2, out=left)
    np.cumsum(moved, axis=2, out=moved)
    total, summed = left[:, :1, -1:], moved[:, :1, -1:]
    right = total - left
    lacking = np.minimum(left, right) < min_leaf
    # Cuts with an empty side are among the lacking ones.
    with np.errstate(divide="ignore", invalid="ignore"):
        base = (summed**2 / total)[:, 0, 0]
        rest = summed - moved
        np.divide(np.square(rest, out=rest), right, out=rest)
        np.divide(np.square(moved, out=moved), left, out=moved)
    saved = np.add(moved, rest, out=moved)
    saved[lacking] = -np.inf
    flat = saved.reshape(nodes, -1)
    pick = flat.argmax(axis=1)
    gain = flat[np.arange(nodes), pick] - base
    return chosen[np.arange(nodes), pick // n_bins], pick % n_bins, np.where(np.isfinite(gain), gain, -1.0)


def reached(trees: dict[str, np.ndarray], roots: np.ndarray, goes_left) -> np.ndarray:
    """Leaf of every row in every tree (trees x rows); ``goes_left(nodes)`` tells it for an array of that shape."""
    node = roots
    while True:
        inner = trees["feature"][node] >= 0
        if not inner.any():
            return node
        node = np.where(inner, np.where(goes_left(node), trees["left"][node], trees["right"][node]), node)


class LeafMasks:
    """Trees read by masks of leaves: a row looks up one mask per feature instead of walking each tree down.

    Leaves are numbered from left to right, a bit each. A node that sends a row right takes the leaves under its left
    child away, and the first leaf that all nodes leave is the one that the row reaches. Which nodes of a feature do so
    is known by the number of their thresholds below the row's value, so the masks of a feature are one table.
    """

    def __init__(self, trees: Sequence):
        sizes = [len(t.feature) for t in trees]
        roots = np.cumsum([0, *sizes[:-1]])
        shift = np.repeat(roots, sizes)
        feature, left, right = (np.concatenate([np.asarray(getattr(t, c), int) for t in trees]) for c in ("feature", "left", "right"))
        threshold, value = (np.concatenate([np.asarray(getattr(t, c), float) for t in trees]) for c in ("threshold", "value"))
        left, right, inner = left + shift, right + shift, feature >= 0
        levels = [roots]
        while len(top := levels[-1][inner[levels[-1]]]):
            levels[-1] = top
            levels.append(np.concatenate([left[top], right[top]]))
        leaves, first = np.where(inner, 0, 1), np.zeros(len(feature), int)
        for top in levels[-2::-1]:
            leaves[top] = leaves[left[top]] + leaves[right[top]]
        for top in levels[:-1]:
            first[left[top]], first[right[top]] = first[top], first[top] + leaves[left[top]]
        words = -(-leaves[roots] // WORD)
        self.start, self.words, self.width = np.cumsum(words) - words, words, int(words.sum())
        start = np.repeat(self.start, sizes)
        self.value = np.zeros(self.width * WORD)
        self.value[(start * WORD + first)[~inner]] = value[~inner]
        # Words that each inner node takes leaves from.
        node = np.flatnonzero(inner)
        a, b = first[node], first[node] + leaves[left[node]]
        spans = (b - 1) // WORD - a // WORD + 1
        k = np.repeat(np.arange(len(node)), spans)
        word = a[k] // WORD + np.arange(len(k)) - np.repeat(np.cumsum(spans) - spans, spans)
        kept = ~(_low_bits(b[k] - word * WORD) ^ _low_bits(a[k] - word * WORD))
        self.tables = []
        for f in np.unique(feature[node]):
            own = feature[node[k]] == f
            cuts, at = np.unique(threshold[node[k[own]]], return_inverse=True)
            table = np.full((len(cuts) + 1, self.width), ~np.uint64(0))
            np.bitwise_and.at(table, (at + 1, start[node[k[own]]] + word[own]), kept[own])
            self.tables.append((f, cuts, np.bitwise_and.accumulate(table, axis=0)))

    def add(self, x: np.ndarray, total: np.ndarray) -> None:
        """Add what each row of ``x`` reaches to ``total``, tree by tree."""
        step = min(len(x), max(1, GO_WORDS // self.width))
        stays, kept = (np.empty((step, self.width), np.uint64) for _ in range(2))
        for i in range(0, len(x), step):
            rows = x[i : i + step]
            alive, masks = stays[: len(rows)], kept[: len(rows)]
            alive[:] = ~np.uint64(0)
            for f, cuts, table in self.tables:
                alive &= table.take(np.searchsorted(cuts, rows[:, f]), axis=0, out=masks, mode="clip")
            # The lowest bit left; a word without any hands over to the next word of its tree.
            np.subtract(alive, np.uint64(1), out=masks)
            leaf = np.bitwise_count(np.bitwise_and(np.invert(alive, out=alive), masks, out=masks)).astype(int)
            for r in range(self.words.max() - 1, 0, -1):
                at = self.start[self.words > r] + r - 1
                leaf[:, at] = np.where(leaf[:, at] == WORD, leaf[:, at + 1] + WORD, leaf[:, at])
            if self.words.max() > 1:
                leaf = leaf[:, self.start]
            leaf += self.start * WORD
            for v in self.value.take(leaf.T):
                total[i : i + step] += v


def walked(tree, x: np.ndarray) -> np.ndarray:
    """What each row of ``x`` reaches, going down from the root."""
    node = np.zeros(len(x), int)
    feature, threshold = np.asarray(tree.feature, int), np.asarray(tree.threshold, float)
    left, right = np.asarray(tree.left, int), np.asarray(tree.right, int)
    inner = feature[node] >= 0
    while inner.any():
        goes_left = x[np.arange(len(x)), feature[node]] <= threshold[node]
        node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
        inner = feature[node] >= 0
    return np.asarray(tree.value, float)[node]


def add_trees(trees: Sequence, x: np.ndarray, total: np.ndarray) -> None:
    """Add what each row of ``x`` reaches to ``total``, in the order of the trees."""
    for i in range(0, len(trees), BLOCK_TREES):
        block = trees[i : i + BLOCK_TREES]
        if max(len(t.feature) for t in block) <= MASKED_NODES:
            LeafMasks(block).add(x, total)
        else:
            for t in block:
                total += walked(t, x)


def _low_bits(n: np.ndarray) -> np.ndarray:
    """Words with their lowest n bits set, n taken into 0 to ``WORD``."""
    n = np.clip(n, 0, WORD).astype(np.uint64)
    return np.where(n < WORD, (np.uint64(1) << np.minimum(n, np.uint64(WORD - 1))) - np.uint64(1), ~np.uint64(0))


def _seed(seed: int, site: str | None, target: str | None, fold: int, block: int) -> np.random.Generator:
    return np.random.default_rng([seed, zlib.crc32(f"{site}\0{target}".encode()), fold + 1, block])


def _grown(row, draw: int, use: np.ndarray, fold: int, seed: int) -> dict[str, np.ndarray]:
    bins, y, _ = _unpacked(row)
    if not use.any():
        raise ValueError(f"{row.site_id}, {row.target}: no rows to train on")
    return grow(bins[use], y[use], int(row.trees), draw, int(row.min_leaf), _seed(seed, row.site_id, row.target, fold, int(row.block)))


def _spread(tasks: DataFrame, *keys: str) -> DataFrame:
    """Tasks are few and slow: dealt by key, one task at a time where there are cores."""
    spark = tasks.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    return tasks.repartition(n, *SERIES, *keys)


def _one_at_a_time(df: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on each row, as a table of ``schema``; rows hold whole series, so they are read one by one."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                yield run(row)

    return df.mapInPandas(rows, schema)


def _blocks(params: DataFrame) -> DataFrame:
    """(series, rule, min_leaf, block, trees) of every block of trees of each series' parameters."""
    last = F.floor((F.col("params.trees") - 1) / BLOCK_TREES).cast("int")
    return params.select(*SERIES, "params", F.explode(F.sequence(F.lit(0), last)).alias("block")).select(
        *SERIES, F.col("params.features").alias("rule"), F.col("params.min_leaf").alias("min_leaf"), "block",
        F.least(F.lit(BLOCK_TREES), F.col("params.trees") - F.col("block") * BLOCK_TREES).alias("trees"),
    )


def fit_fleet(panel: DataFrame, features: Sequence[str], params: DataFrame, seed: int = 42, ts: str = "ts") -> DataFrame:
    """The forest of every series that has parameters, one row per tree (``TREE_SCHEMA``).

    ``panel``: rows (site_id, target, ts, y, features) without nulls. ``params``: (site_id, target, params), one row per
    series. Nodes of a tree are numbered from its root, 0; a row goes left where its feature is at most the threshold.
    """
    packed = packed_series(panel, features, ts=ts)
    tasks = _spread(packed.join(_blocks(params), list(SERIES)), "block")

    def run(row) -> pd.DataFrame:
        t = _grown(row, features_drawn(row.rule, len(row.features)), np.ones(row.n_rows, bool), -1, seed)
        edges = [np.asarray(e, float) for e in row.edges]
        out = []
        for k in range(int(row.trees)):
            mine = np.flatnonzero(t["tree"] == k)
            number = np.full(len(t["tree"]) + 1, -1)
            number[mine] = np.arange(len(mine))
            cut = [edges[f][c] if f >= 0 else None for f, c in zip(t["feature"][mine], t["cut"][mine])]
            out.append([
                row.site_id, row.target, int(row.block) * BLOCK_TREES + k, list(row.features), t["feature"][mine].tolist(), cut,
                number[t["left"][mine]].tolist(), number[t["right"][mine]].tolist(), t["value"][mine].tolist(),
                t["weight"][mine].tolist(), t["gain"][mine].tolist(),
            ])
        return pd.DataFrame(out, columns=[c.split()[0] for c in TREE_SCHEMA.split(", ")])

    return _one_at_a_time(tasks, run, TREE_SCHEMA)


def predict_fleet(rows: DataFrame, trees: DataFrame, keep: Sequence[str] = (*SERIES, "ts"), ts: str = "ts", span: int = READ_SPAN) -> DataFrame:
    """Mean over the trees for each row of a series that has trees; other series give no rows.

    A task reads one series' rows of one time span and its trees, so long tables of one series are spread. Features are
    taken by the names stored with the trees; a row with an unknown feature gets null.
    """
    ship_package(rows.sparkSession)
    names = [c for c in rows.columns if c not in (*SERIES, ts) and c not in keep]
    placed = rows.withColumn("_chunk", chunk_of(epoch_s(ts), span))
    spans = placed.select(*SERIES, "_chunk").distinct()
    copies = trees.join(spans, list(SERIES)).select(
        F.col("site_id").alias("_site"), F.col("target").alias("_target"), F.col("_chunk").alias("_span"),
        "tree", "features", "feature", "threshold", "left", "right", "value",
    )
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(part: pd.DataFrame, forest: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(forest):
            return part[list(keep)].assign(yhat=np.nan).iloc[:0]
        use = list(forest["features"].iloc[0])
        if lacking := [f for f in use if f not in part.columns]:
            raise ValueError(f"missing model features: {lacking}")
        x = part[use].to_numpy(float)
        total = np.zeros(len(part))
        add_trees(list(forest.sort_values("tree").itertuples(index=False)), x, total)
        yhat = np.where(np.isnan(x).any(axis=1), np.nan, total / len(forest))
        out = part[list(keep)].assign(yhat=yhat)
        return out.assign(yhat=out["yhat"].astype(object).where(out["yhat"].notna(), None))

    left = placed.select(*dict.fromkeys([*SERIES, *keep, *names]), "_chunk").groupBy(*SERIES, "_chunk")
    return left.cogroup(copies.groupBy("_site", "_target", "_span")).applyInPandas(run, f"{kept}, yhat double")


def importances_of(trees: DataFrame) -> DataFrame:
    """(series, feature, importance, rank): shares of the squared error saved, averaged over trees; rank 1 is the highest.

    A feature that no tree uses has the share 0. Ties are ranked by name.
    """
    saved = trees.select(*SERIES, "tree", "features", F.explode(F.arrays_zip("feature", "gain")).alias("n")).where(F.col("n.feature") >= 0)
    per = saved.groupBy(*SERIES, "tree", F.element_at("features", F.col("n.feature") + 1).alias("feature")).agg(F.sum("n.gain").alias("gain"))
    whole = per.groupBy(*SERIES, "tree").agg(F.sum("gain").alias("whole"))
    shares = per.join(whole, [*SERIES, "tree"]).groupBy(*SERIES, "feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
    counts = whole.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n"))
    every = trees.groupBy(*SERIES).agg(F.first("features").alias("features")).select(*SERIES, F.explode("features").alias("feature"))
    out = every.join(shares, [*SERIES, "feature"], "left").join(counts, list(SERIES), "left")
    ranked = out.select(*SERIES, "feature", F.coalesce(F.col("share") / F.col("n"), F.lit(0.0)).alias("importance"))
    # The features of one model.
    order = "ORDER BY importance DESC, feature"
    return ranked.select("*", F.expr(f"row_number() OVER (PARTITION BY site_id, target {order})").alias("rank"))


def _nested(grid: Sequence[ForestParams], n_features: int) -> dict[tuple[int, int], list[ForestParams]]:
    """Grid points by (features drawn, smallest leaf); numbers of trees are multiples of a block, so that prefixes are whole blocks."""
    out: dict[tuple[int, int], list[ForestParams]] = {}
    for p in grid:
        if p.trees % BLOCK_TREES:
            raise ValueError(f"numbers of trees must be multiples of {BLOCK_TREES}, got {p.trees}")
        out.setdefault((features_drawn(p.features, n_features), p.min_leaf), []).append(p)
    return out


def tune_fleet(
    train: DataFrame, features: Sequence[str], grid: Sequence[ForestParams], folds: str = "contiguous", k: int = FOLDS, seed: int = 42, ts: str = "ts"
) -> DataFrame:
    """Mean squared error of every grid point in every fold, for every series: (series, params, param_order, fold, mse, n_rows).

    ``folds``: ``contiguous`` tests each of k blocks on the others, ``expanding`` on the rows before it. Each (series,
    fold, number of features drawn, smallest leaf) is fitted once, with the most trees that the grid asks for; what fewer
    trees would score is read from the first blocks. Rules that draw as many features of the series grow the same trees.
    """
    label = fold_contiguous if folds == "contiguous" else fold_expanding
    # Staged: the packed series are read once per fold, parameters and block.
    packed = stage(packed_series(label(train, list(SERIES), k, ts), features, "fold", ts), "packed-series")
    nested = _nested(grid, len(features))
    points = [(d, leaf, fold, b) for (d, leaf), same in nested.items() for fold in range(k) for b in range(max(p.trees for p in same) // BLOCK_TREES)]
    wanted = F.array(*[F.struct(F.lit(d).alias("draw"), F.lit(leaf).alias("min_leaf"), F.lit(f).alias("fold_no"), F.lit(b).alias("block")) for d, leaf, f, b in points])
    tasks = packed.select("*", F.explode(wanted).alias("p")).select(*packed.columns, "p.*", F.lit(BLOCK_TREES).alias("trees"))
    done = "site_id string, target string, draw int, min_leaf int, fold_no int, block int, y binary, summed binary"

    def run(row) -> pd.DataFrame:
        bins, y, fold = _unpacked(row)
        tested = fold == row.fold_no
        use = ~tested if folds == "contiguous" else fold < row.fold_no
        t = _grown(row, int(row.draw), use, int(row.fold_no), seed)
        held = bins[tested]
        roots = np.repeat(np.arange(int(row.trees))[:, None], len(held), axis=1)
        leaf = reached(t, roots, lambda node: held[np.arange(len(held)), t["feature"][node]] <= t["cut"][node])
        summed = t["value"][leaf].sum(axis=0)
        return pd.DataFrame(
            [[row.site_id, row.target, row.draw, row.min_leaf, row.fold_no, row.block, y[tested].tobytes(), summed.astype("<f8").tobytes()]],
            columns=[c.split()[0] for c in done.split(", ")],
        )

    blocks = _one_at_a_time(_spread(tasks, "draw", "min_leaf", "fold_no", "block"), run, done)
    order = {p: i for i, p in enumerate(grid)}
    scored = f"{_KEYS}, params {PARAMS_SCHEMA}, param_order int, fold int, mse double, n_rows long"

    def score(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        site, target, draw, leaf, fold = key
        parts = parts.sort_values("block")
        y = np.frombuffer(parts["y"].iloc[0], "<f8")
        sums = np.cumsum([np.frombuffer(s, "<f8") for s in parts["summed"]], axis=0)
        out = []
        for p in nested[int(draw), int(leaf)]:
            guess = sums[p.trees // BLOCK_TREES - 1] / p.trees
            out.append((site, target, asdict(p), order[p], int(fold), float(((y - guess) ** 2).mean()), len(y)))
        return pd.DataFrame(out, columns=["site_id", "target", "params", "param_order", "fold", "mse", "n_rows"])

    return blocks.groupBy(*SERIES, "draw", "min_leaf", "fold_no").applyInPandas(score, scored)


def mean_scores(scores: DataFrame) -> DataFrame:
    """(series, params, param_order, mse): the mean over folds, what ``forest.best_params`` chooses from."""
    return scores.groupBy(*SERIES, "params", "param_order").agg(F.avg("mse").alias("mse"))


def save_fleet(trees: DataFrame, root: str) -> None:
    """Write trees by site, so that a site's job reads its own folder."""
    trees.write.mode("overwrite").partitionBy("site_id").parquet(root)


def load_fleet(spark: SparkSession, root: str) -> DataFrame:
    """Saved trees of all series; a filter on site_id reads one folder, and one on target prunes row groups."""
    names = [c.split()[0] for c in TREE_SCHEMA.split(", ")]
    return spark.read.schema(TREE_SCHEMA).parquet(root).select(*names)


def registry_of(trees: DataFrame) -> DataFrame:
    """One row per saved model: series, trees, feature order, deepest tree's nodes and smallest leaf."""
    leaves = F.filter(F.arrays_zip("feature", "weight"), lambda n: n["feature"] < 0)
    return trees.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("trees"), F.first("features").alias("features"), F.max(F.size("feature")).alias("most_nodes"),
        F.min(F.array_min(F.transform(leaves, lambda n: n["weight"]))).alias("smallest_leaf"),
    )
