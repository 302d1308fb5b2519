"""Forests as rows against plain trees, plain walks and known signals."""

import numpy as np
import pandas as pd
import pytest
from conftest import stamps
from pyspark.sql import functions as F

from loadcast.operators import fleet
from loadcast.operators.forest import ForestParams, params_frame
from loadcast.operators.splits import fold_contiguous, fold_expanding

FEATURES = ["a", "b", "c"]


def signal(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    x[:, 2] = np.round(x[:, 2])  # few values
    return x, 3 * np.sin(2 * x[:, 0]) + x[:, 2] + 0.1 * rng.normal(size=n)


def frame(spark, series, n=240):
    parts = []
    for k, name in enumerate(series):
        x, y = signal(n, k)
        parts.append(pd.DataFrame(x, columns=FEATURES).assign(site_id="S1", target=name, ts=stamps("2024-01-01", n), y=y))
    return spark.createDataFrame(pd.concat(parts))


def bins_of(x):
    edges = [fleet.edges_of(x[:, f]) for f in range(x.shape[1])]
    return np.column_stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]).astype(np.uint8), edges


def plain_gain(bins, weight, y, min_leaf):
    """Most squared error that one split saves, each feature and cut in turn."""
    whole = (weight * y).sum() ** 2 / weight.sum()
    best = -np.inf
    for f in range(bins.shape[1]):
        for cut in range(fleet.BINS):
            left = bins[:, f] <= cut
            sizes = weight[left].sum(), weight[~left].sum()
            if min(sizes) >= min_leaf:
                best = max(best, (weight * y)[left].sum() ** 2 / sizes[0] + (weight * y)[~left].sum() ** 2 / sizes[1] - whole)
    return best


@pytest.mark.parametrize("min_leaf", [2, 7])
def test_every_split_is_the_best_one(min_leaf):
    x, y = signal(150, 3)
    bins, _ = bins_of(x)
    trees = fleet.grow(bins, y, 3, 3, min_leaf, np.random.default_rng(8))
    weights = np.random.default_rng(8).multinomial(150, np.full(150, 1 / 150), size=3).astype(float)
    inner = 0
    for k in range(3):
        rows = {k: np.flatnonzero(weights[k])}
        while rows:
            node, mine = rows.popitem()
            w = weights[k][mine]
            assert trees["tree"][node] == k and trees["weight"][node] == w.sum() >= min_leaf
            np.testing.assert_allclose(trees["value"][node], (w * y[mine]).sum() / w.sum())
            best = plain_gain(bins[mine], w, y[mine] - y.mean(), min_leaf)
            if trees["feature"][node] < 0:
                assert best <= 1e-9
                continue
            inner += 1
            np.testing.assert_allclose(trees["gain"][node], best, rtol=1e-6, atol=1e-9)
            left = bins[mine, trees["feature"][node]] <= trees["cut"][node]
            rows[trees["left"][node]], rows[trees["right"][node]] = mine[left], mine[~left]
    assert inner > 20


def test_each_split_looks_at_the_drawn_features_only():
    x, y = signal(200, 1)
    bins, _ = bins_of(x)
    trees = fleet.grow(bins, y, 40, 1, 5, np.random.default_rng(2))
    roots = trees["feature"][:40]
    assert set(roots.tolist()) == {0, 1, 2}  # the noise too, where it is all that was drawn
    assert set(fleet.grow(bins, y, 40, 3, 5, np.random.default_rng(2))["feature"][:40].tolist()) <= {0, 2}
    assert [fleet.features_drawn(r, 20) for r in ("all", "sqrt", "log2")] == [20, 4, 4] and fleet.features_drawn("log2", 1) == 1


def test_edges_keep_few_values_apart():
    assert fleet.edges_of(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5]
    assert len(fleet.edges_of(np.arange(1000.0))) == fleet.BINS - 1 and len(fleet.edges_of(np.ones(9))) == 0


def walk(tree, x):
    node = 0
    while tree["feature"][node] >= 0:
        node = tree["left"][node] if x[tree["feature"][node]] <= tree["threshold"][node] else tree["right"][node]
    return tree["value"][node]


def test_fit_and_predict(spark):
    panel = frame(spark, ["p", "q"])
    params = params_frame(spark, {("S1", "p"): ForestParams(60, "all", 2), ("S1", "q"): ForestParams(20, "sqrt", 9)})
    trees = fleet.fit_fleet(panel, FEATURES, params).cache()
    rows = trees.collect()
    assert {k: sorted(r["tree"] for r in rows if r["target"] == k) for k in "pq"} == {"p": list(range(60)), "q": list(range(20))}
    assert all(w >= 9 for r in rows if r["target"] == "q" for w, f in zip(r["weight"], r["feature"]) if f < 0)
    # A short span, so that rows of a series lie in several tasks; columns in another order; an unknown feature.
    asked = panel.select("ts", "site_id", *FEATURES[::-1], "target", "y").unionByName(
        panel.limit(1).withColumn("a", F.lit(None).cast("double")).withColumn("ts", F.lit("2025-01-01").cast("timestamp"))
    ).unionByName(panel.limit(1).withColumn("target", F.lit("none")))
    got = fleet.predict_fleet(asked, trees, ["site_id", "target", "ts", "y"], span=86400 // 4).toPandas()
    assert len(got) == 481 and got["yhat"].isna().sum() == 1 and set(got["target"]) == {"p", "q"}
    known = {(r["target"], pd.Timestamp(r["ts"])): r for r in panel.collect()}
    for r in got[got["yhat"].notna()].iloc[::17].itertuples():
        x = [known[r.target, r.ts][f] for f in FEATURES]
        np.testing.assert_allclose(r.yhat, np.mean([walk(t, x) for t in rows if t["target"] == r.target]))
    near = got[(got["target"] == "p") & got["yhat"].notna()]
    assert ((near["y"] - near["yhat"]) ** 2).mean() < 0.1 * near["y"].var()
    with pytest.raises(Exception, match="missing model features"):
        fleet.predict_fleet(panel.drop("b"), trees).collect()


def test_masks_of_leaves_reach_what_a_walk_reaches(monkeypatch):
    x, y = signal(700, 4)
    bins, edges = bins_of(x)
    trees = []
    for min_leaf in (1, 3, 90, 400):  # several words of leaves, one word, no split at all
        t = fleet.grow(bins, y, 2, 2, min_leaf, np.random.default_rng(min_leaf))
        for k in range(2):
            mine = np.flatnonzero(t["tree"] == k)
            # Children numbered before their parents, as no rule orders nodes but that the root is 0.
            mine = np.concatenate([mine[:1], mine[:0:-1]])
            number = np.zeros(len(t["tree"]) + 1, int)
            number[mine] = np.arange(len(mine))
            cut = [edges[f][c] if f >= 0 else None for f, c in zip(t["feature"][mine], t["cut"][mine])]
            trees.append(pd.Series({
                "feature": t["feature"][mine], "threshold": cut, "left": number[t["left"][mine]], "right": number[t["right"][mine]], "value": t["value"][mine],
            }))
    leaves = [(t["feature"] < 0).sum() for t in trees]
    assert max(leaves) > 2 * fleet.WORD and min(leaves) == 1
    asked = np.concatenate([x, np.column_stack([edges[0][:5]] * 3), x[:1] + [[np.inf, -np.inf, 0]]])
    got = np.zeros(len(asked))
    fleet.LeafMasks(trees).add(asked, got)
    plain = np.zeros(len(asked))
    for t in trees:
        plain += [walk(t, row) for row in asked]
    assert (got == plain).all()
    assert all(len(t["feature"]) <= fleet.MASKED_NODES for t in trees)
    for most in (10**9, 0):  # small trees by masks, large ones by a walk
        monkeypatch.setattr(fleet, "MASKED_NODES", most)
        got = np.zeros(len(asked))
        fleet.add_trees(trees, asked, got)
        assert (got == plain).all()


def test_rules_that_draw_as_many_features_are_fitted_once(spark):
    names = [f"f{k}" for k in range(18)]
    assert fleet.features_drawn("log2", 18) == fleet.features_drawn("sqrt", 18) == 4
    panel = frame(spark, ["p"], 60).select("site_id", "target", "ts", "y", *[(F.col("a") * k + F.col("b")).alias(n) for k, n in enumerate(names)])
    grid = [ForestParams(t, rule, 5) for t in (50, 100) for rule in ("log2", "sqrt", "all")]
    assert {k: len(v) for k, v in fleet._nested(grid, 18).items()} == {(4, 5): 4, (18, 5): 2}
    scores = fleet.tune_fleet(panel, names, grid).toPandas()
    assert len(scores) == 18 and set(scores["param_order"]) == set(range(6))
    mse = scores.set_index(["param_order", "fold"])["mse"]
    assert (mse.loc[0] == mse.loc[1]).all() and (mse.loc[3] == mse.loc[4]).all() and (mse.loc[0] != mse.loc[2]).all()
    alone = fleet.tune_fleet(panel, names, grid[4:5]).toPandas().set_index("fold")["mse"]
    assert (alone.sort_index() == mse.loc[4].sort_index()).all()


@pytest.mark.parametrize("folds", ["contiguous", "expanding"])
def test_tuning_scores_every_number_of_trees(spark, folds):
    panel = frame(spark, ["p"], 90)
    grid = [ForestParams(t, rule, leaf) for t in (50, 100) for rule, leaf in (("all", 2), ("log2", 8))]
    scores = fleet.tune_fleet(panel, FEATURES, grid, folds).toPandas()
    assert len(scores) == 12 and set(scores["param_order"]) == {0, 1, 2, 3}
    label = {"contiguous": fold_contiguous, "expanding": fold_expanding}[folds]
    rows = label(panel, ["site_id", "target"], 3).orderBy("ts").toPandas()
    bins, _ = bins_of(rows[FEATURES].to_numpy())
    y, fold = rows["y"].to_numpy(), rows["fold"].to_numpy()
    for r in scores.itertuples():
        tested = fold == r.fold
        use = ~tested if folds == "contiguous" else fold < r.fold
        assert r.n_rows == tested.sum()
        guess = np.zeros(tested.sum())
        for block in range(r.params["trees"] // 50):
            draw = fleet.features_drawn(r.params["features"], 3)
            t = fleet.grow(bins[use], y[use], 50, draw, r.params["min_leaf"], fleet._seed(42, "S1", "p", r.fold, block))
            for i, x in enumerate(bins[tested]):
                for k in range(50):
                    node = k
                    while t["feature"][node] >= 0:
                        node = t["left"][node] if x[t["feature"][node]] <= t["cut"][node] else t["right"][node]
                    guess[i] += t["value"][node]
        np.testing.assert_allclose(r.mse, ((y[tested] - guess / r.params["trees"]) ** 2).mean())
    with pytest.raises(ValueError, match="multiples"):
        fleet.tune_fleet(panel, FEATURES, [ForestParams(60, "all", 2)])


def test_importances(spark):
    panel = frame(spark, ["p"])
    trees = fleet.fit_fleet(panel.withColumn("d", F.lit(1.0)), [*FEATURES, "d"], params_frame(spark, {("S1", "p"): ForestParams(50, "all", 2)})).cache()
    got = fleet.importances_of(trees).orderBy("rank").collect()
    assert [r["feature"] for r in got] == ["a", "c", "b", "d"] and [r["rank"] for r in got] == [1, 2, 3, 4]
    assert got[-1]["importance"] == 0 and abs(sum(r["importance"] for r in got) - 1) < 1e-9
    share = np.zeros(4)
    for t in trees.collect():
        own = np.bincount([f for f in t["feature"] if f >= 0], [g for g, f in zip(t["gain"], t["feature"]) if f >= 0], 4)
        share += own / own.sum() / 50
    np.testing.assert_allclose([r["importance"] for r in sorted(got, key=lambda r: r["feature"])], share)


def test_a_thousand_series_are_one_plan(spark, tmp_path):
    hours = spark.range(24).select(F.col("id"), F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("ts"))
    panel = spark.range(1000).select(F.lit("S1").alias("site_id"), F.concat(F.lit("t"), "id").alias("target"), F.col("id").alias("k")).crossJoin(hours).select(
        "site_id", "target", "ts", F.sin("id").alias("a"), F.cos("id").alias("b"), (F.sin("id") * F.col("k")).alias("y")
    )
    params = panel.select("site_id", "target").distinct().withColumn("params", F.expr("named_struct('trees', 2, 'features', 'all', 'min_leaf', 2)"))
    fleet.save_fleet(fleet.fit_fleet(panel, ["a", "b"], params), str(tmp_path / "trees"))
    trees = fleet.load_fleet(spark, str(tmp_path / "trees"))
    out = fleet.predict_fleet(panel.drop("y"), trees)
    assert "Union" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("yhat IS NOT NULL").groupBy("target").count().where("count = 24").count() == 1000
    registry = fleet.registry_of(trees).collect()
    assert len(registry) == 1000 and {(r["trees"], tuple(r["features"])) for r in registry} == {(2, ("a", "b"))}
