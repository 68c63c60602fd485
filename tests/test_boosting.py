"""Second-order boosting against a plain version that tries every split of every distinct value."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ontime_spark.operators import boosting as B
from ontime_spark.operators import models as M

COLS = ["a", "b", "c"]


def rows(n=400, seed=1, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 40, n) / 4, rng.integers(0, 2, n)]).astype(float)
    y = (x[:, 0] > 6).astype(int) ^ (rng.random(n) < 0.2) ^ ((x[:, 1] > 5) & (x[:, 2] == 1))
    x[rng.random(x.shape) < missing] = np.nan
    return x, y.astype(int)


def frame(spark, x, y):
    data = [(*[None if i % 2 and math.isnan(v) else float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "a double, b double, c double, is_delayed int").repartition(3)


def plain(x, y, s):
    """[(place, feature, threshold, missing_left, value)] of each tree."""
    w = np.where(y == 1, (len(y) - y.sum()) / y.sum(), 1.0)
    margin, out = np.zeros(len(y)), []
    shrink = lambda g: np.sign(g) * max(abs(g) - s.alpha, 0)
    score = lambda g, h: shrink(g) ** 2 / (h + s.reg_lambda)
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        nodes, todo, add = [], [(0, np.ones(len(y), bool))], np.zeros(len(y))
        while todo:
            place, own = todo.pop(0)
            best = None
            if place < 2 ** s.depth - 1:
                for f in range(x.shape[1]):
                    for t in np.unique(x[own, f][~np.isnan(x[own, f])]):
                        for left_missing in (False, True):
                            left = own & np.where(np.isnan(x[:, f]), left_missing, x[:, f] <= t)
                            right = own & ~left
                            if h[left].sum() < s.min_child or h[right].sum() < s.min_child:
                                continue
                            gain = round(score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum())
                                         - score(g[own].sum(), h[own].sum()), 6)
                            if gain > 0 and (best is None or gain > best[0]):
                                best = (gain, f, t, left_missing, left, right)
            value = -s.rate * shrink(g[own].sum()) / (h[own].sum() + s.reg_lambda)
            if best:
                # Above the largest value nothing is but what is missing.
                top = best[2] == np.nanmax(x[:, best[1]])
                nodes.append((place, best[1], math.inf if top else best[2], best[3], None))
                todo += [(2 * place + 1, best[4]), (2 * place + 2, best[5])]
            else:
                nodes.append((place, None, None, None, round(value, 9)))
                add[own] += value
        margin += add
        out.append(sorted(nodes, key=str))
    return out, margin


@pytest.mark.parametrize("s", [B.Settings(rounds=4, depth=3, subsample=1, colsample=1),
                               B.Settings(rounds=10, depth=2, subsample=1, colsample=1, alpha=4.0, reg_lambda=7.0, min_child=12.0, rate=0.5)])
def test_trees_match_plain_version(spark, s):
    x, y = rows()
    model = B.fit(frame(spark, x, y), COLS, "is_delayed", s)
    want, margin = plain(x, y, s)
    got = []
    for t in model.trees:
        got.append(sorted([(int(t["place"][i]), int(t["feature"][i]), float(t["threshold"][i]), bool(t["missing_left"][i]), None) if t["left"][i] >= 0
                           else (int(t["place"][i]), None, None, None, round(float(t["value"][i]), 9)) for i in range(len(t["left"]))], key=str))
    assert got == [[(p, f, None if v is None else float(v), m, z if z is None else float(z)) for p, f, v, m, z in t] for t in want]
    assert np.allclose(model.margins(x), margin)


def test_regularisation_changes_the_trees(spark):
    x, y = rows(missing=0)
    df = frame(spark, x, y)
    leaves = {}
    for name, kw in {"none": {"alpha": 0.0, "reg_lambda": 0.0, "min_child": 0.0}, "l1": {"alpha": 30.0}, "l2": {"reg_lambda": 500.0},
                     "child": {"min_child": 45.0}}.items():
        t = B.fit(df, COLS, "is_delayed", B.Settings(rounds=1, depth=4, subsample=1, colsample=1, **kw)).trees[0]
        leaves[name] = t
    end = lambda t: t["left"] < 0
    assert end(leaves["child"]).sum() < end(leaves["none"]).sum() and leaves["child"]["cover"].min() >= 45
    assert np.abs(leaves["l2"]["value"]).max() < 0.5 * np.abs(leaves["none"]["value"]).max()
    assert (leaves["l1"]["value"][end(leaves["l1"])] == 0).any()


def test_sampling_is_repeatable_and_learns(spark):
    x, y = rows(1500, missing=0.02)
    df = frame(spark, x, y).coalesce(2)
    s = B.Settings(rounds=12, depth=3)
    a, b = B.fit(df, COLS, "is_delayed", s), B.fit(df, COLS, "is_delayed", s)
    assert all((u["threshold"] == v["threshold"]).all() and np.allclose(u["value"], v["value"]) for u, v in zip(a.trees, b.trees))
    assert any((u["feature"][0], u["threshold"][0]) != (a.trees[0]["feature"][0], a.trees[0]["threshold"][0]) for u in a.trees)
    p = 1 / (1 + np.exp(-a.margins(x)))
    assert ((p > 0.5) == y).mean() > 0.75
    out = M.predict(a, df).select("a", "b", "c", "probability_delayed").collect()
    own = np.array([[np.nan if v is None else v for v in r[:3]] for r in out], float)
    assert np.allclose([r[3] for r in out], 1 / (1 + np.exp(-a.margins(own))))


def test_many_values_are_cut_at_quantiles(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(v), None, float("nan")) for v in rng.normal(size=5000)], "a double, b double, c double")
    cuts = B.bin_cuts(df, COLS, 32)
    assert 25 <= len(cuts[0]) <= 31 and cuts[0] == sorted(cuts[0]) and cuts[1] == cuts[2] == []
    counts = np.bincount(np.searchsorted(cuts[0], [r[0] for r in df.collect()]))
    assert counts.max() < 3 * 5000 / 32


def test_save_load_importances_and_edges(spark, tmp_dir):
    x, y = rows(200)
    df = frame(spark, x, y)
    model = M.train_model(df, "xgboost", feature_cols=COLS, gbt_rounds=3)
    M.save_model(model, f"{tmp_dir}/xgboost_model")
    again = M.load_all_models(spark, tmp_dir)["xgboost"]
    assert np.array_equal(again.margins(x), model.margins(x)) and again.settings == model.settings
    top = M.feature_importances(spark, model).collect()
    assert abs(sum(r["importance"] for r in top) - 1) < 1e-9 and top[0]["importance"] >= top[-1]["importance"]
    one = df.withColumn("is_delayed", F.lit(1))
    assert np.isfinite(B.fit(one, COLS, "is_delayed", B.Settings(rounds=2)).margins(x)).all()
    assert B.fit(df.limit(0), COLS, "is_delayed").trees == []


def _some_rows(spark, parts):
    rng = np.random.default_rng(12)
    rows = [(float(a), None if i % 7 == 0 else float(b), int(a + b > 9)) for i, (a, b) in enumerate(rng.integers(0, 10, (600, 2)))]
    return spark.createDataFrame(rows, "a double, b double, is_delayed int").repartition(parts)


def test_sums_added_by_column_give_the_same_trees(spark, monkeypatch):
    df, settings = _some_rows(spark, 3), B.Settings(rounds=3, depth=3, subsample=1.0)
    direct = B.fit(df, ["a", "b"], "is_delayed", settings).trees
    monkeypatch.setattr(B, "DIRECT_TASKS", 0)
    for one, other in zip(direct, B.fit(df, ["a", "b"], "is_delayed", settings).trees, strict=True):
        for name in one:
            if name != "next":
                assert np.allclose(one[name], other[name])


def test_a_level_is_one_job(spark):
    df, jobs = _some_rows(spark, 2).cache(), {}
    for rounds in (1, 4):
        spark.sparkContext.setJobGroup(f"fit-{rounds}", "")
        B.fit(df, ["a", "b"], "is_delayed", B.Settings(rounds=rounds, depth=2, subsample=1.0))
        jobs[rounds] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{rounds}"))
    spark.sparkContext.setJobGroup(None, None)
    assert 0 < jobs[4] - jobs[1] <= 3 * 2
