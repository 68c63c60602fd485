"""Metrics against direct Python computations on small score tables."""
import random

import pytest

from ontime_spark.operators import evaluate as EV


def _table(n=400, seed=1, ties=True):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = rnd.random() < 0.35
        s = rnd.random() * 0.6 + (0.3 if y else 0.0)
        rows.append((int(y), round(s, 2) if ties else s))
    return rows


def _auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _ap(rows):
    P = sum(y for y, _ in rows)
    out = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        sel = [y for y, s in rows if s >= t]
        tp_here = sum(y for y, s in rows if s == t)
        out += (tp_here / P) * (sum(sel) / len(sel))
    return out


@pytest.mark.parametrize("ties", [True, False])
def test_ranking_metrics(spark, ties):
    rows = _table(ties=ties)
    df = spark.createDataFrame(rows, "label int, score double")
    m = EV.classification_metrics(df).first()
    assert m["roc_auc"] == pytest.approx(_auc(rows), abs=1e-12)
    assert m["pr_auc"] == pytest.approx(_ap(rows), abs=1e-12)
    tp = sum(1 for y, s in rows if y and s > 0.5)
    fp = sum(1 for y, s in rows if not y and s > 0.5)
    P = sum(y for y, _ in rows)
    assert m["precision"] == pytest.approx(tp / (tp + fp))
    assert m["recall"] == pytest.approx(tp / P)
    assert m["accuracy"] == pytest.approx((tp + (len(rows) - P - fp)) / len(rows))


def test_undefined_precision_is_zero(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double")
    m = EV.classification_metrics(df).first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0


def test_threshold_sweep_matches_loop(spark):
    rows = _table(ties=True)
    df = spark.createDataFrame(rows, "label int, score double")
    sweep = {round(r["threshold"], 2): r for r in EV.threshold_sweep(df).collect()}
    assert len(sweep) == 81
    P = sum(y for y, _ in rows)
    for i in range(10, 91):
        t = i / 100
        tp = sum(1 for y, s in rows if y and s >= t)
        fp = sum(1 for y, s in rows if not y and s >= t)
        f1 = 2 * tp / (2 * tp + fp + (P - tp)) if tp + fp + P else 0.0
        assert sweep[round(t, 2)]["f1"] == pytest.approx(f1)
    best = {r["metric"]: r for r in EV.best_thresholds(EV.threshold_sweep(df)).collect()}
    vals = [(sweep[round(i / 100, 2)]["f1"], -i) for i in range(10, 91)]
    assert best["f1"]["threshold"] == pytest.approx(-max(vals)[1] / 100)


def test_sweep_rejects_unknown_metric(spark):
    df = spark.createDataFrame([(1, 0.1)], "label int, score double")
    with pytest.raises(ValueError):
        EV.best_thresholds(EV.threshold_sweep(df), ("auc",))


def test_confusion_matrix_rows_sum_to_one(spark):
    df = spark.createDataFrame(_table(), "label int, score double")
    by_label = {}
    for r in EV.confusion_matrix(df).collect():
        by_label[r["label"]] = by_label.get(r["label"], 0) + r["rate"]
    assert all(v == pytest.approx(1.0) for v in by_label.values())


def test_roc_points_end_at_one(spark):
    df = spark.createDataFrame(_table(), "label int, score double")
    pts = EV.roc_points(df).orderBy("score").collect()
    assert pts[0]["tpr"] == pytest.approx(1.0) and pts[0]["fpr"] == pytest.approx(1.0)


def test_ranking_metrics_bucketed_path(spark, monkeypatch):
    from ontime_spark.operators import cumulative
    monkeypatch.setattr(cumulative, "ROWS_PER_BUCKET", 40)  # force range buckets
    rows = _table(ties=False)
    df = spark.createDataFrame(rows, "label int, score double")
    m = EV.classification_metrics(df).first()
    assert m["roc_auc"] == pytest.approx(_auc(rows), abs=1e-12)
    assert m["pr_auc"] == pytest.approx(_ap(rows), abs=1e-12)


def test_roc_corners_follow_the_plain_rule(spark):
    """Points whose step equals the next one's are left out, over any number of buckets."""
    import random
    rng = random.Random(5)
    rows = []
    for i in range(300):
        tp, fp = rng.choice([(1, 0), (1, 0), (0, 1), (2, 1)])
        rows += [(1, i / 300)] * tp + [(0, i / 300)] * fp
    scored = spark.createDataFrame(rows, "label int, score double")
    steps = {}
    for y, s in rows:
        t = steps.setdefault(s, [0, 0])
        t[1 - y] += 1
    order = sorted(steps, reverse=True)
    p, n = sum(s[0] for s in steps.values()), sum(s[1] for s in steps.values())
    want, tp, fp = {(None, 0.0, 0.0)}, 0, 0
    for i, s in enumerate(order):
        tp, fp = tp + steps[s][0], fp + steps[s][1]
        if i in (0, len(order) - 1) or steps[order[i + 1]] != steps[s]:
            want.add((s, round(tp / p, 9), round(fp / n, 9)))
    for buckets in (1, 7):
        got = {(r["score"], round(r["tpr"], 9), round(r["fpr"], 9)) for r in EV.roc_corners(scored, buckets=buckets).collect()}
        assert got == want and len(want) < 280
