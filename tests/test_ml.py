"""Features, split, quantiles, AUC, boosted trees and TreeSHAP."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tvpulse.ml import evaluate as ME
from tvpulse.ml import explain as X
from tvpulse.ml import features as MF
from tvpulse.ml import model as MM
from tvpulse.plans.pipeline import Pipeline

from conftest import SF01


def test_split_sizes_are_stratified(spark):
    s = Pipeline(spark, SF01).split
    got = {(r.TARGET_F1, r.SPLIT): r["count"] for r in s.groupBy("TARGET_F1", "SPLIT").count().collect()}
    assert got == {(0, "test"): 10, (0, "train"): 40, (1, "test"): 5, (1, "train"): 20}


def test_exact_quartiles_match_numpy(spark):
    train = Pipeline(spark, SF01).train
    box = {(r.TARGET_F1, r.FEATURE): r for r in MF.eda_box_stats(train).collect()}
    pdf = train.toPandas()
    for (label, feat), r in box.items():
        v = pdf.loc[pdf.TARGET_F1 == label, feat].to_numpy()
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        assert r.Q1 == pytest.approx(q1, abs=1e-9) and r.MEDIAN == pytest.approx(med, abs=1e-9)
        assert r.Q3 == pytest.approx(q3, abs=1e-9)
        iqr = q3 - q1
        assert r.OUTLIERS == int(((v < q1 - 1.5 * iqr) | (v > q3 + 1.5 * iqr)).sum())


def test_auc_with_ties_matches_pairwise_definition(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300), 1)
    df = spark.createDataFrame(pd.DataFrame({"TARGET_F1": y, "PROB_F1": s}))
    pos, neg = s[y == 1], s[y == 0]
    expected = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert ME.eval_auc(df).first().ROC_AUC == pytest.approx(expected, abs=1e-12)
    m = ME.eval_threshold_metrics(df).first()
    tp = int(((s >= 0.5) & (y == 1)).sum()); fp = int(((s >= 0.5) & (y == 0)).sum()); fn = int(((s < 0.5) & (y == 1)).sum())
    assert m.F1_SCORE == pytest.approx(2 * tp / (2 * tp + fp + fn))
    assert ME.eval_confusion(df.filter("TARGET_F1 = 1")).count() == 4


def _brute_force_shap(nodes, x, n_feat):
    """Exact Shapley values of the cover-weighted conditional expectation."""
    by_id = {int(r.id): r for r in nodes.itertuples()}

    def value(node_id, subset):
        r = by_id[node_id]
        if r.leftChild < 0:
            return r.prediction
        left, right = by_id[int(r.leftChild)], by_id[int(r.rightChild)]
        if int(r.featureIndex) in subset:
            return value(int(r.leftChild) if x[int(r.featureIndex)] <= r.threshold else int(r.rightChild), subset)
        return (left.cover * value(int(r.leftChild), subset) + right.cover * value(int(r.rightChild), subset)) / r.cover

    phi = np.zeros(n_feat)
    feats = list(range(n_feat))
    from math import factorial
    for i in feats:
        others = [f for f in feats if f != i]
        for k in range(len(others) + 1):
            for sub in itertools.combinations(others, k):
                w = factorial(k) * factorial(n_feat - k - 1) / factorial(n_feat)
                phi[i] += w * (value(0, set(sub) | {i}) - value(0, set(sub)))
    return phi


def test_treeshap_matches_brute_force_on_a_hand_tree():
    nodes = pd.DataFrame([
        # id, prediction, left, right, feature, threshold, cover
        (0, 0.0, 1, 2, 0, 0.5, 10.0), (1, 0.0, 3, 4, 1, 0.5, 6.0), (2, 0.0, 5, 6, 0, 0.8, 4.0),
        (3, 1.0, -1, -1, -1, np.nan, 2.0), (4, -2.0, -1, -1, -1, np.nan, 4.0),
        (5, 3.0, -1, -1, -1, np.nan, 1.0), (6, 0.5, -1, -1, -1, np.nan, 3.0),
    ], columns=["id", "prediction", "leftChild", "rightChild", "featureIndex", "threshold", "cover"])
    nodes["treeID"] = 0
    table = X.leaf_table(nodes, {0: 0.5}, 2)  # scale = 2 * 0.5 = 1
    xs = np.array([[0.3, 0.2, 9.0], [0.3, 0.9, 9.0], [0.6, 0.1, 9.0], [0.9, 0.9, 9.0]])
    phi = X.shap_values(table, xs)
    for x, p in zip(xs, phi):
        assert p == pytest.approx(_brute_force_shap(nodes, x, 3), abs=1e-12)
    expected_value = (2 * 1.0 + 4 * -2.0 + 1 * 3.0 + 3 * 0.5) / 10
    assert table.base_value == pytest.approx(expected_value)


def test_trained_model_scores_and_explanations_are_additive(spark, scratch):
    import uuid
    p = Pipeline(spark, SF01)
    model = MM.train_model(p.train, maxIter=8)
    scored = MM.score_devices(model, p.features)
    probs = [r.PROB_F1 for r in scored.collect()]
    assert len(probs) == p.features.count() and all(0.0 <= v <= 1.0 for v in probs)
    root = f"{scratch}/reg-{uuid.uuid4().hex}"
    path = MM.register_model(model, root, {"ROC_AUC": 1.0})
    assert MM.load_metadata(root)["MODEL_VERSION"] == "V1"
    MM.register_model(model, root, {"ROC_AUC": 0.5})  # same version is replaced
    assert MM.load_metadata(root)["METRICS"]["ROC_AUC"] == 0.5
    ex = X.explain(spark, f"{path}/model", p.test).join(scored, "DEVICE_ID").toPandas()
    logit = np.log(ex.PROB_F1 / (1 - ex.PROB_F1))
    contrib = ex[[c for c in ex.columns if c.endswith("_EXPLANATION")]].sum(axis=1)
    assert np.abs(contrib + ex.BASE_VALUE - logit).max() < 1e-6
    against = X.explain(spark, f"{path}/model", p.test, background=p.train).join(scored, "DEVICE_ID").toPandas()
    contrib = against[[c for c in against.columns if c.endswith("_EXPLANATION")]].sum(axis=1)
    assert np.abs(contrib + against.BASE_VALUE - np.log(against.PROB_F1 / (1 - against.PROB_F1))).max() < 1e-6
    one = X.device_direction(X.explain(spark, f"{path}/model", p.test, background=p.train)).collect()
    best = against.sort_values(["RAW_SCORE", "DEVICE_ID"], ascending=[False, True]).iloc[0].DEVICE_ID
    assert {r.DEVICE_ID for r in one} == {best} and len(one) == 12
    assert all((r.DIRECTION == "toward_positive") == (r.SHAP_VALUE >= 0) for r in one)
    # the same folder by its URI: nothing looks at the local disk
    uri = path if path.startswith("file:") else f"file:{path}"
    assert X.read_tree_table(spark, f"{uri}/model").base_value == X.read_tree_table(spark, f"{path}/model").base_value
    published = MM.publish_predictions(scored, f"{root}/predictions", expected_rows=len(probs))
    assert published.filter(F.col("MODEL_VERSION") == "V1").count() == len(probs)
    with pytest.raises(RuntimeError):
        MM.publish_predictions(scored.limit(3), f"{root}/predictions", expected_rows=len(probs))
    assert MM.published_predictions(spark, f"{root}/predictions").count() == len(probs)  # the faulty version was never current


def _interventional_brute_force(nodes, x, background, n_feat):
    """Shapley values of f(x's features in S, the others from the background)."""
    from math import factorial
    by_id = {int(r.id): r for r in nodes.itertuples()}

    def score(row, i=0):
        r = by_id[i]
        if r.leftChild < 0:
            return r.prediction
        return score(row, int(r.leftChild) if row[int(r.featureIndex)] <= r.threshold else int(r.rightChild))

    def value(subset):
        return np.mean([score([x[f] if f in subset else b[f] for f in range(n_feat)]) for b in background])
    phi = np.zeros(n_feat)
    for i in range(n_feat):
        others = [f for f in range(n_feat) if f != i]
        for k in range(n_feat):
            for sub in itertools.combinations(others, k):
                phi[i] += factorial(k) * factorial(n_feat - k - 1) / factorial(n_feat) * (value({*sub, i}) - value(set(sub)))
    return phi, value(set())


def test_background_explanations_match_brute_force(spark):
    """Random trees with repeated features on a path, against all background rows."""
    rng = np.random.default_rng(4)
    for _ in range(6):
        rows, at = [], [(0, 0)]
        while at:
            i, depth = at.pop()
            leaf = depth == 3 or (depth and rng.random() < 0.3)
            rows.append((i, rng.normal(), -1 if leaf else 2 * i + 1, -1 if leaf else 2 * i + 2, -1 if leaf else rng.integers(0, 4),
                         rng.random(), 1.0))
            at += [] if leaf else [(2 * i + 1, depth + 1), (2 * i + 2, depth + 1)]
        nodes = pd.DataFrame(rows, columns=["id", "prediction", "leftChild", "rightChild", "featureIndex", "threshold", "cover"])
        nodes["treeID"] = 0
        table = X.leaf_table(nodes, {0: 0.5}, 3)
        background = rng.random((9, 4))
        cols = ["a", "b", "c", "d"]
        df = spark.createDataFrame(pd.DataFrame(background, columns=cols)).repartition(3)
        against = X.against_background(table, X.background_counts(table, df, cols))
        xs = rng.random((5, 4))
        for x, phi in zip(xs, X.shap_values(against, xs)):
            want, base = _interventional_brute_force(nodes, x, background, 4)
            assert phi == pytest.approx(want, abs=1e-12) and against.base_value == pytest.approx(base, abs=1e-12)


def test_feature_checks_fire(spark):
    p = Pipeline(spark, SF01)
    bad = p.features.limit(1).withColumn("DRAMA_SHARE", F.lit(float("nan")))
    names = {r.CHECK_NAME for r in MF.feature_checks(p.features.unionByName(bad), p.labels).collect()}
    assert names == {"feature_device_unique", "feature_finite"}


def test_model_job_refuses_failing_features(spark):
    p = Pipeline(spark, SF01)
    MF.require_clean_features(p.features, p.labels)
    dup_label = p.labels.filter("LABEL_AVAILABLE").limit(1)
    with pytest.raises(MF.FeatureCheckError):
        MF.require_clean_features(p.features, p.labels.unionByName(dup_label))


def test_model_steps_read_stored_stages_and_few_partitions(spark, monkeypatch):
    """Features and split are made from the logs once; training rows are dealt by their number."""
    from tvpulse.ml import jobs as MJ
    p, logs = MJ.prepared(spark, SF01), Pipeline(spark, SF01)
    for stage in ("features", "labels", "split"):
        assert sorted(map(str, getattr(p, stage).collect())) == sorted(map(str, getattr(logs, stage).collect()))
    for df in (p.features, p.train, p.test):
        assert not any("events.parquet" in f for f in df.inputFiles())
    assert MJ.prepared(spark, SF01).features is p.features
    fitted = []
    monkeypatch.setattr(MM, "build_pipeline", lambda **_: type("Fit", (), {"fit": lambda self, data: fitted.append(data)})())
    MM.train_model(p.train.repartition(40))
    monkeypatch.setattr(MM, "TRAIN_ROWS_PER_TASK", 25)
    MM.train_model(p.train.repartition(40))
    assert [data.rdd.getNumPartitions() for data in fitted] == [1, 3]
    assert all(data.count() == p.train.count() for data in fitted)


def test_features_move_the_daily_mart_once(spark):
    """One shuffle, by device; dates are counted once over stations and genres, a NULL date not at all."""
    import datetime as dt
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    daily = spark.createDataFrame([
        ("NW01", "C1", d1, "NEWS", 1, 0.5), ("NW02", "C1", d1, "NEWS", 2, 1.5), ("NW01", "C1", d2, "DRAMA", 1, 2.0),
        ("NW01", "C2", None, "NEWS", 1, 1.0), ("NW01", "C2", d2, None, 1, 3.0), ("NW01", None, d1, "NEWS", 1, None),
        ("NW01", "C3", None, "OTHER", 4, 4.0)],
        "NETWORK_ID string, DEVICE_ID string, VIEW_DATE date, GENRE string, SESSION_COUNT int, VIEW_MINUTES double")
    features = MF.device_features(daily)
    got = {r.DEVICE_ID: (r.ACTIVE_DAYS, r.TOTAL_SESSIONS, r.TOTAL_MINUTES, r.NEWS_SHARE, r.DRAMA_SHARE) for r in features.collect()}
    assert got == {"C1": (2.0, 4.0, 4.0, 0.5, 0.5), "C2": (1.0, 2.0, 4.0, 0.25, 0.0), "C3": (0.0, 4.0, 4.0, 0.0, 0.0),
                   None: (1.0, 1.0, None, None, None)}
    plan = MF.device_features(daily)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
