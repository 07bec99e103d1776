"""Per-feature contributions of a saved MLlib boosted-tree model.

Two kinds: path-dependent (below), and against background rows: the mean, over
all background rows, of the exact Shapley values of replacing a row's features
by the background row's (Lundberg et al., "From local explanations to global
understanding with explainable AI for trees", 2020). For a leaf, a background
row matters only by which of the path's features it follows, one bit each. So
the whole background, however large, becomes one count per leaf and bit
pattern (at most leaves x 2^depth rows, summed by Spark), from which the same
kind of pattern table follows as for the path-dependent values.

Path-dependent TreeSHAP (Lundberg, Erion, Lee: "Consistent individualized
feature attribution for tree ensembles", 2018). Node covers are the weighted
training counts stored with each node. The model's trees are read from its
saved Parquet data with Spark; the table is bounded by trees x 2^(depth+1)
nodes and travels to the tasks inside the ``mapInPandas`` closure.

Vectorisation: for a leaf, the contribution of each feature on its path only
depends on the cover fractions (fixed) and on whether the row follows the
path at that feature's splits (one bit per distinct feature, at most
``depth`` bits). All 2^k patterns are precomputed per leaf, so scoring a batch
is numpy comparisons plus table lookups — no per-row Python recursion.

Contributions are in log-odds units: MLlib's margin m gives
p = 1 / (1 + exp(-2m)), so every tree value is scaled by 2 x tree weight and
sum(contributions) + BASE_VALUE = RAW_SCORE = log(p / (1 - p)).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tvpulse.schemas import FEATURE_COLUMNS


# ---- the TreeSHAP path algebra -------------------------------------------------------

def _extend(path: list[list[float]], z: float, o: float) -> list[list[float]]:
    depth = len(path)
    new = [list(e) for e in path] + [[z, o, 1.0 if depth == 0 else 0.0]]
    for i in range(depth - 1, -1, -1):
        new[i + 1][2] += o * new[i][2] * (i + 1) / (depth + 1)
        new[i][2] = z * new[i][2] * (depth - i) / (depth + 1)
    return new


def _unwound_sum(path: list[list[float]], i: int) -> float:
    last = len(path) - 1
    z, o = path[i][0], path[i][1]
    nxt = path[last][2]
    total = 0.0
    for j in range(last - 1, -1, -1):
        if o != 0:
            tmp = nxt * (last + 1) / ((j + 1) * o)
            total += tmp
            nxt = path[j][2] - tmp * z * (last - j) / (last + 1)
        else:
            total += path[j][2] * (last + 1) / (z * (last - j))
    return total


def leaf_pattern_weights(zs: list[float]) -> np.ndarray:
    """For a path with distinct-feature cover fractions ``zs``: array
    [2^k, k] of phi weights (to multiply by the leaf value) for each
    follow-pattern (bit i set = row follows the path at feature i)."""
    k = len(zs)
    out = np.zeros((1 << k, k))
    for pattern in range(1 << k):
        os_ = [(pattern >> i) & 1 for i in range(k)]
        path = _extend([], 1.0, 1.0)
        for z, o in zip(zs, os_):
            path = _extend(path, z, float(o))
        for i in range(k):
            out[pattern, i] = _unwound_sum(path, i + 1) * (os_[i] - zs[i])
    return out


# ---- the model as leaf paths ------------------------------------------------------------

@dataclass
class LeafTable:
    """Flattened leaves of all trees (arrays are indexed by leaf)."""
    value: np.ndarray            # scaled leaf value (2 x tree weight x prediction)
    node_feature: np.ndarray     # [leaves, depth] split feature per path step (-1 = none)
    node_threshold: np.ndarray   # [leaves, depth]
    node_left: np.ndarray        # [leaves, depth] path goes left (x <= threshold)
    node_slot: np.ndarray        # [leaves, depth] distinct-feature slot of each step
    slot_feature: np.ndarray     # [leaves, depth] feature of each slot (-1 = unused)
    weights: list                # per leaf [2^k, k] pattern weights
    base_value: float


def leaf_table(nodes: pd.DataFrame, tree_weights: dict[int, float], depth: int) -> LeafTable:
    """Build the leaf table from the saved node rows (treeID + node fields)."""
    values, feats, thrs, lefts, slots, slot_feats, weights = [], [], [], [], [], [], []
    base = 0.0
    for tree_id, tree in nodes.groupby("treeID"):
        by_id = {int(r.id): r for r in tree.itertuples()}
        scale = 2.0 * tree_weights[int(tree_id)]

        def walk(node_id, steps):
            nonlocal base
            r = by_id[node_id]
            if r.leftChild < 0:
                cover_root = by_id[0].cover
                base_frac = r.cover / cover_root
                base += scale * r.prediction * base_frac
                order: list[int] = []
                z: dict[int, float] = {}
                for f, _t, _l, frac in steps:
                    if f not in z:
                        order.append(f)
                        z[f] = 1.0
                    z[f] *= frac
                f_arr = np.full(depth, -1)
                t_arr = np.zeros(depth)
                l_arr = np.zeros(depth, dtype=bool)
                s_arr = np.full(depth, -1)
                for n, (f, t, goes_left, _frac) in enumerate(steps):
                    f_arr[n], t_arr[n], l_arr[n], s_arr[n] = f, t, goes_left, order.index(f)
                sf = np.full(depth, -1)
                sf[:len(order)] = order
                values.append(scale * r.prediction)
                feats.append(f_arr)
                thrs.append(t_arr)
                lefts.append(l_arr)
                slots.append(s_arr)
                slot_feats.append(sf)
                weights.append(leaf_pattern_weights([z[f] for f in order]))
                return
            f, t = int(r.featureIndex), float(r.threshold)
            for child, goes_left in ((int(r.leftChild), True), (int(r.rightChild), False)):
                frac = by_id[child].cover / r.cover
                walk(child, steps + [(f, t, goes_left, frac)])
        walk(0, [])
    return LeafTable(np.array(values), np.array(feats), np.array(thrs), np.array(lefts), np.array(slots),
                     np.array(slot_feats), weights, base)


def follow_patterns(table: LeafTable, x: np.ndarray, leaf: int) -> np.ndarray:
    """Per row, bit s set if the row follows the leaf's path at every split of
    the path's s-th distinct feature; all bits set: the row falls in the leaf."""
    k_slots = int((table.slot_feature[leaf] >= 0).sum())
    pattern = np.full(len(x), (1 << k_slots) - 1, dtype=np.int64)
    for f, threshold, left, s in zip(table.node_feature[leaf], table.node_threshold[leaf], table.node_left[leaf], table.node_slot[leaf]):
        if f >= 0:
            pattern &= ~(((x[:, f] <= threshold) != left).astype(np.int64) << s)
    return pattern


def shap_values(table: LeafTable, x: np.ndarray) -> np.ndarray:
    """[rows, features] contributions for a batch of feature rows."""
    phi = np.zeros(x.shape)
    for leaf in range(len(table.value)):
        contrib = table.weights[leaf][follow_patterns(table, x, leaf)] * table.value[leaf]      # [rows, k]
        for s, f in enumerate(table.slot_feature[leaf]):
            if f >= 0:
                phi[:, f] += contrib[:, s]
    return phi


def background_weights(counts: np.ndarray) -> np.ndarray:
    """[2^k, k] weights of a leaf from how many background rows have each pattern.

    With a row's pattern p and a background row's b, the leaf is reached only
    where p or b follows at every feature. Features that only the row follows
    (a of them) each gain (a-1)! c! / (a+c)!, those that only the background
    follows (c) each lose a! (c-1)! / (a+c)!."""
    full = len(counts) - 1
    k = full.bit_length()
    out = np.zeros((full + 1, k))
    for p in range(full + 1):
        for b in np.flatnonzero(counts).tolist():
            if p | b != full:
                continue
            mine, theirs = p & ~b, b & ~p
            a, c = mine.bit_count(), theirs.bit_count()
            for s in range(k):
                if mine >> s & 1:
                    out[p, s] += counts[b] * factorial(a - 1) * factorial(c) / factorial(a + c)
                elif theirs >> s & 1:
                    out[p, s] -= counts[b] * factorial(a) * factorial(c - 1) / factorial(a + c)
    return out / max(1, counts.sum())


def against_background(table: LeafTable, counts: list[np.ndarray]) -> LeafTable:
    """The table whose contributions are against a background; its base value
    is the background's mean score."""
    inside = np.array([c[-1] / max(1, c.sum()) for c in counts])
    return replace(table, weights=[background_weights(c) for c in counts], base_value=float((table.value * inside).sum()))


# ---- Spark side ----------------------------------------------------------------------------

def _tree_stage(spark: SparkSession, model_dir: str) -> str:
    """The boosted-tree stage's folder, named by the saved pipeline's own
    metadata, so that any file system Spark reads will do."""
    folder = model_dir.rstrip("/")
    stages = json.loads(spark.read.text(f"{folder}/metadata").first()[0])["paramMap"]["stageUids"]
    at = max(i for i, uid in enumerate(stages) if "GBT" in uid)
    return f"{folder}/stages/{at:0{len(str(len(stages)))}d}_{stages[at]}"


def read_tree_table(spark: SparkSession, model_dir: str) -> LeafTable:
    """Read the boosted-tree stage of a saved PipelineModel into a LeafTable.

    The node table has at most trees x 2^(depth+1) rows (3,000 for 200
    depth-3 trees), so collecting it is size-bounded by the model, not data."""
    stage = _tree_stage(spark, model_dir)
    nodes = spark.read.parquet(f"{stage}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("featureIndex"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        F.coalesce(F.try_element_at("nodeData.impurityStats", F.lit(1)), F.col("nodeData.rawCount").cast("double"))
        .alias("cover")).toPandas()
    meta = spark.read.parquet(f"{stage}/treesMetadata").toPandas()
    weights = {int(r[0]): float(r[2]) for r in meta.itertuples(index=False)}
    depth = 1
    for _, tree in nodes.groupby("treeID"):
        depth = max(depth, int(np.ceil(np.log2(len(tree) + 1))))
    return leaf_table(nodes, weights, depth)


def background_counts(table: LeafTable, background: DataFrame, feature_cols) -> list[np.ndarray]:
    """Per leaf, the background rows of each follow pattern. Only these counts
    (at most leaves x 2^depth) leave the tasks, are summed and collected."""
    shared = background.sparkSession.sparkContext.broadcast(table)
    cols = list(feature_cols)

    def run(batches):
        table, total = shared.value, None
        sizes = [w.shape[0] for w in table.weights]
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            seen = [np.bincount(follow_patterns(table, x, leaf), minlength=n) for leaf, n in enumerate(sizes)]
            total = seen if total is None else [a + b for a, b in zip(total, seen)]
        if total is not None:
            yield pd.DataFrame([(leaf, p, n) for leaf, counts in enumerate(total) for p, n in enumerate(counts.tolist()) if n],
                               columns=["leaf", "pattern", "n"])

    counts = [np.zeros(w.shape[0], dtype=np.int64) for w in table.weights]
    found = background.select(*cols).mapInPandas(run, "leaf int, pattern int, n long")
    for row in found.groupBy("leaf", "pattern").agg(F.sum("n").alias("n")).collect():
        counts[row["leaf"]][row["pattern"]] = row["n"]
    return counts


def explain(spark: SparkSession, model_dir: str, features: DataFrame, feature_cols=FEATURE_COLUMNS,
            id_col: str = "DEVICE_ID", background: DataFrame | None = None) -> DataFrame:
    """Per-row contributions (``<FEATURE>_EXPLANATION``), BASE_VALUE and RAW_SCORE,
    path-dependent or, with ``background`` rows, against all of these."""
    cols = list(feature_cols)
    table = read_tree_table(spark, model_dir)
    if background is not None:
        table = against_background(table, background_counts(table, background, cols))
    # one copy per executor (the table is bounded by the model, not the data)
    shared = spark.sparkContext.broadcast(table)
    schema = T.StructType([T.StructField(id_col, T.StringType())]
                          + [T.StructField(c + "_EXPLANATION", T.DoubleType()) for c in cols]
                          + [T.StructField("BASE_VALUE", T.DoubleType()), T.StructField("RAW_SCORE", T.DoubleType())])

    def run(batches):
        table = shared.value
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            phi = shap_values(table, x)
            out = pd.DataFrame(phi, columns=[c + "_EXPLANATION" for c in cols])
            out.insert(0, id_col, pdf[id_col].to_numpy())
            out["BASE_VALUE"] = table.base_value
            out["RAW_SCORE"] = table.base_value + phi.sum(axis=1)
            yield out
    return features.select(id_col, *cols).mapInPandas(run, schema)


def mean_abs_ranking(explained: DataFrame, feature_cols=FEATURE_COLUMNS) -> DataFrame:
    """Global importance: mean |contribution| per feature, ranked (12 rows)."""
    wide = explained.agg(*[F.avg(F.abs(c + "_EXPLANATION")).alias(c) for c in feature_cols])
    long = wide.unpivot([], list(feature_cols), "FEATURE", "MEAN_ABS_SHAP")
    # twelve rows (one per feature): the keyless window is bounded
    return long.withColumn("RANK", F.row_number().over(Window.orderBy(F.col("MEAN_ABS_SHAP").desc(), "FEATURE")))


def device_direction(explained: DataFrame, feature_cols=FEATURE_COLUMNS, device_id: str | None = None) -> DataFrame:
    """One device's contributions in long form with their direction: the named
    device, or the one with the highest score (lowest id on ties)."""
    one = (explained.filter(F.col("DEVICE_ID") == device_id) if device_id is not None
           else explained.orderBy(F.desc("RAW_SCORE"), "DEVICE_ID").limit(1))
    long = one.unpivot(["DEVICE_ID"], [c + "_EXPLANATION" for c in feature_cols], "FEATURE", "SHAP_VALUE")
    return long.select("DEVICE_ID", F.regexp_replace("FEATURE", "_EXPLANATION$", "").alias("FEATURE"), "SHAP_VALUE",
                       F.when(F.col("SHAP_VALUE") >= 0, "toward_positive").otherwise("toward_negative").alias("DIRECTION"))


__all__ = ["explain", "shap_values", "leaf_table", "read_tree_table", "mean_abs_ranking", "device_direction",
           "leaf_pattern_weights", "background_weights", "against_background", "background_counts"]
