"""Checks of fitted models that are computed from the rows again, apart from the fit.

The logistic fit is certified by the gradient of its penalised loss, one pass over the training rows. A forest is
recounted: rows walk down the trees by joins with the node table, and node weights, impurity gains, importances,
leaf shares and scores follow from where they end. The node table is bounded by trees and depth (some 2 ** (depth + 1)
nodes a tree), so it is broadcast; rows are not shuffled, only counts of (tree, leaf).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.model import MODEL_FEATURES, SCALED_FEATURES, ChurnModels


def logistic_gradient(models: ChurnModels) -> DataFrame:
    """Per feature and for the intercept: training rows and gradient of the penalised loss over them.

    The loss is the sum of weighted log losses plus half the squared coefficients (the intercept is free).
    """
    weights = [float(w) for w in models.logistic.coefficients]
    intercept = float(models.logistic.intercept)
    margin = sum((F.lit(w) * F.col(c) for w, c in zip(weights, SCALED_FEATURES)), F.lit(intercept))
    residual = F.col("weight") * (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("label"))
    rows = models.training.select(*SCALED_FEATURES, residual.alias("residual"))
    slopes = [(F.sum(F.col("residual") * F.col(c)) + F.lit(w)) for w, c in zip(weights, SCALED_FEATURES)]
    sums = rows.agg(F.count("*").alias("n"), F.array(*slopes, F.sum("residual")).alias("slopes"))
    names = F.array(*[F.lit(name) for name in (*MODEL_FEATURES, "intercept")])
    listed = sums.select("n", F.explode(F.arrays_zip(names.alias("term"), F.col("slopes").alias("slope"))).alias("z"))
    return listed.select(F.col("z.term").alias("term"), "n", (F.col("z.slope") / F.col("n")).alias("gradient"))


def forest_nodes(models: ChurnModels) -> DataFrame:
    """The forest's nodes as MLlib writes them: tree, node, children, split, stored class weights."""
    path = f"{models.workspace.path}/forest-{uuid.uuid4().hex[:8]}"
    models.forest.write().save(path)
    nodes = models.workspace.spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    return nodes.select(
        "tree", F.col("id").alias("node"), inner.alias("inner"), F.col("leftChild").alias("left_child"),
        F.col("rightChild").alias("right_child"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("cut"),
        F.col("impurityStats")[0].alias("w0"), F.col("impurityStats")[1].alias("w1"), "gain",
    )


def routed(rows: DataFrame, nodes: DataFrame, trees: int, depth: int) -> DataFrame:
    """The rows once per tree, with the leaf where each ends as `node`."""
    splits = F.broadcast(nodes.where("inner").select(
        F.col("tree").alias("of_tree"), F.col("node").alias("of_node"), "left_child", "right_child", "feature", "cut"))
    features = F.array(*[F.col(c) for c in SCALED_FEATURES])
    walked = rows.withColumns({"x": features, "node": F.lit(0)}).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    for _ in range(depth):
        met = walked.join(splits, (F.col("tree") == F.col("of_tree")) & (F.col("node") == F.col("of_node")), "left")
        goes_left = F.get("x", F.col("feature")) <= F.col("cut")
        below = F.when(F.col("of_node").isNull(), F.col("node")).when(goes_left, F.col("left_child")).otherwise(
            F.col("right_child"))
        walked = met.withColumn("node", below).drop(*splits.columns)
    return walked


def recounted(models: ChurnModels, nodes: DataFrame) -> DataFrame:
    """The node table with class weights (r0, r1) and rows counted again from the training rows."""
    params = models.params
    ends = routed(models.training, nodes, params.n_trees, params.tree_depth)
    is_one = F.col("label") == 1
    leaves = ends.groupBy("tree", "node").agg(
        F.sum(F.when(~is_one, F.col("weight")).otherwise(0.0)).alias("r0"),
        F.sum(F.when(is_one, F.col("weight")).otherwise(0.0)).alias("r1"), F.count("*").alias("rows"))
    leaves = models.workspace.stage(leaves, "leaves")
    # From here on tables are as small as the forest: counts are carried from the leaves up.
    parents = nodes.where("inner").select("tree", F.col("node").alias("parent"), F.explode(F.array(
        "left_child", "right_child")).alias("node"))
    carried = up = leaves
    for _ in range(params.tree_depth):
        up = up.join(parents, ["tree", "node"]).select("tree", F.col("parent").alias("node"), "r0", "r1", "rows")
        carried = carried.unionByName(up)
    counts = carried.groupBy("tree", "node").agg(
        F.sum("r0").alias("r0"), F.sum("r1").alias("r1"), F.sum("rows").alias("rows"))
    counted = nodes.join(counts, ["tree", "node"], "left").na.fill(0, ["r0", "r1", "rows"])
    return models.workspace.stage(counted, "recounted")


def _gini(w0: Column, w1: Column) -> Column:
    total = w0 + w1
    return F.when(total == 0, 0.0).otherwise(1 - (w0 * w0 + w1 * w1) / (total * total))


def importances(nodes: DataFrame, w0: str, w1: str) -> DataFrame:
    """(feature, importance) from the node weights: impurity gain times weight, normalised per tree, then overall."""
    impurity = nodes.select("tree", "node", F.col(w0).alias("a"), F.col(w1).alias("b"))
    inner = nodes.where("inner").select("tree", "node", "feature", "left_child", "right_child")
    joined = inner.join(impurity, ["tree", "node"])
    for side in ("left", "right"):
        child = impurity.select(
            "tree", F.col("node").alias(f"{side}_child"), F.col("a").alias(f"{side}_a"), F.col("b").alias(f"{side}_b"))
        joined = joined.join(child, ["tree", f"{side}_child"])
    part = lambda side: (F.col(f"{side}_a") + F.col(f"{side}_b")) * _gini(F.col(f"{side}_a"), F.col(f"{side}_b"))
    gain = (F.col("a") + F.col("b")) * _gini(F.col("a"), F.col("b")) - part("left") - part("right")
    by_tree = joined.groupBy("tree", "feature").agg(F.sum(gain).alias("gain"))
    trees = by_tree.groupBy("tree").agg(F.sum("gain").alias("whole"))
    shares = by_tree.join(trees, "tree").where("whole > 0").groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
    names = F.array(*[F.lit(name) for name in MODEL_FEATURES])
    listed = _listed(nodes, names).join(shares, "feature", "left").na.fill(0.0, ["share"])
    whole = listed.agg(F.sum("share")).scalar()
    return listed.select("name", F.when(whole > 0, F.col("share") / whole).otherwise(0.0).alias("importance"))


def _listed(frame: DataFrame, names: Column) -> DataFrame:
    return frame.sparkSession.range(1).select(F.posexplode(names).alias("feature", "name"))


def _against(found: DataFrame, models: ChurnModels, what: str) -> DataFrame:
    fitted = models.importances().select(F.col("feature").alias("name"), F.col("importance").alias("fitted"))
    return found.join(fitted, "name").select(
        F.concat(F.lit(f"{what} of "), "name").alias("measure"), F.abs(F.col("importance") - F.col("fitted")).alias("difference"))


def forest_recount(models: ChurnModels) -> DataFrame:
    """(measure, difference) between the fit and the count of its training rows.

    Exact for a forest whose trees see all rows (tree_bootstrap=False); with drawn rows the counts differ by the draw.
    """
    counted = recounted(models, forest_nodes(models))
    share = lambda a, b: F.try_divide(F.col(b), F.col(a) + F.col(b))
    leaf = F.max(F.when(~F.col("inner"), F.abs(share("r0", "r1") - share("w0", "w1")))).alias("difference")
    weight = F.max(F.abs(F.col("r0") + F.col("r1") - F.col("w0") - F.col("w1")) / (F.col("w0") + F.col("w1"))).alias("difference")
    root = F.max(F.when(F.col("node") == 0, F.abs(F.col("rows") - F.lit(models.train_size)))).cast("double").alias("difference")
    named = lambda name, value: counted.agg(value).select(F.lit(name).alias("measure"), "difference")
    return (
        _against(importances(counted, "r0", "r1"), models, "importance")
        .unionByName(named("leaf share", leaf))
        .unionByName(named("node weight", weight))
        .unionByName(named("rows of a root", root))
    )


def score_recount(models: ChurnModels) -> DataFrame:
    """(measure, difference): scores of all customers as mean leaf shares of their walks against the model's, and
    importances from the stored node weights."""
    nodes = models.workspace.stage(forest_nodes(models), "nodes")
    share = (F.col("w1") / (F.col("w0") + F.col("w1"))).alias("share")
    leaves = nodes.where("not inner").select("tree", "node", share)
    rows = models.profile.select("customer_unique_id", *SCALED_FEATURES)
    ends = routed(rows, nodes, models.params.n_trees, models.params.tree_depth)
    walked = ends.join(F.broadcast(leaves), ["tree", "node"]).groupBy("customer_unique_id").agg(F.avg("share").alias("walked"))
    both = models.forest_scores().join(walked, "customer_unique_id", "left")
    gap = F.max(F.coalesce(F.abs(F.col("churn_probability") - F.col("walked")), F.lit(1.0))).alias("difference")
    scores = both.agg(gap).select(F.lit("score").alias("measure"), "difference")
    return _against(importances(nodes, "w0", "w1"), models, "importance").unionByName(scores)
