"""A fitted forest as a table of nodes: least size of a split node, errors of its first trees."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from panelflow.session import scratch_path


def _saved(model: RandomForestRegressionModel) -> str:
    path = scratch_path(SparkSession.active(), "forest")
    model.write().save(path)
    return path


def node_table(model: RandomForestRegressionModel) -> DataFrame:
    """``(tree, id, prediction, rows, feature, threshold, left_id, right_id)``, one row per node.

    Ids run from 0 in each tree, a node before its children.  ``rows`` counts the draws of the
    tree's bag that reached the node.  A leaf's last four columns are null.
    """
    node = F.col("nodeData")
    inner = F.col("nodeData.leftChild") >= 0
    return SparkSession.active().read.parquet(f"{_saved(model)}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        node["rawCount"].alias("rows"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, node["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left_id"),
        F.when(inner, node["rightChild"]).alias("right_id"),
    )


def with_least_split(model: RandomForestRegressionModel, smallest: int) -> RandomForestRegressionModel:
    """The forest in which no node of fewer than ``smallest`` rows is split.

    Nodes are split from the root down, whatever becomes of the others, and all features compete at each.
    So a forest grown under this rule is the one grown without it, cut at the first node on
    each path that is too small.  Counts fall along a path: a node is left if its parent is
    large enough, and a leaf if it is itself too small.  Rows are draws of the tree's bag.
    """
    if smallest <= 2:
        return model
    source, target = _saved(model), _saved(model)
    nodes = SparkSession.active().read.parquet(f"{source}/data").select("treeID", "nodeData.*")
    large = (F.col("rawCount") >= smallest) & (F.col("leftChild") >= 0)
    children = nodes.filter(large).select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"))
    roots = nodes.select("treeID").distinct().select("treeID", F.lit(0).alias("id"))
    order = Window.partitionBy("treeID").orderBy("id")
    left = nodes.join(children.unionByName(roots), ["treeID", "id"]).withColumn("new", F.row_number().over(order) - 1)
    # A node's left child follows it; the right one is looked up by its old number.
    places = left.select("treeID", F.col("id").alias("rightChild"), F.col("new").alias("right_place"))
    out = left.join(places, ["treeID", "rightChild"], "left")
    no_split = F.struct(
        F.lit(-1).alias("featureIndex"),
        F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    out = out.select(
        "treeID",
        F.struct(
            F.col("new").alias("id"),
            "prediction",
            "impurity",
            "impurityStats",
            "rawCount",
            F.when(large, F.col("gain")).otherwise(-1.0).alias("gain"),
            F.when(large, F.col("new") + 1).otherwise(-1).alias("leftChild"),
            F.when(large, F.col("right_place")).otherwise(-1).alias("rightChild"),
            F.when(large, F.col("split")).otherwise(no_split).alias("split"),
        ).alias("nodeData"),
    )
    out.write.mode("overwrite").parquet(f"{target}/data")
    return RandomForestRegressionModel.load(target)


def leaf_values(model: RandomForestRegressionModel) -> list[np.ndarray]:
    """Predictions of each tree's leaves from left to right."""
    leaves = node_table(model).filter("feature IS NULL")
    lists = leaves.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("id", "prediction"))).alias("l"))
    return [np.array([leaf["prediction"] for leaf in r["l"]]) for r in lists.orderBy("tree").collect()]


def staged_by_leaves(model: RandomForestRegressionModel, df: DataFrame, sizes: Sequence[int], name: str = "staged") -> DataFrame:
    """``df`` with an array of the predictions of the first ``sizes[i]`` trees."""
    values, ends = leaf_values(model), np.array(sizes) - 1

    @F.pandas_udf("array<double>")
    def means(leaves: pd.Series) -> pd.Series:
        if leaves.empty:
            return pd.Series([], dtype=object)
        found = np.stack(leaves.to_numpy()).astype(int)
        each = np.stack([v[found[:, t]] for t, v in enumerate(values)], axis=1)
        firsts = each.cumsum(axis=1)[:, ends] / (ends + 1)
        return pd.Series(list(firsts))

    placed = model.copy().setLeafCol("_leaves").transform(df)
    return placed.withColumn(name, means(vector_to_array("_leaves"))).drop("_leaves", model.getPredictionCol())


def squared_error(target: str, staged: Column, sizes: Sequence[int]) -> list[Column]:
    """Root mean squared errors of staged predictions."""
    return [F.sqrt(F.avg((F.col(target) - staged[i]) * (F.col(target) - staged[i]))).alias(f"e{i}") for i in range(len(sizes))]
