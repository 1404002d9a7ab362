"""A random forest as a table of nodes, descended level by level.

The trees of a saved model are rows, so that a forest needs to fit on no machine: a document is at one node in each
tree, a join with the nodes finds the feature that decides there, and a join with the document's entries
the value of it. Documents that have reached a leaf leave the descent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailsift.session import stored

# Levels between two stored tables.
LEVELS_AT_ONCE = 5


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """(tree, node, feature, threshold, left, right, counts) of the forest model saved at ``path``: ``counts`` are
    the training rows of each class at the node, and a leaf has no feature. All features are numbers."""
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
        node["impurityStats"].alias("counts"),
    )


def leaves(documents: DataFrame, features: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, tree, node): the leaf that each document reaches in each tree.

    ``documents`` (doc_id), ``features`` (doc_id, feature, value) with at most one row per document and feature; a
    feature without a row is 0. ``nodes`` as ``node_table`` gives them. A value up to the threshold goes left.
    """
    documents = documents.select("doc_id").distinct()
    nodes = stored(nodes, "forest-nodes")
    inner = nodes.filter(F.col("feature").isNotNull()).drop("counts")
    roots = F.lit([r.tree for r in nodes.select("tree").distinct().orderBy("tree").collect()] or None)
    at = documents.select("doc_id", F.explode(roots.cast("array<int>")).alias("tree"), F.lit(0).alias("node"))
    arrived = []
    while True:
        for _ in range(LEVELS_AT_ONCE):
            asked = at.join(inner, ["tree", "node"], "left")
            known = asked.join(features.select("doc_id", "feature", "value"), ["doc_id", "feature"], "left")
            goes_left = F.coalesce("value", F.lit(0.0)) <= F.col("threshold")
            following = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
            at = known.select("doc_id", "tree", F.coalesce(following, "node").alias("node"))
        at = stored(at, "forest-descent")
        open_nodes = inner.select("tree", "node")
        arrived.append(at.join(open_nodes, ["tree", "node"], "left_anti"))
        at = at.join(open_nodes, ["tree", "node"], "left_semi")
        if at.isEmpty():
            return reduce(DataFrame.unionByName, arrived).select("doc_id", "tree", "node")


def probabilities(documents: DataFrame, features: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, probability): the mean over the trees of the shares of the classes at the leaf reached."""
    reached = leaves(documents, features, nodes).join(nodes.select("tree", "node", "counts"), ["tree", "node"])
    shares = reached.select("doc_id", F.posexplode("counts").alias("at", "n"), F.aggregate("counts", F.lit(0.0), lambda a, n: a + n).alias("all"))
    means = shares.groupBy("doc_id", "at").agg(F.avg(F.col("n") / F.col("all")).alias("p"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "p")))
    return means.groupBy("doc_id").agg(F.transform(ordered, lambda e: e["p"]).alias("probability"))
