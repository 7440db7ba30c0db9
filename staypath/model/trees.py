"""Fitted trees as a table of nodes, and as column expressions that any SQL engine can run.

A model is exported once; scores, classes and importances then come from the table, without the model and without Python.
"""

import uuid

from pyspark.sql import DataFrame, Row, functions as F

from staypath.sources.tables import shared_folder

LEAF = -1


def tree_nodes(spark, model, names: list[str]) -> DataFrame:
    """Nodes of a forest or of boosted trees: ``tree, node, feature, threshold, below, above, value, rows, gain, weight``.

    A row goes to node ``below`` if its ``feature`` is at most ``threshold``, else to ``above``; both are -1 in a leaf, and
    ``feature`` is null. ``value`` is what a tree gives in that node: the share of class 1 in a forest, a margin in
    boosted trees. ``rows`` is the weight of the training rows, ``weight`` that of the tree. The table is read from the
    model's own files in the shared folder.
    """
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    boosted = model.__class__.__name__.startswith("GBT")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    feature = F.array(*[F.lit(n) for n in names])
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    stats = F.col("impurityStats")
    share = F.expr("try_divide(impurityStats[1], aggregate(impurityStats, 0D, (a, b) -> a + b))")
    rows = stats[0] if boosted else F.expr("aggregate(impurityStats, 0D, (a, b) -> a + b)")
    inner = F.col("leftChild") >= 0
    return node.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(inner, F.get(feature, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("leftChild").alias("below"), F.col("rightChild").alias("above"),
        (F.col("prediction") if boosted else share).alias("value"), rows.alias("rows"),
        F.when(inner, F.col("gain")).otherwise(0.0).alias("gain"), F.get(weights, F.col("treeID")).alias("weight"))


def tree_sql(nodes: list[Row], root: int = 0) -> str:
    """One tree as nested ``case``; the text is as long as the tree, which its depth bounds."""
    known = {n["node"]: n for n in nodes}

    def text(at):
        n = known[at]
        if n["below"] == LEAF:
            return f"cast({n['value']!r} as double)"
        name = n["feature"].replace("`", "``")
        return f"case when cast({quote(name)} as double) <= cast({n['threshold']!r} as double) then {text(n['below'])} else {text(n['above'])} end"

    def quote(name):
        return name if name.isidentifier() else f"`{name}`"

    return text(root)


def score_sql(nodes: list[Row], boosted: bool) -> str:
    """Probability of class 1 from the feature columns, for Spark and other engines alike."""
    trees: dict[int, list[Row]] = {}
    for n in nodes:
        trees.setdefault(n["tree"], []).append(n)
    parts = [f"cast({own[0]['weight']!r} as double) * ({tree_sql(own)})" for _, own in sorted(trees.items())]
    total = " + ".join(parts)
    if boosted:
        return f"1 / (1 + exp(-2 * ({total})))"
    return f"({total}) / cast({sum(own[0]['weight'] for own in trees.values())!r} as double)"


def scored_by_nodes(features: DataFrame, nodes: DataFrame, boosted: bool, name: str = "score") -> DataFrame:
    """``features`` with the probability of class 1; the nodes of one model are few and become an expression."""
    return features.withColumn(name, F.expr(score_sql(nodes.collect(), boosted)))


def importances_of(nodes: DataFrame, boosted: bool) -> DataFrame:
    """``feature, score``: gain times rows of a feature's splits, per tree as shares of the tree in a forest, in all as shares of 1.

    Features without a split are left out.
    """
    split = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.expr("sum(gain * rows) as gained"))
    if not boosted:
        whole = split.groupBy("tree").agg(F.sum("gained").alias("whole"))
        split = split.join(whole, "tree").select("feature", (F.col("gained") / F.col("whole")).alias("gained"))
    per = split.groupBy("feature").agg(F.sum("gained").alias("gained"))
    return per.select("feature", (F.col("gained") / per.agg(F.sum("gained")).scalar()).alias("score"))
