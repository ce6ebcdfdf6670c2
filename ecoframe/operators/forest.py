"""A fitted forest as a table of nodes, and its pruning by a least number of rows per split.

MLlib grows trees without a least split size.  Its saved form is a table with one row per node and
the number of training rows in it; trees grow from the top, so a node below the least size can be made a leaf
afterwards (without bootstrap the result equals not splitting it): the children of such a node are cut off, and the
forest is loaded again and predicts in the JVM.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ecoframe.session import scratch_path

LEAF = -1  # fixed value of the saved form: no child


def _rows(node: Column) -> Column:
    """Training rows of a saved node: the sum of their weights, which is also right where one row stands for several."""
    return F.get(node["impurityStats"], 0)


def save_forest(model: RandomForestRegressionModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def copy_parts(spark: SparkSession, path: str, target: str) -> None:
    """Copies what a saved forest has beside its nodes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("metadata", "treesMetadata"):
        source, goal = (jvm.org.apache.hadoop.fs.Path(f"{p}/{name}") for p in (path, target))
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, goal.getFileSystem(conf), goal, False, True, conf)


def prune(spark: SparkSession, path: str, target: str, min_split: int) -> str:
    """Writes the forest saved at ``path`` to ``target`` with every node of fewer than ``min_split`` rows a leaf."""
    nodes = spark.read.parquet(f"{path}/data")
    small = _rows(F.col("nodeData")) < min_split
    cut = F.col("nodeData").withField("leftChild", F.when(small, F.lit(LEAF)).otherwise(F.col("nodeData.leftChild"))) \
        .withField("rightChild", F.when(small, F.lit(LEAF)).otherwise(F.col("nodeData.rightChild")))
    nodes.withColumn("nodeData", cut).write.mode("overwrite").parquet(f"{target}/data")
    copy_parts(spark, path, target)
    return target


def min_split_forest(model: RandomForestRegressionModel, min_split: int) -> RandomForestRegressionModel:
    """``model`` with no split of fewer than ``min_split`` training rows."""
    spark = SparkSession.getActiveSession()
    path = save_forest(model, scratch_path(spark, "forest"))
    pruned = RandomForestRegressionModel.load(prune(spark, path, scratch_path(spark, "forest-pruned"), min_split))
    return pruned.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def reachable(nodes: DataFrame) -> DataFrame:
    """Nodes that a row can come to: roots and the children of splits.

    Rows only get fewer on the way down, so below a node that was cut every node was cut too: a split that is left
    can be reached, and one join tells its children from the nodes that were cut off."""
    children = nodes.filter(F.col("left") != LEAF).select("tree", F.explode(F.array("left", "right")).alias("id"))
    return nodes.join(children.unionByName(nodes.filter("id = 0").select("tree", "id")), ["tree", "id"], "left_semi")


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The reachable nodes of the forest saved at ``path``: tree, id, left, right (-1 for a leaf), n_rows, value, and for
    splits the feature number and the threshold, or for a split by categories those that go left."""
    d = F.col("nodeData")
    split, by_number = d["leftChild"] != LEAF, d["split"]["numCategories"] == -1
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), d["id"].alias("id"), d["leftChild"].alias("left"), d["rightChild"].alias("right"),
        F.round(_rows(d)).cast("long").alias("n_rows"), d["prediction"].alias("value"),
        F.when(split, d["split"]["featureIndex"]).alias("feature"),
        F.when(split & by_number, F.get(d["split"]["leftCategoriesOrThreshold"], 0)).alias("threshold"),
        F.when(split & ~by_number, d["split"]["leftCategoriesOrThreshold"]).alias("left_categories"))
    return reachable(nodes)


def leaf_means(model: RandomForestRegressionModel, rows: DataFrame, label: str, weight: str | None = None) -> DataFrame:
    """tree, leaf (its place among the tree's leaves), n and mean label of the rows that come to it.  A row stands for
    ``weight`` rows where that column is named."""
    n = F.col(weight) if weight else F.lit(1.0)
    placed = model.copy().setLeafCol("_leaf").transform(rows).select(
        F.col(label).cast("double").alias("_y"), n.alias("_n"), F.posexplode(vector_to_array("_leaf")).alias("tree", "leaf"))
    return placed.groupBy("tree", F.col("leaf").cast("int").alias("leaf")).agg(
        F.sum("_n").cast("long").alias("n"), (F.sum(F.col("_n") * F.col("_y")) / F.sum("_n")).alias("mean"))


def leaves(nodes: DataFrame) -> DataFrame:
    """tree, leaf, n_rows and value of the leaves of a node table, numbered in id order (one window per tree)."""
    w = W.partitionBy("tree").orderBy("id")
    return nodes.filter(F.col("left") == LEAF).select("tree", (F.row_number().over(w) - 1).alias("leaf"), "n_rows", "value")
