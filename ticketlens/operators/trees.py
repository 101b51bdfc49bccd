"""Fitted trees as a table of nodes: cut back where too few rows are left to split, and walked by joins.

Spark writes the nodes of a tree in preorder, a node's left child right behind it.
So a subtree is a range of numbers, and where it ends is the next node that stands
with one open place less; both are windows over the nodes of a tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketlens.session import materialize, remove_folder, scratch_folder

NODE = (
    "struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
    "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>"
)


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a forest saved by Spark: treeID and nodeData."""
    return spark.read.schema(f"treeID int, nodeData {NODE}").parquet(f"{path}/data")


def node_table(saved: DataFrame) -> DataFrame:
    """tree, id, feature, threshold, left_child, right_child, rows, stats (class weights) and prediction; leaves have no feature."""
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    return saved.select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner, F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"), F.when(inner, n["leftChild"]).alias("left_child"),
        F.when(inner, n["rightChild"]).alias("right_child"), n["rawCount"].alias("rows"), n["impurityStats"].alias("stats"), n["prediction"].alias("prediction"),
    )


def cut_back(saved: DataFrame, min_rows: int) -> DataFrame:
    """The forest with every node of fewer than `min_rows` rows as a leaf, numbered anew; treeID and nodeData."""
    n = F.col("nodeData")
    tree = Window.partitionBy("treeID").orderBy("id")
    before = tree.rowsBetween(Window.unboundedPreceding, -1)
    flat = saved.select("treeID", n["id"].alias("id"), "nodeData", (n["leftChild"] >= 0).alias("inner"))
    placed = flat.select(
        "*", (F.col("inner") & (n["rawCount"] < min_rows)).alias("stop"),
        (1 + F.coalesce(F.sum(F.when(F.col("inner"), 1).otherwise(-1)).over(before), F.lit(0))).alias("open"),
    )
    # the subtree of a node ends at the next one with one open place less
    asked = placed.filter("stop").select("treeID", (F.col("open") - 1).alias("open"), "id", F.lit(True).alias("asks"))
    along = Window.partitionBy("treeID", "open").orderBy("id").rowsBetween(1, Window.unboundedFollowing)
    both = placed.select("treeID", "open", "id", F.lit(False).alias("asks")).unionByName(asked)
    ends = both.select("treeID", "id", "asks", F.min(F.when(~F.col("asks"), F.col("id"))).over(along).alias("end")).filter("asks")
    marks = ends.select("treeID", F.inline(F.array(
        F.struct((F.col("id") + 1).alias("id"), F.lit(1).alias("mark")), F.struct(F.col("end").alias("id"), F.lit(-1).alias("mark"))))).filter("id IS NOT NULL")
    summed = marks.groupBy("treeID", "id").agg(F.sum("mark").alias("mark"))
    marked = placed.join(summed, ["treeID", "id"], "left").withColumn("mark", F.coalesce("mark", F.lit(0)))
    left = marked.withColumn("inside", F.sum("mark").over(tree.rowsBetween(Window.unboundedPreceding, Window.currentRow))).filter("inside = 0")
    numbered = left.select("treeID", "id", "nodeData", (F.col("inner") & ~F.col("stop")).alias("splits"), (F.row_number().over(tree) - 1).alias("number"))
    right = numbered.select(F.col("treeID").alias("of"), F.col("id").alias("known"), F.col("number").alias("right"))
    joined = numbered.join(right, (F.col("treeID") == F.col("of")) & F.col("splits") & (n["rightChild"] == F.col("known")), "left")
    leaf = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    s = F.col("splits")
    node = F.struct(
        F.col("number").alias("id"), n["prediction"].alias("prediction"), n["impurity"].alias("impurity"), n["impurityStats"].alias("impurityStats"),
        n["rawCount"].alias("rawCount"), F.when(s, n["gain"]).otherwise(-1.0).alias("gain"), F.when(s, F.col("number") + 1).otherwise(-1).alias("leftChild"),
        F.when(s, F.col("right")).otherwise(-1).alias("rightChild"), F.when(s, n["split"]).otherwise(leaf).alias("split"),
    )
    return joined.select("treeID", node.cast(NODE).alias("nodeData"))


def saved_with_min_split(model, min_rows: int, path: str, spark: SparkSession) -> bool:
    """Saves the forest with nodes of fewer than `min_rows` rows not split. Whether there were any."""
    model.write().save(path)
    saved = saved_nodes(spark, path)
    n = F.col("nodeData")
    if min_rows <= 2 or saved.filter((n["leftChild"] >= 0) & (n["rawCount"] < min_rows)).isEmpty():
        return False
    materialize(cut_back(saved, min_rows)).write.mode("overwrite").parquet(f"{path}/data")
    return True


def with_min_split(model, min_rows: int, spark: SparkSession):
    """The forest with nodes of fewer than `min_rows` rows not split. Its nodes are written, cut back and read by Spark again."""
    if min_rows <= 2:
        return model
    path = scratch_folder(spark)
    if saved_with_min_split(model, min_rows, path, spark):
        return type(model).load(path)
    remove_folder(spark, path)
    return model


def walk(rows: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """key, tree, stats and prediction of the leaf that each row (key, features: array) reaches in each tree.

    A step down is a join with the node table on tree and node; a forest is a small
    table beside its rows, and Spark broadcasts it by its measured size.
    """
    features = F.col("features")
    trees = [r["tree"] for r in nodes.filter("id = 0").select("tree").orderBy("tree").collect()]  # as many as the forest has
    now = rows.select("key", "features", F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"), F.lit(0).alias("at"))
    for step in range(depth + 1):
        now = now.join(nodes.withColumnRenamed("id", "at"), ["tree", "at"])
        if step == depth:
            break
        left = F.get(features, F.col("feature")) <= F.col("threshold")
        to = F.when(F.col("feature").isNull(), F.col("at")).when(left, F.col("left_child")).otherwise(F.col("right_child"))
        now = now.select("key", "features", "tree", to.alias("at"))
    return now.select("key", "tree", "stats", "prediction")


def walked_probabilities(rows: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """key and p: class probabilities, each tree's share of its leaf's weights, averaged over the trees."""
    total = F.aggregate("stats", F.lit(0.0), lambda s, x: s + x)
    shares = walk(rows, nodes, depth).select("key", F.posexplode(F.transform("stats", lambda x: x / total)).alias("c", "share"))
    per_class = shares.groupBy("key", "c").agg(F.avg("share").alias("p"))
    return per_class.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "p"))), lambda x: x["p"]).alias("p"))
