"""Fitted models as tables, and scoring as joins with them.

A linear model is a row for each feature with a weight, a tree a row for each node. Scoring
reads features as rows (key, feature, value) of the values that are not zero, so a model of
any width costs what the texts hold, and its tables can be kept, compared and joined anywhere.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, new_folder


def _listed(vector: str) -> Column:
    parts = F.unwrap_udt(F.col(vector))
    stored = F.arrays_zip(parts["indices"].alias("feature"), parts["values"].alias("value"))
    every = F.transform(parts["values"], lambda v, i: F.struct(i.alias("feature"), v.alias("value")))
    return F.when(parts["indices"].isNull(), every).otherwise(stored)


def feature_rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, feature, value`` of the values of a vector that are not zero. Of a sparse vector
    only the values it stores are looked at, so a row costs what it holds and not its width."""
    return df.select(key, F.explode(_listed(vector)).alias("x")).select(key, "x.*").filter(F.col("value") != 0)


def filled(vector: str) -> Column:
    """The features of a vector whose values are not zero, without the values."""
    return F.transform(F.filter(_listed(vector), lambda x: x["value"] != 0), lambda x: x["feature"])


def linear_table(model: LogisticRegressionModel) -> tuple[DataFrame, float]:
    """``feature, weight`` of a model of two classes, and its intercept."""
    spark = SparkSession.getActiveSession()
    rows = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray()) if w != 0]
    return spark.createDataFrame(rows, "feature INT, weight DOUBLE"), float(model.intercept)


def score_linear(
    keys: DataFrame, key: str, features: DataFrame, weights: DataFrame, intercept: float = 0.0
) -> DataFrame:
    """``key, margin, prediction`` for each row of ``keys``: the sum of value times weight.

    A text without weighted features has the intercept alone. Sums are made on the map side
    of the last shuffle, and products need no text in one place.
    """
    summed = (
        features.join(weights, "feature").groupBy(key)
        .agg(F.sum(F.col("value") * F.col("weight")).alias("__sum"))
    )
    margin = F.coalesce("__sum", F.lit(0.0)) + F.lit(float(intercept))
    return (
        keys.select(key).join(summed, key, "left").withColumn("margin", margin)
        .select(key, "margin", (F.col("margin") > 0).cast("int").alias("prediction"))
    )


def tree_table(model: DecisionTreeClassificationModel) -> DataFrame:
    """``node, feature, threshold, lower, upper, prediction``: a value up to the threshold
    goes to ``lower``; a leaf has no feature. The root is node 0."""
    spark = SparkSession.getActiveSession()
    path = new_folder(spark, "tree")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select("nodeData.*")
    leaf = F.col("leftChild") < 0
    inner = lambda c: F.when(~leaf, c)
    return data.select(
        F.col("id").cast("int").alias("node"),
        inner(F.col("split.featureIndex")).cast("int").alias("feature"),
        inner(F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        inner(F.col("leftChild")).cast("int").alias("lower"),
        inner(F.col("rightChild")).cast("int").alias("upper"),
        "prediction",
    )


def score_tree(keys: DataFrame, key: str, features: DataFrame, nodes: DataFrame, depth: int | None = None) -> DataFrame:
    """``key, node, prediction`` of the leaf that each row of ``keys`` falls into.

    A row's features are one map, and it goes down a level with each join with the nodes; the
    rows themselves are not moved again where Spark can send the nodes to them. ``depth``
    bounds the levels; without it they are counted.
    """
    if depth is None:
        depth = tree_depth(nodes)
    values = features.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("__values"))
    at = keys.select(key).join(values, key, "left").withColumn("node", F.lit(0))
    steps = nodes.select(
        F.col("node").alias("__at"), F.col("feature").alias("__feature"), F.col("threshold").alias("__threshold"),
        F.col("lower").alias("__lower"), F.col("upper").alias("__upper"),
    )
    for _ in range(depth):
        value = F.coalesce(F.try_element_at("__values", "__feature"), F.lit(0.0))
        onward = F.when(F.col("__feature").isNull(), F.col("node")).when(
            value <= F.col("__threshold"), F.col("__lower")
        ).otherwise(F.col("__upper"))
        at = at.join(steps, F.col("node") == F.col("__at")).select(key, "__values", onward.alias("node"))
    return at.drop("__values").join(nodes.select("node", "prediction"), "node").select(key, "node", "prediction")


def tree_depth(nodes: DataFrame) -> int:
    """Levels below the root; a round for each."""
    children = nodes.filter("feature is not null").select(
        F.col("node").alias("__parent"), F.explode(F.array("lower", "upper")).alias("node")
    )
    level = nodes.filter("node = 0").select("node")
    depth = 0
    while True:
        level = materialise(children.join(level.withColumnRenamed("node", "__parent"), "__parent").select("node"), "level")
        if level.isEmpty():
            return depth
        depth += 1
