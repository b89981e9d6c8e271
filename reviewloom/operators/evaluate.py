"""Evaluation of predictions against labels.

Everything starts from the counts of (label, prediction) pairs, at most the square of
the number of classes. They are the only shuffle over the data, with a partial count
before it; the measures are arithmetic on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per pair. Rows without a label go; those without a prediction are left to the
    measures, as a filter on the prediction would compute it a second time."""
    return (
        df.groupBy(
            F.col(label).cast("int").alias("label"),
            F.col(prediction).cast("int").alias("prediction"),
        )
        .agg(F.count("*").alias("n"))
        .filter(F.col("label").isNotNull())
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_measures(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where a class has no rows to
    divide by."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    counted = pairs.withColumn(
        "n", F.when(F.col("prediction").isNull(), F.lit(0)).otherwise(F.col("n"))
    )
    sides = counted.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("support"),
                    zero.alias("predicted"),
                    hit.cast("bigint").alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    zero.alias("support"),
                    F.col("n").alias("predicted"),
                    zero.alias("hits"),
                ),
            )
        ).alias("side")
    ).select("side.*").filter(F.col("class").isNotNull())
    totals = sides.groupBy("class").agg(
        *(F.sum(c).alias(c) for c in ("support", "predicted", "hits"))
    )
    measured = totals.withColumn("precision", _share(F.col("hits"), F.col("predicted"))).withColumn(
        "recall", _share(F.col("hits"), F.col("support"))
    )
    both = F.col("precision") + F.col("recall")
    return measured.withColumn(
        "f1", _share(2 * F.col("precision") * F.col("recall"), both)
    )


def _weighted(measure: str) -> Column:
    return F.try_divide(F.sum(F.col(measure) * F.col("support")), F.sum("support"))


def summary(measures: DataFrame) -> DataFrame:
    """Accuracy and the support-weighted measures in one row."""
    return measures.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("weighted_precision"),
        _weighted("recall").alias("weighted_recall"),
        _weighted("f1").alias("weighted_f1"),
    )


def class_report(measures: DataFrame) -> DataFrame:
    """A row per class, and rows ``accuracy``, ``macro avg`` and ``weighted avg``.

    One rollup gives the class rows and the total row; the total row is then spread into
    the three summary rows, so the predictions are read once.
    """
    rolled = measures.rollup("class").agg(
        F.grouping("class").alias("total"),
        F.sum("hits").alias("hits"),
        F.sum("support").alias("support"),
        *(F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")),
        *(_weighted(m).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")),
    )

    def row(name: Column, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            name.alias("class"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1"),
            F.col("support").alias("support"),
        )

    macro = [F.col(f"macro_{m}") for m in ("precision", "recall", "f1")]
    weighted = [F.col(f"weighted_{m}") for m in ("precision", "recall", "f1")]
    accuracy = F.try_divide("hits", "support")
    nothing = F.lit(None)
    per_class = F.array(row(F.col("class").cast("string"), *macro))
    overall = F.array(
        row(F.lit("accuracy"), nothing, nothing, accuracy),
        row(F.lit("macro avg"), *macro),
        row(F.lit("weighted avg"), *weighted),
    )
    return rolled.select(
        F.explode(F.when(F.col("total") == 0, per_class).otherwise(overall)).alias("r")
    ).select("r.*")


def confusion(pairs: DataFrame, classes: Sequence[int] = ()) -> DataFrame:
    """The square matrix over all classes found as label or prediction, and those given:
    a row per class, a column per predicted class, zeros filled in."""
    counts = {(x["label"], x["prediction"]): x["n"] for x in pairs.collect()}
    found = sorted({c for pair in counts for c in pair if c is not None} | set(classes))
    names = [f"predicted_{c}".replace("-", "minus_") for c in found]
    rows = [(y, *(counts.get((y, p), 0) for p in found)) for y in found]
    schema = ", ".join(["label INT", *(f"{n} BIGINT" for n in names)])
    return pairs.sparkSession.createDataFrame(rows, schema)
