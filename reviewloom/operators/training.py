"""Training frames, the classifier pipelines, cross-validation and stored models."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, NGram
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import DEFAULT, Lexicons
from ..functions.records import binarize
from ..plans import profiles
from ..session import materialise
from . import evaluate
from .features import BUCKETS, NGRAM, with_tokens

# The settings of the two classifiers and of the validation.
TREE = {"maxDepth": 17, "minInstancesPerNode": 3}
LOGISTIC = {"maxIter": 20, "regParam": 0.3}
FOLDS = 5
SEED = 42


def training_frame(df: DataFrame, text: str, label: str, *keep: str) -> DataFrame:
    """``free_text, label_id`` with three classes made two, each split by its own labels."""
    return df.select(
        *keep, F.col(text).alias("free_text"), binarize(F.col(label)).alias("label_id")
    )


def drop_empty(df: DataFrame, text: str = "free_text") -> DataFrame:
    return df.filter(F.length(text) > 0)


def prepare(df: DataFrame, lexicons: Lexicons = DEFAULT, profile: str = profiles.TRAINING) -> DataFrame:
    """Clean ``free_text``, add ``words``, drop the rows that end up empty.

    The cleaned table is written before rows are dropped: a filter on cleaned text would
    be pushed below the cleaning and run it a second time.
    """
    cleaned = profiles.clean(df, "free_text", "free_text", profile, lexicons)
    return drop_empty(materialise(with_tokens(cleaned, "free_text", "words"), "prepared"))


def _classifier(kind: str):
    columns = {"featuresCol": "features", "labelCol": "label_id"}
    if kind == "tree":
        return DecisionTreeClassifier(**columns, **TREE)
    if kind == "logistic":
        return LogisticRegression(**columns, **LOGISTIC)
    raise ValueError(f"kind is 'tree' or 'logistic', not {kind!r}")


def _grid(kind: str, classifier) -> list:
    builder = ParamGridBuilder()
    for name, value in (TREE if kind == "tree" else LOGISTIC).items():
        builder = builder.addGrid(classifier.getParam(name), [value])
    return builder.build()


def _together(kind: str, parallelism: int) -> int:
    """Folds that are fitted at a time. A tree's fit holds each row at full width, so trees are
    fitted one after the other."""
    return 1 if kind == "tree" else min(parallelism, FOLDS)


class FoldsTogether(CrossValidator):
    """Cross-validation of one setting, ``parallelism`` folds at a time. The folds and their
    measures are those of ``CrossValidator``, which fits settings of one fold at a time and
    caches the fold's rows beside the classifier's own copy of what it iterates over."""

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        (setting,) = self.getEstimatorParamMaps()
        folds = self._kFold(dataset)

        def measured(fold: int) -> list[float]:
            train, validation = folds[fold]
            model = self.getEstimator().fit(train, setting)
            return [self.getEvaluator().copy().evaluate(model.transform(validation, setting))]

        with ThreadPool(self.getParallelism()) as pool:
            measures = pool.map(inheritable_thread_target(dataset.sparkSession)(measured), range(len(folds)))
        mean, deviation = self._gen_avg_and_std_metrics(measures)
        best = self.getEstimator().fit(dataset, setting)
        return self._copyValues(CrossValidatorModel(best, mean, None, deviation))


def _validator(kind: str, estimator, classifier, parallelism: int) -> CrossValidator:
    accuracy = MulticlassClassificationEvaluator(
        labelCol="label_id", predictionCol="prediction", metricName="accuracy"
    )
    return FoldsTogether(
        estimator=estimator,
        estimatorParamMaps=_grid(kind, classifier),
        evaluator=accuracy,
        numFolds=FOLDS,
        seed=SEED,
        parallelism=_together(kind, parallelism),
    )


@dataclass(frozen=True)
class Fitted:
    """A model together with the cleaning profile and the lexicons its texts went through."""

    model: PipelineModel
    profile: str
    fold_accuracy: float
    lexicons: Lexicons = DEFAULT


def fit(
    frame: DataFrame,
    kind: str,
    profile: str = profiles.TRAINING,
    idf_in_folds: bool = False,
    parallelism: int = 2,
    lexicons: Lexicons = DEFAULT,
) -> Fitted:
    """Bigrams, hashed counts, IDF and a cross-validated classifier.

    ``frame`` is read several times and should be a written table. What the folds share
    is computed once and written: the weighted vectors, or with ``idf_in_folds`` the
    counts, since then each fold fits its own weights from its own document counts.
    """
    classifier = _classifier(kind)
    ngram = NGram(n=NGRAM, inputCol="words", outputCol="ngrams")
    counts = HashingTF(inputCol="ngrams", outputCol="raw_features", numFeatures=BUCKETS)
    idf = IDF(inputCol="raw_features", outputCol="features")
    if idf_in_folds:
        shared, estimator, column = [ngram, counts], Pipeline(stages=[idf, classifier]), "raw_features"
    else:
        shared, estimator, column = [ngram, counts, idf], classifier, "features"
    shaping = Pipeline(stages=shared).fit(frame)
    shaped = materialise(shaping.transform(frame).select(column, "label_id"), "shaped")
    validated = _validator(kind, estimator, classifier, parallelism).fit(shaped)
    model = PipelineModel(stages=[*shaping.stages, validated])
    return Fitted(model, profile, validated.avgMetrics[0], lexicons)


def predict_texts(fitted: Fitted, df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Predictions straight from texts, batch or stream: cleaning, features and model are
    one projection. Texts that are empty once cleaned have none."""
    named = df.select(*keep, F.col(text).alias("free_text"))
    cleaned = profiles.clean(named, "free_text", "free_text", fitted.profile, fitted.lexicons)
    scored = fitted.model.transform(with_tokens(cleaned, "free_text", "words"))
    return scored.select(*keep, F.when(F.length("free_text") > 0, F.col("prediction")).alias("prediction"))


def predict(fitted: Fitted, prepared: DataFrame, *keep: str) -> DataFrame:
    """Predictions for texts prepared with the profile the model was trained on."""
    return fitted.model.transform(prepared).select(*keep, F.col("prediction"))


def held_out(key: Column) -> Column:
    """Three of sixteen rows, by a hash of the key alone; rows without a key are not."""
    first = F.substring(F.md5(key.cast("string").cast("binary")), 1, 1)
    return F.coalesce(first.isin("0", "1", "2"), F.lit(False))


def holdout_report(prepared: DataFrame, kind: str, key: str) -> DataFrame:
    """The class report of a classifier on labelled rows that it was not fitted on.

    ``prepared`` is read several times and should be a written table.
    """
    labelled = prepared.filter(F.col("label_id").isNotNull())
    test = held_out(F.col(key))
    fitted = fit(labelled.filter(~test).select("words", "label_id"), kind)
    predicted = predict(fitted, labelled.filter(test), "label_id")
    pairs = evaluate.pair_counts(predicted, "label_id", "prediction")
    return evaluate.class_report(evaluate.class_measures(pairs))


def fold_of(key: Column, folds: int = FOLDS) -> Column:
    """The fold of a row, by a hash of its key alone; rows without a key are in the first."""
    first = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.coalesce(F.conv(first, 16, 10).cast("long") % folds, F.lit(0)).cast("int")


def fold_confusion(prepared: DataFrame, kind: str, key: str, parallelism: int = 2) -> DataFrame:
    """``fold, label, prediction, n``: what the model of each fold, fitted on the other folds,
    makes of the rows it has not seen. Folds go by ``fold_of``, so they are the same in every
    run. ``prepared`` should be a written table.

    ``parallelism`` folds (of trees one) are fitted at a time, each from the written counts: the classifiers
    keep their own copy of what they iterate over, so none is cached beside it. No model of
    all rows is fitted."""
    labelled = prepared.filter(F.col("label_id").isNotNull()).withColumn("fold", fold_of(F.col(key)))
    ngram = NGram(n=NGRAM, inputCol="words", outputCol="ngrams")
    counts = HashingTF(inputCol="ngrams", outputCol="raw_features", numFeatures=BUCKETS)
    counted = materialise(
        Pipeline(stages=[ngram, counts]).fit(labelled).transform(labelled).select("raw_features", "label_id", "fold"),
        "counted",
    )
    found = {r["fold"] for r in counted.select("fold").distinct().collect()}
    if len(found) < FOLDS:
        raise ValueError(f"The data of folds {sorted(set(range(FOLDS)) - found)} is empty.")
    estimator = Pipeline(stages=[IDF(inputCol="raw_features", outputCol="features"), _classifier(kind)])

    def fitted(fold: int) -> PipelineModel:
        return estimator.copy().fit(counted.filter(F.col("fold") != fold))

    with ThreadPool(_together(kind, parallelism)) as pool:
        models = pool.map(inheritable_thread_target(counted.sparkSession)(fitted), range(FOLDS))
    seen = [
        model.transform(counted.filter(F.col("fold") == i)).select("fold", "label_id", "prediction")
        for i, model in enumerate(models)
    ]
    return (
        reduce(DataFrame.unionByName, seen)
        .groupBy("fold", F.col("label_id").alias("label"), F.col("prediction").cast("int").alias("prediction"))
        .agg(F.count("*").alias("n"))
    )


def fold_measures(confusion: DataFrame) -> DataFrame:
    """``fold, n, accuracy, weighted_precision, weighted_recall, weighted_f1`` by fold."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    labels = confusion.groupBy("fold", F.col("label").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(hit).alias("hits")
    )
    predicted = confusion.groupBy("fold", F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    classes = (
        labels.join(predicted, ["fold", "class"], "left")
        .withColumn("precision", share(F.col("hits"), F.col("predicted")))
        .withColumn("recall", share(F.col("hits"), F.col("support")))
        .withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    total = F.sum("support")
    weighted = [(F.sum(F.col(m) * F.col("support")) / total).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")]
    return classes.groupBy("fold").agg(total.alias("n"), (F.sum("hits") / total).alias("accuracy"), *weighted)


_LISTS = ("stopwords", "char_to_emoji", "emoji_to_word", "abbreviations", "phrases", "compounds")


def save(fitted: Fitted, path: str) -> None:
    """Store the model, and beside its stages the profile and the lexicons it needs: lists
    as one JSON row, tables as tables."""
    fitted.model.write().overwrite().save(path)
    spark = SparkSession.getActiveSession()
    values = {x: getattr(fitted.lexicons, x) for x in _LISTS}
    tables = {x: v for x, v in values.items() if isinstance(v, DataFrame)}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/lexicons/{name}")
    lists = {x: v for x, v in values.items() if x not in tables}
    bundle = json.dumps({"profile": fitted.profile, "lists": lists, "tables": sorted(tables)})
    note = spark.range(1).select(F.lit(bundle).alias("value"))
    note.coalesce(1).write.mode("overwrite").text(f"{path}/profile")


def load(path: str) -> Fitted:
    spark = SparkSession.getActiveSession()
    model = PipelineModel.load(path)
    bundle = json.loads(spark.read.text(f"{path}/profile").first()["value"])
    values = {
        x: tuple(tuple(v) if isinstance(v, list) else v for v in listed) for x, listed in bundle["lists"].items()
    }
    values |= {x: spark.read.parquet(f"{path}/lexicons/{x}") for x in bundle["tables"]}
    return Fitted(model, bundle["profile"], model.stages[-1].avgMetrics[0], Lexicons(**values))
