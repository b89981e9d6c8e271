"""Models as tables, stored bundles, folds, and lexicons that change under a stream."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.catalog import features as feature_queries
from reviewloom.catalog.registry import Tables
from reviewloom.functions import lexicon as lex
from reviewloom.operators import features, lookup, model_tables, training
from reviewloom.session import materialise
from reviewloom.sources import topics
from reviewloom.streaming import jobs, versions


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        on = {rng.randrange(30): float(rng.randint(1, 4)) for _ in range(rng.randint(0, 8))}
        label = int(on.get(3, 0) > 1 or on.get(7, 0) > on.get(9, 0) or rng.random() < 0.1)
        rows.append((i, SparseVector(30, on), label))
    return spark.createDataFrame(rows, ["key", "features", "label"]).cache()


def test_linear_table_predicts_what_the_model_predicts(vectors):
    model = LogisticRegression(labelCol="label", regParam=0.01).fit(vectors)
    weights, intercept = model_tables.linear_table(model)
    rows = model_tables.feature_rows(vectors, "key", "features")
    got = {r["key"]: r for r in model_tables.score_linear(vectors, "key", rows, weights, intercept).collect()}
    for r in model.transform(vectors).collect():
        assert got[r["key"]]["prediction"] == r["prediction"]
        assert got[r["key"]]["margin"] == pytest.approx(r["rawPrediction"][1])


@pytest.mark.parametrize("depth", [0, 1, 6])
def test_tree_table_predicts_what_the_model_predicts(vectors, depth):
    model = DecisionTreeClassifier(labelCol="label", maxDepth=depth).fit(vectors)
    nodes = model_tables.tree_table(model)
    assert model_tables.tree_depth(nodes) == model.depth
    rows = model_tables.feature_rows(vectors, "key", "features")
    got = {r["key"]: r["prediction"] for r in model_tables.score_tree(vectors, "key", rows, nodes).collect()}
    assert got == {r["key"]: r["prediction"] for r in model.transform(vectors).collect()}
    assert len(got) == 400


GOOD, BAD = "rất đẹp hài lòng giao nhanh", "xấu quá thất vọng trả lại"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows = [(i, f"{(GOOD, BAD)[i % 2]} {rng.choice('abc')} ok{i}", i % 2) for i in range(90)] + [(90, "", 1), (91, None, 0)]
    return spark.createDataFrame(rows, "doc_id INT, free_text STRING, label_id INT")


def test_a_bundle_keeps_profile_and_lexicons(spark, labelled, tmp_path):
    own = lex.Lexicons(
        stopwords=("quá", "rất"),
        abbreviations=spark.createDataFrame([(1, "ok", "oke")], "ord LONG, key STRING, value STRING"),
        phrases=(("a", "b"),),
    )
    prepared = training.prepare(labelled, own)
    fitted = training.fit(prepared.select("words", "label_id"), "logistic", lexicons=own)
    training.save(fitted, str(tmp_path / "model"))
    stored = training.load(str(tmp_path / "model"))
    assert stored.lexicons.stopwords == own.stopwords and stored.lexicons.phrases == own.phrases
    assert stored.lexicons.compounds == lex.COMPOUNDS
    assert [tuple(r) for r in stored.lexicons.abbreviations.collect()] == [(1, "ok", "oke")]
    want, got = (
        sorted(map(tuple, training.predict_texts(f, labelled, "free_text", "doc_id").collect())) for f in (fitted, stored)
    )
    assert got == want
    assert {i: p for i, p in got if i >= 90} == {90: None, 91: None}
    assert all(p == i % 2 for i, p in got if i < 90)


def test_a_stored_model_serves_a_stream(spark, labelled, tmp_path):
    prepared = training.prepare(labelled)
    training.save(training.fit(prepared.select("words", "label_id"), "tree"), str(tmp_path / "model"))
    stored = training.load(str(tmp_path / "model"))
    labelled.select("doc_id", "free_text").repartition(4).write.parquet(str(tmp_path / "in"))
    stream = topics.read_landing(spark, str(tmp_path / "in"), "doc_id INT, free_text STRING", max_files=1)
    served = training.predict_texts(stored, stream, "free_text", "doc_id")
    jobs.drain(jobs.to_files(served, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, training.predict_texts(stored, labelled, "free_text", "doc_id").collect()))


def test_folds_are_the_same_in_every_run(labelled):
    prepared = training.prepare(labelled)
    one, two = (
        sorted(map(tuple, training.fold_confusion(p, "logistic", "doc_id").collect()))
        for p in (prepared, prepared.repartition(3))
    )
    assert one == two and sum(r[3] for r in one) == 90
    folds = prepared.select(training.fold_of(F.col("doc_id")).alias("f"), "label_id").collect()
    want = {(r["f"], r["label_id"]) for r in folds}
    assert {r[:2] for r in one} == want
    # a text tells its label, so each fold's model must be right on what it has not seen
    measured = training.fold_measures(training.fold_confusion(prepared, "logistic", "doc_id")).collect()
    assert len(measured) == 5 and all(r["accuracy"] > 0.9 and r["weighted_f1"] > 0.9 for r in measured)
    assert sum(r["n"] for r in measured) == 90


def test_folds_are_fitted_once_each(labelled, monkeypatch):
    """No model beside those of the folds, and the same rows right and wrong as by CrossValidator."""
    prepared = training.prepare(labelled).filter("label_id is not null").withColumn("fold", training.fold_of(F.col("doc_id")))
    hashed = features.hashed_counts(features.with_ngrams(prepared)).select("raw_features", "label_id", "fold").cache()
    classifier = LogisticRegression(featuresCol="features", labelCol="label_id", **training.LOGISTIC)
    estimator = Pipeline(stages=[IDF(inputCol="raw_features", outputCol="features"), classifier])
    accuracy = MulticlassClassificationEvaluator(labelCol="label_id", metricName="accuracy")
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=training._grid("logistic", classifier), evaluator=accuracy,
        numFolds=training.FOLDS, foldCol="fold", collectSubModels=True,
    )
    want = Counter()
    for i, models in enumerate(validator.fit(hashed).subModels):
        rows = models[0].transform(hashed.filter(F.col("fold") == i)).select("fold", "label_id", "prediction").collect()
        want.update((r[0], r[1], int(r[2])) for r in rows)
    fits, fit = [], LogisticRegression._fit

    def counted(self, dataset):
        fits.append(dataset.count())
        return fit(self, dataset)

    monkeypatch.setattr(LogisticRegression, "_fit", counted)
    got = training.fold_confusion(prepared.drop("fold"), "logistic", "doc_id").collect()
    assert {tuple(r)[:3]: r["n"] for r in got} == want
    assert len(fits) == training.FOLDS and sum(fits) == (training.FOLDS - 1) * hashed.count()


@pytest.mark.parametrize("kind, at_once", [("logistic", 2), ("tree", 1)])
def test_folds_together_measure_as_cross_validation_does(labelled, monkeypatch, kind, at_once):
    """The same folds, measures and model, without a cached copy of each fold."""
    prepared = training.prepare(labelled).filter("label_id is not null")
    frame = features.tfidf(features.with_ngrams(prepared)).select("features", "label_id")
    # some labels are wrong, so that folds differ
    frame = materialise(frame.withColumn("label_id", F.when(F.rand(3) < 0.3, 1 - F.col("label_id")).otherwise(F.col("label_id"))), "frame")
    classifier = training._classifier(kind)
    validator = training._validator(kind, classifier, classifier, 2)
    plain = CrossValidator(
        estimator=classifier, estimatorParamMaps=training._grid(kind, classifier), evaluator=validator.getEvaluator(),
        numFolds=training.FOLDS, seed=training.SEED,
    )
    plain._resetUid(validator.uid)
    want, cached, fit = plain.fit(frame), [], type(classifier)._fit

    def noted(self, dataset):
        cached.append(dataset.storageLevel.useMemory or dataset.storageLevel.useDisk)
        return fit(self, dataset)

    monkeypatch.setattr(type(classifier), "_fit", noted)
    got = validator.fit(frame)
    assert cached == [False] * (training.FOLDS + 1) and validator.getParallelism() == at_once
    assert got.avgMetrics == want.avgMetrics and got.stdMetrics == want.stdMetrics
    assert got.avgMetrics[0] < 1
    pairs = [sorted(map(tuple, m.transform(frame).select("label_id", "prediction").collect())) for m in (got, want)]
    assert pairs[0] == pairs[1]


def test_a_fold_without_rows_is_refused(labelled):
    with pytest.raises(ValueError, match="is empty"):
        training.fold_confusion(training.prepare(labelled).limit(2), "logistic", "doc_id")


def test_weights_are_sent_to_the_bucket_rows(spark):
    from reviewloom import catalog

    scored = catalog.entries()["score_linear_table"].run(spark, "/root/testdata/sf0.001")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(feature" not in plan and "BroadcastHashJoin [feature" in plan
    assert scored.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_fold_measures_by_hand(spark):
    rows = [(0, 0, 0, 3), (0, 0, 1, 1), (0, 1, 0, 2), (0, 1, 1, 4), (1, 0, 1, 5)]
    confusion = spark.createDataFrame(rows, "fold INT, label INT, prediction INT, n LONG")
    got = {r["fold"]: r for r in training.fold_measures(confusion).collect()}
    assert got[0]["accuracy"] == pytest.approx(0.7)
    assert got[0]["weighted_precision"] == pytest.approx(0.4 * 3 / 5 + 0.6 * 4 / 5)
    assert got[0]["weighted_recall"] == pytest.approx(0.7)
    assert (got[1]["n"], got[1]["accuracy"], got[1]["weighted_f1"]) == (5, 0, 0)


def test_a_batch_run_again_keeps_its_lexicon_version(spark, tmp_path):
    path, log, landing = (str(tmp_path / x) for x in ("lexicon", "log", "in"))
    words = lambda *w: spark.createDataFrame([(x,) for x in w], "entry STRING")
    store, failed = jobs.append_batches(str(tmp_path / "out")), []

    def rewrite(batch, lexicon):
        return lookup.drop_tokens(batch, "id", "text", lexicon, "out")

    def fail_once(batch, batch_id):
        store(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            # a new version comes between the failure and the restart
            versions.publish(words("c"), path)
            raise RuntimeError("not committed")

    def run(handle):
        stream = topics.read_landing(spark, landing, "id INT, text STRING")
        jobs.drain(jobs.each_batch(stream, handle, str(tmp_path / "cp"), drain=True))

    handle = versions.reloading(path, log, rewrite, fail_once)
    land = lambda i: spark.createDataFrame([(i, "a b c")], "id INT, text STRING").write.mode("append").parquet(landing)
    land(0)
    with pytest.raises(Exception, match="no version"):
        run(handle)
    assert versions.publish(words("a"), path) == 1
    run(handle)
    assert versions.publish(words("b"), path) == 2
    land(1)
    with pytest.raises(Exception, match="not committed"):
        run(handle)
    run(handle)
    land(2)
    run(handle)
    got = {r["id"]: r["out"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: "b c", 1: "a c", 2: "a b"} and versions.latest(spark, path) == 3


def test_buckets_are_counts(spark):
    df = spark.createDataFrame([(1, ["a b", "b c", "a b"]), (2, [])], "doc_id INT, ngrams ARRAY<STRING>")
    rows = model_tables.feature_rows(features.hashed_counts(df), "doc_id", "raw_features").collect()
    assert sorted(r["value"] for r in rows) == [1.0, 2.0] and {r["doc_id"] for r in rows} == {1}


def test_a_wide_vector_costs_what_it_holds(spark):
    """Only stored values are looked at: a vector of a billion places has no array of them."""
    rows = [(1, SparseVector(10**9, {7: 2.0, 10**9 - 1: 0.0})), (2, DenseVector([0.0, 3.0])), (3, SparseVector(5, {})), (4, None)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", VectorUDT())]))
    got = sorted(map(tuple, model_tables.feature_rows(df, "k", "v").collect()))
    assert got == [(1, 7, 2.0), (2, 1, 3.0)]


def test_labels_meet_filled_buckets_without_their_values(spark, tmp_path):
    """What crosses the shuffle with the labels has no numbers beside the buckets; zeros stored are none."""
    rows = [(1, SparseVector(5, {1: 2.0, 3: 0.0})), (2, SparseVector(5, {1: 1.0, 4: 1.0})), (3, DenseVector([0.0, 3.0])), (4, None)]
    schema = T.StructType([T.StructField("doc_id", T.IntegerType()), T.StructField("raw_features", VectorUDT())])
    vectors = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None)], "doc_id INT, quality INT").write.parquet(str(tmp_path / "labels.parquet"))
    sides = feature_queries._sides(Tables(spark, str(tmp_path)), vectors)
    assert sorted(map(tuple, sides.collect())) == [(1, 2, 1), (4, 1, 1)]
    below = sides._jdf.queryExecution().optimizedPlan().toString().split("Join ", 1)[0]
    assert "raw_features" not in below
    assert [r[1] for r in vectors.select("doc_id", model_tables.filled("raw_features")).orderBy("doc_id").collect()] == [[1], [1, 4], [1], None]


def test_the_batch_beside_the_stream_is_of_labelled_texts(spark, tmp_path, monkeypatch):
    """The stream serves every text; a batch prediction without a label would meet no row."""
    from reviewloom import catalog

    words = (["hàng đẹp lắm", "giao nhanh quá"], ["hàng xấu lắm", "giao chậm quá"])
    texts = [(i, " ".join([*words[i % 2], f"từ {'abc'[i % 3]}"])) for i in range(90)]
    spark.createDataFrame([*texts, (0, "hàng đẹp"), (None, "hàng")], "doc_id LONG, text STRING").write.parquet(
        str(tmp_path / "documents.parquet"))
    labels = [(i, None if i == 7 else i % 2) for i in range(40)]
    spark.createDataFrame(labels, "doc_id LONG, quality INT").write.parquet(str(tmp_path / "labels.parquet"))
    served, predict = [], training.predict_texts
    monkeypatch.setattr(training, "predict_texts", lambda f, df, *names: served.append(df) or predict(f, df, *names))
    got = catalog.entries()["stream_predict"].run(spark, str(tmp_path))
    # the repeated key meets itself: two served, two in the batch, two labelled rows
    assert sorted(map(tuple, got.collect())) == [(0, 19 + 8, 0), (1, 19, 0)]
    batch = [df for df in served if not df.isStreaming]
    assert len(served) == 4 and [df.count() for df in batch] == [41]
