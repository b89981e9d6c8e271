"""What the optimizer makes of the queries."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from reviewloom import catalog, session
from reviewloom.functions.score import sentiment
from reviewloom.operators import evaluate, skew
from reviewloom.plans.profiles import clean

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_no_python_in_cleaning_and_scoring(spark):
    entries = catalog.entries()
    for name in ("clean_serving", "clean_training", "score_reviews", "eval_class_report"):
        text = plan(entries[name].run(spark, FOLDER))
        assert "Python" not in text and "ArrowEval" not in text, name


def test_a_filter_on_cleaned_text_stays_small(documents):
    cleaned = clean(documents, "text", "out").withColumn("s", sentiment(F.col("out")))
    plain = len(plan(cleaned))
    filtered = cleaned.filter((F.col("s") == 1) & (F.length("out") > 0))
    assert len(plan(filtered)) < 6 * plain
    assert filtered.count() > 0


def test_other_filters_reach_the_scan(documents):
    kept = clean(documents, "text", "out").filter("lang = 'en'").select("doc_id", "out")
    scan = plan(kept)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(lang,en\)", scan)
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in scan


def test_stop_words_are_a_hash_set(documents):
    assert "INSET" in plan(clean(documents, "text", "out"))


def test_evaluation_counts_before_the_shuffle(documents):
    pairs = evaluate.pair_counts(documents.selectExpr("n_chars % 2 y", "n_chars % 3 p"), "y", "p")
    text = plan(evaluate.class_report(evaluate.class_measures(pairs)))
    assert text.count("FileScan") == 1
    assert "partial_count" in text


def test_large_joins_are_not_cross_joins(spark):
    for name in ("page_assembly", "dedupe_keep_last", "idf_terms", "map_abbrev_table"):
        text = plan(catalog.entries()[name].run(spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_salted_join_without_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(merge, "false")
    try:
        large = spark.range(20_000).select(F.lit(1).alias("k"), "id")
        keyed = spark.createDataFrame([(1, "x")], "k INT, v STRING")
        joined = skew.salted_join(large, keyed, ["k"])
        assert joined.filter("v = 'x'").count() == 20_000
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set(merge, "true")


def test_shuffle_partitions_grow_with_the_input():
    assert session.shuffle_partitions(1 << 20, 8) == 8
    assert session.shuffle_partitions(100 << 40, 8) == 819_200


def test_shared_folder_comes_from_the_session(spark):
    folder = session.new_folder(spark, "x")
    assert folder != session.new_folder(spark, "x")
    assert folder.startswith(session.shared_folder(spark))
