from __future__ import annotations

import json

from reviewloom.functions import records as r
from reviewloom.plans.scoring import read_results, score_messages, to_result_value
from reviewloom.sources import topics
from reviewloom.streaming import jobs

TEXTS = ["đẹp", "xấu 😀", "", None, "hài lòng www.x.vn", "{bad"]


def land(spark, folder, name, texts):
    values = [
        "{bad" if t == "{bad" else json.dumps({"rating": "5", "comment": t, "time": "N/A"}, ensure_ascii=False)
        for t in texts
    ]
    (folder / name).mkdir(parents=True)
    for i, value in enumerate(values):
        frame = spark.createDataFrame([(value,)], "value STRING").coalesce(1)
        frame.write.mode("append").parquet(str(folder / name))
    return spark.read.parquet(str(folder / name))


def listed(df):
    return sorted(x["value"] for x in df.collect())


def test_stream_equals_batch_in_many_batches(spark, tmp_path):
    batch = land(spark, tmp_path, "in", TEXTS)
    stream = topics.read_landing(spark, str(tmp_path / "in"), "value STRING", max_files=2)
    out = str(tmp_path / "out")
    query = jobs.to_files(jobs.score_stream(stream), out, str(tmp_path / "cp"), drain=True)
    jobs.drain(query)
    assert query.lastProgress["batchId"] == 2
    assert listed(spark.read.parquet(out)) == listed(to_result_value(score_messages(batch)))


def test_resume_neither_loses_nor_repeats(spark, tmp_path):
    stream = lambda: topics.read_landing(spark, str(tmp_path / "in/*"), "value STRING")
    out, progress = str(tmp_path / "out"), str(tmp_path / "cp")
    want = []
    for name, texts in (("a", TEXTS[:2]), ("b", []), ("c", TEXTS[2:])):
        if texts:
            want += listed(to_result_value(score_messages(land(spark, tmp_path / "in", name, texts))))
        jobs.drain(jobs.to_files(jobs.score_stream(stream()), out, progress, drain=True))
        assert listed(spark.read.parquet(out)) == sorted(want)


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    handle = jobs.append_batches(str(tmp_path / "out"))
    frame = spark.createDataFrame([("x",), ("y",)], "value STRING")
    for batch_id in (0, 1, 1):
        handle(frame, batch_id)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_each_batch_is_handled_once(spark, tmp_path):
    land(spark, tmp_path, "in", TEXTS)
    stream = topics.read_landing(spark, str(tmp_path / "in"), "value STRING", max_files=1)
    seen = []
    jobs.drain(
        jobs.each_batch(
            stream, lambda df, i: seen.append((i, df.count())), str(tmp_path / "cp"), drain=True
        )
    )
    assert seen == [(i, 1) for i in range(len(TEXTS))]


def test_a_running_query_is_stopped(spark, tmp_path):
    land(spark, tmp_path, "in", TEXTS[:1])
    stream = topics.read_landing(spark, str(tmp_path / "in"), "value STRING")
    query = jobs.each_batch(stream, jobs.show_batches(), str(tmp_path / "cp"), every="1 second")
    with jobs.running(query):
        query.processAllAvailable()
        assert query.isActive
    assert not query.isActive


def test_results_are_read_back(spark):
    values = ['{"processed_comment":"đẹp","sentiment":1,"time":"N/A"}', "", None]
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    got = read_results(df)
    assert got.columns == r.RESULT_READ.names
    assert [tuple(x) for x in got.collect()] == [("đẹp", 1)]


def test_messages_are_keyed_by_order(spark):
    df = spark.createDataFrame([(7, "x")], "orderid LONG, value STRING")
    assert tuple(topics.keyed(df, "orderid").first()) == ("7", "x")
