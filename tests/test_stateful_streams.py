"""Counters, state across batches, order inside a key, restarts."""

from __future__ import annotations

import datetime
import glob
import itertools
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from reviewloom.operators import ingest
from reviewloom.sources import topics
from reviewloom.streaming import counters, delivery, jobs, stateful

GOOD, BAD = '{"rating":"5","comment":"x"}', "{bad"


def land(spark, folder, rows, schema, files=1):
    spark.createDataFrame(rows, schema).coalesce(files).write.mode("append").parquet(str(folder))


def stream_of(spark, folder, schema, max_files=1):
    return topics.read_landing(spark, str(folder), schema, max_files=max_files)


# --- counters -----------------------------------------------------------------------


def test_counters_of_several_batches_and_one_run_again(spark, tmp_path):
    landing, progress, path = (str(tmp_path / x) for x in ("in", "cp", "counters"))
    for values in ([GOOD, "", None], [GOOD, GOOD, BAD], [BAD]):
        land(spark, landing, [(v,) for v in values], "value STRING")

    def run(handle):
        stream = counters.observed(ingest.flag_rejects(stream_of(spark, landing, "value STRING")))
        with counters.RunCounters(spark, path) as listener:
            listener.drain(jobs.each_batch(stream, handle, progress, drain=True))

    run(jobs.append_batches(str(tmp_path / "out")))
    rows = {r["batch_id"]: r for r in counters.stored(spark, path).collect()}
    assert len(rows) == 3
    want = (7, 3, 2, 2, True)
    assert tuple(counters.totals(spark, path).first()) == want
    # the last batch was written and not committed: it is run again under its number
    os.remove(f"{progress}/commits/2")
    for crc in glob.glob(f"{progress}/commits/.2.crc"):
        os.remove(crc)
    run(jobs.append_batches(str(tmp_path / "out")))
    assert tuple(counters.totals(spark, path).first()) == want
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def test_counters_of_a_batch_the_sink_already_has(spark, tmp_path):
    landing, progress, path = (str(tmp_path / x) for x in ("in", "cp", "counters"))
    land(spark, landing, [(GOOD,), (BAD,)], "value STRING")
    for turn in range(2):
        stream = counters.observed(ingest.flag_rejects(stream_of(spark, landing, "value STRING")))
        with counters.RunCounters(spark, path) as listener:
            listener.drain(jobs.to_files(stream.select("value", "reason"), str(tmp_path / "out"), progress, drain=True))
        assert tuple(counters.totals(spark, path).first()) == (2, 1, 0, 1, True)
        if not turn:
            os.remove(f"{progress}/commits/0")
            for crc in glob.glob(f"{progress}/commits/.0.crc"):
                os.remove(crc)


def test_a_failing_store_is_raised(spark, tmp_path):
    land(spark, tmp_path / "in", [(GOOD,)], "value STRING")
    stream = counters.observed(ingest.flag_rejects(stream_of(spark, tmp_path / "in", "value STRING")))
    (tmp_path / "file").write_text("no folder")
    with counters.RunCounters(spark, str(tmp_path / "file")) as listener, pytest.raises(Exception, match="file"):
        query = jobs.each_batch(stream, jobs.append_batches(str(tmp_path / "out")), str(tmp_path / "cp"), drain=True)
        listener.drain(query)


def test_totals_of_nothing(spark, tmp_path):
    (tmp_path / "q" / "0").mkdir(parents=True)
    (tmp_path / "q" / "0" / "part.json").write_text("")
    assert tuple(counters.totals(spark, str(tmp_path)).first()) == (0, 0, 0, 0, False)


# --- repeats --------------------------------------------------------------------------

RECORD = "item INT, page INT, pos INT, ts TIMESTAMP"


def at(minute):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def test_repeats_across_batches_go_and_state_stays_bounded(spark, tmp_path):
    stateful.state_on_disk(spark)
    landing = tmp_path / "in"
    # each poll reads the records of the last three steps again
    for step in range(20):
        rows = [(i, s, None if i == 4 else 0, at(10 * s)) for s in range(max(0, step - 2), step + 1) for i in range(5)]
        land(spark, landing, rows + rows[:3], RECORD)
    once = stateful.drop_repeats(stream_of(spark, landing, RECORD), "ts", "30 minutes")
    sizes = []
    query = jobs.to_files(once, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    jobs.drain(query)
    for p in query.recentProgress:
        sizes += [s["numRowsTotal"] for s in p["stateOperators"]]
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("item", "page", "pos").collect()]
    assert sorted(got, key=str) == sorted(((i, s, None if i == 4 else 0) for s in range(20) for i in range(5)), key=str)
    # 100 keys in all; a key goes once the watermark is three steps behind its own limit, and
    # the watermark of a batch is that of the one before
    assert max(sizes) <= 40 and max(sizes[10:]) <= max(sizes[:10])


# --- pages ----------------------------------------------------------------------------

PAGE = "item INT, page INT, size INT, payload STRING"


@pytest.mark.parametrize("seed", range(3))
def test_pages_in_any_order(spark, tmp_path, seed):
    stateful.state_on_disk(spark)
    rng = random.Random(seed)
    rows = [(0, p, 3, f"p{p}") for p in range(200)]
    rows += [(i, p, rng.choice([0, 1, 2, 3, 4]), "x") for i in range(1, 12) for p in rng.sample(range(60), 20)]
    rows += [(None, 1, 2, "no item"), (None, 2, 0, "no item"), (None, 3, 2, "no item"), (50, 0, 0, "only empty"), (51, 4, None, "no size")]
    rng.shuffle(rows)
    for lo in range(0, len(rows), 90):
        land(spark, tmp_path / "in", rows[lo : lo + 90], PAGE)
    pruned = stateful.prune_pages(stream_of(spark, tmp_path / "in", PAGE), "item", "page", "size", salts=3)
    query = jobs.to_files(pruned, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    jobs.drain(query)
    assert query.lastProgress["batchId"] >= 4
    out = spark.read.parquet(str(tmp_path / "out"))
    batch = ingest.assemble_pages(spark.createDataFrame(rows, PAGE), "item", "page", "size")
    key = lambda r: str(tuple(r))
    assert sorted(map(key, ingest.assemble_pages(out, "item", "page", "size").collect())) == sorted(map(key, batch.collect()))
    # one number for each item that has an empty page, and salt
    stops = {r[0] for r in rows if r[2] == 0}
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * len(stops)
    assert out.filter("size = 0").count() <= sum(r[2] == 0 for r in rows)


def test_items_share_the_groups_of_the_state(spark, tmp_path, monkeypatch):
    """Calls and rows of the state go by the groups; the lists are those of a batch, text items too."""
    monkeypatch.setattr(stateful, "BUCKETS", 4)
    stateful.state_on_disk(spark)
    schema = "item STRING, page LONG, size INT"
    far = 2**53
    rows = [(f"i{i}", far + p, (i + p) % 4) for i in range(60) for p in range(7)]
    # alike but for the last digit: the stop is no floating number
    rows += [("far", far + 1, 0), ("far", far, 3), ("far", far + 2, 1), ("", 1, 2), ("", 1, 0), ("", 0, 2)]
    random.Random(3).shuffle(rows)
    for lo in range(0, len(rows), 150):
        land(spark, tmp_path / "in", rows[lo : lo + 150], schema)
    pruned = stateful.prune_pages(stream_of(spark, tmp_path / "in", schema), "item", "page", "size", salts=2)
    query = jobs.to_files(pruned, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    jobs.drain(query)
    got, want = (
        sorted(map(tuple, ingest.assemble_pages(x, "item", "page", "size").collect()))
        for x in (spark.read.parquet(str(tmp_path / "out")), spark.createDataFrame(rows, schema))
    )
    assert got == want and ("far", far, 3) in got
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4 * 2


# --- order ----------------------------------------------------------------------------

MESSAGE = "k STRING, t INT, body STRING"


def test_order_inside_a_key_over_several_batches(spark, tmp_path):
    rng = random.Random(5)
    times = itertools.count()
    batches = [[(rng.choice(["hot", "hot", "hot", "a", "b", None]), next(times), "x") for _ in range(80)] for _ in range(3)]
    landing, progress, out = tmp_path / "in", str(tmp_path / "cp"), str(tmp_path / "out")
    handle, failed = delivery.append_in_order(out, "k", ["t"]), []

    def once(batch, batch_id):
        handle(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("between write and commit")

    for rows in batches:
        rng.shuffle(rows)
        land(spark, landing, rows, MESSAGE)
        delivery.supervise(
            lambda: jobs.each_batch(stream_of(spark, landing, MESSAGE), once, progress, drain=True), sleep=lambda _: None
        )
    got = [(r["k"], r["t"], r["seq"]) for r in spark.read.parquet(out).collect()]
    want, n = [], {}
    for k, t, _ in sorted(sum(batches, []), key=lambda r: r[1]):
        n[k] = n.get(k, 0) + 1
        want.append((k, t, n[k]))
    assert sorted(got, key=str) == sorted(want, key=str)
    for batch_id in range(3):
        holders = {}
        for file in glob.glob(f"{out}/batch_id={batch_id}/*.parquet"):
            table = pq.read_table(file, partitioning=None).to_pylist()
            for k in {r["k"] for r in table}:
                assert holders.setdefault(k, file) == file
                seqs = [r["seq"] for r in table if r["k"] == k]
                assert seqs == sorted(seqs)


# --- restarts ---------------------------------------------------------------------------


def test_a_failed_batch_is_run_again(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    for i in range(4):
        land(spark, landing, [(f"m{i}",)], "value STRING")
    store, fails, pauses = jobs.append_batches(out), {0: 1, 2: 3}, []

    def handle(batch, batch_id):
        store(batch, batch_id)
        if fails.get(batch_id, 0):
            fails[batch_id] -= 1
            raise RuntimeError("down")

    query = delivery.supervise(
        lambda: jobs.each_batch(stream_of(spark, landing, "value STRING"), handle, str(tmp_path / "cp"), drain=True),
        attempts=4, pause=2.0, longest_pause=5.0, sleep=pauses.append,
    )
    assert query.exception() is None and not query.isActive
    assert sorted(r["value"] for r in spark.read.parquet(out).collect()) == ["m0", "m1", "m2", "m3"]
    assert pauses == [2.0, 2.0, 4.0, 5.0]


def test_a_fault_that_stays_ends_with_its_cause(spark, tmp_path):
    land(spark, tmp_path / "in", [("m",)], "value STRING")
    starts = []

    def handle(batch, batch_id):
        raise RuntimeError("the disk is gone")

    def start():
        starts.append(1)
        return jobs.each_batch(stream_of(spark, tmp_path / "in", "value STRING"), handle, str(tmp_path / "cp"), drain=True)

    with pytest.raises(StreamingQueryException, match="the disk is gone"):
        delivery.supervise(start, attempts=3, sleep=lambda _: None)
    assert len(starts) == 3
