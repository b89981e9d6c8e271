"""Streaming queries, worked off to the end over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records as r
from ..functions import steps as s
from ..operators import ingest, lookup, training
from ..session import new_folder
from ..sources import topics
from ..streaming import counters, delivery, jobs, stateful, versions
from . import duck, evaluation, features, sources, texts, views
from .registry import Catalog, Tables

CATALOG = Catalog()

FILES_PER_BATCH = 1_000


class _Arriving(Tables):
    """The given tables as streams; views are written against either."""

    def __getattr__(self, name: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.folder}/{name}.parquet").schema
        return topics.read_landing(
            self.spark, self.files(name), schema, max_files=FILES_PER_BATCH
        )


def _stream(t: Tables) -> Tables:
    return _Arriving(t.spark, t.folder)


def _drained(t: Tables, stream: DataFrame, name: str) -> DataFrame:
    path = new_folder(t.spark, name)
    jobs.drain(jobs.to_files(stream, path, new_folder(t.spark, "progress"), drain=True))
    return t.spark.read.schema(stream.schema).parquet(path)


@CATALOG.query("SELECT event_id, event_type, (props::JSON ->> 'k')::BIGINT AS k FROM events")
def src_stream_file(t: Tables) -> DataFrame:
    events = _stream(t).events
    parsed = events.withColumn("data", r.parse(F.col("props"), "k BIGINT"))
    return _drained(t, parsed.select("event_id", "event_type", "data.k"), "events")


@CATALOG.query(views.NORMALIZED_SQL)
def src_incremental(t: Tables) -> DataFrame:
    """Landed pages, polled in bounded micro-batches, give the messages of one batch run."""
    pages = ingest.parse_pages(views.with_payload(_stream(t).events))
    keep = ("item", "page")
    normal = ingest.normalize(ingest.explode_ratings(pages, keep), (*keep, "pos"))
    return _drained(t, normal, "messages")


_EVENT_VALUES = """
SELECT event_id, '{"event_type":"' || event_type || '","k":' || (props::JSON ->> 'k') || '}' AS value FROM events
"""


def _event_values(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    return events.select("event_id", r.emit("event_type", k).alias("value"))


@CATALOG.query(_EVENT_VALUES)
def sink_stream_append(t: Tables) -> DataFrame:
    return _drained(t, _event_values(_stream(t).events), "appended")


@CATALOG.query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def sink_foreach_batch(t: Tables) -> DataFrame:
    """A handler that stores the counts of each micro-batch; the batches add up."""
    path = new_folder(t.spark, "batches")
    store = jobs.append_batches(path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        store(batch.groupBy("event_type").agg(F.count("*").alias("n")), batch_id)

    events = _stream(t).events
    jobs.drain(jobs.each_batch(events, handle, new_folder(t.spark, "progress"), drain=True))
    stored = t.spark.read.parquet(path)
    return stored.groupBy("event_type").agg(F.sum("n").alias("n"))


@CATALOG.query(_EVENT_VALUES)
def sink_parquet_append(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "results")
    values = _event_values(_stream(t).events)
    handle = jobs.append_batches(path)
    jobs.drain(jobs.each_batch(values, handle, new_folder(t.spark, "progress"), drain=True))
    return t.spark.read.parquet(path).drop("batch_id")


@CATALOG.query(f"SELECT rating, original_comment, processed_comment, sentiment, time FROM ({texts.SCORED_SQL})")
def stream_score(t: Tables) -> DataFrame:
    """Scored messages of a stream equal those of a batch."""
    cores = t.spark.sparkContext.defaultParallelism
    few = t.documents.rdd.getNumPartitions() < cores
    messages = views.messages(_stream(t))
    values = _drained(t, jobs.score_stream(messages, partitions=cores if few else None), "scored")
    return values.select(r.parse(F.col("value"), r.RESULT_MESSAGE).alias("m")).select("m.*")


@CATALOG.query(
    """
SELECT 'd' || doc_id AS message_id, text AS comment FROM documents
UNION ALL SELECT 'c' || conv_id || ':' || turn, text FROM conversations
"""
)
def stream_resume(t: Tables) -> DataFrame:
    """Two runs over one checkpoint, with new files landing between them: each message
    once."""
    landing, results = new_folder(t.spark, "landing"), new_folder(t.spark, "resumed")
    progress = new_folder(t.spark, "progress")
    documents = t.documents.select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("message_id"), F.col("text").alias("comment")
    )
    turns = t.conversations.select(
        F.concat(F.lit("c"), F.col("conv_id"), F.lit(":"), F.col("turn")).alias("message_id"),
        F.col("text").alias("comment"),
    )
    schema = "message_id STRING, comment STRING"
    for arrived in (documents, turns):
        arrived.select(r.emit("message_id", "comment").alias("value")).write.mode("append").parquet(landing)
        stream = topics.read_landing(t.spark, landing, "value STRING")
        parsed = stream.select(r.parse(F.col("value"), schema).alias("m")).select("m.*")
        jobs.drain(jobs.to_files(parsed, results, progress, drain=True))
    return t.spark.read.schema(schema).parquet(results)


# --- state, counters and order ----------------------------------------------------------

#: Deliveries that the given rows are landed in, each at least one micro-batch.
DELIVERIES = 3


def _delivered(t: Tables, parts: list[DataFrame], run: Callable[[DataFrame], None], schema=None) -> None:
    """Land the parts one after the other and run what is given on the stream after each."""
    landing = new_folder(t.spark, "landing")
    for part in parts:
        part.write.mode("append").parquet(landing)
        run(topics.read_landing(t.spark, landing, schema or parts[0].schema, max_files=FILES_PER_BATCH))


def _dealt(rows: DataFrame, key: str) -> list[DataFrame]:
    """The rows in deliveries, by a hash of the key."""
    at = F.pmod(F.xxhash64(key), F.lit(DELIVERIES))
    return [rows.filter(at == i) for i in range(DELIVERIES)]


@CATALOG.query(evaluation.COUNTS_SQL)
def stream_counts(t: Tables) -> DataFrame:
    """Counters observed while batches are written, stored by batch and added up."""
    results, progress, path = (new_folder(t.spark, x) for x in ("flagged", "progress", "counters"))
    with counters.RunCounters(t.spark, path) as run:

        def drain(stream: DataFrame) -> None:
            flagged = counters.observed(ingest.flag_rejects(stream))
            run.drain(jobs.to_files(flagged.select("event_id", "reason"), results, progress, drain=True))

        _delivered(t, _dealt(views.mixed_messages(t), "event_id"), drain)
    return counters.totals(t.spark, path)


_REPEATED_SQL = """
SELECT user_id AS item, event_id AS page, event_type, ts FROM events
"""


@CATALOG.query(_REPEATED_SQL)
def stream_drop_repeats(t: Tables) -> DataFrame:
    """Each poll delivers again what the polls before have delivered; each record stays once."""
    stateful.state_on_disk(t.spark)
    rows = t.events.select(
        F.col("user_id").alias("item"), F.col("event_id").alias("page"), "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    parts = _dealt(rows, "page")
    polls = [reduce(DataFrame.unionByName, parts[: i + 1]) for i in range(len(parts))]
    results, progress = new_folder(t.spark, "once"), new_folder(t.spark, "progress")

    def drain(stream: DataFrame) -> None:
        # the polls repeat records of the whole span of the table
        once = stateful.drop_repeats(stream, "ts", "1000 days", ("item", "page"))
        jobs.drain(jobs.to_files(once, results, progress, drain=True))

    _delivered(t, polls, drain)
    return t.spark.read.parquet(results).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@CATALOG.query(sources.PAGES_SQL)
def stream_page_assembly(t: Tables) -> DataFrame:
    """Pages that arrive in any order, over several batches, give the lists of one batch run."""
    stateful.state_on_disk(t.spark)
    pages = ingest.parse_pages(views.with_payload(t.events))
    sized = pages.select("item", "page", F.size("ratings").alias("size"))
    results, progress = new_folder(t.spark, "pages"), new_folder(t.spark, "progress")

    def drain(stream: DataFrame) -> None:
        pruned = stateful.prune_pages(stream, "item", "page", "size")
        jobs.drain(jobs.to_files(pruned, results, progress, drain=True))

    _delivered(t, _dealt(sized, "page"), drain)
    return ingest.assemble_pages(t.spark.read.parquet(results), "item", "page", "size")


@CATALOG.query(
    """
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events
"""
)
def sink_keyed_order(t: Tables) -> DataFrame:
    """Messages numbered within their key, batch after batch."""
    rows = t.events.select("user_id", "event_id", "ts")
    # deliveries follow the time, as a topic's partitions do
    cuts = [F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date")]
    parts = [
        rows.filter(F.col("ts") < cuts[0]),
        rows.filter((F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1])),
        rows.filter(F.col("ts") >= cuts[1]),
    ]
    results, progress = new_folder(t.spark, "ordered"), new_folder(t.spark, "progress")
    handle = delivery.append_in_order(results, "user_id", ("ts", "event_id"))
    _delivered(t, parts, lambda stream: jobs.drain(jobs.each_batch(stream, handle, progress, drain=True)))
    return t.spark.read.parquet(results).select("user_id", "event_id", "seq")


@CATALOG.query("SELECT event_id, event_type FROM events")
def stream_restart(t: Tables) -> DataFrame:
    """Each delivery's batch fails once between its write and its commit; each message once."""
    results, progress = new_folder(t.spark, "restarted"), new_folder(t.spark, "progress")
    store, failed = jobs.append_batches(results), set()

    def handle(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        if batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("the batch is written and not committed")

    def drain(stream: DataFrame) -> None:
        delivery.supervise(lambda: jobs.each_batch(stream, handle, progress, drain=True), sleep=lambda _: None)

    _delivered(t, _dealt(t.events.select("event_id", "event_type"), "event_id"), drain)
    return t.spark.read.parquet(results).drop("batch_id")


@CATALOG.query(
    f"""
WITH short AS (SELECT DISTINCT unnest({duck.tokens("text")}) AS word FROM benchmark),
long AS (SELECT DISTINCT w FROM (SELECT unnest({duck.tokens("text")}) AS w FROM documents) WHERE length(w) > 6),
tok AS (
  SELECT doc_id, generate_subscripts({duck.tokens("text")}, 1) AS i, unnest({duck.tokens("text")}) AS w FROM documents)
SELECT d.doc_id, coalesce(o.out, '') AS out FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS out FROM tok
  WHERE CASE WHEN doc_id % 3 = 0 THEN w NOT IN (SELECT word FROM short) ELSE w NOT IN (SELECT w FROM long) END
  GROUP BY doc_id) o USING (doc_id)"""
)
def stream_lexicon_reload(t: Tables) -> DataFrame:
    """Texts arrive in three deliveries; behind the first a new word list is published, which
    the batches after it take up, without a restart of the job that publishes nothing."""
    texts_ = t.documents.select("doc_id", "text")
    word = F.explode(s.token_array(F.col("text"))).alias("entry")
    lists = [t.benchmark.select(word).distinct(), texts_.select(word).filter(F.length("entry") > 6).distinct(), None]
    path, log, results, progress = (new_folder(t.spark, x) for x in ("lexicon", "versions", "cleaned", "progress"))
    handle = versions.reloading(
        path, log, lambda batch, words: lookup.drop_tokens(batch, "doc_id", "text", words, "out"), jobs.append_batches(results)
    )
    todo = iter(lists)

    def drain(stream: DataFrame) -> None:
        words = next(todo)
        if words is not None:
            versions.publish(words, path)
        jobs.drain(jobs.each_batch(stream, handle, progress, drain=True))

    _delivered(t, [texts_.filter(F.col("doc_id") % DELIVERIES == i) for i in range(DELIVERIES)], drain)
    return t.spark.read.parquet(results).select("doc_id", "out")


@CATALOG.query(
    f"""{features.LABELLED_SQL} SELECT label::INT AS label, count(*)::BIGINT AS predicted, 0::BIGINT AS differ
FROM labelled GROUP BY label"""
)
def stream_predict(t: Tables) -> DataFrame:
    """A stored model, its profile and its lexicons serve a stream of texts: labelled texts
    with a prediction, and those whose prediction is not that of the batch."""
    labels = t.labels.select("doc_id", F.col("quality").alias("label"))
    frame = training.training_frame(t.documents.join(labels, "doc_id"), "text", "label", "doc_id")
    prepared = training.prepare(frame.filter(F.col("label_id").isNotNull()))
    path, results, progress = (new_folder(t.spark, x) for x in ("model", "predicted", "progress"))
    training.save(training.fit(prepared.select("words", "label_id"), "logistic"), path)
    stored = training.load(path)
    texts_ = t.documents.select("doc_id", "text")

    def drain(stream: DataFrame) -> None:
        served = training.predict_texts(stored, stream, "text", "doc_id")
        jobs.drain(jobs.to_files(served, results, progress, drain=True))

    _delivered(t, _dealt(texts_, "doc_id"), drain)
    # the stream serves every text; of the batch only texts with a label meet it below
    labelled = texts_.join(labels.select("doc_id"), "doc_id", "left_semi")
    batch = training.predict_texts(stored, labelled, "text", "doc_id").withColumnRenamed("prediction", "in_batch")
    both = t.spark.read.parquet(results).join(batch, "doc_id").join(frame.select("doc_id", "label_id"), "doc_id")
    return (
        both.filter(F.col("label_id").isNotNull() & F.col("prediction").isNotNull())
        .groupBy(F.col("label_id").alias("label"))
        .agg(F.count("*").alias("predicted"), F.count_if(~F.col("prediction").eqNullSafe(F.col("in_batch"))).alias("differ"))
    )
