"""The corpus pipeline: each stage works on all that the one before kept.

A stage takes the documents that are left and returns the documents that stay, with the
columns they came with; the last one adds the probability of the sample. Rows are told apart
by their place in the files they are read from, so rows without a doc_id, or that share one,
do not share a fate, and nothing is copied for it. A stage writes its decision, a bit (in the
last one a probability) for each document, 64 to a row, and deletes what its operator wrote on
the way; the documents themselves are joined with it as they are read. So Spark can send the
decision over many times as many documents to all tasks as with a row for each, and only
beyond that the texts are shuffled for it.

Defined results: of equal texts the exact de-duplication keeps one row, also where they have
no doc_id; of near copies the row of the smallest doc_id stays, null ids last; null and empty
texts have no language and go in the first stage; a document without a language gets the one
that was predicted, and mixing goes by that; columns of any other name stay as they are, and
where one is called ``probability`` the last stage's has ``_`` put before its name; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.decontaminate import decontaminate
from reviewloom.llm.exact_dedup import exact_dedup
from reviewloom.llm.language import UNKNOWN, identify_language
from reviewloom.llm.mixing import mix_sources
from reviewloom.llm.ngram_join import ngram_join
from reviewloom.llm.scratch import Scratch, settled

#: Score of the predicted language below which a document goes: one of the comparisons that
#: chose it was lost. No held-out text of the given tables has less than 0.509, of 2,499.
LEAST_SCORE = 0.5
#: Files up to which their list is sent to all tasks; beyond that it is joined by a shuffle.
FEW_FILES = 50_000
#: Bits of a row's number inside its file, and of the place among the rows that one word of a
#: decision is for.
_ROW_BITS = 36
_PLACE_BITS = 6


def _fresh(docs: DataFrame, name: str) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _numbered(spark: SparkSession, docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The documents with a column of numbers that are the same whenever they are read, and
    its name: the number of the file and of the row in it. What is no table of files is
    written first."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = Scratch(spark, name).put(docs)
    row, file, path, at, place = (_fresh(docs, x) for x in ("row_", "file_", "path_", "at_", "place_"))
    # a row for each file, so its size is known
    files = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    numbers = spark.createDataFrame(list(enumerate(files)), f"{file} long, {path} string")
    if len(files) <= FEW_FILES:
        numbers = F.broadcast(numbers)
    placed = docs.select("*", F.col("_metadata.file_path").alias(at), F.col("_metadata.row_index").alias(place))
    number = F.shiftleft(F.col(file), _ROW_BITS) + F.col(place)
    return placed.join(numbers, F.col(at) == F.col(path)).select(*docs.columns, number.alias(row)), row


def _word(row: str) -> Column:
    return F.shiftright(F.col(row), _PLACE_BITS)


def _place(row: str) -> Column:
    return F.col(row).bitwiseAND((1 << _PLACE_BITS) - 1).cast("int")


def _as_bits(rows: DataFrame, row: str) -> DataFrame:
    """(word, bits): the rows listed, once or more, 64 numbers to a word."""
    bit = F.expr(f"shiftleft(1L, cast(`{row}` & {(1 << _PLACE_BITS) - 1} as int))")
    return rows.groupBy(_word(row).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _with_bits(docs: DataFrame, decided: DataFrame, row: str, listed: bool) -> DataFrame:
    """The documents that are listed, or those that are not."""
    word, bits = (_fresh(docs, x) for x in ("word_", "bits_"))
    joined = docs.join(decided.toDF(word, bits), _word(row) == F.col(word), "inner" if listed else "left")
    bit = F.getbit(F.coalesce(bits, F.lit(0).cast("long")), _place(row))
    return joined.filter(bit == int(listed)).drop(row, word, bits)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, those whose language is not sure enough, and all where
    no language was learned; the others have a language, given or predicted."""
    columns = docs.columns
    docs, row = _numbered(spark, docs, "pipeline-language")
    predicted, unsure, blank = (_fresh(docs, x) for x in ("predicted_", "unsure_", "blank_"))

    def decide() -> DataFrame:
        """The rows that go or get a language: few beside those that stay as they are."""
        read = docs.select("doc_id", "text", "lang", row, F.col("lang").isNull().alias(blank))
        found = identify_language(read, carry=[row, blank])
        sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
        return found.filter(~sure | F.col(blank)).select(row, (~sure).alias(unsure), F.col("lang_pred").alias(predicted))

    changed = settled(spark, "pipeline-language", decide)
    lang = F.coalesce("lang", F.col(predicted).cast(docs.schema["lang"].dataType))
    kept = docs.join(changed, row, "left").filter(~F.coalesce(unsure, F.lit(False)))
    return kept.withColumn("lang", lang).select(*columns)


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays: the longest, then that of the smallest id."""
    docs, row = _numbered(spark, docs, "pipeline-copies")
    kept = settled(
        spark, "pipeline-copies",
        lambda: _as_bits(exact_dedup(docs.select("doc_id", "text", row), carry=[row]).filter("kept"), row),
    )
    return _with_bits(docs, kept, row, True)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    docs, row = _numbered(spark, docs, "pipeline-near")

    def decide() -> DataFrame:
        found = ngram_join(docs.select(row, "text"), id_col=row).select(row, "component_id")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", row))
        kept = (
            found.join(docs.select(row, "doc_id"), row)
            .groupBy("component_id").agg(first.alias("first")).select(F.col("first")[row].alias(row))
        )
        return _as_bits(kept, row)

    return _with_bits(docs, settled(spark, "pipeline-near", decide), row, True)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    docs, row = _numbered(spark, docs, "pipeline-benchmark")
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    gone = settled(
        spark, "pipeline-benchmark",
        lambda: _as_bits(decontaminate(docs.select(row, "text"), benchmark, id_col=row).filter("contaminated"), row),
    )
    return _with_bits(docs, gone, row, False)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample by calibrated probabilities, with each document's probability."""
    columns, name = docs.columns, _fresh(docs, "probability")
    docs, row = _numbered(spark, docs, "pipeline-mixing")
    rate = F.struct(_place(row).cast("tinyint"), "probability")
    rates = settled(
        spark, "pipeline-mixing",
        lambda: mix_sources(docs.select("doc_id", "text", "source", "lang", row), carry=[row])
        .filter("kept").groupBy(_word(row).alias("word")).agg(F.map_from_entries(F.collect_list(rate)).alias("rates")),
    )
    word, by_place = (_fresh(docs, x) for x in ("word_", "rates_"))
    joined = docs.join(rates.toDF(word, by_place), _word(row) == F.col(word))
    place = _place(row).cast("tinyint")
    kept = joined.filter(F.map_contains_key(by_place, place))
    return kept.select(*columns, F.try_element_at(by_place, place).alias(name))


STAGES = [
    ("language", known_language),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("decontamination", no_benchmark),
    ("mixing", mixed),
]

#: Language identification has no SQL form; tests/llm compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again, and the one
    before it is deleted."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = scratch.put(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
