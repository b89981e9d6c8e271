"""Phrase tables, and profiles whose lexicons are tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import lexicon as lex
from reviewloom.functions import steps as s
from reviewloom.operators import phrases
from reviewloom.plans.profiles import SERVING, TRAINING, clean, run_steps


def longest_from_the_left(text, table):
    words, out, i = text.split(), [], 0
    longest = max((len(k.split()) for k in table), default=0)
    while i < len(words):
        for n in range(min(longest, len(words) - i), 0, -1):
            found = table.get(" ".join(words[i : i + n]))
            if found is not None:
                out.append(found)
                i += n
                break
        else:
            out.append(words[i])
            i += 1
    return " ".join(" ".join(out).split())


def test_longest_phrase_from_the_left(spark):
    rng = random.Random(2)
    table = {" ".join(rng.choice("abcd") for _ in range(rng.choice([1, 2, 2, 3, 5]))): f"<{i}>" for i in range(40)}
    table |= {"a  b": None, "x y": "", "y": "why not"}
    texts = [" ".join(rng.choice("abcdxyz") for _ in range(rng.choice([0, 1, 2, 9, 60]))) for _ in range(80)]
    texts += ["  a\tb \n c  ", None, "", " ".join("ab" * 4000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    listed = [*table.items(), (" ", "blank"), (None, "null"), ("y", "yet another"), ("  x   y ", "twice")]
    dictionary = spark.createDataFrame(listed, "key STRING, value STRING")
    got = {r["id"]: r["out"] for r in phrases.map_phrases(rows, "id", "text", dictionary, "out").collect()}
    del table["a  b"]
    assert got == {i: None if t is None else longest_from_the_left(t, table) for i, t in enumerate(texts)}


def test_no_phrases_and_no_texts(spark):
    rows = spark.createDataFrame([(1, "a  b")], "id INT, text STRING")
    none = spark.createDataFrame([], "key STRING, value STRING")
    some = spark.createDataFrame([("a", "b")], "key STRING, value STRING")
    assert [r["text"] for r in phrases.map_phrases(rows, "id", "text", none).collect()] == ["a b"]
    assert phrases.map_phrases(rows.filter("false"), "id", "text", some).count() == 0


def test_compound_table_gives_what_the_step_gives(spark):
    rng = random.Random(3)
    syllables = " ".join(lex.COMPOUNDS).split() + ["và", "x"]
    texts = [" ".join(rng.choice(syllables) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    table = spark.createDataFrame([(c,) for c in (*lex.COMPOUNDS, "và", "")], "entry STRING")
    by_step = rows.select("id", run_steps(F.col("text"), [s.join_compounds(lex.COMPOUNDS)]).alias("out"))
    by_table = phrases.join_compounds(rows, "id", "text", table, "out").select("id", "out")
    assert sorted(by_table.collect()) == sorted(by_step.collect())


TEXTS = [
    None, "", "  ", "Chất lượng sản phẩm: tốt  Tính năng nổi bật: đẹp ko", "sp ko tốt add okela", "và\tcủa những gì \n ko",
    "giao hàng nhanh , hài lòng chất lượng sản phẩm rất ok 😀 :)", "anh bạn hihihi kk k k", "Không KO Sp", "không tốt " * 300,
]


@pytest.mark.parametrize("name", [SERVING, TRAINING])
@pytest.mark.parametrize("keep", [(), ("tốt", "không_tốt")])
def test_a_profile_gives_the_same_with_tables(spark, name, keep):
    stop = (*lex.STOPWORDS, "không tốt", "giao hàng")
    literal = lex.Lexicons(stopwords=stop)
    tables = lex.Lexicons(
        stopwords=spark.createDataFrame([(w,) for w in stop], "word STRING"),
        abbreviations=spark.createDataFrame(
            [(i, k, v) for i, (k, v) in enumerate(lex.ABBREVIATIONS)], "ord LONG, key STRING, value STRING"
        ),
        compounds=spark.createDataFrame([(c,) for c in lex.COMPOUNDS], "entry STRING"),
    )
    rows = spark.createDataFrame([(i, t, "kept", 1) for i, t in enumerate(TEXTS)], "id INT, text STRING, out STRING, __word INT")
    plain, joined = (
        clean(rows, "text", "out", name, lexicons, keep).select("id", "text", "out").collect() for lexicons in (literal, tables)
    )
    assert sorted(map(tuple, joined), key=str) == sorted(map(tuple, plain), key=str)


def test_tables_are_refused_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("a",)], "text STRING").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text STRING").parquet(str(tmp_path / "in"))
    lexicons = lex.Lexicons(stopwords=spark.createDataFrame([("a",)], "word STRING"))
    with pytest.raises(ValueError, match="batch handler"):
        clean(stream, "text", "out", lexicons=lexicons)
