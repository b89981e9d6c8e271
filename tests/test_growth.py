"""Work that must not grow faster than the texts: what is written, repeated and scanned."""

from __future__ import annotations

import contextlib
import io
import math
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewloom.functions import lexicon as lex
from reviewloom.functions import patterns as p
from reviewloom.functions import steps as s
from reviewloom.operators import abbreviations, dedupe, features, lookup, phrases
from reviewloom.session import configure, new_folder
from reviewloom.sources import files

LISTED = ("de", "la")
TEXTS = [
    ("la casa de la", "es"), ("la casa de la", "fr"), ("la casa de la", None), ("la casa de la", "es"),
    ("de,la ' \" \n de", "fr"), ("  de", ""), ("nothing here", "en"), ("", "en"), (None, "fr"),
]


def _texts(spark, rows=None):
    return spark.createDataFrame(TEXTS if rows is None else rows, "text STRING, lang STRING")


def _rows(spark):
    spans = abbreviations.spans(_texts(spark), "text", LISTED, "lang", F.col("text").alias("cmt"))
    return spans.withColumn("origin", F.concat_ws("_", "abb", "lang")).select(*abbreviations.CORPUS)


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(True)
    return out.getvalue()


def test_corpus_of_texts_is_the_corpus_by_text(spark):
    def listed(corpus):
        return {r["cmt"]: (len(r["occurrences"]), {tuple(o) for o in r["occurrences"]}) for r in corpus.collect()}

    got = abbreviations.corpus_of_texts(_texts(spark), "text", "lang", LISTED)
    assert listed(got) == listed(abbreviations.corpus_by_text([_rows(spark)]))
    # the texts are grouped ahead of the search, so nothing is moved for each occurrence
    plan = _plan(got)
    assert "Generate" not in plan


def test_split_has_each_text_once(spark):
    long = ("la " * 2000, "es")
    folder = new_folder(spark, "split")
    spark.createDataFrame([(x,) for x in LISTED], "entry STRING").write.text(f"{folder}/list")
    texts = _texts(spark, [*TEXTS, long])
    abbreviations.write_split(texts, "text", "lang", LISTED, f"{folder}/rows", f"{folder}/texts")
    words, splits = abbreviations.read_corpus(spark, f"{folder}/list", [f"{folder}/rows"], [f"{folder}/texts"])
    got = sorted(map(tuple, dedupe.concat_splits(splits).filter(F.length("cmt") < 100).collect()))
    assert words == LISTED and got == sorted(map(tuple, _rows(spark).collect()))
    assert splits[0].filter(F.length("cmt") == 6000).count() == 2000
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, found in os.walk(folder) for f in found)
    assert size < 100 * 6000  # with each of its occurrences the long text would take 2,000 times 6,000


def test_split_takes_less_than_its_texts(spark):
    """Files are compressed, and copies of a text, which are written as they come, are read once."""
    folder = new_folder(spark, "split")
    rows = [(f'la "{i}" \n ' + f"word{i} \\ de, " * 300, lang) for i in range(60) for lang in ("es", "fr", "es")]
    texts = _texts(spark, rows).repartition(4)
    abbreviations.write_split(texts, "text", "lang", LISTED, f"{folder}/rows", f"{folder}/texts")
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, found in os.walk(folder) for f in found)
    assert size < sum(len(t) for t, _ in rows) / 4
    spark.createDataFrame([(x,) for x in LISTED], "entry STRING").write.text(f"{folder}/list")
    _, (got,) = abbreviations.read_corpus(spark, f"{folder}/list", [f"{folder}/rows"], [f"{folder}/texts"])
    want = abbreviations.spans(texts, "text", LISTED, "lang", F.col("text").alias("cmt"))
    want = want.withColumn("origin", F.concat_ws("_", "abb", "lang")).select(*abbreviations.CORPUS)
    found = sorted(map(tuple, got.collect()))
    assert len(found) == 180 and found == sorted(map(tuple, want.collect()))


def test_terms_and_lexicons_are_not_repeated(spark, monkeypatch):
    rows = spark.createDataFrame([(1, ["a b", "a b", "b c"]), (2, ["a b"]), (3, [])], "k LONG, ngrams ARRAY<STRING>")
    weighted = features.tfidf_terms(rows, "k")
    got = {(r["k"], r["term"]): (r["tf"], round(r["weight"], 6)) for r in weighted.collect()}
    assert got == {(1, "a b"): (2, 0.575364), (1, "b c"): (1, 0.693147), (2, "a b"): (1, 0.287682)}
    texts = spark.createDataFrame([(1, "a b a"), (2, "")], "k LONG, text STRING")
    words = spark.createDataFrame([("a",), ("a",), ("z",)], "entry STRING")
    dropped = lookup.drop_tokens(texts, "k", "text", words)
    assert {r["k"]: r["text"] for r in dropped.collect()} == {1: "b", 2: ""}
    assert "salt" not in _plan(weighted) + _plan(dropped)


def test_weighted_terms_move_once(spark):
    """One shuffle by the term, whether a key repeats, is null, or its row has no terms."""
    data = [(1, ["b c", "a b", "b c"]), (1, ["b c"]), (None, ["a b"]), (None, ["a b"]), (2, []), (3, None), (4, ["", "", None])]
    weighted = features.tfidf_terms(spark.createDataFrame(data, "k LONG, ngrams ARRAY<STRING>"), "k")
    got = sorted(((r["k"] or 0, r["term"], r["tf"]), r["weight"]) for r in weighted.collect())
    df = {"b c": 2, "a b": 3, "": 1}
    want = [(0, "a b", 2), (1, "a b", 1), (1, "b c", 3), (4, "", 2)]
    assert [x for x, _ in got] == want
    assert [w for _, w in got] == pytest.approx([n * math.log(8 / (df[t] + 1)) for _, t, n in want])
    physical = _plan(weighted).split("Initial Plan")[-1]
    assert physical.count("Exchange hashpartitioning") == 1 and "Join" not in physical


ODD = [
    "hài lòng", "hài lòng hài lòng", "xhài lòng hài lòngx", "hài lòng", "hài lòng\thài lòng\n", " hài lòng ",
    "chất lượng sản phẩm chất lượng", "﷐hài lòng﷑ ﷒ hài lòng", "a1 b c2", " a1", "a1 ", "b  a1\t\n c ", "x² y ab٣ z",
    "a \t\t b   c　d1e  f", "", " ", "\n", "k", "k k k", "a k", "&", "kkk kk ok", "akkb kk  hihi x", "😀", "a 😀 😀 b😀c", "#a @b ://c :d #", "😀 \t 😀",
]


def _compounds_before(x):
    """Hits by looking behind and ahead at each place, inner spaces by looking ahead."""
    ordered = sorted(lex.COMPOUNDS, key=lambda c: (-len(c), c))
    hit = f"(?<![^{p.J_BLANK}])({p.any_of(ordered)})(?![^{p.J_BLANK}])"
    marked = F.regexp_replace(s._escaped(x), hit, f"{s._OPEN}$1{s._CLOSE}")
    joined = F.regexp_replace(marked, f" (?=[^{s._OPEN}{s._CLOSE}]{{0,{max(map(len, ordered))}}}+{s._CLOSE})", "_")
    return s.squeeze(s._restored(F.replace(F.replace(joined, F.lit(s._OPEN)), F.lit(s._CLOSE))))


def _numbered_before(x):
    single = F.regexp_replace(x, f"[{p.J_BLANK}]+", " ")
    return F.trim(F.regexp_replace(single, rf"(?<![^ ])[^ {p.J_DIGIT}]*+[{p.J_DIGIT}][^ ]*+ ?", ""))


@pytest.mark.parametrize("state", [s.RAW, s.TIDY, s.SPACED])
def test_steps_without_looking_behind(spark, state):
    """The patterns begin with a character, and give what looking behind gave."""
    x = F.col("x")
    ready = {s.RAW: lambda v: v, s.TIDY: s.squeeze, s.SPACED: lambda v: F.array_join(s.token_array(v), " ")}[state]
    df = spark.createDataFrame([(v,) for v in [*ODD, None]], "x STRING").select(ready(x).alias("x"))
    before = {
        "compounds": _compounds_before(x),
        "numbered": F.when(F.rlike(x, F.lit(f"[{p.J_DIGIT}{p.J_ODD_BLANK}]")), _numbered_before(x)).otherwise(s.squeeze(x)),
        "emoji": s.squeeze(F.regexp_replace(x, f"[{p.J_EMOJI}]+", " ")),
        "tag": s.squeeze(F.regexp_replace(x, rf"(?:@|#|://)[^{p.J_SPACE}]+", " ")),
        "laughter": s.squeeze(s._laugh_away(x, s.tokens(x))),
        "phrases": s.squeeze(s._fold(F.concat(F.lit(" "), x, F.lit(" ")), [(f" {k} ", f" {v} ") for k, v in lex.PHRASES])),
    }
    after = {
        "compounds": s.join_compounds(lex.COMPOUNDS), "numbered": s.numbered_words, "emoji": s.emoji, "tag": s.tag,
        "laughter": s.laughter_everywhere, "phrases": s.replace_phrases(lex.PHRASES),
    }
    for name, step in after.items():
        for r in df.select("x", before[name].alias("want"), step.on(x, state).alias("got")).collect():
            assert r["got"] == r["want"], (name, r["x"])
    now = df.select(after["compounds"].on(x, state), after["numbered"].on(x, state))
    assert "(?<!" not in _plan(now)


def test_a_repeated_token_meets_a_lexicon_once(spark):
    """What a text repeats is joined and moved once, and texts are rebuilt in one pass."""
    rows = [(1, "a b " * 3000 + "c"), (2, None), (3, " \t"), (None, "a  b"), (4, "b a"), (5, "a z a")]
    texts = spark.createDataFrame(rows, "k LONG, text STRING")
    found = lookup._found(texts, "k", "text", spark.createDataFrame([("a", "x")], "__word STRING, __value STRING"))
    assert {r["k"]: len(r["__hits"]) for r in found.filter("k is not null").collect()} == {1: 1, 4: 1, 5: 1}
    pairs = spark.createDataFrame([(1, "a", "x y"), (2, "b", None)], "ord LONG, key STRING, value STRING")
    mapped = lookup.map_tokens(texts, "k", "text", pairs, "out")
    want = {(1, "x y b " * 3000 + "c"), (2, None), (3, ""), (None, "a b"), (4, "b x y"), (5, "x y z x y")}
    assert {(r["k"], r["out"]) for r in mapped.collect()} == want
    listed = spark.createDataFrame([("a b", "1"), ("b a", "2"), ("b c", "3")], "key STRING, value STRING")
    hits = phrases.phrase_hits(texts.filter("k = 1"), "k", "text", phrases.phrase_table(listed)).first()["__hits"]
    assert sorted(tuple(h) for h in hits) == [("a b", "1"), ("b a", "2"), ("b c", "3")]
    got = {(r["k"], r["out"]) for r in phrases.map_phrases(texts, "k", "text", listed, "out").collect()}
    assert got == {(1, "1 " * 3000 + "c"), (2, None), (3, ""), (None, "a b"), (4, "2"), (5, "a z a")}
    assert "sort_array" not in _plan(mapped)


def test_what_goes_to_python_at_once_is_bounded_by_bytes(spark):
    """Batches by rows alone hold thousands of long texts, and each core has a worker."""

    @F.pandas_udf("long")
    def at_once(texts: pd.Series) -> pd.Series:
        return pd.Series([int(texts.str.len().sum())] * len(texts))

    long = spark.range(0, 4000, 1, 1).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("de la "), 1000)).alias("t"))
    configure(spark)
    assert long.select(at_once("t").alias("n")).agg(F.max("n")).first()[0] < 4 << 20
