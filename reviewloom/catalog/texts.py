"""Cleaning steps, profiles and the lexicon score."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as lex
from ..functions import steps as s
from ..functions.score import sentiment
from ..operators import lookup, phrases
from ..plans.profiles import SERVING, TRAINING, clean, run_steps
from ..plans.scoring import score_messages
from ..session import new_folder, spread
from ..sources import files
from . import duck, views
from .registry import Catalog, Tables

CATALOG = Catalog()


def _step(
    name: str,
    spark_step: Callable[[Column], Column],
    sql_step: duck.Sql,
    comment: str = views.COMMENT,
) -> None:
    """One step over the whole review comments, each with and without its input tidied."""

    def body(t: Tables) -> DataFrame:
        return views.reviews(t, comment).select("doc_id", spark_step(F.col("comment")).alias("out"))

    sql = f"SELECT doc_id, {sql_step('comment')} AS out FROM (SELECT doc_id, {comment} AS comment FROM documents)"
    CATALOG.add(name, sql, body)


_step("clean_stopwords", s.drop_tokens(lex.STOPWORDS), duck.drop_tokens(lex.STOPWORDS))
_step("clean_emoji", s.emoji, duck.emoji)
_step("clean_url", s.url, duck.url)
_step("clean_special", s.special, duck.special)
_step("clean_repeat", s.repeats, duck.repeats)
_step("clean_mail", s.mail, duck.mail, views.COMMENT_WITH_MAIL)
_step("clean_mail_scoped", s.mail_scoped, duck.mail_scoped, views.COMMENT_WITH_MAIL)
_step("clean_tag", s.tag, duck.tag, views.COMMENT_WITH_MAIL)
_step("clean_mixed", s.numbered_words, duck.numbered_words)
_step("clean_punct", s.sentence_marks, duck.sentence_marks)
_step("clean_lower", s.lower, duck.lower)
_step("map_char_to_emoji", s.replace_all(lex.CHAR_TO_EMOJI), duck.replace_all(lex.CHAR_TO_EMOJI))
_step("map_emoji_to_word", s.replace_all(lex.EMOJI_TO_WORD), duck.replace_all(lex.EMOJI_TO_WORD))
_step("map_abbrev_token", s.map_tokens(lex.ABBREVIATIONS), duck.map_tokens(lex.ABBREVIATIONS))
_step("map_abbrev_phrase", s.replace_phrases(lex.PHRASES), duck.replace_phrases(lex.PHRASES))
_step("map_laughter", s.laughter, duck.laughter)
_step("map_laughter_everywhere", s.laughter_everywhere, duck.laughter_everywhere)
_step("drop_label_quality", s.quality_label, duck.drop_label("Chất lượng sản phẩm:"))
_step("drop_label_feature", s.feature_label, duck.drop_label("Tính năng nổi bật:"))
_step("squeeze", s.squeeze, duck.squeeze, "'  ' || text || '   a \t b '")
_step(
    "join_compounds",
    lambda x: s.join_compounds(lex.COMPOUNDS)(s.numbered_words(x)),
    lambda x: duck.join_compounds(lex.COMPOUNDS)(duck.numbered_words(x)),
)


def _test(name: str, test: Callable[[Column], Column], sql: str) -> None:
    """A yes/no test, over the whole comment and over the source name and the language,
    which are short enough to fail it."""

    def body(t: Tables) -> DataFrame:
        return t.documents.select(
            "doc_id",
            test(F.col("text")).alias("in_text"),
            test(F.col("lang")).alias("in_lang"),
            test(F.concat_ws(" ", "lang", "source")).alias("in_source"),
        )

    CATALOG.add(
        name,
        f"SELECT doc_id, {sql.format(x='text')} AS in_text, {sql.format(x='lang')} AS in_lang, "
        + sql.format(x="(lang || ' ' || source)")
        + " AS in_source FROM documents",
        body,
    )


_NEIGHBOURS = duck.neighbours(duck.squeeze("{x}").replace("{2,}", "{{2,}}"))
_test("has_repeat", s.has_repeat, f"len(list_filter({_NEIGHBOURS}, lambda c: c[1] = c[2])) > 0")
_test("has_space", s.has_space, "contains({x}, ' ')")
_test("has_nonalpha", s.has_nonalpha, r"regexp_matches({x}, '[^\p{{L}}]')")


@CATALOG.query(
    "SELECT d.doc_id, CASE WHEN trim(coalesce(b.text, '')) = '' THEN '' ELSE b.text END AS out "
    "FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id"
)
def blank_guard(t: Tables) -> DataFrame:
    """Documents with the benchmark text of the same number: most have none."""
    items = t.benchmark.select(F.col("item_id").alias("doc_id"), F.col("text").alias("item"))
    joined = t.documents.select("doc_id").join(items, "doc_id", "left")
    return joined.select("doc_id", s.blank_guard(F.col("item")).alias("out"))


@CATALOG.query(
    f"SELECT doc_id, {duck.tokens(duck.join_compounds(lex.COMPOUNDS)(duck.numbered_words('comment')))} AS words"
    f" FROM ({views.REVIEWS_SQL})"
)
def token_array(t: Tables) -> DataFrame:
    steps = [s.numbered_words, s.join_compounds(lex.COMPOUNDS)]
    joined = run_steps(F.col("comment"), steps)
    return views.reviews(t).select("doc_id", s.token_array(joined).alias("words"))


# --- lexicons as tables ---------------------------------------------------------------

# Every word of the benchmark texts, and a chain through the first of them.
_WORDS_SQL = f"SELECT DISTINCT unnest({duck.tokens('text')}) AS word FROM benchmark"


def _benchmark_words(t: Tables) -> DataFrame:
    return t.benchmark.select(F.explode(s.token_array(F.col("text"))).alias("word")).distinct()


@CATALOG.query(
    f"""
WITH words AS ({_WORDS_SQL}),
mapped AS (SELECT word AS key, word || '_in_' || length(word) AS value FROM words),
tok AS (
  SELECT doc_id, generate_subscripts({duck.tokens('text')}, 1) AS i, unnest({duck.tokens('text')}) AS w
  FROM documents
)
SELECT d.doc_id, coalesce(o.out, '') AS out
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(coalesce(value || '_twice', w), ' ' ORDER BY i) AS out
  FROM tok LEFT JOIN mapped ON key = w GROUP BY doc_id
) o USING (doc_id)
"""
)
def map_abbrev_table(t: Tables) -> DataFrame:
    """A dictionary table of two chained rows per word: the first leads to the second."""
    words = _benchmark_words(t)
    once = F.concat_ws("_in_", "word", F.length("word").cast("string"))
    pairs = words.select(
        F.explode(
            F.array(
                F.struct(F.lit(1).cast("bigint").alias("ord"), F.col("word").alias("key"), once.alias("value")),
                F.struct(F.lit(2).cast("bigint").alias("ord"), once.alias("key"), F.concat(once, F.lit("_twice")).alias("value")),
            )
        ).alias("row")
    ).select("row.*")
    texts = spread(t.documents.select("doc_id", "text"))
    return lookup.map_tokens(texts, "doc_id", "text", pairs, "out").select("doc_id", "out")


@CATALOG.query(
    f"""
WITH words AS ({_WORDS_SQL}),
tok AS (
  SELECT doc_id, generate_subscripts({duck.tokens('text')}, 1) AS i, unnest({duck.tokens('text')}) AS w
  FROM documents
)
SELECT d.doc_id, coalesce(o.out, '') AS out
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS out
  FROM tok WHERE w NOT IN (SELECT word FROM words) GROUP BY doc_id
) o USING (doc_id)
"""
)
def drop_words_table(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "text"))
    return lookup.drop_tokens(texts, "doc_id", "text", _benchmark_words(t), "out").select("doc_id", "out")


# Every run of one to four words of the benchmark texts.
_RUNS_SQL = f"""
SELECT DISTINCT array_to_string(w[i:i+n-1], ' ') AS key, n
FROM (SELECT {duck.tokens('text')} AS w FROM benchmark), (SELECT unnest([1, 2, 3, 4]) AS n),
LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)
"""


def _benchmark_runs(t: Tables, sizes: Sequence[int]) -> DataFrame:
    def runs(n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size("w")), lambda i: i + n - 1 <= F.size("w"))
        return F.transform(starts, lambda i: F.array_join(F.slice(F.col("w"), i, n), " "))

    listed = t.benchmark.select(s.token_array(F.col("text")).alias("w")).filter(F.size("w") > 0)
    return listed.select(F.explode(F.concat(*map(runs, sizes))).alias("key")).distinct()


def _longest_from_the_left(sizes: str, value: str) -> str:
    """The scan as steps from hit to hit: each goes to the first hit behind its own end."""
    return f"""
WITH RECURSIVE tok AS MATERIALIZED (
  SELECT doc_id, generate_subscripts({duck.tokens('text')}, 1) AS i, unnest({duck.tokens('text')}) AS w
  FROM documents),
runs AS MATERIALIZED (SELECT * FROM ({_RUNS_SQL}) WHERE n IN ({sizes})),
probes AS (
  SELECT doc_id, i, unnest([
    {{'n': 1, 'p': w}}, {{'n': 2, 'p': w || ' ' || w2}}, {{'n': 3, 'p': w || ' ' || w2 || ' ' || w3}},
    {{'n': 4, 'p': w || ' ' || w2 || ' ' || w3 || ' ' || w4}}]) AS x
  FROM (
    SELECT doc_id, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4
    FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i))),
hits AS MATERIALIZED (
  SELECT doc_id, i, max(n) AS n, arg_max(key, n) AS key
  FROM (SELECT doc_id, i, x.n AS n, x.p AS key FROM probes WHERE x.p IS NOT NULL) JOIN runs USING (n, key)
  GROUP BY doc_id, i),
following AS MATERIALIZED (
  SELECT a.doc_id, a.i, a.n, a.key, b.i AS next
  FROM hits a ASOF LEFT JOIN hits b ON a.doc_id = b.doc_id AND a.i + a.n <= b.i),
taken AS (
  SELECT f.* FROM following f JOIN (SELECT doc_id, min(i) AS i FROM hits GROUP BY doc_id) USING (doc_id, i)
  UNION ALL SELECT f.* FROM taken k JOIN following f ON f.doc_id = k.doc_id AND f.i = k.next),
pieces AS (
  SELECT doc_id, i, {value} AS w FROM taken
  UNION ALL
  SELECT doc_id, i, w FROM tok ANTI JOIN (
    SELECT doc_id, unnest(range(i, i + n)) AS i FROM taken) USING (doc_id, i))
SELECT d.doc_id, coalesce(o.out, '') AS out
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS out FROM pieces GROUP BY doc_id) o USING (doc_id)
"""


@CATALOG.query(_longest_from_the_left("1, 2, 3, 4", "'<' || n || '>'"))
def map_phrases_table(t: Tables) -> DataFrame:
    """Every run of one to four benchmark words, replaced by its number of words."""
    runs = _benchmark_runs(t, (1, 2, 3, 4))
    number = F.size(F.split("key", " ")).cast("string")
    table = runs.withColumn("value", F.concat(F.lit("<"), number, F.lit(">")))
    texts = spread(t.documents.select("doc_id", "text"))
    return phrases.map_phrases(texts, "doc_id", "text", table, "out").select("doc_id", "out")


@CATALOG.query(_longest_from_the_left("2, 3, 4", "replace(key, ' ', '_')"))
def join_compounds_table(t: Tables) -> DataFrame:
    texts = spread(t.documents.select("doc_id", "text"))
    runs = _benchmark_runs(t, (2, 3, 4))
    return phrases.join_compounds(texts, "doc_id", "text", runs, "out").select("doc_id", "out")


# --- profiles and scores --------------------------------------------------------------

_SERVED = duck.chain(views.MAIL_REVIEWS_SQL, "comment", duck.serving(), "processed_comment", "doc_id")
_TRAINED = duck.chain(views.MAIL_REVIEWS_SQL, "comment", duck.training(), "free_text", "doc_id")


@CATALOG.query(f"{_SERVED}\nSELECT doc_id, processed_comment FROM cleaned")
def clean_serving(t: Tables) -> DataFrame:
    texts = spread(views.reviews(t, views.COMMENT_WITH_MAIL))
    return clean(texts, "comment", name=SERVING).drop("comment")


_STOP_SQL = f"""
SELECT word AS entry FROM ({_WORDS_SQL})
UNION SELECT w FROM (SELECT unnest({duck.tokens("text")}) AS w FROM documents) WHERE length(w) > 8
UNION SELECT 'entry' || o_orderkey FROM orders
"""
_SERVED_BY_TABLES = duck.chain(
    views.MAIL_REVIEWS_SQL,
    "comment",
    duck.serving(
        drop=duck.Joined("doc_id", f"t.w FROM {{tokens}} t WHERE t.w NOT IN ({_STOP_SQL})"),
        mapped=duck.Joined(
            "doc_id",
            "coalesce(m.value, t.w) AS w FROM {tokens} t LEFT JOIN ("
            "SELECT DISTINCT c_mktsegment || c_custkey AS key, 'segment' AS value FROM customer"
            " UNION SELECT 'le', 'una') m ON m.key = t.w",
        ),
    ),
    "processed_comment",
    "doc_id",
)


@CATALOG.query(f"{_SERVED_BY_TABLES}\nSELECT doc_id, processed_comment FROM cleaned")
def clean_serving_tables(t: Tables) -> DataFrame:
    """The serving profile with a stop-word file and a dictionary file of many entries."""
    long_words = t.documents.select(F.explode(s.token_array(F.col("text"))).alias("entry"))
    entries = (
        _benchmark_words(t).select(F.col("word").alias("entry"))
        .union(long_words.filter(F.length("entry") > 8))
        .union(t.orders.select(F.concat(F.lit("entry"), "o_orderkey")))
        .distinct()
    )
    stop_path, dictionary_path = new_folder(t.spark, "stopwords"), new_folder(t.spark, "dictionary")
    entries.write.text(stop_path)
    keys = t.customer.select(F.concat("c_mktsegment", "c_custkey").alias("key"), F.lit("segment").alias("value"))
    rows = keys.union(t.spark.createDataFrame([("le", "una")], "key STRING, value STRING")).distinct()
    files.write_csv(rows.select(F.xxhash64("key").alias("ord"), "key", "value"), dictionary_path)
    lexicons = lex.Lexicons(
        stopwords=files.words(files.read_lines(t.spark, stop_path), limit=100),
        abbreviations=files.pairs(files.read_dictionary(t.spark, dictionary_path), limit=100),
    )
    texts = spread(views.reviews(t, views.COMMENT_WITH_MAIL))
    return clean(texts, "comment", lexicons=lexicons).drop("comment")


@CATALOG.query(f"{_TRAINED}\nSELECT doc_id, free_text FROM cleaned")
def clean_training(t: Tables) -> DataFrame:
    texts = spread(views.reviews(t, views.COMMENT_WITH_MAIL))
    return clean(texts, "comment", "free_text", TRAINING).drop("comment")


@CATALOG.query(
    f"{_SERVED}\nSELECT doc_id, {duck.sentiment('processed_comment')} AS sentiment FROM cleaned"
)
def sentiment_lexicon(t: Tables) -> DataFrame:
    return clean_serving(t).select("doc_id", sentiment(F.col("processed_comment")).alias("sentiment"))


@CATALOG.query(
    f"""
WITH w AS (SELECT doc_id, {duck.tokens('lower(comment)')} AS words FROM ({views.REVIEWS_SQL})),
n AS (
  SELECT doc_id, len(list_intersect(words, [{duck.lits(lex.POSITIVE)}])) AS pos,
         len(list_intersect(words, [{duck.lits(lex.NEGATIVE)}])) AS neg FROM w
)
SELECT doc_id, CASE WHEN neg > pos THEN 0 ELSE 1 END AS sentiment FROM n
"""
)
def sentiment_tokens(t: Tables) -> DataFrame:
    scored = sentiment(F.col("comment"), mode="token").alias("sentiment")
    return views.reviews(t).select("doc_id", scored)


_SCORED = duck.chain(
    views.MESSAGE_FIELDS_SQL, "comment", duck.serving(), "processed_comment",
    "message_id, rating, comment, time",
)
SCORED_SQL = f"""{_SCORED}
SELECT message_id, rating, comment AS original_comment, processed_comment,
       {duck.sentiment('processed_comment')} AS sentiment, time
FROM cleaned"""


@CATALOG.query(SCORED_SQL)
def score_reviews(t: Tables) -> DataFrame:
    return score_messages(spread(views.messages(t)), keep=("message_id",))
