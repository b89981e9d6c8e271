"""N-grams, term counts, TF-IDF."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import steps as s

# The n-gram size and the number of hash buckets.
NGRAM = 2
BUCKETS = 2000


def with_tokens(df: DataFrame, text: str, output: str = "words") -> DataFrame:
    return df.withColumn(output, s.token_array(F.col(text)))


def with_ngrams(
    df: DataFrame, words: str = "words", output: str = "ngrams", unigrams: bool = False
) -> DataFrame:
    """Bigrams of a token list, or single tokens and bigrams; fewer than two tokens give
    no bigram."""
    df = NGram(n=NGRAM, inputCol=words, outputCol=output).transform(df)
    return df.withColumn(output, F.concat(words, output)) if unigrams else df


def term_counts(df: DataFrame, terms: str = "ngrams") -> DataFrame:
    """Occurrences of each term. Partial sums come first, so a term reaches the shuffle
    at most once per task."""
    return df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def document_frequency(df: DataFrame, terms: str = "ngrams") -> DataFrame:
    """Rows per term. Terms are made distinct inside the row, not by a shuffle."""
    return (
        df.select(F.explode(F.array_distinct(terms)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )


def _idf(df: DataFrame) -> Column:
    """The smoothed weight of a term by its ``df`` among the rows of ``df``."""
    rows = df.agg(F.count("*")).scalar()
    return F.log((rows + F.lit(1)) / (F.col("df") + F.lit(1)))


def idf_terms(df: DataFrame, terms: str = "ngrams") -> DataFrame:
    """Smoothed inverse document frequency of every term."""
    return document_frequency(df, terms).withColumn("idf", _idf(df))


def top_terms(df: DataFrame, terms: str, n: int) -> DataFrame:
    """The ``n`` most frequent terms; ties go by the term itself."""
    return term_counts(df, terms).orderBy(F.desc("n"), F.asc("term")).limit(n)


def hashed_counts(df: DataFrame, terms: str = "ngrams", output: str = "raw_features") -> DataFrame:
    return HashingTF(inputCol=terms, outputCol=output, numFeatures=BUCKETS).transform(df)


def tfidf(df: DataFrame, terms: str = "ngrams", output: str = "features") -> DataFrame:
    """Hashed TF-IDF vectors."""
    counted = hashed_counts(df, terms, "__tf")
    model = IDF(inputCol="__tf", outputCol=output).fit(counted)
    return model.transform(counted).drop("__tf")


def _counted(terms: Column) -> Column:
    """The terms of a list, each once with its count, as runs of the sorted list."""

    def last(ordered: Column) -> Column:
        ends = F.transform(ordered, lambda x, i: F.when(~x.eqNullSafe(F.get(ordered, i + 1)), i + 1))
        return F.filter(ends, lambda i: i.isNotNull())

    def counted(ordered: Column) -> Column:
        return s.bind(
            last(ordered),
            lambda ends: F.transform(
                ends,
                lambda end, i: F.struct(
                    F.get(ordered, end - 1).alias("term"), (end - F.when(i > 0, F.get(ends, i - 1)).otherwise(0)).alias("tf")
                ),
            ),
        )

    return s.bind(F.sort_array(terms), counted)


def tfidf_terms(df: DataFrame, key: str, terms: str = "ngrams") -> DataFrame:
    """Exact weights, without hash buckets: a row for each key and term.

    Terms are counted inside their row and then move once, by the term: there the rows that have
    it are counted, and those of one key are added up. There are about as many terms as rows, so
    no side of a join is moved beside them; a term has as many rows as texts hold it, at most.
    """
    each = df.select(key, F.explode(_counted(F.col(terms))).alias("x")).select(key, "x.*").filter("term is not null")
    met = each.repartition("term").withColumn("df", F.count("*").over(Window.partitionBy("term")))
    counts = met.groupBy(key, "term", "df").agg(F.sum("tf").alias("tf"))
    return counts.select(key, "term", "tf", (F.col("tf") * _idf(df)).alias("weight"))


def vector_sum(vector: str):
    return F.aggregate(vector_to_array(F.col(vector)), F.lit(0.0), lambda a, b: a + b)
