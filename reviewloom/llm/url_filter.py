"""URL filtering by rules, and by logistic regression where no rule fits.

The regression sees hashed character n-grams of the host and of the path. It is fitted by
Spark ML on a small table of labelled URLs, given as a parameter (url, label) or made from the
topic words below, a bounded list of some hundred URLs. What it makes of hosts that it has not
seen is told by ``held_out_report``.

Defined results: a null URL, or one without ``://``, has an empty host and path and is
judged on those; repeated rows are judged alike; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = 1 << 14
SIZES = (3, 4)
#: Probability from which a URL without a rule is blocked: a wrong block costs more.
BLOCK_FROM = 0.7
#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Words of hosts to block and to allow, the words that go with them, and parts of paths: the
#: labelled table combines them. They are topics, and no hosts of any given table.
BLOCKED = (
    "casino", "poker", "bets", "betting", "lottery", "pills", "pharma", "viagra", "spam", "ads", "adserver",
    "banner", "tracker", "track", "clicks", "popup", "adult", "porn", "escort", "loans", "payday", "replica",
    "warez", "torrent", "malware", "phishing",
)
BLOCKED_WITH = ("", "online-", "-bonus", "-zone", "-365", "super-")
ALLOWED = (
    "library", "museum", "weather", "garden", "school", "recipes", "journal", "theatre", "history", "science",
    "travel", "music", "health", "hospital", "physics", "letters", "nature", "bakery", "railway", "harbour",
    "orchestra", "university", "archive", "chess", "cycling", "astronomy",
)
ALLOWED_WITH = ("", "the-", "-society", "-house", "-21", "city", "north-", "-today")
PREFIXES = ("", "www.", "blog.", "m.", "shop.")
DOMAINS = ("com", "org", "net", "example.com", "example.org", "example.net", "co.uk")
PATHS = ("", "en/{}", "fr/{}", "de/{}", "es/{}", "news/{}.html", "item?id={}", "{}/")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES):
    """The longest rule that fits, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, own, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(prefix))
        name = F.when(fits, own + prefix).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> list[Column]:
    """The overlapping n-grams of the text between two end marks."""
    whole = F.concat(F.lit("^"), text, F.lit("$"))
    return [
        F.transform(
            F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)),
            lambda x: F.concat(F.lit(mark), x),
        )
        for n in SIZES
    ]


def grams(host: Column, path: Column) -> Column:
    return F.concat(*_grams(host, "h"), *_grams(path, "p"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label, word): the words with what goes with them, under prefixes, domains and
    paths in turn. More hosts are allowed than blocked, as in any crawl."""
    rows = []
    for words, beside, label in ((BLOCKED, BLOCKED_WITH, 1.0), (ALLOWED, ALLOWED_WITH, 0.0)):
        for i, word in enumerate(words):
            for j, other in enumerate(beside):
                name = other + word if not other or other.endswith("-") or other.isalpha() else word + other
                k = i * len(beside) + j
                host = f"{PREFIXES[k % len(PREFIXES)]}{name}.{DOMAINS[k % len(DOMAINS)]}"
                # the same paths under either label, so that they tell nothing by themselves
                for turn in range(4):
                    path = PATHS[(j + 2 * turn) % len(PATHS)].format(37 * (7 * i + j) % 9000)
                    rows.append((f"https://{host}/{path}", label, word))
    return spark.createDataFrame(rows, "url string, label double, word string")


def held_out_report(labelled: DataFrame, folds: int = 5) -> DataFrame:
    """(fold, blocked, caught, alarms): what models fitted without a fold's words make of
    their hosts. ``labelled`` has the columns url, label and word; all hosts of a word are in
    one fold, so none of them was seen in any form."""
    part = F.pmod(F.xxhash64("word"), F.lit(folds))
    out = []
    for fold in range(folds):
        rows = labelled.filter(part == fold)
        host, path = host_and_path(F.col("url"))
        seen = fit(labelled.filter(part != fold)).transform(rows.withColumn("grams", grams(host, path)))
        seen = seen.withColumn("blocked", vector_to_array("probability")[1] >= BLOCK_FROM)
        out.append(
            seen.agg(
                F.lit(fold).alias("fold"), F.count_if(F.expr("label = 1")).alias("blocked"),
                F.count_if(F.expr("label = 1 and blocked")).alias("caught"),
                F.count_if(F.expr("label = 0 and blocked")).alias("alarms"),
            )
        )
    return reduce(DataFrame.union, out)


def fit(labelled: DataFrame) -> PipelineModel:
    host, path = host_and_path(F.col("url"))
    rows = labelled.select(grams(host, path).alias("grams"), "label").coalesce(1)
    return Pipeline(
        stages=[
            HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features"),
            LogisticRegression(regParam=0.01, maxIter=30),
        ]
    ).fit(rows)


def filter_urls(
    pages: DataFrame, model: PipelineModel | None = None, labelled: DataFrame | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, probability (of block)."""
    if model is None:
        model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = model.transform(rows.withColumn("grams", grams(F.col("host"), F.col("path"))))
    blocked = vector_to_array("probability")[1]
    return judged.select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(blocked >= BLOCK_FROM, "block").otherwise("allow")).alias("verdict"),
        blocked.alias("probability"),
    )
