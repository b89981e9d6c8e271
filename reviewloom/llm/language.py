"""Language identification: the family first, then one-versus-one inside the family.

Features are the square roots of the shares of hashed letter trigrams of the whole text,
other characters counting as one space. A linear support vector machine for each pair of
families picks the family by votes, and one for each pair of languages in it the language.
The machines are fitted by Spark ML on at most ``PER_LANGUAGE`` labelled texts a language,
the first in the order of their hashes; copies count once. Prediction reads the text only.

Defined results: null text, and text without letters, is ``und`` with score 0, and so is
every text where nothing was learned; rows without a language are not learned from; with
one learned language all texts with letters are of it, with score 1; repeated rows are
predicted alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, bounded_batches

UNKNOWN = "und"
#: Labelled texts a language that training uses at most.
PER_LANGUAGE = 300
FEATURES = 4096
#: Bytes worked on at a time.
SLICE = 1 << 20
#: Language families; a language that is not listed is a family of its own.
FAMILIES: Mapping[str, str] = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
    "ro": "romance", "ca": "romance", "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic",
}

#: Letters keep their lower case, bytes of other scripts stay, all else is a space (0).
_CODE = np.zeros(256, dtype=np.uint32)
_CODE[65:91] = _CODE[97:123] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def features(raw: bytes) -> np.ndarray:
    """Square roots of the shares of the text's trigrams, hashed."""
    counts = np.zeros(FEATURES, dtype=np.int64)
    for at in range(0, len(raw), SLICE):
        code = _CODE[np.frombuffer(raw[max(0, at - 2) : at + SLICE], dtype=np.uint8)]
        hashed = (code[:-2] * np.uint32(0x9E3779B1) + code[1:-1]) * np.uint32(0x85EBCA6B) + code[2:]
        hashed = (hashed * np.uint32(0xC2B2AE35)) >> np.uint32(20)
        counts += np.bincount(hashed[code[1:-1] > 0], minlength=FEATURES)
    total = counts.sum()
    return np.sqrt(counts / total) if total else counts.astype(float)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features((x or "").encode()) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array(rows, pa.list_(pa.float64()))], names=["lang", "x"]
        )


def fit(labelled: DataFrame, scratch: Scratch, families: Mapping[str, str] = FAMILIES, per_language: int = PER_LANGUAGE) -> dict:
    """Machines from (text, lang): {"languages": [...], "machines": {(a, b): (w, c)}}.

    The sample is of distinct texts, those of the lowest hashes of each language. It is
    chosen by hashes alone, the first of each partition and then of each language, so only
    its rows' texts move.
    """
    labelled = labelled.filter("lang is not null and text is not null").withColumn("draw", F.xxhash64("text"))
    by_lang = Window.partitionBy("lang").orderBy("draw")
    chosen = scratch.put(
        labelled.select("lang", "draw").distinct()
        .withColumn("rank", F.row_number().over(by_lang))
        .filter(F.col("rank") <= per_language)
        .select("lang", "draw")
    )
    sample = (
        labelled.join(F.broadcast(chosen), ["lang", "draw"])
        .groupBy("lang", "draw").agg(F.min("text").alias("text"))
        .select("text", "lang")
    )
    rows = scratch.put(sample.coalesce(8).mapInArrow(_feature_rows, "lang string, x array<double>"))
    rows = rows.withColumn("features", array_to_vector("x")).drop("x").coalesce(4)
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    family = {lang: families.get(lang, lang) for lang in languages}

    def machine(groups: tuple[list[str], list[str]]):
        one, two = groups
        train = rows.filter(F.col("lang").isin(one + two)).withColumn(
            "label", F.col("lang").isin(two).cast("double")
        )
        model = LinearSVC(maxIter=25, regParam=1e-3, standardization=False).fit(train)
        return np.array(model.coefficients.toArray()), float(model.intercept)

    names = sorted(set(family.values()))
    within = {f: [x for x in languages if family[x] == f] for f in names}
    machines = {
        ("family", a, b): machine((within[a], within[b])) for a, b in itertools.combinations(names, 2)
    }
    for f in names:
        for a, b in itertools.combinations(within[f], 2):
            machines["language", a, b] = machine(([a], [b]))
    return {"families": names, "within": within, "machines": machines}


def _vote(kind: str, names: list[str], x: np.ndarray, machines: dict) -> tuple[np.ndarray, np.ndarray]:
    """The winner of each row, and the least sure of its wins as a probability."""
    votes = np.zeros((len(x), len(names)))
    margin = np.full((len(x), len(names)), np.inf)
    for (i, a), (j, b) in itertools.combinations(enumerate(names), 2):
        w, c = machines[kind, a, b]
        m = x @ w + c
        votes[:, i] += m < 0
        votes[:, j] += m >= 0
        margin[:, i] = np.minimum(margin[:, i], -m)
        margin[:, j] = np.minimum(margin[:, j], m)
    # votes first, then the margin of the least sure comparison, then the name
    best = np.argmax(votes * 1e6 + np.clip(margin, -1e5, 1e5), axis=1)
    sure = margin[np.arange(len(x)), best]
    return best, 1 / (1 + np.exp(-np.clip(4 * sure, -50, 50)))


def classify(x: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    names, within = model["families"], model["within"]
    family, score = _vote("family", names, x, model["machines"])
    out = np.empty(len(x), dtype=object)
    for k, name in enumerate(names):
        own = np.flatnonzero(family == k)
        if len(own):
            lang, sure = _vote("language", within[name], x[own], model["machines"])
            out[own] = np.array(within[name], dtype=object)[lang]
            score[own] = np.minimum(score[own], sure)
    return out, score


def identify_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    families: Mapping[str, str] = FAMILIES, per_language: int = PER_LANGUAGE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score, and the columns to carry
    along.

    Rows whose crc32 of the id, modulo 4, is 2 are held out from learning.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "language")
    out = held_out(F.col(id_col))
    model = fit(
        docs.filter(~out).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")),
        scratch, families, per_language,
    )
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()
    carried = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = len(texts)
            lang, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
            own = [i for i, t in enumerate(texts) if has_letter(t)] if model["families"] else []
            for at in range(0, len(own), 256):
                part = own[at : at + 256]
                x = np.stack([features(texts[i].encode()) for i in part])
                lang[part], score[part] = classify(x, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score), *[batch.column(c) for c in carry]],
                names=["id", "held_out", "lang_pred", "score", *carry],
            )

    return (
        docs.select(F.col(id_col).alias("id"), out.alias("held_out"), F.col(text_col).alias("text"), *carry)
        .mapInArrow(run, f"id {id_type}, held_out boolean, lang_pred string, score double" + carried)
        .withColumnRenamed("id", id_col)
    )
