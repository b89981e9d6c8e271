"""The regression over texts with their occurrences against that over a row for each occurrence."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector

from reviewloom.operators import abbreviations, shared_rows

OWN, TERMS = 12, 9


def _rows(classes: int) -> list[tuple]:
    rng, rows = random.Random(5), []
    for _ in range(150):
        indices = sorted(rng.sample(range(TERMS), rng.randint(0, 5)))
        values = [rng.choice([0.3, 1.2, 2.5]) for _ in indices]
        held = rng.randint(1, 4)
        labels = [(rng.randint(0, 9) < 3) * rng.randint(0, classes - 1) + (len(indices) > 2) for _ in range(held)]
        own = [sorted({rng.randint(0, 2), *(3 + rng.randint(0, OWN - 4) for _ in range(2))}) for _ in range(held)]
        rows.append((indices, values, [min(x, classes - 1) for x in labels], own))
    return rows


@pytest.mark.parametrize("classes", [2, 3])
def test_the_model_is_that_of_a_row_for_each_occurrence(spark, classes, monkeypatch):
    monkeypatch.setattr(shared_rows, "OCCURRENCES_HELD", 7)
    rows = _rows(classes)
    schema = "indices ARRAY<INT>, values ARRAY<DOUBLE>, labels ARRAY<INT>, own ARRAY<ARRAY<INT>>"
    table = spark.createDataFrame(rows, schema).repartition(3)
    got = shared_rows.fit(table, OWN, TERMS, classes, 20, 0.01)
    each = [
        (float(y), SparseVector(OWN + TERMS, {**{i: 1.0 for i in own}, **{OWN + i: v for i, v in zip(indices, values, strict=True)}}))
        for indices, values, labels, owns in rows for y, own in zip(labels, owns, strict=True)
    ]
    frame = spark.createDataFrame(each, ["label", "features"])
    want = LogisticRegression(maxIter=20, regParam=0.01).fit(frame)
    predicted = [[r["prediction"] for r in model.transform(frame).collect()] for model in (got, want)]
    assert predicted[0] == predicted[1]
    assert got.numClasses == want.numClasses == classes and got.numFeatures == want.numFeatures
    assert np.allclose(got.coefficientMatrix.toArray(), want.coefficientMatrix.toArray(), rtol=1e-6, atol=1e-8)
    assert np.allclose(got.interceptVector.toArray(), want.interceptVector.toArray(), rtol=1e-6, atol=1e-8)


def test_weights_of_a_text_are_held_once(spark, monkeypatch):
    """A text of 3,000 occurrences is one row of what is learnt from, with its places behind 8,000."""
    seen, fit = [], shared_rows.fit
    monkeypatch.setattr(shared_rows, "fit", lambda table, *args: seen.append(table) or fit(table, *args))
    texts = spark.createDataFrame([("de la " * 1500, "es"), ("de x", "fr"), ("x la", "fr")], "text STRING, lang STRING")
    listed = ("de", "la")
    learnt = abbreviations.fit(abbreviations.corpus_of_texts(texts, "text", "lang", listed), abbreviations=listed)
    (table,) = seen
    rows = sorted((len(r["labels"]), r) for r in table.collect())
    assert [n for n, _ in rows] == [1, 1, 3000] and len(rows[2][1]["indices"]) == 2
    # the abbreviation and the characters it covers, or their stretch
    assert sorted({len(x) for x in rows[2][1]["own"]}) == [2, 3]
    turns = spark.createDataFrame([("x de",), ("de la de",)], "text STRING")
    got = {r["out"] for r in abbreviations.expand(learnt, turns, "text", output="out").collect()}
    assert all(w.split("_")[0] in ("x", *listed) for t in got for w in t.split(" ")) and "x de" not in got
