"""Hook for an external word segmenter."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F

from .steps import TIDY, Step


def segment_with(segmenter: Callable[[str], str]) -> Step:
    """Join compounds with a word segmenter of your own, in Arrow batches. This is the
    only step that leaves the JVM, and no profile uses it unless asked to."""

    @F.pandas_udf("string")
    def segment(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: segmenter(t) if t else "")

    return Step("segment", segment, keeps=TIDY)
