"""Mixing sources to target weights by iterative proportional fitting.

The tokens of all documents are added up in cells of source, language and topic. The cells'
weights are raked: scaled to the target share of each source, then of each language, then
of each topic, again and again until the factors are one. A cell's weight over its tokens,
times a common factor, is the probability with which each of its documents is kept, by a
hash of the document. The common factor is the one that keeps the wanted share of all
tokens; probabilities end at one, as documents are not repeated.

Targets are given as {column: {value: weight}}. Where none are given for a column they are
its own token shares raised to a power below one, which lifts small values against large.

Defined results: null in a column is a value of its own, ``NONE``; null or blank text has
no tokens, a weight of zero and is not kept; values without a target weight are not kept;
repeated rows share their fate; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

NONE = "(none)"
#: Power of the observed shares that makes the default targets.
TEMPER = 0.7
#: Share of all tokens to keep.
KEEP = 0.8
#: Sweeps over the three columns at most, and the factor's deviation that ends them.
SWEEPS, TOLERANCE = 30, 1e-4
#: Sweeps planned as one job.
AT_ONCE = 5
#: Cells, of some 100 bytes each, up to which a job holds all of them in one partition,
#: where no sweep needs a shuffle. More cells are swept by shuffles.
TOGETHER = 200_000
#: Common factors tried at once, twice.
GRID = 64
SPACE = r"[\x20\x09-\x0D]+"

#: The topics, first match counts: what a text of that form contains.
TOPICS = (
    ("legal", ("License", "license")),
    ("contact", ("@",)),
    ("table", (" | ",)),
    ("noise", ("%%%", "$$$", "###", "&&&", "***")),
)


def topic(text: Column) -> Column:
    """A topic by the form of the whole text; ``prose`` for all others."""
    out = None
    for name, marks in TOPICS:
        has = F.lit(False)
        for mark in marks:
            has = has | F.contains(text, F.lit(mark))
        out = F.when(has, name) if out is None else out.when(has, name)
    return out.otherwise("prose")


def token_count(text: Column) -> Column:
    whole = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(whole == "", 0).otherwise(F.size(F.split(whole, SPACE))).cast("long")


def _targets(cells: DataFrame, column: str, given: Mapping[str, float] | None, temper: float) -> DataFrame:
    """(column, share), the shares of the values that have tokens add up to one."""
    seen = cells.groupBy(column).agg(F.sum("n").alias("seen")).filter("seen > 0")
    if given is None:
        weighted = seen.withColumn("weight", F.pow(F.col("seen").cast("double"), F.lit(temper)))
    else:
        table = cells.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in given.items()], f"`{column}` string, weight double"
        )
        weighted = seen.join(table, column).filter("weight > 0")
    whole = weighted.agg(F.sum("weight").alias("whole"))
    # one row: the sum of all weights
    total = whole.first()["whole"]
    return weighted.select(column, (F.col("weight") / F.lit(total or 1.0)).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], scratch: Scratch) -> DataFrame:
    """``cells`` (columns, n) with their fitted weight ``w``; the weights add up to one."""
    total = cells.agg(F.sum("n")).first()[0] or 0
    fitted = cells.filter("n > 0")
    for column, target in targets.items():
        fitted = fitted.join(target.withColumnRenamed("share", f"share_{column}"), column)
    fitted = scratch.put(fitted.withColumn("w", F.col("n") / F.lit(float(max(total, 1)))))
    together = fitted.count() <= TOGETHER
    for _ in range(0, SWEEPS, AT_ONCE):
        swept = fitted.coalesce(1) if together else fitted
        for _ in range(AT_ONCE):
            off = F.lit(0.0)
            for column in targets:
                factor = F.col(f"share_{column}") / F.sum("w").over(Window.partitionBy(column))
                swept = swept.withColumn(f"f_{column}", factor).withColumn("w", F.col("w") * F.col(f"f_{column}"))
                off = F.greatest(off, F.abs(F.log(F.col(f"f_{column}"))))
        swept = scratch.put(swept.withColumn("off", off))
        scratch.drop(fitted)
        fitted = swept.drop(*[f"f_{c}" for c in targets], "off")
        fitted._scratch_path = swept._scratch_path
        if (swept.agg(F.max("off")).first()[0] or 0.0) < TOLERANCE:
            break
    return fitted


def common_factor(ratios: DataFrame, keep: float) -> float:
    """The factor f for which the sum of n * min(1, f * ratio) is ``keep`` of all tokens."""
    ends = ratios.agg(F.min("ratio"), F.max("ratio"), F.sum("n")).first()
    if ends[2] is None or not ends[0]:
        return 1.0
    low, high = keep / ends[1] / 2, 1 / ends[0]
    if keep >= 1:
        return high
    for _ in range(2):
        steps = [low * (high / low) ** (i / (GRID - 1)) for i in range(GRID)]
        sums = ratios.agg(
            *[F.sum(F.col("n") * F.least(F.lit(1.0), F.col("ratio") * s)) for s in steps]
        ).first()
        at = next((i for i, x in enumerate(sums) if x >= keep * ends[2]), GRID - 1)
        low, high = steps[max(at - 1, 0)], steps[at]
    return high


def mix_sources(
    docs: DataFrame,
    columns: Mapping[str, Column] | None = None,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    keep: float = KEEP,
    temper: float = TEMPER,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, the columns, n_tokens, probability, kept, and the
    columns to carry along.

    ``columns`` are the three (or more) ways to divide the documents, by default source,
    language and topic.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    if columns is None:
        columns = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.coalesce(F.col(text_col), F.lit("")))}
    targets = targets or {}
    text = F.col(text_col)
    rows = scratch.put(
        docs.select(
            F.col(id_col).alias("id"),
            *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(k) for k, c in columns.items()],
            token_count(text).alias("n_tokens"),
            F.xxhash64(F.col(id_col), text, F.lit(seed)).alias("draw"),
            *carry,
        )
    )
    cells = scratch.put(rows.groupBy(*columns).agg(F.sum("n_tokens").alias("n")))
    shares = {k: _targets(cells, k, targets.get(k), temper) for k in columns}
    fitted = rake(cells, shares, scratch)
    ratios = scratch.put(fitted.select(*columns, "n", (F.col("w") / F.col("n")).alias("ratio")))
    # Sums of doubles depend on their order in the last digits; rounding hides that.
    probability = F.round(F.least(F.lit(1.0), F.col("ratio") * common_factor(ratios, keep)), 6)
    cell_rates = scratch.put(ratios.select(*columns, probability.alias("probability")))
    unit = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))
    return (
        rows.join(cell_rates, list(columns), "left")
        .withColumn("probability", F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0))
        .select(
            F.col("id").alias(id_col), *columns, "n_tokens", "probability",
            (unit < F.col("probability")).alias("kept"),
            *carry,
        )
    )
