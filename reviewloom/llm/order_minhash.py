"""Document fingerprints by Order MinHash: signatures that follow the edit distance.

A text's items are its runs of ``K`` code points, each with its occurrence number, the count
of the same run before it, so that all items of a text differ. For each of ``SKETCHES``
hash orders the ``TUPLE`` smallest items are taken, put back in the order in which they stand
in the text, and hashed as a tuple. The likeness of two fingerprints is the share of equal
tuples: moved passages change the order inside tuples, which sets of runs cannot see.

Neighbours in the order of ids come from ranges of the order: each task walks its sorted range
once, and only the first and last text of each range are joined across ranges.

Defined results: a null text is empty; a text of fewer code points than ``K`` is one item, the
empty text too; a text of fewer items than ``TUPLE`` takes all it has; equal texts have equal
fingerprints. Rows are ordered by id, null ids last, rows of one id by their text's hash; a
table of one row is its own neighbour; an empty table gives no rows; other columns are not
read. Memory of a task follows its longest pair of texts.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix
from .scratch import Scratch, bounded_batches

K = 8
TUPLE = 2
SKETCHES = 32
#: Items worked on at a time in one hash order.
CHUNK = 4096
#: Code points of short texts that are hashed together.
STRETCH = 1 << 15

_MAX = np.iinfo(np.uint32).max
_RUN = mix(np.arange(101, 101 + 64, dtype=np.uint64)) | np.uint64(1)
#: One odd factor for each hash order; equal ranks are taken in text order.
_FACTOR = (mix(np.arange(5001, 5001 + 1024, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_NO_POINT = np.uint32(0xFFFFFFFF)
_NUMBER = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4")


def _runs(texts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all runs of the texts, one text after the other, and how many each has.

    A shorter text is padded to ``k`` with what is no code point.
    """
    texts = [x if len(x) >= k else np.concatenate([x, np.full(k - len(x), _NO_POINT)]) for x in texts]
    lengths = np.array([len(x) for x in texts])
    points = np.concatenate(texts).astype(np.uint64)
    n = len(points) - k + 1
    total = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        total += points[j : n + j] * _RUN[j]
    inside = np.ones(len(points), dtype=bool)
    inside[(np.cumsum(lengths)[:, None] - np.arange(1, k)).ravel()] = False
    return mix(total[inside[:n]]), lengths - k + 1


def _numbered(runs: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The runs with their occurrence numbers, the count of the same run before in the text."""
    own = runs + text.astype(np.uint64) * _NUMBER
    sorted_ = np.sort(own)
    again = sorted_[1:][sorted_[1:] == sorted_[:-1]]
    if not len(again):
        return runs
    # only runs that share low bits with a repeated one are put in order
    seen = np.zeros(1 << 16, dtype=bool)
    seen[again.astype(np.uint16)] = True
    at = np.flatnonzero(seen.take(own.astype(np.uint16)))
    at = at[np.lexsort((runs[at], text[at]))]
    place = np.arange(len(at))
    start = np.concatenate([[True], (runs[at[1:]] != runs[at[:-1]]) | (text[at[1:]] != text[at[:-1]])])
    number = place - np.maximum.accumulate(np.where(start, place, 0))
    at, number = at[number > 0], number[number > 0]
    out = runs.copy()
    out[at] = mix(runs[at] + number.astype(np.uint64) * _NUMBER)
    return out


@functools.cache
def _room(sketches: int) -> np.ndarray:
    """Working memory of a task, made once."""
    return np.empty(sketches * CHUNK, dtype=np.uint32)


def _least(ranks: np.ndarray, sketches: int, size: int) -> np.ndarray:
    """The places of the smallest items of a text in each hash order, in text order."""
    rows = np.arange(sketches)[:, None]
    held = at = None
    for lo in range(0, len(ranks), CHUNK):
        own = ranks[lo : lo + CHUNK]
        part = _room(sketches)[: sketches * len(own)].reshape(sketches, len(own))
        np.multiply(own, _FACTOR[:sketches, None], out=part)
        values, places = [], []
        for i in range(min(size, len(own))):
            least = part.argmin(axis=1)[:, None]
            places.append(least + lo)
            values.append(part[rows, least])
            if i + 1 < size:
                part[rows, least] = _MAX
        values, places = np.concatenate(values, axis=1), np.concatenate(places, axis=1)
        if held is not None:
            values, places = np.concatenate([held, values], axis=1), np.concatenate([at, places], axis=1)
            best = np.argsort(values, axis=1, kind="stable")[:, :size]
            values, places = values[rows, best], places[rows, best]
        held, at = values, places
    return at


def _of_stretch(texts: list[np.ndarray], sketches: int, size: int, k: int) -> np.ndarray:
    runs, n = _runs(texts, k)
    found = _numbered(runs, np.repeat(np.arange(len(texts)), n))
    ranks = (found >> np.uint64(32)).astype(np.uint32)
    places = np.empty((len(texts), sketches, size), dtype=np.int64)
    starts = np.cumsum(n) - n
    for i, (lo, own) in enumerate(zip(starts.tolist(), n.tolist(), strict=True)):
        least = _least(ranks[lo : lo + own], sketches, size)
        # with too few items the last one stands for the missing ones
        places[i, :, : least.shape[1]] = least
        places[i, :, least.shape[1] :] = least[:, -1:]
    places.sort(axis=2)
    places += starts[:, None, None]
    out = np.minimum(n, size).astype(np.uint64)[:, None]
    for j in range(size):
        out = mix(out * _RUN[-1] + found[places[:, :, j]])
    return (out >> np.uint64(32)).astype(np.uint32)


def fingerprints(
    texts: list[np.ndarray], sketches: int = SKETCHES, size: int = TUPLE, k: int = K
) -> np.ndarray:
    """For each text, as code points, one 32-bit tuple hash for each hash order."""
    out, group, held = [np.empty((0, sketches), dtype=np.uint32)], [], 0
    with np.errstate(over="ignore"):
        for text in texts:
            group.append(text)
            held += len(text) + k
            if held >= STRETCH:
                out.append(_of_stretch(group, sketches, size, k))
                group, held = [], 0
        if group:
            out.append(_of_stretch(group, sketches, size, k))
    return np.concatenate(out)


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last quarter replaced by the beginning of the next text."""
    cut = len(points) // 4
    return np.concatenate([points[: len(points) - cut], following[:cut]])


def _compared(ids: list, texts: list[str | None], following: list[str | None], schema: pa.Schema) -> pa.RecordBatch:
    """Each text with the one that follows it."""
    own, new = [code_points(x) for x in texts], [code_points(x) for x in following]
    changed = [edited(a, b) for a, b in zip(own, new, strict=True)]
    # in a row of texts each one but the last is also the next one's follower
    chained = all(a is b for a, b in zip(texts[1:], following))
    prints = fingerprints(own + new[-1:]) if chained else fingerprints(own)
    after = prints[1:] if chained else fingerprints(new)
    prints = prints[: len(own)]
    moved = fingerprints(changed)
    n = len(ids)
    values = {
        "id": pa.array(ids, schema.field("id").type),
        "n_chars": pa.array([len(x) for x in own], pa.int64()),
        "edited_sha256": pa.array(
            [hashlib.sha256(x.tobytes().decode("utf-32-le").encode()).digest() for x in changed], pa.binary()
        ),
        "fingerprint": pa.array([x.tobytes() for x in prints.astype(">u4")], pa.binary()),
        "edited_fingerprint": pa.array([x.tobytes() for x in moved.astype(">u4")], pa.binary()),
        "near_edited": pa.array((prints == moved).mean(axis=1), pa.float64()),
        "near_next": pa.array((prints == after).mean(axis=1), pa.float64()),
    }
    return pa.RecordBatch.from_arrays(
        [values[x.name] if x.name in values else pa.nulls(n, x.type) for x in schema], schema=schema
    )


_COLUMNS = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _schema(id_type: pa.DataType, *more: pa.Field) -> pa.Schema:
    return pa.schema([
        pa.field("id", id_type), pa.field("n_chars", pa.int64()), pa.field("edited_sha256", pa.binary()),
        pa.field("fingerprint", pa.binary()), pa.field("edited_fingerprint", pa.binary()),
        pa.field("near_edited", pa.float64()), pa.field("near_next", pa.float64()), *more,
    ])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted range: each text with the next one, and the texts at the range's ends."""
    last = schema = part = None
    for batch in batches:
        ids, texts, parts = (batch.column(x).to_pylist() for x in ("id", "text", "part"))
        if not ids:
            continue
        if last is None:
            part = parts[0]
            schema = _schema(
                batch.schema.field("id").type, pa.field("part", pa.int32()), pa.field("end", pa.string()),
                pa.field("text", pa.string()),
            )
            yield _end(ids[0], part, "first", texts[0], schema)
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
        if len(ids) > 1:
            yield _compared(ids[:-1], texts[:-1], texts[1:], schema)
        last = ids[-1], texts[-1]
    if last is not None:
        yield _end(last[0], part, "last", last[1], schema)


def _end(id_, part: int, end: str, text: str | None, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"id": id_, "part": part, "end": end, "text": text}], schema=schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(x).to_pylist() for x in ("id", "text", "next_text")]
        if columns[0]:
            yield _compared(*columns, _schema(batch.schema.field("id").type))


def order_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    bounded_batches(spark, 200)
    scratch = Scratch(spark, "fingerprints")
    id_type = docs.schema[id_col].dataType.simpleString()
    # the last column tells rows apart that are alike, so that no range holds them all
    order = [F.col("id").asc_nulls_last(), F.col("h"), F.col("n")]
    walked = scratch.put(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .withColumn("h", F.xxhash64("text")).withColumn("n", F.monotonically_increasing_id())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("id", "text", F.spark_partition_id().alias("part"))
        .mapInArrow(_walk, f"id {id_type}, {_COLUMNS}, part int, end string, text string")
    )
    ends = walked.filter("end is not null").select("id", "part", "end", "text")
    # one number for each range; the last range is followed by the first one
    parts = sorted(r["part"] for r in ends.filter("end = 'first'").select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    across = (
        ends.filter("end = 'last'").join(F.broadcast(after), "part")
        .join(
            ends.filter("end = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text")),
            "next",
        )
        .select("id", "text", "next_text")
        .mapInArrow(_pairs, f"id {id_type}, {_COLUMNS}")
    )
    return walked.filter("end is null").select(across.columns).union(across).select(
        F.col("id").alias(id_col), "n_chars",
        *[F.lower(F.hex(x)).alias(x) for x in ("edited_sha256", "fingerprint", "edited_fingerprint")],
        "near_edited", "near_next",
    )
