"""Near duplicates: a Jaccard self-join of word n-gram sets over count-vector R-trees.

A text's tokens are its distinct runs of five words, as 64-bit hashes. Tokens are hashed
into groups; the number of tokens in each group is the text's point. The sum of coordinate
minima of two points bounds the size of the intersection, and that of a point with a node's
upper corner bounds it for all that is below the node. Packed trees are searched from the
root down, and what is left is verified on the sets (``rtree``).

A tree over all texts would be one task's, so texts are dealt to regions first. A text can
only be linked if three quarters of its tokens are in other texts too; the tokens of all
texts are brought together once, packed, to learn which are, and most texts go. In one
order of all tokens, two linked texts share one of the first quarter of either's tokens;
tokens that many texts hold come last in it, by counts of all tokens of all texts in 2^20
groups. The texts with a token among their first form a cell, each cell goes to the region of
one of its texts, the hub, and a region's texts are searched once, in however many of its cells
they are. Equal sets are one class, named by a 64-bit hash that is checked to be unique.

Large groups of copies stay in proportion. Before the search each class is verified against
two hubs of its cells, and what is linked becomes one component; cells of a single component
are done with. In a region's search two sets of one component are not compared, a link joins
their components at once, and so a task hands on fewer links than it has components. A region
that is too large for one task is cut into blocks, by component first, and pairs of blocks are
searched, except those of one component with itself.

Defined results: a null, empty or blank text has no tokens, size 0 and no links; a text of
fewer words than five is one token; rows with one id stand for one document, which has
the links of all its rows; a row without an id has no component; an empty table gives no
rows; other columns are not read. Ids are integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .hashing import mix, shingle_sets
from .rtree import links as tree_links
from .scratch import Scratch, bounded_batches

SHINGLE = 5
#: Groups whose counts order the tokens; a fixed number, so their table is small anywhere.
ORDER_GROUPS = 1 << 20
ORDER_SLICES = 64
#: Bits of the filter of shared tokens, as a power of two, and of a token that are looked at
#: for it; fixed numbers.
FILTER_BITS = 27
KEPT_BITS = 48
#: Tokens of texts that a task packs together, and of all texts that are unpacked together.
STRETCH = 4_000_000
PART_TOKENS = 4_000_000
#: Hubs that each class is held against before the search.
STAR_TURNS = 2
#: Sets, and tokens of sets, of a block of a region.
BLOCK = 1024
BLOCK_TOKENS = 2_000_000


def _columns(batch: pa.RecordBatch) -> tuple[pa.Array, list[bytes | None]]:
    return batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()


def _name(tokens: np.ndarray, seed: int) -> int:
    """The class of a set, as a signed number."""
    with np.errstate(over="ignore"):
        salted = mix(tokens + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) % (1 << 64)))
        name = mix(np.array([salted.sum(dtype=np.uint64)], dtype=np.uint64))
    return int(name.view(np.int64)[0])


def _signatures(size: int, seed: int):
    """(id, text) to a row for each text, and the group counts of the task in slices."""
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("sig", pa.int64()),
         ("slice", pa.int32()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ORDER_GROUPS, dtype=np.uint32)
        for batch in batches:
            ids, texts = _columns(batch)
            sets = shingle_sets(texts, size)
            tokens = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
            counts += np.bincount(
                (tokens >> np.uint64(44)).astype(np.int64), minlength=ORDER_GROUPS
            ).astype(np.uint32)
            n = len(sets)
            xors = np.array([np.bitwise_xor.reduce(s) for s in sets], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_name(s, seed) for s in sets], pa.int64()), pa.array(xors.view(np.int64)),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                schema=schema,
            )
        parts = counts.reshape(ORDER_SLICES, -1)
        full = [i for i in range(ORDER_SLICES) if parts[i].any()]
        k = len(full)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(k, pa.int64())] * 4, pa.array(full, pa.int32()),
             pa.array([zlib.compress(parts[i].tobytes(), 1) for i in full], pa.binary())],
            schema=schema,
        )

    return run


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the slices of a partition; memory is that of one table of counts."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(raw), dtype=np.uint32)
            total[at] = total.get(at, 0) + part.astype(np.int64)
    rows = [(k, np.log2(1 + v) * 8) for k, v in total.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in rows], pa.int32()),
         pa.array([v.astype(np.uint8).tobytes() for _, v in rows], pa.binary())],
        names=["slice", "levels"],
    )


def _levels(table: DataFrame) -> bytes:
    """The logarithm of each group's count, in steps of an eighth: one byte a group."""
    rows = (
        table.filter("slice is not null").select("slice", "counts")
        .repartition(ORDER_SLICES, "slice")
        .mapInArrow(_sum_slices, "slice int, levels binary")
        .collect()
    )
    out = np.zeros((ORDER_SLICES, ORDER_GROUPS // ORDER_SLICES), dtype=np.uint8)
    for row in rows:
        out[row["slice"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return out.tobytes()


def prefix_length(n: int, numerator: int, denominator: int) -> int:
    """Tokens, first in the common order, of which one is shared with each set that is linked.

    With the similarity a/b an intersection is at least n*a/b, so n minus that plus one tokens
    cannot all be missing from it.
    """
    return n - -(-n * numerator // denominator) + 1


def _first_tokens(tokens: np.ndarray, level: np.ndarray, numerator: int, denominator: int) -> np.ndarray:
    own = level[(tokens >> np.uint64(44)).astype(np.int64)]
    # by level, then by the token itself; tokens are sorted already
    return tokens[np.argsort(own, kind="stable")[: prefix_length(len(tokens), numerator, denominator)]]


def _blobs(size: int, part_bits: int):
    """(id, text) to (part, blob): the tokens of stretches of texts, by their first bits."""
    rest = np.uint64(KEPT_BITS - part_bits)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        kept = np.sort(np.concatenate(held)) >> np.uint64(64 - KEPT_BITS)
        # of tokens that many of the texts hold two places tell as much as all
        kept = kept[np.concatenate([[True, True], kept[2:] != kept[:-2]])[: len(kept)]]
        parts, starts = np.unique(kept >> rest, return_index=True)
        blobs = [
            zlib.compress(_planes(x & ((np.uint64(1) << rest) - np.uint64(1))), 1) for x in np.split(kept, starts[1:])
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(parts.astype(np.int64)), pa.array(blobs, pa.binary())], names=["part", "blob"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, texts = _columns(batch)
            for i, tokens in zip(ids.to_pylist(), shingle_sets(texts, size), strict=True):
                if len(tokens) and i is not None:
                    held.append(tokens)
                    n += len(tokens)
            if n >= STRETCH:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    return run


def _planes(values: np.ndarray) -> bytes:
    """Sorted numbers as their distances, the first bytes of all, the second ones of all..."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _shared_bits(part_bits: int):
    """The blobs of a part to the filter's bits of the tokens that are there twice."""
    bits = max(3, FILTER_BITS - part_bits)
    shift = np.uint64(KEPT_BITS - part_bits - bits)

    def run(table: pa.Table) -> pa.Table:
        values = np.sort(np.concatenate([_from_planes(zlib.decompress(x)) for x in table["blob"].to_pylist()]))
        own = np.zeros(1 << bits, dtype=bool)
        own[(values[1:][values[1:] == values[:-1]] >> shift).astype(np.int64)] = True
        packed = zlib.compress(np.packbits(own).tobytes(), 1)
        return pa.table({"part": table["part"][:1], "bits": pa.array([packed], pa.binary())})

    return run


def _shared_tokens(texts: DataFrame, size: int, n_tokens: int) -> tuple[int, list[tuple[int, bytes]]]:
    """The parts, as a power of two, of a table of bits that holds the one of each token found
    in two texts, and those that hold any, packed; its size does not grow. Where it is too full
    to tell tokens apart more texts pass, and none is lost. It is unpacked where it is used, not
    in the driver."""
    part_bits = min(FILTER_BITS - 3, max(6, (n_tokens // PART_TOKENS).bit_length()))
    rows = (
        texts.mapInArrow(_blobs(size, part_bits), "part long, blob binary")
        .groupBy("part").applyInArrow(_shared_bits(part_bits), "part long, bits binary").collect()
    )
    return part_bits, [(row["part"], bytes(row["bits"])) for row in rows]


def _unpacked(part_bits: int, parts: list[tuple[int, bytes]]) -> np.ndarray:
    out = np.zeros((1 << part_bits, (1 << (FILTER_BITS - part_bits)) // 8), dtype=np.uint8)
    for part, packed in parts:
        out[part] = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
    return out.ravel()


def _passes(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - FILTER_BITS)
    held = bits[(at >> np.uint64(3)).astype(np.int64)]
    return (held >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0


def _sets(size: int, seed: int, numerator: int, denominator: int, bits):
    """(id, text) to (c, tokens) of the texts that may be linked: enough of their tokens are
    in other texts too."""
    schema = pa.schema([("c", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = _unpacked(*bits.value)
        for batch in batches:
            ids, texts = _columns(batch)
            sets = [
                x for i, x in zip(ids.to_pylist(), shingle_sets(texts, size), strict=True)
                if len(x) and i is not None
                and int(_passes(x, shared).sum()) * denominator >= len(x) * numerator
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_name(x, seed) for x in sets], pa.int64()),
                 pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))],
                schema=schema,
            )

    return run


def _cells(numerator: int, denominator: int, levels):
    """(c, tokens) to (h, c, n): the first tokens of each class."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels.value, dtype=np.uint8)
        for batch in batches:
            listed = batch.column("tokens")
            sizes = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            tokens = listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            first = [
                _first_tokens(tokens[end - n : end], level, numerator, denominator)
                for n, end in zip(sizes.tolist(), ends.tolist(), strict=True)
            ]
            if first:
                lengths = [len(x) for x in first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(first).view(np.int64)),
                     pa.array(np.repeat(batch.column("c").to_numpy(), lengths)),
                     pa.array(np.repeat(sizes.astype(np.int32), lengths))],
                    schema=schema,
                )

    return run


def _search(numerator: int, denominator: int):
    """Some regions, or two blocks of one: their trees, searched for links of components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("region", "ascending"), ("comp", "ascending"), ("c", "ascending")])
        region, c, comp, side = (table[x].to_numpy() for x in ("region", "c", "comp", "side"))
        listed = table["tokens"].combine_chunks()
        tokens = listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        starts = np.concatenate([[0], np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1], [True]]))
        out = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = starts[lo : hi + 1]
            found = tree_links(
                tokens[own[0] : own[-1]], own - own[0], comp[lo:hi], side[lo:hi], numerator, denominator
            )
            out += [(int(c[lo + a]), int(c[lo + b])) for a, b in found]
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _joined(found: DataFrame, moved: DataFrame | None, scratch: Scratch) -> DataFrame:
    """The components (v, component) after more links between classes, of which earlier
    ones are in ``moved``."""
    found = scratch.put(found)
    if moved is None:
        return components(found, scratch)
    if found.isEmpty():
        return moved
    renamed = (
        found.join(moved.toDF("a", "of_a"), "a", "left").join(moved.toDF("b", "of_b"), "b", "left")
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    )
    more = components(renamed, scratch)
    again = moved.join(more.toDF("component", "to"), "component", "left").select(
        "v", F.coalesce("to", "component").alias("component")
    )
    return scratch.put(again.union(more.join(moved.select("v"), "v", "left_anti")))


def _regions(live: DataFrame, scratch: Scratch) -> DataFrame:
    """The classes of live cells (h, c, n, comp), once for each search they take part in:
    (g, i, j, region, c, comp, side); tasks are groups of (g, i, j)."""
    by = lambda c: F.struct(F.xxhash64(c, F.lit(7)).alias("x"), F.col(c).alias("c"))
    hubs = live.groupBy("h").agg(F.min(by("c")).getField("c").alias("region"))
    dealt = scratch.put(
        live.join(hubs, "h").groupBy("region", "c").agg(F.first("n").alias("n"), F.first("comp").alias("comp"))
    )
    of_comp = dealt.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("k") / BLOCK), F.ceil(F.col("tokens") / BLOCK_TOKENS))
    of_comp = of_comp.withColumn("own", blocks.cast("int"))
    large = F.col("own") > 1
    rest = F.greatest(
        F.ceil(F.sum(F.when(~large, F.col("k"))) / BLOCK), F.ceil(F.sum(F.when(~large, F.col("tokens"))) / BLOCK_TOKENS)
    )
    of_region = of_comp.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_comps"), F.coalesce(rest, F.lit(0)).cast("int").alias("rest"), F.max("own").alias("most")
    )
    # a region of one component has nothing left to find
    of_region = scratch.put(of_region.filter("n_comps > 1"))
    whole = (F.col("most") <= 1) & (F.col("rest") <= 1)
    groups = max(1, dealt.count() // (4 * BLOCK))
    small = dealt.join(of_region.filter(whole).select("region"), "region").select(
        F.pmod(F.xxhash64("region"), F.lit(groups)).alias("g"), F.lit(-1).alias("i"), F.lit(-1).alias("j"),
        "region", "c", "comp", F.lit(0).alias("side"),
    )
    cut = of_comp.join(of_region.filter(~whole).select("region", "rest"), "region")
    # blocks are numbered: those of small components first, then those of each large one
    sizes = cut.filter(large).select("region", "comp", "own")
    numbers = sizes.groupBy("region").agg(F.sort_array(F.collect_list(F.struct("comp", "own"))).alias("list"))
    firsts = numbers.select(
        "region",
        F.explode(
            F.transform(
                "list",
                lambda x, i: F.struct(
                    x["comp"].alias("comp"), x["own"].alias("own"),
                    F.aggregate(F.slice("list", 1, i), F.lit(0), lambda s, y: s + y["own"]).alias("before"),
                ),
            )
        ).alias("x"),
    ).select("region", "x.*")
    totals = cut.groupBy("region").agg(
        F.max("rest").alias("rest"), (F.max("rest") + F.coalesce(F.sum(F.when(large, F.col("own"))), F.lit(0))).alias("blocks")
    )
    placed = (
        dealt.join(totals, "region").join(firsts, ["region", "comp"], "left")
        .withColumn(
            "block",
            F.when(F.col("own").isNull(), F.pmod(F.xxhash64("comp"), F.col("rest")))
            .otherwise(F.col("rest") + F.col("before") + F.pmod(F.xxhash64("c"), F.col("own"))).cast("int"),
        )
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
        # blocks of one large component have nothing to find among themselves
        .filter(
            F.col("own").isNull() | (F.col("other") < F.col("rest") + F.col("before"))
            | (F.col("other") >= F.col("rest") + F.col("before") + F.col("own"))
        )
        .select(
            F.col("region").alias("g"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            "region", "c", "comp",
            F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
        )
    )
    return small.union(placed)


def ngram_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    similarity: tuple[int, int] = (3, 4),
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    Two documents are linked when their Jaccard similarity is at least the given fraction;
    component_id is the smallest id that links lead to.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "ngram-join")
    num, den = similarity
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    seed = 0
    while True:
        found = scratch.put(
            texts.mapInArrow(_signatures(size, seed), "id long, n long, c long, sig long, slice int, counts binary")
        )
        rows = found.filter("slice is null").select("id", "n", "c", "sig")
        names = rows.filter("n > 0").groupBy("c").agg(
            *[f(x).alias(f"{f.__name__}_{x}") for x in ("n", "sig") for f in (F.min, F.max)]
        )
        if names.filter("min_n <> max_n or min_sig <> max_sig").isEmpty():
            break
        # two sets under one name: other names
        scratch.drop(found)
        seed += 1
    levels = spark.sparkContext.broadcast(_levels(found))
    known = rows.filter("n > 0 and id is not null")

    n_tokens = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = spark.sparkContext.broadcast(_shared_tokens(texts, size, n_tokens))
    sets = scratch.put(
        texts.mapInArrow(_sets(size, seed, num, den, bits), "c long, tokens array<long>").dropDuplicates(["c"])
    )
    bits.destroy()
    cells = sets.mapInArrow(_cells(num, den, levels), "h long, c long, n int")
    shared = cells.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("h")
    member = scratch.put(cells.join(shared, "h").withColumn("comp", F.col("c")))
    levels.destroy()

    # the texts of one id are one document
    same = known.groupBy("id").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a <> b").select("id", "a")
    moved = _joined(known.join(same, "id").filter("a <> c").select("a", F.col("c").alias("b")), None, scratch)

    def with_components(cells: DataFrame) -> DataFrame:
        """The cells that still hold several components."""
        named = cells.drop("comp").join(moved.toDF("c", "comp"), "c", "left").withColumn("comp", F.coalesce("comp", "c"))
        several = named.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
        return scratch.put(named.join(several.select("h"), "h").select("h", "c", "n", "comp"))

    # First each class against one text: of the first in its cells, in an order that changes,
    # the one that is first in most of them.
    for turn in range(STAR_TURNS):
        if member.isEmpty():
            break
        order = [F.col("n")] if not turn else [F.xxhash64("c", F.lit(turn))]
        hubs = member.groupBy("h").agg(F.min(F.struct(*[x.alias("x") for x in order], "n", "c", "comp")).alias("hub"))
        stars = scratch.put(
            member.join(hubs, "h")
            .filter(f"comp <> hub.comp and least(n, hub.n) * {den} >= greatest(n, hub.n) * {num}")
            .groupBy("c", F.col("hub.c").alias("a")).agg(F.count(F.lit(1)).alias("k"))
            .groupBy(F.col("c").alias("b")).agg(F.max_by("a", F.struct("k", "a")).alias("a"))
        )
        linked = (
            stars.join(sets.toDF("b", "tb"), "b").join(sets.toDF("a", "ta"), "a")
            .filter(F.size(F.array_intersect("ta", "tb")) * (num + den) >= num * (F.size("ta") + F.size("tb")))
            .select("a", "b")
        )
        moved = _joined(linked, moved, scratch)
        old, member = member, with_components(member)
        scratch.drop(old, stars)

    if not member.isEmpty():
        dealt = scratch.put(_regions(member, scratch))
        linked = dealt.join(sets, "c").groupBy("g", "i", "j").applyInArrow(_search(num, den), "a long, b long")
        moved = _joined(linked, moved, scratch)
        scratch.drop(dealt)
    scratch.drop(member, sets)

    least = known.groupBy("c").agg(F.min("id").alias("least")).join(moved.toDF("c", "comp"), "c", "left")
    least = scratch.put(least.withColumn("comp", F.coalesce("comp", "c")))
    named = least.join(least.groupBy("comp").agg(F.min("least").alias("component")), "comp").select("c", "component")
    return rows.join(named, "c", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id")).alias("component_id"),
    )
