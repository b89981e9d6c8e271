"""Resampling, order fingerprints and the conversation trie against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reviewloom.llm import ngram_table, order_minhash
from reviewloom.llm.centroids import subtree_sums
from reviewloom.llm.hashing import mix
from reviewloom.llm.ordering import numbered
from reviewloom.llm.order_minhash import code_points, edited, fingerprints, order_fingerprints
from reviewloom.llm.prefix_trie import prefix_trie
from reviewloom.llm.resampling import resample
from reviewloom.llm.scratch import Scratch

DOCS = "doc_id long, text string, id string, n long, h int, part int, score int, rank string, weight int"
LONG = " ".join(random.Random(5).choice("alpha Beta gamma delta eps".split()) for _ in range(30_000))
TEXTS = [
    None, "", " \n", "a", "A", "one two three", "one  two; three ", LONG, LONG + " tail", "x" * 70_000 + " " + "x" * 70_000,
    " " * 300_000 + "end", "Über große Straße 😀 " * 9, "1234 +1 (555) 010-2030 9 " * 4, "same words " * 12, "same words " * 12,
]


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, "y", 5) for i, t in pairs], DOCS)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)
    words = "red green blue apple pear the of and question answer benchmark".split()
    more = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    # a repeated id with another text, a repeated row, and rows without an id
    return [*enumerate(TEXTS + more), (3, "a second text " * 8), (4, "A"), (None, "no id " * 15), (None, "no id " * 15), (None, None)]


def word_list(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def grams(text):
    w = word_list(text)
    return w + [a + b" " + b for a, b in zip(w, w[1:])]


@pytest.mark.parametrize("stretch", [23, 1 << 18])
def test_ngram_table_counts_every_place(monkeypatch, stretch):
    monkeypatch.setattr(ngram_table, "STRETCH", stretch)
    rng = random.Random(1)
    bits = [b"a", b"B", b"word ", b" ", b"..", "ü".encode(), b"Longer word, ", b"z" * 70 + b" ", b"9\n", b" " * 40]
    texts = [b"".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 30, 200]))) for _ in range(120)]
    want = Counter(zlib.crc32(x) % 1000 for t in texts for x in grams(t.decode()))
    got, n = Counter(), np.zeros(len(texts), dtype=int)
    for text_of, _, found in ngram_table.features(texts, 1000):
        for slot in found.used:
            got[int(found.buckets[slot])] += int(found.counts[slot])
        n += np.bincount(text_of, minlength=len(texts))
    assert got == want
    assert n.tolist() == [len(grams(t.decode())) for t in texts]


def test_equal_keys_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(ngram_table, "hashes", lambda buffer, starts, lengths: np.zeros(len(starts), dtype=np.uint64))
    texts = [b"ab cd ab abcdefgh abcdefgi ab cd " + b"q" * 80 + b" " + b"q" * 79 + b"r"]
    got = sum((list(t.counts[t.used]) for _, _, t in ngram_table.features(texts, 1 << 20)), [])
    assert sorted(got) == sorted(Counter(grams(texts[0].decode())).values())


def test_keys_are_xxhash64():
    data = np.frombuffer(random.Random(3).randbytes(400), dtype=np.uint8)
    buffer, starts = ngram_table.Buffer(data), np.arange(100)
    for length in range(1, 100):
        want = [xxhash.xxh64_intdigest(data[s : s + length].tobytes()) for s in starts]
        assert ngram_table.hashes(buffer, starts, np.full(100, length)).tolist() == want


def test_resample(spark, pairs):
    target = ["benchmark question answer", None, "answer 9"]
    source = Counter(zlib.crc32(x) % 10_000 for _, t in pairs for x in grams(t))
    aim = Counter(zlib.crc32(x) % 10_000 for t in target for x in grams(t))
    S, T = sum(source.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (S + 10_000) / ((source[b] + 1) * (T + 10_000))))
    want = []
    for i, t in pairs:
        f = grams(t)
        weight = sum(gain(zlib.crc32(x) % 10_000) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append([i, len(f), weight, score, len(word_list(t)) >= 20])
    able = sorted((-w[3], w[0] is None, w[0] or 0, w[1]) for w in want if w[4])
    drawn = able[: 25 * len(able) // 100]
    got = resample(table(spark, pairs), spark.createDataFrame([(t,) for t in target], "text string")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:4])
    assert sorted(map(key, got)) == sorted(map(key, want))
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0, r["n_features"]) for r in ranked] == drawn


def test_resample_of_nothing(spark, pairs):
    docs = table(spark, pairs)
    assert resample(docs.filter("false"), docs).count() == 0
    assert resample(docs, docs.filter("false")).count() == len(pairs)


def test_numbered(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") * 37 % 1000).alias("b"))
    got = numbered(rows, [F.col("a").desc(), F.col("b")], "at", Scratch(spark, "test")).collect()
    assert [r["at"] for r in sorted(got, key=lambda r: (-r["a"], r["b"]))] == list(range(1000))


def plain_print(text, sketches=32, size=2, k=8):
    """The definition, one item after the other."""
    points = [ord(c) for c in text]
    points += [0xFFFFFFFF] * (k - len(points))
    top = 1 << 64
    one = lambda x: int(mix(np.array([x % top], dtype=np.uint64))[0])
    seen, found = Counter(), []
    for i in range(len(points) - k + 1):
        run = one(k + sum(p * int(r) for p, r in zip(points[i : i + k], order_minhash._RUN)))
        number, seen[run] = seen[run], seen[run] + 1
        found.append(one(run + number * int(order_minhash._NUMBER)) if number else run)
    out = []
    for a in order_minhash._FACTOR[:sketches].tolist():
        best = sorted(range(len(found)), key=lambda i: ((found[i] >> 32) * a % (1 << 32), i))[:size]
        best = sorted(best)
        h = len(best)
        for i in (best if len(best) == size else best + best[-1:] * (size - len(best))):
            h = one(h * int(order_minhash._RUN[-1]) + found[i])
        out.append(h >> 32)
    return out


def test_fingerprints_follow_the_definition(monkeypatch):
    monkeypatch.setattr(order_minhash, "CHUNK", 16)
    order_minhash._room.cache_clear()
    rng = random.Random(4)
    texts = ["".join(rng.choice("abü😀") for _ in range(rng.choice([0, 1, 7, 8, 9, 10, 40, 90]))) for _ in range(40)]
    got = fingerprints([code_points(t) for t in texts])
    order_minhash._room.cache_clear()
    assert got.tolist() == [plain_print(t) for t in texts]


def test_fingerprints_do_not_depend_on_company():
    texts = [code_points(t) for t in TEXTS]
    together = fingerprints(texts)
    assert all((fingerprints([t])[0] == row).all() for t, row in zip(texts, together))


def test_order_matters():
    rng = random.Random(9)
    parts = [" ".join(str(rng.randrange(10**6)) for _ in range(60)) for _ in range(8)]
    whole, swapped = " ".join(parts), " ".join(parts[4:] + parts[:4])
    small = " ".join(parts[:7] + ["changed"])
    a, b, c = fingerprints([code_points(x) for x in (whole, swapped, small)])
    # the sets of runs are nearly the same, but half of the pairs stand the other way round
    assert (a == b).mean() < 0.7 and (a == c).mean() > 0.6


@pytest.mark.parametrize("n", [1, 2, 5, None])
def test_order_fingerprints(spark, pairs, n):
    pairs = pairs[:n]
    got = order_fingerprints(table(spark, pairs).repartition(5)).collect()
    assert len(got) == len(pairs)
    # rows of one id come in the order of their hash, which Spark tells
    hashed = table(spark, pairs).select("doc_id", "text", F.xxhash64("text").alias("x")).collect()
    order = sorted(hashed, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["x"]))
    want = []
    for here, after in zip(order, order[1:] + order[:1]):
        a, b = here["text"] or "", after["text"] or ""
        cut = len(a) // 4
        new = a[: len(a) - cut] + b[:cut]
        p = fingerprints([code_points(a), code_points(new), code_points(b)])
        want.append((
            here["doc_id"], len(a), hashlib.sha256(new.encode()).hexdigest(),
            p[0].astype(">u4").tobytes().hex(), p[1].astype(">u4").tobytes().hex(),
            float((p[0] == p[1]).mean()), float((p[0] == p[2]).mean()),
        ))
    key = lambda r: (r[0] is None, *[x or 0 for x in r[:1]], *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_order_fingerprints_of_nothing(spark, pairs):
    assert order_fingerprints(table(spark, pairs).filter("false")).count() == 0
    assert edited(code_points("abcdefgh"), code_points("z")).tolist() == [ord(c) for c in "abcdefz"]


@pytest.mark.parametrize("seed", range(12))
def test_subtree_sums(seed):
    rng = random.Random(seed)
    n = rng.choice([0, 1, 2, 30, 300])
    reach = rng.choice([1, 3, 1000])
    parents = [-1 if not i or rng.random() < 0.05 else rng.randrange(max(0, i - reach), i) for i in range(n)]
    values = [(rng.randint(-5, 5), 1) for _ in range(n)]
    want = [list(v) for v in values]
    for i in range(n - 1, -1, -1):
        if parents[i] >= 0:
            want[parents[i]] = [a + b for a, b in zip(want[parents[i]], want[i])]
    assert subtree_sums(parents, values) == want


def test_subtree_sums_of_a_long_path():
    n = 20_000
    assert [x[0] for x in subtree_sums([i - 1 for i in range(n)], [(1,)] * n)] == list(range(n, 0, -1))


TURNS = "conv_id long, turn long, role string, text string, conv string, d int, r string, pos int, at int"


def plain_trie(rows):
    own = defaultdict(list)
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = own[c] if base == c else own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        ends = sorted(c for c in convs if len(built[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids),
            sum(not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in below) for m in below),
            sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def talks(kind):
    rng = random.Random(11)
    if kind == "odd":
        rows = [(0, None, None, None), (0, 1, "user", "hi  there"), (0, 1, "user", "hi  there"), (0, 1, "a", "tie"),
                (3, 0, "user", ""), (7, 5, "", "x"), (41, 0, "u", "base is absent"), (45, 2, None, "t"), (-3, 0, "u", "neg"),
                (-20, 0, "u", "hello you"), (-20, 1, "u", "more"), (None, 0, "u", "no id")]
        return rows
    if kind == "long":
        rows = [(c, t, "u", f"turn {t}") for c in (0, 1, 2, 60, 61, 75) for t in range(150 - c)]
        return rows + [(c, t, "u", rng.choice("ab")) for c in range(100, 160) for t in range(rng.randint(1, 9))]
    # a conversation that a third repeat, and one very common first turn
    rows = [(c, t, "u", f"the same words {t}") for c in range(0, 2000, 20) for t in range(4)]
    return rows + [(c, t, "ua"[t % 2], "first" if not t else rng.choice("abc")) for c in range(2001, 2200) for t in range(rng.randint(1, 6))]


@pytest.mark.parametrize("together", [2, 4096])
@pytest.mark.parametrize("kind", ["odd", "long", "hot"])
def test_prefix_trie(spark, kind, together):
    rows = talks(kind)
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], TURNS).repartition(3)
    got = [tuple(r) for r in prefix_trie(frame, together=together).collect()]
    assert sorted(got, key=lambda r: r[:2]) == sorted(plain_trie(rows), key=lambda r: r[:2])


def test_prefix_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie(empty).count() == 0
