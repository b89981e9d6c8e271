"""Each step against fixed cases and against a plain Python statement of its rule."""

from __future__ import annotations

import random

import pytest
import regex
from pyspark.sql import functions as F

from reviewloom.functions import lexicon as lex
from reviewloom.functions import patterns as p
from reviewloom.functions import steps as s
from reviewloom.functions.score import sentiment
from reviewloom.plans.profiles import SERVING, TRAINING, clean, profile, run_steps


def outcome(spark, step, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    return [r[0] for r in rows.select(step(F.col("t")).alias("o"), "i").orderBy("i").collect()]


GOLDEN = [
    (s.mail, "hello a@b.com thanks", ""),
    (s.mail, "hi @shop tốt. cảm ơn", ""),
    (s.mail, "a @b. c @d", "@d"),
    (s.mail_scoped, "hello a@b.com thanks", "hello thanks"),
    (s.repeats, "tốttt a__b 1122 ưưư", "tốt a_b 12 ư"),
    (s.special, "a[b]c&d\\f/g_h-i\"j'k", "a b c d f g h i j'k"),
    (s.squeeze, "a \n b\t\tc", "a \n b\t\tc"),
    (s.numbered_words, "áo a1 x² đẹp", "áo đẹp"),
    (s.laughter, "kk kkk", "ha ha ha ha"),
    (s.laughter_everywhere, "kk kkk", "ha ha ha ha k"),
    (s.replace_phrases([("k", "không")]), "k k", "không k"),
    (s.map_tokens([("a", "b"), ("b", "c")]), "a", "c"),
    (s.map_tokens([("b", "c"), ("a", "b")]), "a", "b"),
    (s.drop_tokens(lex.STOPWORDS), "không tốt", ""),
    (s.drop_tokens(lex.STOPWORDS), "Không Tốt", "Không Tốt"),
    (s.drop_tokens(lex.STOPWORDS, keep=["tốt"]), "không tốt", "tốt"),
    (s.quality_label, "Chất lượng sản phẩm: đẹp", "đẹp"),
    (s.emoji, "đẹp 👍🏽 quá❤️", "đẹp quá"),
    (s.tag, "a @b #c http://d e", "a http e"),
    (s.url, "a http://b.c/d www.e f", "a f"),
    (s.join_compounds(["a b", "b c d", "a b c"]), "a b c d a b", "a_b_c d a_b"),
    (s.blank_guard, None, ""),
    (s.blank_guard, " \t　", ""),
]


def test_golden_cases(spark):
    for step, text, want in GOLDEN:
        got = outcome(spark, step, [text])[0]
        assert got == want, (getattr(step, "name", step), text, got)


@pytest.mark.parametrize(
    "text,want",
    [
        (None, -1), ("", -1), (" \t", -1), ("đẹp", 1), ("xấu", 0), ("bình_thường", 1),
        ("không_tốt", 1), ("oke xấu", 1), ("TỆ", 0),
    ],
)
def test_score(spark, text, want):
    assert outcome(spark, sentiment, [text]) == [want]


def test_score_by_token(spark):
    by_token = lambda x: sentiment(x, mode="token")
    assert outcome(spark, by_token, ["oker xấu", "ok xấu", "xấu_hơn", ""]) == [0, 1, 1, -1]


def squeeze(text):
    return regex.sub("  +", " ", text).strip()


def compounds(text, words):
    left, out = text.split(" "), []
    while left:
        n = next((n for n in (3, 2) if " ".join(left[:n]) in words and len(left) >= n), 1)
        out.append("_".join(left[:n]))
        left = left[n:]
    return " ".join(out)


def tokenwise(pairs):
    def one(word):
        for key, value in pairs:
            word = value if word == key else word
        return word

    return lambda t: squeeze(" ".join(map(one, t.split())))


def in_order(pairs, pad):
    def run(text):
        text = pad + text + pad
        for key, value in pairs:
            text = text.replace(pad + key + pad, f" {value} ")
        return squeeze(text)

    return run


def laugh_all(text):
    for word in text.split():
        if any(x in word for x in p.LAUGHTER):
            text = text.replace(word, " ha ha ")
    return squeeze(text)


# The patterns of the rules, as the steps must reproduce them.
PAIRS = [("ko", "không"), ("a", "b c"), ("b c", "x"), ("k", "ko"), ("ko", "z"), ("|", "&")]
RULES = {
    "url": (s.url, lambda t: squeeze(regex.sub(r"https?://\S+|www\.\S+", " ", t))),
    "mail": (s.mail, lambda t: squeeze(regex.sub(r"[^@]+@[^@]+\.[^@]+", " ", t))),
    "tag": (s.tag, lambda t: squeeze(regex.sub(r"(?:@|#|://)\S+", " ", t))),
    "marks": (s.sentence_marks, lambda t: squeeze(regex.sub("[.,?!]", " ", t))),
    "repeats": (s.repeats, lambda t: squeeze(regex.sub(r"(\w)\1+", r"\1", t))),
    "special": (
        s.special,
        lambda t: squeeze(
            "".join(" " if c in p.PUNCTUATION or regex.match(r"\d", c) else c for c in t)
        ),
    ),
    "numbered": (
        s.numbered_words,
        lambda t: " ".join(w for w in t.split() if not any(c.isdigit() for c in w)),
    ),
    "laughter": (s.laughter_everywhere, laugh_all),
    "drop": (
        s.drop_tokens(["ko", "a", "tốt"]),
        lambda t: " ".join(w for w in t.split() if w not in ("ko", "a", "tốt")),
    ),
    "map": (s.map_tokens(PAIRS), tokenwise(PAIRS)),
    "all": (s.replace_all(PAIRS), in_order(PAIRS, "")),
    "phrases": (s.replace_phrases(PAIRS), in_order(PAIRS, " ")),
    "lower": (s.lower, str.lower),
    "repeat?": (
        s.has_repeat,
        lambda t: any(a == b for a, b in zip(squeeze(t), squeeze(t)[1:])),
    ),
    "alpha?": (s.has_nonalpha, lambda t: any(not c.isalpha() for c in t)),
    "array": (s.token_array, str.split),
}

PIECES = (
    "a b ko k kk kkk haha xhihix tốt Tốttt ưư éé 12 a1 x² ① ٣ @ @b a@b.c .@. http://x www.y # #t :// "
    "| & ... , ?! __ _ 😀 ❤️ 'q \" [z] \\ / - đẹp ĐẸP"
).split(" ") + [" ", "  ", "\t", "\n", "\xa0", "　", "\x1c", " ", "​", "́"]


def samples(n=600):
    rng = random.Random(7)
    out = ["", " ", "@", "a@b.c"]
    for _ in range(n):
        parts = rng.choices(PIECES, k=rng.randint(1, 12))
        out.append(rng.choice(["", " "]).join(parts))
    return out


@pytest.mark.parametrize("name", RULES)
def test_rule(spark, name):
    step, rule = RULES[name]
    texts = samples()
    for text, got in zip(texts, outcome(spark, step, texts)):
        assert got == rule(text), (name, text)


def test_chains_do_not_depend_on_the_shortcuts(spark):
    """A chain that tracks the state of the blanks equals one that assumes nothing."""
    texts = samples()
    for name in (SERVING, TRAINING):
        steps = profile(name)

        def plain(x):
            x = s.blank_guard(x)
            for step in steps:
                x = step.on(x, s.RAW)
            return x

        assert outcome(spark, lambda x: run_steps(x, steps), texts) == outcome(spark, plain, texts)


def test_compounds_match_longest_first(spark):
    words = {"a b", "a b c", "c a", "b b"}
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(300)]
    got = outcome(spark, s.join_compounds(sorted(words)), texts)
    assert got == [compounds(t, words) for t in texts]


def test_long_dictionaries_fold_like_short_ones(spark):
    many = PAIRS + [(f"word{i}", f"w{i}") for i in range(s.NESTED_MAX + 5)]
    texts = samples(200) + ["word7 word51 ko", " word1 "]
    assert outcome(spark, s.replace_all(many), texts) == list(map(in_order(many, ""), texts))
    assert outcome(spark, s.replace_phrases(many), texts) == list(map(in_order(many, " "), texts))


@pytest.mark.parametrize("step", [s.squeeze, s.emoji, s.url, s.special, s.repeats, s.sentence_marks])
def test_twice_is_once(spark, step):
    once = outcome(spark, step, samples(200))
    assert outcome(spark, step, once) == once


def test_mail_is_linear(spark):
    """Long stretches without an address, before and after one."""
    import time

    long = "chữ và số " * 40_000
    start = time.time()
    got = outcome(spark, s.mail, [long, "a@b.c @" + long, long + "@"])
    assert time.time() - start < 30
    assert got[0] == long.strip() and got[1] == "@" + long.strip()


def test_profiles_differ_as_documented(spark):
    df = spark.createDataFrame([("Không tốttt lắm , hài lòng kk",)], "t STRING")
    served = clean(df, "t", "o", SERVING).first()["o"]
    trained = clean(df, "t", "o", TRAINING).first()["o"]
    assert served == "không_tốt lắm hài_lòng ha ha"
    assert trained == "không_tốt lắm hài_lòng ha ha"
    kept = clean(df.selectExpr("'giày tốt' AS t"), "t", "o", SERVING, keep_words=["tốt"]).first()["o"]
    assert kept == "giày tốt"


def test_segmenter_hook(spark):
    df = spark.createDataFrame([("giao hang nhanh",), (None,)], "t STRING")
    rows = clean(df, "t", "o", segmenter=lambda t: t.replace("giao hang", "giao_hang")).collect()
    assert [r["o"] for r in rows] == ["giao_hang nhanh", ""]


def test_compounds_keep_every_character_of_a_text(spark):
    marks = "\ufdd0 \ufdd1x\ufdd2 2\ufdd20 \ufdd2\ufdd0"
    texts = [marks, f"hài lòng {marks} hài lòng", "\ufdd0hài lòng\ufdd1 hài lòng"]
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    got = [r[0] for r in df.select(s.join_compounds(["hài lòng"])(F.col("text"))).collect()]
    assert got == [marks, f"hài_lòng {marks} hài_lòng", "\ufdd0hài lòng\ufdd1 hài_lòng"]
