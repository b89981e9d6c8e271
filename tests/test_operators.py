from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import records as r
from reviewloom.functions import steps as s
from reviewloom.operators import abbreviations, dedupe, evaluate, features, ingest, lookup, skew, training
from reviewloom.plans.scoring import score_messages, to_result_value
from reviewloom.sources import files, topics


def test_salted_join_keeps_every_row(spark):
    large = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), "id"
    )
    keyed = spark.createDataFrame([(i, i * 10) for i in range(0, 60, 2)], "k LONG, v LONG")
    want = sorted(map(tuple, large.join(keyed, "k", "left").select("id", "k", "v").collect()), key=str)
    got = skew.salted_join(large, keyed, ["k"]).select("id", "k", "v").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_pages_stop_at_the_first_empty_one(spark):
    rng = random.Random(5)
    rows = [(item, page, rng.choice([0, 1, 2, 5])) for item in range(8) for page in range(12)]
    rows += [(99, page, 3) for page in range(500)] + [(98, 0, 0)]
    df = spark.createDataFrame(rows, "item INT, page INT, size INT")
    for limit in (None, 5):
        want = set()
        for item in {x[0] for x in rows}:
            for _, page, size in sorted(x for x in rows if x[0] == item):
                if size == 0 or (limit is not None and page >= limit):
                    break
                want.add((item, page, size))
        got = ingest.assemble_pages(df, "item", "page", "size", limit).collect()
        assert {tuple(x) for x in got} == want and len(got) == len(want)


def test_payloads_and_missing_fields(spark):
    payloads = [
        '{"data":{"ratings":[{"rating_star":5,"comment":"ok","orderid":7,"ctime":1738938053},{"ctime":0}]}}',
        '{"data":{}}',
        "{bad",
        None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(payloads)], "i INT, payload STRING")
    pages = ingest.parse_pages(df)
    assert [len(x["ratings"]) for x in pages.orderBy("i").collect()] == [2, 0, 0, 0]
    got = [tuple(x) for x in ingest.normalize(ingest.explode_ratings(pages)).collect()]
    assert got == [("5", "ok", "7", "2025-02-07 14:20:53"), ("N/A", "N/A", "N/A", "N/A")]


def test_a_bad_record_leaves_the_others(spark):
    page = '{"data":{"ratings":["junk",{"rating_star":4.5,"orderid":"A77"},3,{"comment":"x"},{"comment":"x"}]}}'
    df = spark.createDataFrame([(1, 1, page)], "item INT, page INT, payload STRING")
    keep = ("item", "page")
    pages = ingest.parse_pages(df)
    assert len(pages.first()["ratings"]) == 5
    rows = ingest.normalize(ingest.explode_ratings(pages, keep), (*keep, "pos"))
    want = [(1, "4.5", "N/A", "A77"), (3, "N/A", "x", "N/A"), (4, "N/A", "x", "N/A")]
    assert [tuple(x)[2:6] for x in rows.orderBy("pos").collect()] == want
    assert [tuple(x)[2:] for x in ingest.page_rejects(df, keep).collect()] == [(0, "junk"), (2, "3")]
    assert ingest.drop_repeats(rows.union(rows)).count() == 3


def test_epoch_text_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        df = spark.createDataFrame([(1738938053,), (0,), (-5,), (None,), (10**12,)], "s LONG")
        got = [x[0] for x in df.select(r.epoch_text(F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2025-02-07 14:20:53", "N/A", "N/A", "N/A", "N/A"]


def test_rejects(spark):
    values = ['{"rating":"5"}', "{bad", "", None, "[]", "{}"]
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    flagged = ingest.flag_rejects(df)
    assert [x["reason"] for x in flagged.collect()] == [
        None, "malformed", "empty", "empty", "malformed", "malformed",
    ]
    good, bad = ingest.split_rejects(flagged)
    assert (good.count(), bad.count()) == (1, 5)
    assert tuple(ingest.ingest_counts(flagged).first()) == (6, 1, 2, 3, True)
    assert tuple(ingest.ingest_counts(flagged.limit(0)).first()) == (0, 0, 0, 0, False)


def test_keep_last_and_reindex(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", f"t{i % 50}"]), i * 3) for i in range(900)]
    df = spark.createDataFrame(rows, "text STRING, pos LONG")
    last = {}
    for text, pos in rows:
        last[text] = pos
    want = [(t, pos, n) for n, (t, pos) in enumerate(sorted(last.items(), key=lambda x: x[1]))]
    got = dedupe.reindex(dedupe.keep_last(df, ["text"], "pos"), "pos", bucket_rows=100)
    assert [tuple(x) for x in got.orderBy("index").select("text", "pos", "index").collect()] == want


def test_reindex_of_sparse_positions(spark):
    positions = random.Random(2).sample(range(-(1 << 60), 1 << 60), 3000)
    df = spark.createDataFrame([(x,) for x in positions], "pos LONG")
    for size in (None, 100):
        got = {x["pos"]: x["index"] for x in dedupe.reindex(df, "pos", bucket_rows=size).collect()}
        assert got == {x: n for n, x in enumerate(sorted(positions))}
    assert dedupe.reindex(df.limit(0), "pos", bucket_rows=100).count() == 0


def brute_measures(pairs):
    classes = sorted({a for a, _ in pairs} | {b for _, b in pairs})
    out = {}
    for c in classes:
        hits = sum(a == b == c for a, b in pairs)
        support, predicted = sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
        precision = hits / predicted if predicted else 0.0
        recall = hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        out[c] = (precision, recall, f1, support)
    return out


def test_evaluation_against_counting(spark):
    rng = random.Random(2)
    pairs = [(rng.choice([0, 0, 0, 1, 2]), rng.choice([-1, 0, 0, 1])) for _ in range(500)]
    df = spark.createDataFrame(pairs, "y INT, p INT")
    counts = evaluate.pair_counts(df, "y", "p")
    want = brute_measures(pairs)
    rows = {x["class"]: x for x in evaluate.class_report(evaluate.class_measures(counts)).collect()}
    for c, (precision, recall, f1, support) in want.items():
        got = rows[str(c)]
        assert (got["precision"], got["recall"], got["f1"]) == pytest.approx((precision, recall, f1))
        assert got["support"] == support
    accuracy = sum(a == b for a, b in pairs) / len(pairs)
    assert rows["accuracy"]["f1"] == pytest.approx(accuracy)
    for i, m in enumerate(("precision", "recall", "f1")):
        assert rows["macro avg"][m] == pytest.approx(sum(v[i] for v in want.values()) / len(want))
        weighted = sum(v[i] * v[3] for v in want.values()) / len(pairs)
        assert rows["weighted avg"][m] == pytest.approx(weighted)
        summary = evaluate.summary(evaluate.class_measures(counts)).first()
        assert summary[f"weighted_{m}"] == pytest.approx(weighted)
    matrix = {x["label"]: tuple(x)[1:] for x in evaluate.confusion(counts, [-1, 0, 1]).collect()}
    tally = Counter(pairs)
    CLASSES = sorted({c for pair in pairs for c in pair} | {-1, 0, 1})
    assert matrix == {y: tuple(tally[(y, p)] for p in CLASSES) for y in CLASSES}


def test_lexicon_tables_equal_literals(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(vocabulary + ["hot"] * 20, k=rng.randint(0, 40))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    pairs = [("w1", "w2"), ("w2", "w3 x"), ("hot", "w5"), ("w5", "w1"), ("w3", "w4"), ("w2", "z"), ("w1", "y")]
    rows = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(pairs)], "ord LONG, key STRING, value STRING")
    assert {tuple(x) for x in lookup.resolve_chains(rows).collect()} == set(s.chained(pairs).items())
    for got, step in (
        (lookup.map_tokens(df, "id", "text", rows, "out"), s.map_tokens(pairs)),
        (
            lookup.drop_tokens(df, "id", "text", rows.select("key"), "out"),
            s.drop_tokens([k for k, _ in pairs]),
        ),
    ):
        want = df.select("id", step(F.col("text")).alias("out"))
        assert sorted(map(tuple, got.select("id", "out").collect())) == sorted(map(tuple, want.collect()))


def test_long_chains_and_long_texts(spark):
    chain = [(i, f"w{i}", f"w{i + 1}") for i in range(100)]
    rows = spark.createDataFrame(chain, "ord LONG, key STRING, value STRING")
    assert {x[0]: x[1] for x in lookup.resolve_chains(rows).collect()} == {f"w{i}": "w100" for i in range(100)}
    texts = [(1, " ".join(["w1", "x"] * 20_000)), (2, None), (3, " \n"), (4, "x  y")]
    df = spark.createDataFrame(texts, "id INT, text STRING")
    mapped = {x["id"]: x["out"] for x in lookup.map_tokens(df, "id", "text", rows, "out").collect()}
    assert mapped == {1: " ".join(["w100", "x"] * 20_000), 2: None, 3: "", 4: "x y"}
    kept = {x["id"]: x["out"] for x in lookup.drop_tokens(df, "id", "text", rows.select("key"), "out").collect()}
    assert kept == {1: " ".join(["x"] * 20_000), 2: None, 3: "", 4: "x y"}


def test_chains_resolve_like_a_scan(spark):
    rng = random.Random(6)
    for _ in range(200):
        pairs = [(rng.choice("abcd"), rng.choice("abcdx")) for _ in range(rng.randint(1, 7))]
        for word in "abcd":
            seen = word
            for key, value in pairs:
                seen = value if seen == key else seen
            assert s.chained(pairs).get(word, word) == seen


def test_small_lexicons_become_literals(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", "c"), (1, "a", "b")], "ord LONG, key STRING, value STRING")
    files.write_csv(rows, str(tmp_path / "d"))
    dictionary = files.read_dictionary(spark, str(tmp_path / "d"))
    assert files.pairs(dictionary) == (("a", "b"), ("b", "c"))
    assert files.pairs(dictionary, limit=1) is dictionary
    (tmp_path / "words.txt").write_text("rất\n\n \nvới nhau\n á\nrất\n", encoding="utf-8")
    lines = files.read_lines(spark, str(tmp_path / "words.txt"))
    assert files.words(lines) == tuple(sorted(["rất", "với nhau", " á"]))
    assert files.words(lines, limit=2) is lines
    assert files.read_lines(spark, str(tmp_path / "words.txt"), keep_blank=True).count() == 5


def test_review_table_has_a_byte_order_mark(spark, tmp_path):
    rows = [("5", 'đẹp; "quá"\nlắm ', "1", "N/A"), ("4", "", "2", "N/A")]
    path = str(tmp_path / "r")
    files.write_reviews(spark.createDataFrame(rows, r.RAW_MESSAGE).coalesce(1), path)
    part = next((tmp_path / "r").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbf")
    back = files.read_reviews(spark, path)
    assert back.columns == ["Rating", "Comment", "Order ID", "Time"]
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_tells_empty_from_null(spark, tmp_path):
    rows = [("a", "", None), ("", "b", " "), ('q"', "l\nm", "x,y"), (None, "\\N", '""')]
    df = spark.createDataFrame(rows, "p STRING, q STRING, r STRING")
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), df.schema).collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)


def test_scored_message_shape(spark):
    values = ['{"rating":"5","comment":"đẹp","orderid":"1","time":"N/A"}', "{bad", None]
    df = spark.createDataFrame([(v,) for v in values], "value STRING")
    scored = score_messages(df)
    assert [tuple(x) for x in scored.collect()] == [
        ("5", "đẹp", "đẹp", 1, "N/A"),
        (None, None, "", -1, None),
        (None, None, "", -1, None),
    ]
    assert to_result_value(scored).collect()[1]["value"] == '{"processed_comment":"","sentiment":-1}'


def test_scoring_parses_only_what_it_needs(spark):
    df = spark.createDataFrame([("{}",)], "value STRING")
    assert "orderid" not in score_messages(df)._jdf.queryExecution().optimizedPlan().toString()


def test_ngrams(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b", "c"],), ([],)], "words ARRAY<STRING>")
    got = [x["ngrams"] for x in features.with_ngrams(df).collect()]
    assert got == [[], ["a b", "b c"], []]
    both = [x["ngrams"] for x in features.with_ngrams(df, unigrams=True).collect()]
    assert both[1] == ["a", "b", "c", "a b", "b c"]


def test_labels_become_two_classes(spark):
    df = spark.createDataFrame([("x", 0), ("", 1), ("z", 2)], "t STRING, l INT")
    frame = training.drop_empty(training.training_frame(df, "t", "l"))
    assert [tuple(x) for x in frame.collect()] == [("x", 0), ("z", 1)]
    assert [f.dataType for f in frame.schema] == [f.dataType for f in r.TRAINING]


def test_training_and_stored_model(spark, tmp_path):
    rng = random.Random(9)
    good, bad = ["đẹp tuyệt vời", "giao nhanh đẹp tuyệt"], ["hỏng rách nát", "quá hỏng rách"]
    rows = [(" ".join(rng.choices(good if i % 2 else bad, k=4)), i % 2) for i in range(120)]
    frame = training.prepare(spark.createDataFrame(rows, r.TRAINING))
    for kind in ("tree", "logistic"):
        fitted = training.fit(frame, kind)
        assert 0.9 <= fitted.fold_accuracy <= 1.0
        path = str(tmp_path / kind)
        training.save(fitted, path)
        stored = training.load(path)
        assert stored.profile == fitted.profile
        assert stored.fold_accuracy == pytest.approx(fitted.fold_accuracy)
        want = [x["prediction"] for x in training.predict(fitted, frame).collect()]
        assert [x["prediction"] for x in training.predict(stored, frame).collect()] == want


def test_abbreviations_in_context(spark):
    rng = random.Random(8)
    sides = {"kg": ("không", "ăn uống ngon"), "KG": ("ki lô", "cân nặng kí")}
    rows = []
    for i in range(80):
        origin, around = sides[rng.choice(list(sides))]
        words = around.split() * 2
        words.insert(rng.randint(0, 5), "kg")
        text = " ".join(words)
        start = (" " + text + " ").index(" kg ")
        rows.append(("kg", start, start + 2, text, origin))
    schema = "abb STRING, start_index INT, end_index INT, cmt STRING, origin STRING"
    corpus = spark.createDataFrame(rows, schema)
    by_text = abbreviations.corpus_by_text([corpus, corpus])
    assert by_text.selectExpr("sum(size(occurrences))").first()[0] == len(set(rows))
    expander = abbreviations.fit(by_text)
    texts = [(1, "kg ăn uống kg ngon kg"), (2, "cân kg nặng"), (3, "skg"), (4, "")]
    df = spark.createDataFrame(texts, "id INT, text STRING")
    got = {x["id"]: x["text"] for x in abbreviations.expand(expander, df, "text", ["kg"]).collect()}
    assert got == {1: "không ăn uống không ngon không", 2: "cân ki lô nặng", 3: "skg", 4: ""}


def test_a_stored_expander_needs_no_key(spark, tmp_path):
    rows = [("kg", 3, 5, "ăn kg ngon", "không"), ("kg", 4, 6, "cân kg nặng", "ki lô"), ("kg", 4, 6, "cân kg nặng quá", "ki lô")]
    schema = "abb STRING, start_index INT, end_index INT, cmt STRING, origin STRING"
    by_text = abbreviations.corpus_by_text([spark.createDataFrame(rows, schema)])
    expander = abbreviations.fit(by_text, abbreviations=["kg"])
    abbreviations.save(expander, str(tmp_path / "e"))
    stored = abbreviations.load(str(tmp_path / "e"))
    assert stored.labels == ("ki lô", "không") and stored.abbreviations == ("kg",)
    texts = [(1, "ăn kg ngon"), (1, "cân kg nặng"), (1, "ăn kg ngon"), (None, "kg"), (None, None)]
    df = spark.createDataFrame(texts, "id INT, text STRING")
    want, got = (
        sorted(map(str, abbreviations.expand(e, df, "text", output="out").collect())) for e in (expander, stored)
    )
    assert got == want and len(got) == 5
    assert {r["out"] for r in abbreviations.expand(stored, df.filter("id = 1"), "text", output="out").collect()} == {
        "ăn không ngon", "cân ki lô nặng"}


def test_offsets_in_a_long_text(spark):
    import random

    rng = random.Random(3)
    texts = ["", "kg", " kg", "kg kg", "a  kg ", " ".join(rng.choice(["kg", "ü", "", "abc😀"]) for _ in range(20_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    got = sorted(map(tuple, abbreviations.spans(df, "text", ["kg"], "id").select("id", "pos", "start_index", "end_index").collect()))
    want = []
    for i, t in enumerate(texts):
        at = 0
        for pos, w in enumerate(t.split(" ")):
            if w == "kg":
                want.append((i, pos, at, at + 2))
            at += len(w) + 1
    assert got == want


def test_labels_by_frequency_then_name(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", "c", "c", None]], "origin STRING")
    assert abbreviations.learn_labels(df) == ("c", "a", "b")


def test_abbreviations_far_behind_in_a_text(spark):
    """One text holds both meanings behind position 8,000: only the place tells them apart."""
    def text(n):
        return "xa " * n + "kg " + "xa " * 7000 + "kg", 3 * n, 3 * n + 3 + 21000

    rows = []
    for i in range(12):
        whole, near, far = text(3000 + i)
        rows += [("kg", near, near + 2, whole, "không"), ("kg", far, far + 2, whole, "ki lô")]
    schema = "abb STRING, start_index INT, end_index INT, cmt STRING, origin STRING"
    expander = abbreviations.fit(abbreviations.corpus_by_text([spark.createDataFrame(rows, schema)]))
    whole, near, far = text(3005)
    df = spark.createDataFrame([(1, whole)], "id INT, text STRING")
    got = abbreviations.expand(expander, df, "text", ["kg"]).first()["text"]
    assert got == whole[:near] + "không" + whole[near + 2 : far] + "ki lô"


def test_topic_options():
    read = topics.kafka_read_options(max_per_batch=100, min_partitions=64)
    assert read["startingOffsets"] == "latest" and read["failOnDataLoss"] == "false"
    assert read["subscribe"] == "rawData" and read["maxOffsetsPerTrigger"] == "100"
    assert read["minPartitions"] == "64"
    write = topics.kafka_write_options()
    assert write["topic"] == "resultData" and write["kafka.acks"] == "all"
    assert write["kafka.max.in.flight.requests.per.connection"] == "1"
