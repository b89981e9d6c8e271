"""Personal data: set patterns, and terms that give the protected entities away.

Protected entities are the mail addresses, IP addresses, card and phone numbers that the
patterns find. What a term reveals of an entity is estimated from co-occurrence in the
corpus: of the entity's information, -ln p(e), the share PMI(t, e) / -ln p(e), with
probabilities counted over documents. Terms are the runs of letters outside mail addresses
(the other entities have no letters), lower-cased; a term and an entity meet where they
stand in one document, at any distance. Where that is so in at least ``SUPPORT`` documents
and the term reveals at least ``DISCLOSED`` of the entity, all places of the term become
spans too, also in documents without the entity, where the term alone discloses it;
``sanitise`` generalises entities to their kind and removes such terms.

Patterns are possessive and begin at the start of a run of their characters, or where the
match before ended, so that matching takes time linear in the text. Places are made from
the lengths of the matches and of what is between them.

Defined results: null text is empty and has no spans; repeated rows read alike, each
counts as a document; an empty table gives no rows; other columns are not read. Places
count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decontaminate import words
from .scratch import Scratch

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text has anything a pattern could match.
TRIGGERS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)"
IP = rf"^(?:{_PART}\.){{3}}{_PART}$"
SUPPORT = 3
DISCLOSED = 0.8
#: Revealing terms, of some 10 bytes each, up to which they are sent to all tasks.
SENT = 200_000


def _luhn(digits: Column) -> Column:
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == 1, F.rlike(match, F.lit(IP)))
        .when(kind == 2, F.when(n.between(12, 19), _luhn(digits)).otherwise(False))
        .when(kind == 3, n.between(9, 15))
        .otherwise(True)
    )


def _matches(text: Column, kind: str) -> Column:
    """kind, i, match and gap (length before it)."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    n = F.size(found)
    zipped = F.arrays_zip(found.alias("match"), F.slice(gaps, F.lit(1), n).alias("left"))
    rows = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), x["match"].alias("match"),
            F.length(x["left"]).alias("gap"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,match:string,gap:int>>")
    return F.when(F.rlike(text, F.lit(TRIGGERS[kind])), rows).otherwise(none)


def base_spans(rows: DataFrame) -> DataFrame:
    """From (rid, found): rid, kind, start, end, match of the valid matches."""
    by_kind = Window.partitionBy("rid", "kind").orderBy("i")
    upto = by_kind.rowsBetween(Window.unboundedPreceding, 0)
    spans = rows.select("rid", F.explode("found").alias("f")).select("rid", "f.*")
    return (
        spans.withColumn("size", F.length("match"))
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("long"))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter(_valid(F.col("kind"), F.col("match")))
        .select("rid", "kind", "start", "end", "match")
    )


def _masked(text: Column) -> Column:
    """The text with its mail addresses blanked out, all places as they were."""
    pattern = PATTERNS["email"]
    blanks = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    pieces = F.zip_with(
        F.split(text, pattern, -1), blanks, lambda gap, blank: F.concat(gap, F.coalesce(blank, F.lit("")))
    )
    return F.when(F.contains(text, F.lit("@")), F.array_join(pieces, "")).otherwise(text)


def _terms(rows: DataFrame, *keep: str) -> DataFrame:
    """From (rid, text): the columns to keep, and the distinct terms of each row."""
    found = F.array_distinct(words(_masked(F.col("text")), r"[^\p{L}]+"))
    return rows.select(*keep, F.explode(F.array_distinct(F.transform(found, lambda x: F.lower(x)))).alias("term"))


def revealing_terms(
    rows: DataFrame, spans: DataFrame, n_docs: int, scratch: Scratch, support: int = SUPPORT, disclosed: float = DISCLOSED
) -> DataFrame:
    """Terms (term) that reach the threshold for some entity. ``rows`` has rid and text."""
    information = F.log(F.lit(float(max(n_docs, 1))) / F.col("n_e"))

    def reached(n_te: Column) -> Column:
        pmi = F.log(n_te * F.lit(float(max(n_docs, 1))) / (F.col("n_t") * F.col("n_e")))
        return (information > 0) & (pmi >= disclosed * information)

    held = scratch.put(spans.select("rid", F.concat_ws(":", "kind", "match").alias("entity")).distinct())
    entities = scratch.put(
        held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
        .filter((F.col("n_e") >= support) & (information > 0))
    )
    # Written, so that the joins read them as they are and can split a large group.
    held = scratch.put(held.join(entities, "entity"))
    most = held.agg(F.max("n_e")).first()[0] or 1
    # A pair shares no more documents than either of it has. Terms and pairs that miss the
    # threshold even so, such as those of common words, are not counted further.
    bound = F.least("n_t", "n_e")
    spread = scratch.put(
        _terms(rows, "rid").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
        .filter(F.col("n_t") >= support)
        .withColumn("n_e", F.lit(most)).filter(reached(bound)).drop("n_e")
    )
    own = _terms(rows.join(held.select("rid").distinct(), "rid", "left_semi"), "rid").join(spread, "term")
    return (
        own.join(held, "rid").filter(reached(bound))
        .groupBy("term", "entity")
        .agg(F.count(F.lit(1)).alias("n_te"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
        .filter((F.col("n_te") >= support) & reached(F.col("n_te")))
        .select("term").distinct()
    )


def term_places(rows: DataFrame, terms: DataFrame, scratch: Scratch) -> DataFrame:
    """All places of ``terms`` in (rid, text): rid, kind, start, end."""
    sent = F.broadcast(terms) if terms.count() <= SENT else terms
    marked = scratch.put(_terms(rows, "rid").join(sent, "term", "left_semi").select("rid").distinct())
    # Texts cross the network once, not their words.
    texts = (
        rows.select("rid", "text").join(marked, "rid", "left_semi").repartition("rid")
        .select("rid", _masked(F.col("text")).alias("text"))
    )
    word = r"\p{L}++"
    zipped = F.arrays_zip(
        F.regexp_extract_all("text", F.lit(word), F.lit(0)).alias("word"),
        F.transform(F.split("text", word, -1), lambda gap: F.length(gap)).alias("gap"),
    )
    upto = Window.partitionBy("rid").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (
        texts.select("rid", F.posexplode(zipped).alias("i", "x"))
        .select("rid", "i", "x.word", "x.gap").filter("word is not null")
        .withColumn("end", F.sum(F.col("gap") + F.length("word")).over(upto).cast("long"))
        .select("rid", F.lower("word").alias("term"), (F.col("end") - F.length("word")).alias("start"), "end")
        .join(sent, "term", "left_semi")
        .select("rid", F.lit(KINDS.index("term")).alias("kind"), "start", "end")
    )


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    support: int = SUPPORT, disclosed: float = DISCLOSED,
) -> DataFrame:
    """One row per row of ``docs``: id, spans (kind, start, end, by start and kind), and
    found, the digest columns n_email, n_ip, n_card, n_phone and base."""
    scratch = Scratch(docs.sparkSession, "privacy")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = scratch.put(
        texts.select(
            F.monotonically_increasing_id().alias("rid"), "id", "text",
            F.concat(*[_matches(F.col("text"), k) for k in PATTERNS]).alias("found"),
        )
    )
    spans = scratch.put(base_spans(rows))
    revealing = scratch.put(revealing_terms(rows, spans, rows.count(), scratch, support, disclosed))
    terms = term_places(rows, revealing, scratch)
    every = spans.select("rid", "kind", "start", "end").union(terms)
    place = F.struct("start", "kind", "end")
    by_row = every.groupBy("rid").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sort_array(F.collect_list(F.when(F.col("kind") < 4, place))).alias("base"),
        F.sort_array(F.collect_list(place)).alias("spans"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.select("rid", "id").join(by_row, "rid", "left").select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{name}", F.lit(0).cast("long")).alias(f"n_{name}") for name in KINDS],
        F.coalesce("base", none).alias("base"),
        F.coalesce("spans", none).alias("spans"),
    )


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def sanitise(text: Column, spans: Column) -> Column:
    """The text with entities generalised to their kind and revealing terms removed; of
    spans that overlap the one that starts last is replaced."""
    marks = F.array(*[F.lit("" if k == "term" else f"[{k.upper()}]") for k in KINDS])
    start = F.struct(text.alias("text"), F.length(text).cast("long").alias("free"))

    def replaced(state: Column, s: Column) -> Column:
        out = F.concat(
            F.left(state["text"], s["start"].cast("int")), F.get(marks, s["kind"]),
            F.substring(state["text"], s["end"].cast("int") + 1, F.length(state["text"])),
        )
        fits = s["end"] <= state["free"]
        return F.struct(
            F.when(fits, out).otherwise(state["text"]).alias("text"),
            F.when(fits, s["start"]).otherwise(state["free"]).alias("free"),
        )

    return F.aggregate(F.reverse(spans), start, replaced)["text"]
