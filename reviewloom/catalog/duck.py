"""The cleaning steps once more, as SQL text for the checking engine.

Written from the definition of each step and not from the Spark expressions: plain
classes, one pass per replacement, no guards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from ..functions import patterns as p
from ..functions.lexicon import DEFAULT, NEGATIVE, POSITIVE

Sql = Callable[[str], str]


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(words: Sequence[str]) -> str:
    return ", ".join(lit(w) for w in words)


def sub(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(replacement)}, 'g')"


def trim_blank(x: str) -> str:
    return f"trim({x}, {lit(p.BLANK_CHARS)})"


def squeeze(x: str) -> str:
    return trim_blank(sub(x, " {2,}", " "))


def tokens(x: str) -> str:
    pattern = lit(f"[{p.BLANK}]+")
    return f"list_filter(regexp_split_to_array({x}, {pattern}), lambda w: w <> '')"


def join(words: str) -> str:
    return f"array_to_string({words}, ' ')"


def chars(x: str) -> str:
    return f"string_split({x}, '')"


def blank_guard(x: str) -> str:
    return f"CASE WHEN {trim_blank(f'coalesce({x}, {lit(str())})')} = '' THEN '' ELSE {x} END"


def drop_label(label: str) -> Sql:
    return lambda x: trim_blank(f"replace(coalesce({x}, ''), {lit(label)}, '')")


def drop_tokens(words: Sequence[str]) -> Sql:
    return lambda x: join(f"list_filter({tokens(x)}, lambda w: w NOT IN ({lits(words)}))")


def lower(x: str) -> str:
    return f"lower({x})"


def url(x: str) -> str:
    return squeeze(sub(x, rf"https?://[^{p.SPACE}]+|www\.[^{p.SPACE}]+", " "))


def mail(x: str) -> str:
    return squeeze(sub(x, r"[^@]+@[^@]+\.[^@]+", " "))


def mail_scoped(x: str) -> str:
    s = p.SPACE
    return squeeze(sub(x, rf"[^@{s}]+@[^@.{s}]+\.[^@{s}]+", " "))


def tag(x: str) -> str:
    return squeeze(sub(x, rf"(?:@|#|://)[^{p.SPACE}]+", " "))


def numbered_words(x: str) -> str:
    digit = lit(f"[{p.DIGIT}]")
    return squeeze(
        join(f"list_filter({tokens(x)}, lambda w: NOT regexp_matches(w, {digit}))")
    )


def sentence_marks(x: str) -> str:
    return squeeze(sub(x, "[.,?!]", " "))


def emoji(x: str) -> str:
    return squeeze(sub(x, f"[{p.EMOJI}]", " "))


def special(x: str) -> str:
    digits = sub(x, r"\p{Nd}+", " ")
    return squeeze(sub(digits, f"[{p.char_class(p.PUNCTUATION)}]", " "))


def neighbours(x: str) -> str:
    """Pairs of each character and the one before it, empty for the first."""
    return f"list_zip({chars(x)}, list_prepend('', list_slice({chars(x)}, 1, -2)))"


def repeats(x: str) -> str:
    word = lit(r"^[\p{L}\p{M}\p{Nd}\p{Pc}]$")
    kept = f"list_filter({neighbours(x)}, lambda c: c[1] <> c[2] OR NOT regexp_matches(c[1], {word}))"
    return squeeze(f"array_to_string(list_transform({kept}, lambda c: c[1]), '')")


def laughter(x: str) -> str:
    any_laugh = "|".join(p.LAUGHTER)
    return squeeze(sub(x, rf"[^{p.BLANK}]*(?:{any_laugh})[^{p.BLANK}]*", " ha ha "))


def laughter_everywhere(x: str) -> str:
    any_laugh = lit("|".join(p.LAUGHTER))
    laughing = f"list_filter({tokens(x)}, lambda w: regexp_matches(w, {any_laugh}))"
    return squeeze(
        f"list_reduce(list_prepend({x}, {laughing}), lambda t, w: replace(t, w, ' ha ha '))"
    )


def replace_all(pairs) -> Sql:
    def step(x: str) -> str:
        for key, value in pairs:
            x = f"replace({x}, {lit(key)}, {lit(f' {value} ')})"
        return squeeze(x)

    return step


def replace_phrases(pairs) -> Sql:
    def step(x: str) -> str:
        x = f"(' ' || {x} || ' ')"
        for key, value in pairs:
            x = f"replace({x}, {lit(f' {key} ')}, {lit(f' {value} ')})"
        return squeeze(x)

    return step


def map_tokens(pairs) -> Sql:
    """Row by row: a token that equals the row's key becomes its value and goes on."""
    word = "w"
    for key, value in pairs:
        word = f"replace(chr(1) || {word} || chr(1), chr(1) || {lit(key)} || chr(1), chr(1) || {lit(value)} || chr(1))[2:-2]"
    return lambda x: squeeze(join(f"list_transform({tokens(x)}, lambda w: {word})"))


def join_compounds(compounds: Sequence[str]) -> Sql:
    """Every token gets spaces of its own, hits are marked, then joined pair by pair."""
    ordered = sorted(compounds, key=lambda c: (-len(c), c))
    hit = "|".join(c.replace(" ", "  ") for c in ordered)
    pairs = max(c.count(" ") for c in ordered)

    def step(x: str) -> str:
        x = f"(' ' || replace({x}, ' ', '  ') || ' ')"
        x = sub(x, f" ({hit}) ", " \x01\\1\x02 ")
        for _ in range(pairs):
            x = sub(x, "\x01([^ \x01\x02]+)  ([^\x01\x02]*)\x02", "\x01\\1_\\2\x02")
        x = f"replace(replace({x}, '\x01', ''), '\x02', '')"
        return squeeze(f"replace({x}, '  ', ' ')")

    return step


def serving(lex=DEFAULT, drop: Joined | None = None, mapped: Joined | None = None) -> list[Sql | Joined]:
    """``drop`` and ``mapped`` take the place of the stop words and the abbreviations."""
    single = [w for w in lex.stopwords if " " not in w]
    return [
        blank_guard,
        drop_label("Chất lượng sản phẩm:"),
        drop_label("Tính năng nổi bật:"),
        drop or drop_tokens(single),
        lower,
        *_shared(lex, mapped),
    ]


def training(lex=DEFAULT) -> list[Sql]:
    return [blank_guard, lower, *_shared(lex), drop_tokens(lex.joined_stopwords)]


def _shared(lex, mapped: Joined | None = None) -> list[Sql | Joined]:
    return [
        replace_all(lex.char_to_emoji),
        url,
        mail,
        tag,
        numbered_words,
        sentence_marks,
        laughter_everywhere,
        replace_phrases(lex.phrases),
        replace_all(lex.char_to_emoji),
        emoji,
        repeats,
        special,
        mapped or map_tokens(lex.abbreviations),
        join_compounds(lex.compounds),
    ]


class Joined:
    """A step on the tokens of all texts at once, for lists that are tables: ``rewrite`` is
    a join of the tokens (key, i, w), giving those that stay."""

    def __init__(self, key: str, rewrite: str):
        self.key, self.rewrite = key, rewrite

    def of(self, previous: str, keep: str) -> str:
        kept = ", ".join(f"p.{x.strip()}" for x in keep.split(","))
        listed = f"(SELECT {self.key}, generate_subscripts({tokens('x')}, 1) AS i, unnest({tokens('x')}) AS w FROM {previous})"
        return f"""
SELECT {kept}, coalesce(o.x, '') AS x FROM {previous} p LEFT JOIN (
  SELECT {self.key}, string_agg(w, ' ' ORDER BY i) AS x
  FROM (SELECT t.{self.key}, t.i, {self.rewrite.replace("{tokens}", listed)}) GROUP BY {self.key}) o USING ({self.key})"""


def chain(source: str, column: str, steps: Sequence[Sql], output: str, keep: str) -> str:
    """``WITH`` clauses that apply the steps one after another; the last is ``cleaned``
    with the columns ``keep`` and ``output``."""
    parts = [f"s0 AS (SELECT {keep}, {column} AS x FROM ({source}))"]
    for i, step in enumerate(steps, 1):
        if isinstance(step, Joined):
            parts.append(f"s{i} AS MATERIALIZED ({step.of(f's{i - 1}', keep)})")
        else:
            parts.append(f"s{i} AS (SELECT {keep}, {step('x')} AS x FROM s{i - 1})")
    # Materialised, or the engine would put the whole chain in place of each mention.
    parts.append(f"cleaned AS MATERIALIZED (SELECT {keep}, x AS {output} FROM s{len(steps)})")
    return "WITH " + ",\n".join(parts)


def sentiment(x: str) -> str:
    def hits(words):
        return " + ".join(f"contains(lower({x}), {lit(w)})::INT" for w in words)

    return (
        f"CASE WHEN {x} IS NULL OR {trim_blank(x)} = '' THEN -1"
        f" WHEN ({hits(NEGATIVE)}) > ({hits(POSITIVE)}) THEN 0 ELSE 1 END"
    )


def utc_text(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%d %H:%M:%S')"
