"""Cleaning steps, each a Column -> Column rewrite that stays on the JVM.

A ``Step`` carries its rewrite, a cheap test that tells whether the rewrite can change
anything, and how the result is tidied. Regex rewrites copy every row through a Java
string even when nothing matches; the test is a byte search, so a text without a link
never pays for the link pattern.

A chain also tracks what is known of the blanks in the text, since tidying is a large
part of the work:

``RAW``     nothing
``TIDY``    no blank at either end, no two spaces in a row
``SPACED``  tidy, and the space is the only blank, as after splitting and joining

A step whose test is false returns tidy text untouched, and cheaper rewrites can be used
where the state allows.

Steps are made to be nested. Where a step needs its input several times it binds it
(``bind``), so an expression mentions its input once and a chain grows by addition. That
also holds where the optimizer copies it: a filter on a cleaned column is pushed below
the projection with the whole chain inside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as p

# Above this many entries a lexicon is joined as a table (operators.lookup) instead of
# being part of the expression.
LITERAL_MAX = 2_000
# Up to this many replacements are nested, which keeps them in generated code; beyond,
# they are folded over a literal array so that the expression does not grow.
NESTED_MAX = 48

Pairs = Sequence[tuple[str, str]]


def trim_blank(x: Column) -> Column:
    return F.trim(x, F.lit(p.BLANK_CHARS))


def _single(x: Column) -> Column:
    return F.regexp_replace(x, " {2,}", " ")


def squeeze(x: Column) -> Column:
    """Runs of spaces become one; tabs and line breaks inside stay."""
    return trim_blank(_single(x))


def blank_guard(x: Column) -> Column:
    """Null and all-blank text become the empty string."""
    text = F.coalesce(x.cast("string"), F.lit(""))
    return bind(text, lambda v: F.when(trim_blank(v) == "", F.lit("")).otherwise(v))


def bind(x: Column, body: Callable[[Column], Column]) -> Column:
    """``body(x)`` with ``x`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(x), body)[0]


RAW, TIDY, SPACED = range(3)

Rewrite = Callable[[Column], Column]


@dataclass(frozen=True)
class Step:
    name: str
    rewrite: Rewrite
    touches: Rewrite | None = None
    # How the result of ``rewrite`` is finished: "squeeze", "trim" or "none".
    finish: str = "squeeze"
    # The state that holds afterwards whatever the input was.
    reaches: int = TIDY
    # The best state the step can hand on.
    keeps: int = SPACED
    # The rewrite alone does not spoil a tidy text.
    harmless: bool = False
    # Rewrites for tidy and for single-spaced text; they leave at most a blank at the ends.
    tidy_rewrite: Rewrite | None = None
    spaced_rewrite: Rewrite | None = None
    spaced_touches: Rewrite | None = None

    def on(self, x: Column, state: int = RAW) -> Column:
        trim = F.trim if state == SPACED else trim_blank
        rewrite, touches = self.rewrite, self.touches
        if state == SPACED and self.spaced_rewrite:
            rewrite, finish = self.spaced_rewrite, trim
            touches = self.spaced_touches or touches
        elif state >= TIDY and self.tidy_rewrite:
            rewrite, finish = self.tidy_rewrite, trim
        elif self.finish == "none" or (state >= TIDY and self.harmless):
            finish = lambda v: v
        elif self.finish == "trim":
            finish = trim
        else:
            finish = lambda v: trim(_single(v))
        if touches is None:
            return finish(rewrite(x))
        if state >= TIDY:
            return bind(x, lambda v: F.when(touches(v), finish(rewrite(v))).otherwise(v))
        return finish(bind(x, lambda v: F.when(touches(v), rewrite(v)).otherwise(v)))

    def after(self, state: int) -> int:
        return min(max(state, self.reaches), self.keeps)

    def __call__(self, x: Column) -> Column:
        return self.on(x)


def _has(*needles: str) -> Callable[[Column], Column]:
    return lambda x: reduce(lambda a, b: a | b, (F.contains(x, F.lit(n)) for n in needles))


def tokens(x: Column) -> Column:
    """Blank-separated tokens; an empty text gives one empty token."""
    return F.split(trim_blank(x), f"[{p.J_BLANK}]+")


def _spaced_tokens(x: Column) -> Column:
    return F.split(x, " ")


def _join(words: Column) -> Column:
    return F.array_join(words, " ")


# --- links, addresses, tags -------------------------------------------------------

url = Step(
    "url",
    lambda x: F.regexp_replace(x, rf"https?://[^{p.J_SPACE}]+|www\.[^{p.J_SPACE}]+", " "),
    _has("http", "www."),
)

# A run of text up to an @, the @, and the run after it if that run holds a dot with
# text on both sides. Starting only where a run starts, and never giving characters
# back, keeps the scan linear also in the text behind the last @.
mail = Step(
    "mail",
    lambda x: F.regexp_replace(x, r"(?<![^@])[^@]++@(?=[^@]+\.[^@])[^@]++", " "),
    _has("@"),
)

# Only the address itself.
mail_scoped = Step(
    "mail_scoped",
    lambda x: F.regexp_replace(
        x, rf"(?<![^@{p.J_SPACE}])[^@{p.J_SPACE}]++@[^@.{p.J_SPACE}]++\.[^@{p.J_SPACE}]++", " "
    ),
    _has("@"),
)

tag = Step(
    "tag",
    lambda x: F.regexp_replace(x, rf"(?=[@#:])(?:[@#]|://)[^{p.J_SPACE}]+", " "),
    _has("@", "#", "://"),
)

# --- characters -------------------------------------------------------------------

lower = Step("lower", F.lower, finish="none", reaches=RAW)

emoji = Step(
    "emoji",
    lambda x: F.regexp_replace(x, f"[{p.J_EMOJI}]+", " "),
    tidy_rewrite=lambda x: F.regexp_replace(x, f" ?[{p.J_EMOJI}][ {p.J_EMOJI}]*+", " "),
)

_SPECIAL = rf"\p{{Nd}}{p.char_class(p.PUNCTUATION)}"
special = Step(
    "special",
    lambda x: F.regexp_replace(x, f"[{_SPECIAL}]+", " "),
    tidy_rewrite=lambda x: F.regexp_replace(x, f" ?[{_SPECIAL}][ {_SPECIAL}]*+", " "),
)

_MARKS = p.char_class(p.SENTENCE_MARKS)
sentence_marks = Step(
    "sentence_marks",
    lambda x: F.regexp_replace(x, f"[{_MARKS}]+", " "),
    _has(*p.SENTENCE_MARKS),
    tidy_rewrite=lambda x: F.regexp_replace(x, f" ?[{_MARKS}][ {_MARKS}]*+", " "),
)

repeats = Step(
    "repeats", lambda x: F.regexp_replace(x, r"(?U)(\w)\1+", "$1"), harmless=True
)


def label(prefix: str) -> Step:
    """Drop a form label wherever it stands."""
    return Step(
        f"label:{prefix}",
        lambda x: F.replace(F.coalesce(x, F.lit("")), F.lit(prefix), F.lit("")),
        finish="trim",
        reaches=RAW,
        keeps=RAW,
    )


# The form labels of the review site.
quality_label = label("Chất lượng sản phẩm:")
feature_label = label("Tính năng nổi bật:")

# --- tokens -----------------------------------------------------------------------


# A token goes with the space ahead of it: a pattern that begins with a plain character
# rules most places out by one look, where one that looks behind does its work at each.
# Plain letters are run over first, as their test is the cheapest.
def _drop_numbered(x: Column) -> Column:
    return F.regexp_replace(
        F.concat(F.lit(" "), x), rf" [a-z]*+[^ {p.J_DIGIT}]*+[{p.J_DIGIT}][^ ]*+", ""
    )


def _spaced(x: Column) -> Column:
    """Runs of blanks become a space; one that is a single space already is passed over."""
    return F.regexp_replace(x, f"(?=[{p.J_BLANK}])(?: *+[{p.J_ODD_BLANK}][{p.J_BLANK}]*+| {{2,}}+)", " ")


# Tokens with a digit go; what remains is joined by single spaces.
numbered_words = Step(
    "numbered_words",
    lambda x: F.trim(_drop_numbered(_spaced(x))),
    lambda x: F.rlike(x, F.lit(f"[{p.J_DIGIT}{p.J_ODD_BLANK}]")),
    reaches=SPACED,
    harmless=True,
    spaced_rewrite=_drop_numbered,
    spaced_touches=lambda x: F.rlike(x, F.lit(f"[{p.J_DIGIT}]")),
)

_laughs = "(?:" + "|".join(p.LAUGHTER) + ")"

# Token by token: each laughing token becomes two syllables.
laughter = Step(
    "laughter",
    lambda x: F.regexp_replace(
        x, rf"(?<![^{p.J_BLANK}])[^{p.J_BLANK}]*?{_laughs}[^{p.J_BLANK}]*+", " ha ha "
    ),
    _has(*p.LAUGHTER),
)

# Text by text: the text of each laughing token is replaced wherever it occurs, also
# inside longer words, in order of appearance. A second pass over the same token text
# finds nothing, so distinct tokens are enough.
def _laugh_away(x: Column, words: Column) -> Column:
    laughing = F.filter(words, _has(*p.LAUGHTER))
    return F.reduce(
        F.array_distinct(laughing), x, lambda text, w: F.replace(text, w, F.lit(" ha ha "))
    )


laughter_everywhere = Step(
    "laughter_everywhere",
    lambda x: _laugh_away(x, tokens(x)),
    _has(*p.LAUGHTER),
    spaced_rewrite=lambda x: _single(_laugh_away(x, _spaced_tokens(x))),
)


def drop_tokens(words: Sequence[str], keep: Sequence[str] = ()) -> Step:
    """Drop tokens that are listed, except those in ``keep``.

    ``isin`` over literals becomes a hash set, so the cost per token does not depend on
    the length of the list.
    """
    dropped = sorted((set(words) - set(keep)) | {""})

    def rewrite(words: Column) -> Column:
        return _join(F.filter(words, lambda w: ~w.isin(dropped)))

    return Step(
        "drop_tokens",
        lambda x: rewrite(tokens(x)),
        finish="none",
        reaches=SPACED,
        spaced_rewrite=lambda x: rewrite(_spaced_tokens(x)),
    )


def chained(pairs: Pairs) -> dict[str, str]:
    """One lookup that equals scanning the ordered rows once per token, where a hit
    changes the token and the scan goes on with the next row."""
    resolved: dict[str, str] = {}
    for key, value in reversed(pairs):
        resolved[key] = resolved.get(value, value)
    return resolved


def _well_spaced(values) -> bool:
    """No value that could bring in an odd blank, or be nothing but blanks."""
    return all(v.split() and v == " ".join(v.split()) for v in values)


def map_tokens(pairs: Pairs) -> Step:
    """Replace whole tokens through the chained dictionary."""
    table = chained(pairs)

    def rewrite(words: Column) -> Column:
        if not table:
            return _join(words)
        lookup = F.create_map(*(F.lit(s) for kv in table.items() for s in kv))
        known = list(table)
        return _join(
            F.transform(
                words,
                lambda w: F.when(w.isin(known), F.try_element_at(lookup, w)).otherwise(w),
            )
        )

    if not _well_spaced(table.values()):
        return Step("map_tokens", lambda x: rewrite(tokens(x)), keeps=TIDY)
    return Step(
        "map_tokens",
        lambda x: rewrite(tokens(x)),
        finish="none",
        reaches=SPACED,
        spaced_rewrite=lambda x: rewrite(_spaced_tokens(x)),
    )


def _fold(x: Column, pairs: Pairs) -> Column:
    if len(pairs) <= NESTED_MAX:
        return reduce(lambda t, kv: F.replace(t, F.lit(kv[0]), F.lit(kv[1])), pairs, x)
    rows = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in pairs))
    return F.reduce(rows, x, lambda t, kv: F.replace(t, kv["k"], kv["v"]))


def replace_all(pairs: Pairs) -> Step:
    """Ordered literal replacement; each value is set off by spaces."""
    keys = [k for k, _ in pairs]
    padded = [(k, f" {v} ") for k, v in pairs]
    if not pairs:
        touches = None
    elif len(pairs) <= NESTED_MAX:
        touches = _has(*keys)
    else:
        touches = lambda x: F.rlike(x, F.lit(p.any_of(keys)))
    keeps = SPACED if _well_spaced(v for _, v in pairs) else TIDY
    return Step("replace_all", lambda x: _fold(x, padded), touches, keeps=keeps)


def replace_phrases(pairs: Pairs) -> Step:
    """Ordered replacement of phrases that stand between two spaces. Two hits that share
    a space are not both replaced."""
    padded = [(f" {k} ", f" {v} ") for k, v in pairs]
    alone = f"(?:^| )(?:{p.any_of(k for k, _ in pairs)})(?: |$)"
    inside = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    if not pairs:
        touches = None
    elif len(pairs) <= NESTED_MAX:
        touches = lambda x: bind(inside(x), _has(*(k for k, _ in padded)))
    else:
        touches = lambda x: F.rlike(x, F.lit(alone))
    return Step(
        "replace_phrases",
        lambda x: _fold(inside(x), padded),
        touches,
        keeps=SPACED if _well_spaced(v for _, v in pairs) else TIDY,
    )


# Marks around a hit, and what a text's own ones are written with meanwhile.
_OPEN, _CLOSE, _ESCAPE = "\ufdd0", "\ufdd1", "\ufdd2"
_ESCAPED = ((_ESCAPE, f"{_ESCAPE}2"), (_OPEN, f"{_ESCAPE}0"), (_CLOSE, f"{_ESCAPE}1"))


def _escaped(x: Column) -> Column:
    own = _has(_OPEN, _CLOSE, _ESCAPE)
    return bind(x, lambda v: F.when(own(v), _fold(v, _ESCAPED)).otherwise(v))


def _restored(x: Column) -> Column:
    back = [(b, a) for a, b in reversed(_ESCAPED)]
    return bind(x, lambda v: F.when(F.contains(v, F.lit(_ESCAPE)), _fold(v, back)).otherwise(v))


def join_compounds(compounds: Sequence[str]) -> Step:
    """Join the syllables of listed compounds with ``_``.

    Left to right, the longest compound that starts at a token wins. Hits are marked first,
    each found from the blank ahead of it; then the text is cut at the marks and the inner
    spaces of every second piece are joined, so the number of passes over the text does not
    grow with the list.
    """
    ordered = sorted({c for c in compounds if " " in c}, key=lambda c: (-len(c), c))
    if not ordered:
        return Step("join_compounds", lambda x: x, harmless=True)
    one_of = p.any_of(ordered)

    def rewrite(x: Column, blank: str) -> Column:
        hit = f"([{blank}])({one_of})(?=[{blank}]|\\z)"
        marked = F.regexp_replace(F.concat(F.lit(" "), _escaped(x)), hit, f"$1{_OPEN}$2{_CLOSE}")
        pieces = F.transform(
            F.split(marked, f"[{_OPEN}{_CLOSE}]"),
            lambda w, i: F.when(i % 2 == 1, F.replace(w, F.lit(" "), F.lit("_"))).otherwise(w),
        )
        # without the blank set ahead of the text
        return _restored(F.substring(F.array_join(pieces, ""), 2, (1 << 31) - 1))

    touches = _has(*ordered) if len(ordered) <= NESTED_MAX else None
    return Step(
        "join_compounds",
        lambda x: rewrite(x, p.J_BLANK),
        touches,
        harmless=True,
        spaced_rewrite=lambda x: rewrite(x, " "),
    )


# --- tests on a text ----------------------------------------------------------------


def has_repeat(x: Column) -> Column:
    """Two equal neighbours, after squeezing."""
    return F.rlike(squeeze(F.coalesce(x, F.lit(""))), F.lit(r"(?s)(.)\1"))


def has_space(x: Column) -> Column:
    return F.contains(F.coalesce(x, F.lit("")), F.lit(" "))


def has_nonalpha(x: Column) -> Column:
    return F.rlike(F.coalesce(x, F.lit("")), F.lit(r"[^\p{L}]"))


def token_array(x: Column) -> Column:
    """Token list; an empty text gives an empty list."""
    return F.filter(tokens(x), lambda w: w != "")
