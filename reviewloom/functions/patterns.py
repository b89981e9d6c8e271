"""Character classes and patterns shared by the text steps.

Every class is spelled out with ``\\x{...}`` escapes instead of relying on ``\\s``,
``\\d`` or ``\\w``: Java matches only ASCII with those by default, while the text here
is Vietnamese.
"""

from __future__ import annotations

import re

# What the str methods strip() and split() treat as blank.
BLANK_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The same without the plain space.
ODD_BLANK = BLANK.replace(r"\x{1C}-\x{20}", r"\x{1C}-\x{1F}")

# The White_Space property, which leaves out the separators 1C-1F.
SPACE = (
    r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Decimal digits plus the superscript, subscript and circled digits.
DIGIT = (
    r"\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)

# Unicode emoji, code point ranges in order, with the joiner, the
# variation selector and the keycap mark that emoji sequences are made of.
EMOJI_RANGES = (
    "A9 AE 200D 203C 2049 20E3 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 "
    "23F8-23FA 24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D "
    "2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 "
    "2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB "
    "26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 "
    "26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 2728 2733-2734 2744 "
    "2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 "
    "2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 FE0F 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E "
    "1F191-1F19A 1F1E6-1F1FF 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F64F "
    "1F680-1F6FF 1F7E0-1F7EB 1F7F0 1F90C-1F9FF 1FA70-1FAFF"
)
EMOJI = "".join(
    "-".join(rf"\x{{{point}}}" for point in span.split("-")) for span in EMOJI_RANGES.split()
)

# The punctuation that is blanked out. The apostrophe is not in it.
PUNCTUATION = "~!@#$%^&*()_+{}“”|:\"<>?`´-=[];\\/.,"
SENTENCE_MARKS = ".,?!"
LAUGHTER = ("kk", "kaka", "kiki", "haha", "hihi")


def java_class(ranges: str, common: str, rare: str) -> str:
    """The inside of a Java class that equals ``ranges`` but is quick to rule out.

    Java tries the ranges of a class one by one. Here a character is first looked for in
    ``common``, and the whole list is only tried inside the wide span ``rare``, where
    ordinary letters are not.
    """
    return rf"{common}[{rare}&&[{ranges}]]"


def char_class(chars: str) -> str:
    """The inside of a bracket class that matches exactly ``chars``."""
    return "".join(rf"\x{{{ord(c):X}}}" for c in chars)


def any_of(words) -> str:
    """An alternation of literals, in the order given."""
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in words)


# The classes as the steps use them. SQL engines without class intersection take the
# plain lists above.
J_BLANK = java_class(BLANK, r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}", r"\x{1680}-\x{3000}")
J_ODD_BLANK = java_class(
    ODD_BLANK, r"\x{9}-\x{D}\x{1C}-\x{1F}\x{85}\x{A0}", r"\x{1680}-\x{3000}"
)
J_SPACE = java_class(SPACE, r"\x{9}-\x{D}\x{20}\x{85}\x{A0}", r"\x{1680}-\x{3000}")
J_DIGIT = java_class(
    DIGIT, r"0-9\x{B2}\x{B3}\x{B9}", r"\x{660}-\x{1CFF}\x{2070}-\x{10FFFF}"
)
J_EMOJI = java_class(EMOJI, r"\x{A9}\x{AE}", r"\x{200D}-\x{10FFFF}")
