"""Word lists and dictionaries.

The lists below are a small default vocabulary. A deployment passes its own: stop words
as one entry per line, dictionaries as ordered ``ord,key,value`` rows
(``sources.files``). Order matters, since entries chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# The words the score looks for.
POSITIVE = ("tốt", "đẹp", "chất_lượng", "hài_lòng", "tuyệt", "ok", "oke")
NEGATIVE = ("tệ", "kém", "xấu", "không_tốt", "thất_vọng", "dở")

# Common Vietnamese function words, single syllables, lower case.
STOPWORDS = tuple(
    """
    à ai anh bạn bị bởi các cái càng cần chỉ cho chứ có còn của cùng cũng cứ đã đang đây
    để đến đều đi do đó được em gì hay hơn khi không là lại làm lên mà mình mỗi một mới
    nào này nên nếu ngay như nhưng những nhé ở ơi qua quá ra rằng rất rồi sau sẽ sự tại
    thì tôi tốt từ từng và vào vẫn vậy về vì với vừa ạ ấy
    """.split()
)

# Emoticons as they look after lower-casing.
CHAR_TO_EMOJI = (
    (":))", "😂"),
    (":)", "🙂"),
    (":((", "😭"),
    (":(", "🙁"),
    (":d", "😃"),
    (";)", "😉"),
    (":p", "😛"),
    ("<3", "❤"),
    ("^^", "😊"),
)

EMOJI_TO_WORD = (
    ("😂", "cười"),
    ("🙂", "vui"),
    ("😀", "vui vẻ"),
    ("😭", "khóc"),
    ("🙁", "buồn"),
    ("😃", "vui vẻ"),
    ("❤", "yêu"),
    ("👍", "tốt"),
    ("👎", "tệ"),
)

# Abbreviations that are one token. "add" shows how a hit goes on to a later row.
ABBREVIATIONS = (
    ("ko", "không"),
    ("kg", "không"),
    ("hok", "không"),
    ("dc", "được"),
    ("đc", "được"),
    ("sp", "sản phẩm"),
    ("cl", "chất lượng"),
    ("r", "rồi"),
    ("j", "gì"),
    ("vs", "với"),
    ("mn", "mọi người"),
    ("mk", "mình"),
    ("bt", "bình thường"),
    ("cx", "cũng"),
    ("tl", "trả lời"),
    ("add", "ad"),
    ("ad", "shop"),
    ("okela", "oke"),
)

# Phrases that stand between spaces.
PHRASES = (
    ("k", "không"),
    ("không tl", "không trả lời"),
    ("|", "hoặc"),
    ("&", "và"),
    ("t/g", "thời gian"),
    ("s/p", "sản phẩm"),
)

COMPOUNDS = (
    "hài lòng",
    "thất vọng",
    "không tốt",
    "chất lượng",
    "sản phẩm",
    "chất lượng sản phẩm",
    "bình thường",
    "giao hàng",
    "thời gian",
    "mọi người",
    "trả lời",
    "vui vẻ",
)


@dataclass(frozen=True)
class Lexicons:
    """Everything the cleaning profiles look words up in.

    Stop words, abbreviations and compounds may be tables of any size instead (one column of
    entries; ``ord, key, value``). ``sources.files.words`` and ``pairs`` choose by the size.
    """

    stopwords: tuple[str, ...] | DataFrame = STOPWORDS
    char_to_emoji: tuple[tuple[str, str], ...] = CHAR_TO_EMOJI
    emoji_to_word: tuple[tuple[str, str], ...] = EMOJI_TO_WORD
    abbreviations: tuple[tuple[str, str], ...] | DataFrame = ABBREVIATIONS
    phrases: tuple[tuple[str, str], ...] = PHRASES
    compounds: tuple[str, ...] | DataFrame = COMPOUNDS

    @property
    def joined_stopwords(self) -> tuple[str, ...]:
        """The stop words as they look once compounds are joined."""
        return tuple(w.replace(" ", "_") for w in self.stopwords)


DEFAULT = Lexicons()
