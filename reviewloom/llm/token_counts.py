"""Token counts under a unigram vocabulary, by forward scores shared in a trie.

A pre-token is a run of non-space bytes behind the vocabulary's word mark. The forward
score of a prefix is the best sum of piece scores that spell it; it depends on the prefix
alone. The distinct pre-tokens of a stretch of texts are walked in sorted order, which is
a depth-first walk of their trie: only the nodes behind the prefix shared with the one
before are computed. What is stored of a pre-token is the number of pieces of its best
spelling: of equal scores the one of fewer pieces, and then whatever is first.

Piece scores come from the order of the vocabulary, -log(rank + 2); a byte that no piece
spells is one token of score ``BYTE``. The vocabulary is a file given by its path.

Defined results: null, empty and blank texts have no tokens; repeated rows are counted
alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import _slices
from .scratch import bounded_batches

WORD_MARK = "▁".encode()
#: The score of a byte without a piece.
BYTE = -30.0
#: Pre-tokens whose counts a task remembers at most; beyond that it starts anew.
REMEMBERED = 300_000


def load_pieces(path: str) -> dict[bytes, float]:
    """Pieces and scores of a vocabulary file; special and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [
        model.id_to_piece(i).encode()
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return {piece: -math.log(rank + 2) for rank, piece in enumerate(usable)}


class ForwardTrie:
    """Counts pieces of pre-tokens; the current path's scores are all it holds."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces = pieces
        # lengths that pieces with these last two bytes have
        ends: dict[bytes, set[int]] = {}
        for piece in pieces:
            ends.setdefault(piece[-2:], set()).add(len(piece))
            if len(piece) == 1:
                for first in range(256):
                    ends.setdefault(bytes([first]) + piece, set()).add(1)
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ends.items()}

    def counts(self, words: list[bytes]) -> dict[bytes, int]:
        out = {}
        score, count = [0.0], [0]
        pieces, lengths = self.pieces, self.lengths
        last = b""
        for word in sorted(words):
            path = WORD_MARK + word
            shared = 0
            limit = min(len(path), len(last))
            while shared < limit and path[shared] == last[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(path) + 1):
                best, n = score[end - 1] + BYTE, count[end - 1] + 1
                for length in lengths.get(path[max(0, end - 2) : end], ()):
                    at = end - length
                    if at < 0:
                        continue
                    own = pieces.get(path[at:end])
                    if own is not None:
                        own += score[at]
                        if own > best or (own == best and count[at] + 1 < n):
                            best, n = own, count[at] + 1
                score.append(best)
                count.append(n)
            out[word] = count[-1]
            last = path
        return out


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_pretokens, n_tokens."""
    spark = docs.sparkSession
    bounded_batches(spark)
    # a vocabulary is of a fixed size, some ten thousand pieces
    shared = spark.sparkContext.broadcast(load_pieces(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ForwardTrie(shared.value)
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            pre, tokens = [0] * len(texts), [0] * len(texts)
            waiting: list[tuple[int, list[bytes]]] = []
            held = 0

            def settle():
                nonlocal held
                new = {w for _, words in waiting for w in words if w not in known}
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = {w for _, words in waiting for w in words}
                known.update(trie.counts(list(new)))
                for i, words in waiting:
                    pre[i] += len(words)
                    tokens[i] += sum(map(known.__getitem__, words))
                waiting.clear()
                held = 0

            for i, raw in enumerate(texts):
                for part in _slices(raw):
                    waiting.append((i, part.split()))
                    held += len(part)
                    if held >= 1 << 20:
                        settle()
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) for x in texts], pa.int64()),
                 pa.array(pre, pa.int64()), pa.array(tokens, pa.int64())],
                names=["id", "n_bytes", "n_pretokens", "n_tokens"],
            )

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {id_type}, n_bytes long, n_pretokens long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )
