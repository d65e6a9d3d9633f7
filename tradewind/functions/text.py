"""Comment text: slices of a pool of sentences built from a small grammar."""

from __future__ import annotations

from functools import lru_cache
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions import words as W
from tradewind.functions.draws import MODULUS, MULTIPLIER, STREAMS, draw, state

POOL_SIZE = 32 * 1024
_PIECE_BITS = 7

_WORDS = {"N": W.NOUNS, "V": W.VERBS, "D": W.ADVERBS, "J": W.ADJECTIVES, "X": W.AUXILIARIES,
          "A": W.ARTICLES}


class _Stream:
    """The pool's own stream of draws."""

    def __init__(self):
        self.value = STREAMS["text"][0]

    def choose(self, options: list[tuple[str, int]]) -> str:
        self.value = self.value * MULTIPLIER % MODULUS
        sums = list(accumulate(weight for _, weight in options))
        drawn = 1 + int(self.value / MODULUS * sums[-1])
        return next(word for (word, _), top in zip(options, sums) if top >= drawn)


def _phrase(stream: _Stream, forms: list[tuple[str, int]]) -> str:
    return " ".join(stream.choose(_WORDS[token[0]]) + token[1:]
                    for token in stream.choose(forms).split())


def _sentence(stream: _Stream) -> str:
    parts = []
    for token in stream.choose(W.SENTENCES).split():
        if token == "N":
            parts.append(_phrase(stream, W.NOUN_PHRASES))
        elif token == "V":
            parts.append(_phrase(stream, W.VERB_PHRASES))
        elif token == "P":
            preposition = stream.choose(W.PREPOSITIONS)
            parts.append(f"{preposition} the {_phrase(stream, W.NOUN_PHRASES)}")
        else:
            parts[-1] += stream.choose(W.TERMINATORS)
    return " ".join(parts)


@lru_cache(maxsize=4)
def pool(size: int = POOL_SIZE) -> str:
    stream, text, length = _Stream(), [], 0
    while length < size:
        text.append(_sentence(stream))
        length += len(text[-1]) + 1
    return " ".join(text)[:size]


def comment(stream: str, average: int, nth: int | Column = 1, size: int = POOL_SIZE) -> Column:
    """A slice of the pool of 0.4 to 1.6 times the average length.

    Taking a slice counts characters from the start of its text, so the pool is
    held as overlapping pieces and only one short piece is ever scanned.
    """
    shortest, longest = int(average * 0.4), int(average * 1.6)
    start = draw(stream, 0, size - longest, nth)
    length = draw(stream, shortest, longest, nth + 1)
    piece = _pieces(size, longest)[F.shiftright(start, _PIECE_BITS).cast("int")]
    return F.substr(piece, (start % (1 << _PIECE_BITS) + 1).cast("int"), length.cast("int"))


def _pieces(size: int, overlap: int) -> Column:
    stride = 1 << _PIECE_BITS
    text = pool(size)
    pieces = [text[at:at + stride + overlap] for at in range(0, size, stride)]
    return F.split(F.lit("|".join(pieces)), r"\|")


def address(stream: str) -> Column:
    """10 to 40 letters, digits, blanks and commas."""
    noise = F.base64(F.unhex(F.sha2(state(stream, 2).cast("string"), 256)))
    return F.substr(F.translate(noise, "+/", " ,"), F.lit(1),
                    draw(stream, 10, 40).cast("int"))
