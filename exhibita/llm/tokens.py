"""Count-only Viterbi segmentation under a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character of a word; dynamic programming
carries the best score and its number of pieces, without ever building the pieces. Ties go to the piece that
starts first, as in the tokenizers' own Viterbi, which keeps the first of equal candidates in order of start.

A best score needs no more than the scores as far back as the longest piece reaches. So a word of any length, such as
a text without spaces, is read slice by slice and only that many scores go on from one slice to the next.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import inf

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import named, table, with_made, without

SPACE = "▁"
#: What an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker remembers.
REMEMBERED = 300_000
#: Characters of a text that are held as words at once.
PIECE = 1 << 20
#: Characters of a word that are looked at at once.
SLICE = 1 << 14
COLUMNS = ("n_tokens", "n_unknown", "score")

#: Pieces hold the space mark at their start only, so a text falls apart before each run of marks.
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Where a run of spaces begins.
_GAP = re.compile(f"(?<![ {SPACE}])[ {SPACE}]")


@dataclass
class Vocabulary:
    """Pieces with scores, and whether characters without a piece fall back to one token for each UTF-8 byte."""

    scores: dict[str, float]
    byte_fallback: bool = True
    automaton: ahocorasick.Automaton = field(init=False, repr=False)
    single: frozenset[str] = field(init=False, repr=False)
    unknown: float = field(init=False)
    longest: int = field(init=False)
    seen: dict[str, tuple[float, int, int]] = field(default_factory=dict, init=False, repr=False)

    def __post_init__(self) -> None:
        inner = [p for p in self.scores if SPACE in p.lstrip(SPACE)]
        if inner:
            raise ValueError(f"the space mark stands inside {inner[0]!r}; words can't be counted one by one")
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if self.scores:
            self.automaton.make_automaton()
        self.single = frozenset(p for p in self.scores if len(p) == 1)
        self.longest = max(map(len, self.scores), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY

    def best(self, word: str) -> tuple[float, int, int]:
        """Score, number of tokens and of unknown characters of the best segmentation of a word."""
        found = self.seen.get(word)
        if found is not None:
            return found
        found = self._known(word) if len(word) <= SLICE and self.single.issuperset(word) else self._any(word)
        if len(word) <= 64:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = found
        return found

    def _known(self, word: str) -> tuple[float, int, int]:
        """For a word whose characters are all pieces, so that none can stand as unknown."""
        score, count = [0.0] + [-inf] * len(word), [0] * (len(word) + 1)
        for end, (length, value) in self.automaton.iter(word):  # by end, the piece that starts first comes first
            at = end + 1 - length
            total = score[at] + value
            if total > score[end + 1]:
                score[end + 1], count[end + 1] = total, count[at] + 1
        return score[-1], count[-1], 0

    def _any(self, word: str) -> tuple[float, int, int]:
        """For any word, in slices; lists hold a slice and what a piece can reach back to, by distance from ``base``."""
        reach, base = self.longest, 0
        score, count, strange, odd = [0.0], [0], [0], [False]
        for start in range(0, len(word), SLICE):
            part = word[max(0, start - reach + 1) : start + SLICE]
            first = start - max(0, start - reach + 1)  # characters of the part that came before
            ends: list[list[tuple[int, float]]] = [[] for _ in part]
            if self.scores:
                for end, piece in self.automaton.iter(part):
                    ends[end].append(piece)
            for k in range(first, len(part)):
                at, top, before = start + k - first + 1 - base, -inf, 0
                for length, value in ends[k]:
                    total = score[at - length] + value
                    if total > top:
                        top, before = total, at - length
                char = part[k]
                if char not in self.single and score[at - 1] + self.unknown > top:
                    # no piece is this character alone: it may stand as unknown, after all pieces that start before it
                    score.append(score[at - 1] + self.unknown)
                    fused = not self.byte_fallback and odd[at - 1]
                    count.append(count[at - 1] + (len(char.encode("utf-8", "replace")) if self.byte_fallback else 0 if fused else 1))
                    strange.append(strange[at - 1] + 1)
                    odd.append(True)
                else:
                    score.append(top)
                    count.append(count[before] + 1)
                    strange.append(strange[before])
                    odd.append(False)
            base += max(0, len(score) - reach - 1)
            for values in (score, count, strange, odd):
                del values[: max(0, len(values) - reach - 1)]
        return score[-1], count[-1], strange[-1]

    def count(self, text: str | None) -> tuple[int, int, float]:
        """Tokens, unknown characters and score of a whole text. Nothing comes before an empty text."""
        if not text:
            return 0, 0, 0.0
        tokens, strange, score, start, best = 0, 0, 0.0, 0, self.best
        while start < len(text):
            # a piece of text ends before a run of spaces, so no word is cut
            gap = _GAP.search(text, start + PIECE)
            cut = gap.start() if gap else len(text)
            part = (SPACE if not start else "") + text[start:cut].replace(" ", SPACE)
            for word in _WORDS.findall(part):
                s, n, u = best(word)
                tokens, strange, score = tokens + n, strange + u, score + s
            start = cut
        return tokens, strange, score


def load_vocabulary(path: str) -> Vocabulary:
    """The normal pieces of a SentencePiece model file with the scores that it gives them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in ids]
    scores = {model.id_to_piece(i): model.get_score(i) for i in ids if not special[i]}
    return Vocabulary(scores, byte_fallback=any(model.is_byte(i) for i in ids))


def default_path() -> str:
    """The installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_unknown`` and ``score`` of each whole text.

    Null and empty texts have no tokens and score 0. Repeated rows count alike, an empty table stays empty. A text of any
    length is counted whole, in memory that its longest word adds nothing to but its characters. Input columns with one
    of the three names are replaced, all others may have any name.
    """
    base = without(docs, *COLUMNS)
    kept = [c for c in base.columns if keep is None or c in keep]
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.scores, vocabulary.byte_fallback))
    new = dict(zip(COLUMNS, (T.LongType(), T.LongType(), T.DoubleType()), strict=True))

    def make():
        vocabulary = Vocabulary(*shared.value)

        def count(texts: pa.Array) -> list:
            found = [vocabulary.count(t.as_py()) for t in texts]
            return list(zip(*found, strict=True)) if found else [(), (), ()]

        return count

    return with_made(base, kept, [named(text)], new, make)


def op10_tokens(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document under the pieces and scores of the public 32k vocabulary, read as a unigram model."""
    return count_tokens(table(spark, sf_dir, "documents"), load_vocabulary(default_path()), keep=["doc_id"])
