"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists the vocabulary pieces that end at each place of a text; a Viterbi pass
keeps, per place, the best sum of scores and the number of pieces on that path. The rules are those of
the public unigram tokenizers: of paths with equal scores the one with the longer last piece wins
(pieces are tried by ascending start, and only a strictly better one replaces); a character that is
no piece by itself may be unknown, at the lowest score less 10; an unknown run is spelled in bytes
if the vocabulary has all bytes, else it is one token. White space is marked by U+2581, with one in
front of the text.

Pieces hold the mark only at their start, so no piece spans a word boundary, and none spans a
character that occurs in no piece. With whole-number scores sums are exact, so the best path of a text
is that of its words, and frequent words are looked up. Other vocabularies run over the whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.names import quoted, unused
from tradewind.llm.worker import remembered, travels_with_tasks

travels_with_tasks(__name__)

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words remembered per Python worker, twice over.
CACHE_WORDS = 300_000
#: Longest word that is remembered.
CACHE_LENGTH = 64
#: Longest word whose path is kept place by place.
LONG_WORD = 4096


@dataclass
class Vocabulary:
    """Pieces with their scores; ``bytes`` tells whether unknown characters are spelled in bytes."""

    scores: dict[str, float]
    lowest: float
    bytes: bool
    longest: int = 0
    seen: dict[str, tuple[float, int]] = field(default_factory=dict)
    older: dict[str, tuple[float, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if self.scores:
            self.automaton.make_automaton()
        self.longest = max(map(len, self.scores), default=1)
        covered = set().union(*self.scores) - {MARK}
        whole = all(float(s).is_integer() for s in (*self.scores.values(), self.lowest))
        apart = not any(MARK in piece.lstrip(MARK) for piece in self.scores)
        inside = "".join(map(re.escape, sorted(covered))) if covered else "^\\s\\S"
        # Without byte spelling a run of unknown characters is one token, so it must stay together.
        self.words = (
            re.compile(f"{MARK}*[{inside}]+|{MARK}+|(?s:.)") if whole and apart and self.bytes else None
        )

    def best(self, word: str) -> tuple[float, int]:
        """Score and number of pieces of the best path."""
        if len(word) > LONG_WORD or not self.bytes or not self.scores:
            return self._best(word)
        unknown = self.lowest - UNKNOWN_PENALTY
        score, count = [0.0] * (len(word) + 1), [0] * (len(word) + 1)
        place, single = 0, True
        for end, (length, value) in self.automaton.iter(word):
            end += 1
            if end != place:
                # Places without a match, and the last one if its character is no piece by itself.
                for at in range(place if not single else place + 1, end):
                    self._unknown(word, at, unknown, score, count, at == place)
                place, single = end, False
                score[end] = score[end - length] + value
                count[end] = count[end - length] + 1
            elif score[end - length] + value > score[end]:
                score[end] = score[end - length] + value
                count[end] = count[end - length] + 1
            if length == 1:
                single = True
        for at in range(place if not single else place + 1, len(word) + 1):
            self._unknown(word, at, unknown, score, count, at == place)
        return score[-1], count[-1]

    @staticmethod
    def _unknown(word, at, unknown, score, count, reached) -> None:
        """The path through an unknown character before this place, if it is the better one."""
        total = score[at - 1] + unknown
        if not reached or total > score[at]:
            score[at] = total
            count[at] = count[at - 1] + len(word[at - 1].encode("utf-8", "surrogatepass"))

    def _best(self, word: str) -> tuple[float, int]:
        """The same in memory that follows the longest piece, for words of any length."""
        ending: dict[int, list] = {}
        if self.scores:
            for end, piece in self.automaton.iter(word):
                ending.setdefault(end, []).append(piece)
        ring = min(self.longest, len(word)) + 1
        score, count, loose = [0.0] * ring, [0] * ring, [False] * ring
        unknown = self.lowest - UNKNOWN_PENALTY
        for end, char in enumerate(word):
            top, pieces, single = None, 0, False
            # The automaton lists the longest piece first, that is, by ascending start.
            for length, value in ending.pop(end, ()):
                at = (end + 1 - length) % ring
                single |= length == 1
                if top is None or score[at] + value > top:
                    top, pieces, unk = score[at] + value, count[at] + 1, False
            at = end % ring
            if not single and (top is None or score[at] + unknown > top):
                top, unk = score[at] + unknown, True
                if self.bytes:
                    pieces = count[at] + len(char.encode("utf-8", "surrogatepass"))
                else:
                    pieces = count[at] + (not loose[at])
            at = (end + 1) % ring
            score[at], count[at], loose[at] = top, pieces, unk
        return score[len(word) % ring], count[len(word) % ring]

    def count(self, text: str | None) -> tuple[float, int]:
        """Best score and number of pieces of a whole text; nothing for an empty one."""
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if self.words is None:
            return self.best(marked)
        seen, score, pieces = self.seen, 0.0, 0
        for word in self.words.findall(marked):
            found = seen.get(word)
            if found is None:
                found = self.older.get(word) or self.best(word)
                if len(word) <= CACHE_LENGTH:
                    if len(seen) >= CACHE_WORDS:
                        # The words of this round are kept for another one.
                        self.older, self.seen = seen, {}
                        seen = self.seen
                    seen[word] = found
            score += found[0]
            pieces += found[1]
        return score, pieces


def load(path: str) -> Vocabulary:
    """The pieces and published scores of a piece model; loaded once per Python worker."""
    return remembered(("pieces", path), lambda: _read(path))


def _read(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in ids]
    scores = {model.id_to_piece(i): model.get_score(i) for i in ids if not special[i]}
    lowest = min(model.get_score(i) for i in ids)
    return Vocabulary(scores, lowest, sum(map(model.is_byte, ids)) == 256)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def counted(text: Column, path: str | None = None) -> Column:
    """Struct of ``score`` and ``n_tokens``; null and empty texts have none."""

    @F.pandas_udf("score double, n_tokens long")
    def of(texts: pd.Series) -> pd.DataFrame:
        vocabulary = load(path or default_path())
        found = [vocabulary.count(t) for t in texts]
        return pd.DataFrame(found, columns=["score", "n_tokens"]).astype({"score": float, "n_tokens": "int64"})

    return of(text)


def token_counts(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` and the ``score`` of the best path, replacing columns of these names."""
    found = unused(docs, "found")
    kept = docs.drop("score", "n_tokens")
    return docs.withColumn(found, counted(F.col(text), path)).select(
        *quoted(kept.columns), f"{found}.n_tokens", f"{found}.score"
    )
