"""Token counts without tokens: the best segmentation of a text under a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic
programming keeps, for every end, the best score, where its last piece starts and how many
tokens that path has.  Ties follow the tokenizer's rule: a path is replaced only by a
strictly better one, and starts are visited from left to right, so the longest last piece
wins.  A character that no single-character piece covers may be an unknown piece (scored
ten below the worst piece); it counts as many tokens as it has bytes (byte fallback).

Sums are rounded as the library rounds them: the score of an end is a single precision number,
a candidate is compared before it is rounded (an unknown piece after).  So how a word is cut
depends on the score before it: in long texts small differences disappear.

As long as no piece holds the word mark behind another character, a best path never crosses
the beginning of a word, so every distinct word is solved once and remembered, for each way in
which its sums can be rounded: that depends on the power of two below the score before it and on
the last bit of that score, and only on these while the power stays the same.  Words of exact
sums (whole scores below 2**24) are remembered once, and so are words whose best path leads by
more than rounding can change.  The memory is emptied when full, which changes no result.  No
shuffle takes place.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tablewright.llm.common import field, narrowed, text_blocks, texts_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0


#: Least score of a vocabulary piece.  The file marks 15 runs of word marks by -1e9, which is no
#: unigram score: in single precision such a number leaves no room for the others.
LEAST_SCORE = -40_000.0


def pieces_of(model_file: str, least: float = LEAST_SCORE) -> dict[str, float]:
    """Piece -> score (``least`` at least) of the normal pieces of a sentencepiece model."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {
        model.id_to_piece(i): max(model.get_score(i), least)
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                or model.is_unused(i))
    }


#: Whole numbers up to this size are exact in single precision.
EXACT = 1 << 24


class Segmenter:
    """Best score and token count of words and texts."""

    def __init__(self, pieces: dict[str, float], remembered: int = 400_000):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self._single = array("f", [0.0])
        self.unknown = self.rounded(min(pieces.values()) - UNKNOWN_PENALTY)
        self.single = {p for p in pieces if len(p) == 1}
        self.by_word = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.whole = all(score == int(score) and score <= 0 for score in pieces.values())
        self.remembered = remembered
        self.exact: dict[str, tuple] = {}
        self.states: dict[tuple, tuple] = {}

    def rounded(self, value: float) -> float:
        """To single precision."""
        self._single[0] = value
        return self._single[0]

    def solve(self, text: str, before: float = 0.0) -> tuple[int, float, float, float]:
        """Tokens of one marked text and its score, added to the score ``before`` it; the
        least and the greatest score on the way."""
        best: list[float] = [before] + [0.0] * len(text)
        count = [0] * (len(text) + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in text]
        for end, match in self.automaton.iter(text):
            ends[end].append(match)
        rounded = self.rounded
        for end, char in enumerate(text):
            found, tokens = None, 0
            for length, score in sorted(ends[end], reverse=True):  # smallest start first
                start = end + 1 - length
                candidate = best[start] + score
                if found is None or candidate > found:
                    found, tokens = rounded(candidate), count[start] + 1
            if char not in self.single:
                candidate = rounded(best[end] + self.unknown)
                if found is None or candidate > found:
                    found = candidate
                    tokens = count[end] + len(char.encode())
            best[end + 1], count[end + 1] = found, tokens
        return count[-1], best[-1], min(best), max(best)

    def words(self, text: str) -> list[str]:
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return [marked]
        if MARK * 2 in marked:
            return re.findall(f"{MARK}+[^{MARK}]*", marked)
        return [MARK + w for w in marked.split(MARK)[1:]]

    def path(self, word: str) -> tuple[int, float, list[float], float]:
        """Tokens and exact score of a word, the scores along its best path, and how large sums
        may get before rounding could put the second best path first."""
        lost, single, unknown = -math.inf, self.single, self.unknown
        best, second = [0.0], [lost]
        last: list[tuple[int, float]] = []
        matches = self.automaton.iter(word)
        end, match = next(matches, (-1, None))
        for here, char in enumerate(word):
            high = low = lost
            edge = match
            while end == here:  # longest piece, so smallest start, first
                length, score = match
                start = here + 1 - length
                value = best[start] + score
                if value > high:
                    if high > low:
                        low = high
                    other = second[start] + score
                    if other > low:
                        low = other
                    high, edge = value, match
                elif value > low:
                    low = value
                end, match = next(matches, (-1, None))
            if char not in single:
                value = best[here] + unknown
                if value > high:
                    low = max(low, high, second[here] + unknown)
                    high, edge = value, (0, unknown)
                elif value > low:
                    low = value
            best.append(high)
            second.append(low)
            last.append(edge)
        scores, tokens, at = [], 0, len(word)
        while at:
            length, score = last[at - 1]
            scores.append(score)
            if length:
                tokens, at = tokens + 1, at - length
            else:  # an unknown character
                at -= 1
                tokens += len(word[at].encode())
        # every sum is off by half a unit of its last bit at most, a power of two below the size
        # of the sums times 2 ** -23; a path that leads by more than all of them stays best
        margin = (best[-1] - second[-1]) / (2 * (len(word) + 1) * 2.0 ** -23)
        return tokens, best[-1], scores[::-1], margin

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        words = self.words(text)
        if len(self.exact) + len(self.states) > self.remembered:
            self.exact.clear()
            self.states.clear()
        exact = self.exact
        for word in set(words).difference(exact):
            exact[word] = self.path(word)
        if self.whole:
            total = sum([exact[word][1] for word in words])
            if total > -EXACT:
                return sum([exact[word][0] for word in words]), total
        tokens, score, states = 0, 0.0, self.states
        single = self._single
        for word in words:
            more, added, scores, margin = exact[word]
            if self.whole and score + added > -EXACT:
                tokens, score = tokens + more, score + added
                continue
            if margin > abs(score) + abs(added) + 1:
                for piece in scores:
                    single[0] = score + piece
                    score = single[0]
                tokens += more
                continue
            mantissa, power = math.frexp(score)
            state = word, power, int(mantissa * EXACT) & 1
            known = states.get(state)
            # the power of two must not change within the word
            if known and math.frexp(score + known[2])[1] == power == math.frexp(score + known[3])[1]:
                tokens, score = tokens + known[0], score + known[1]
                continue
            more, after, least, most = self.solve(word, score)
            if score and math.frexp(least)[1] == power == math.frexp(most)[1]:
                states[state] = more, after - score, least - score, most - score
            tokens, score = tokens + more, after
        return tokens, score


def token_counts(
    df: DataFrame, model_file: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_tokens long, best_score double)`` of every row.

    ``model_file``: a sentencepiece model readable on every executor; its pieces and their
    scores are the vocabulary.  Null and empty texts have 0 tokens and score 0; repeated
    rows and null keys stay rows of their own; an empty table gives an empty table.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(pieces_of(model_file))
        for block in text_blocks(batches):
            found = [segmenter.count(t) for t in texts_of(block)]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())],
                names=[key, "n_tokens", "best_score"],
            )

    rows = narrowed(df, key=key, text=text)
    schema = ", ".join([field(key, rows.schema["key"].dataType),
                        "n_tokens long", "best_score double"])
    return rows.mapInArrow(count, schema)
