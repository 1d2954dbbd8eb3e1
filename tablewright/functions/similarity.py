"""String similarity: the one function Spark has no built-in for.

``indel_score`` is the share of characters two strings have in common in order
(twice the longest common subsequence over the summed lengths), as an integer
percentage.  It runs on Arrow batches and is always placed behind native filters that
cannot reject a qualifying pair.

A batch is computed as a whole: the rows of the dynamic programme are bits, 64 to a word
(Hyyrö 2004), and one step takes the next character of every text of the batch at once.
Common beginnings and ends are cut off before; with a least score, pairs that cannot reach
it any more leave the batch on the way.  Long texts are computed one pair after the other, a row
being one whole number: a carry through many words is one addition there, and many passes over
the batch here.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tablewright.functions.text import BLANK

# Executors need not have this package installed: its few lines travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a batch and of its match table at most (8 bytes each), and characters of its texts.
_BATCH_WORDS, _TABLE_WORDS, _BATCH_CHARACTERS = 1 << 17, 1 << 23, 1 << 23
#: Characters between two looks at who can still reach the least score.
_STRIDE = 64
#: Characters of the shorter text from which a pair is computed by itself.
_LONG = 256
#: Characters of a text that is compared beginning by beginning, at most.
_LONGEST_LEVEL = 128


class _Pairs:
    """Pairs of texts as ranges of one array of code points, the shorter text first."""

    def __init__(self, left: Sequence[str], right: Sequence[str]) -> None:
        texts = [*left, *right]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.codes = np.frombuffer(
            "".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        n = len(left)
        swap = lengths[:n] > lengths[n:]
        self.size = np.where(swap, lengths[n:], lengths[:n])
        self.other_size = np.where(swap, lengths[:n], lengths[n:])
        self.begin = np.where(swap, begins[n:], begins[:n])
        self.other_begin = np.where(swap, begins[:n], begins[n:])
        self.total = self.size + self.other_size

    def trim(self) -> np.ndarray:
        """Cuts off common beginnings, then common ends; their lengths."""
        ahead = self._run(self.begin, self.other_begin, 1)
        self.begin, self.other_begin = self.begin + ahead, self.other_begin + ahead
        self.size, self.other_size = self.size - ahead, self.other_size - ahead
        back = self._run(self.begin + self.size - 1, self.other_begin + self.other_size - 1, -1)
        self.size, self.other_size = self.size - back, self.other_size - back
        return ahead + back

    def _run(self, here: np.ndarray, there: np.ndarray, step: int) -> np.ndarray:
        run = np.zeros(len(here), np.int64)
        rows = np.flatnonzero(self.size)
        window = np.arange(_STRIDE)
        while len(rows):
            at = run[rows, None] + window
            inside = at < self.size[rows, None]
            at = np.where(inside, at, 0) * step
            same = inside & (self.codes[here[rows, None] + at] == self.codes[there[rows, None] + at])
            equal = np.where(same.all(1), _STRIDE, same.argmin(1))
            run[rows] += equal
            rows = rows[equal == _STRIDE]
        return run

    def characters(self, rows: np.ndarray, other: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row (its number in ``rows``), place and code of every character."""
        sizes = (self.other_size if other else self.size)[rows]
        row = np.repeat(np.arange(len(rows)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        begins = (self.other_begin if other else self.begin)[rows]
        return row, place, self.codes[begins[row] + place]


def _batches(pairs: _Pairs, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of similar length together, in batches of bounded memory."""
    rows = rows[np.lexsort((pairs.other_size[rows], pairs.size[rows]))]
    words = (pairs.size[rows] + 63) // 64
    longest = np.maximum.accumulate(pairs.other_size[rows])
    start = 0
    for i in range(1, len(rows) + 1):
        held = i + 1 - start
        if i == len(rows) or held * words[i] > _BATCH_WORDS or held * longest[i] > _BATCH_CHARACTERS:
            yield rows[start:i]
            start = i


def _needed(total: np.ndarray, least: int) -> np.ndarray:
    """Characters in common below which the score is certainly less than ``least``."""
    return np.ceil(least * total / 200 - 1e-6)


def common_subsequences(left: Sequence[str], right: Sequence[str], least: int = 0) -> np.ndarray:
    """Lengths of the longest common subsequences; -1 where the score is below ``least``
    for certain."""
    pairs = _Pairs(left, right)
    needed = _needed(pairs.total, least)
    common = np.where(pairs.size < needed, -1, 0)
    pairs.size = np.where(common < 0, 0, pairs.size)
    trimmed = pairs.trim()
    common = np.where(common < 0, -1, trimmed)
    for row in np.flatnonzero(pairs.size >= _LONG).tolist():
        begin, size = pairs.begin[row], pairs.size[row]
        other, other_size = pairs.other_begin[row], pairs.other_size[row]
        found = _common_of_long(pairs.codes[begin:begin + size], pairs.codes[other:other + other_size],
                                int(needed[row] - trimmed[row]))
        common[row] = -1 if found < 0 else trimmed[row] + found
    stack = list(_batches(pairs, np.flatnonzero((pairs.size > 0) & (pairs.size < _LONG))))
    while stack:
        rows = stack.pop()
        row, place, code = pairs.characters(rows, other=False)
        names, symbol = np.unique(row << 21 | code, return_inverse=True)
        words = int((pairs.size[rows].max() + 63) // 64)
        if len(names) * words > _TABLE_WORDS and len(rows) > 1:
            stack += [rows[:len(rows) // 2], rows[len(rows) // 2:]]
            continue
        order = np.argsort(-pairs.other_size[rows], kind="stable")
        other_row, other_place, other_code = pairs.characters(rows, other=True)
        other_name = other_row << 21 | other_code
        other_symbol = np.searchsorted(names, other_name)
        known = names[np.minimum(other_symbol, len(names) - 1)] == other_name
        other_symbol = np.where(known, other_symbol, len(names))
        if least:  # characters that both have, counted with repetition
            shared = np.minimum(np.bincount(symbol, minlength=len(names)),
                                np.bincount(other_symbol, minlength=len(names) + 1)[:-1])
            most = trimmed[rows] + np.bincount(names >> 21, shared, len(rows))
            hopeless = most < needed[rows]
            common[rows[hopeless]] = -1
            order = order[~hopeless[order]]
        matches = np.zeros((len(names) + 1, words), np.uint64)
        np.bitwise_or.at(matches, (symbol, place >> 6),
                         np.left_shift(np.uint64(1), (place & 63).astype(np.uint64)))
        texts = np.full((int(pairs.other_size[rows].max()), len(rows)), len(names), np.int64)
        texts[other_place, other_row] = other_symbol
        found = _advance(matches, texts[:, order], pairs.other_size[rows[order]],
                         needed[rows[order]] - trimmed[rows[order]])
        common[rows[order]] = np.where(found < 0, -1, trimmed[rows[order]] + found)
    return common


def _common_of_long(pattern: np.ndarray, text: np.ndarray, needed: int) -> int:
    """Common subsequence of two texts (code points), -1 when ``needed`` is out of reach."""
    symbols, pattern = np.unique(pattern, return_inverse=True)
    size, known = len(pattern), np.minimum(np.searchsorted(symbols, text), len(symbols) - 1)
    # characters that both have, counted with repetition
    known = np.where(symbols[known] == text, known, len(symbols))
    held = np.bincount(pattern, minlength=len(symbols))
    if np.minimum(held, np.bincount(known, minlength=len(symbols) + 1)[:-1]).sum() < needed:
        return -1
    matches = [
        int.from_bytes(np.packbits(pattern == i, bitorder="little").tobytes(), "little")
        for i in range(len(symbols))
    ] + [0]
    full = state = (1 << size) - 1
    for start in range(0, len(known), _STRIDE):
        if size - state.bit_count() + len(known) - start < needed:
            return -1
        for symbol in known[start:start + _STRIDE].tolist():
            shared = state & matches[symbol]
            state = (state + shared | state - shared) & full
    return size - state.bit_count()


def _advance(matches: np.ndarray, texts: np.ndarray, sizes: np.ndarray,
             needed: np.ndarray) -> np.ndarray:
    """Common subsequences of patterns (their places by symbol) and texts (symbols by place,
    a column for each pair, longest first)."""
    found = np.full(len(sizes), -1, np.int64)
    alive = np.arange(len(sizes))
    state = np.full((len(sizes), matches.shape[1]), ~np.uint64(0))
    for place in range(len(texts)):
        active = int(np.searchsorted(-sizes, -place))
        if place % _STRIDE == 0 and place:
            reached = (np.bitwise_count(~state).sum(1, dtype=np.int64)
                       + np.maximum(sizes - place, 0))
            kept = np.flatnonzero(reached >= needed)
            if len(kept) < len(alive):
                alive, state, sizes, needed = alive[kept], state[kept], sizes[kept], needed[kept]
                texts = texts[:, kept]
                active = int(np.searchsorted(-sizes, -place))
        if not active:
            break
        mask = matches[texts[place, :active]]
        row = state[:active]
        shared = row & mask
        total = row + shared
        carry = total < shared
        while carry.shape[1] > 1 and carry[:, :-1].any():
            ahead = np.zeros_like(total)
            ahead[:, 1:] = carry[:, :-1]
            total += ahead
            carry = total < ahead
        state[:active] = total | (row & ~mask)
    found[alive] = np.bitwise_count(~state).sum(1, dtype=np.int64)
    return found


def indel_percents(left: Sequence[str], right: Sequence[str], least: int = 0) -> np.ndarray:
    """Scores 0-100; -1 for scores below ``least``."""
    total = np.fromiter(map(len, left), np.int64, len(left)) + np.fromiter(
        map(len, right), np.int64, len(right))
    common = common_subsequences(left, right, least)
    score = _percent(common, total)
    return np.where((common < 0) | (score < least), -1, score)


def _percent(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    score = ((1.0 - (total - 2 * common) / np.maximum(total, 1)) * 100).astype(np.int64)
    return np.where(total == 0, 100, score)


class Beginnings:
    """Texts to be compared with one other text after the other.

    They are sorted, and what a beginning of several of them has in common with the other text
    is computed once: a level holds the different beginnings of one length, and its row of the
    recurrence follows from that of the level before.
    """

    def __init__(self, texts: Sequence[str], least: int = 0) -> None:
        self.texts, self.least = texts, least
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.long = np.flatnonzero(self.lengths > _LONGEST_LEVEL)
        order = sorted(np.flatnonzero(self.lengths <= _LONGEST_LEVEL).tolist(), key=texts.__getitem__)
        lengths = self.lengths[order]
        codes = np.frombuffer("".join(texts[i] for i in order).encode(
            "utf-32-le", "surrogatepass"), np.uint32)
        self.symbols, codes = np.unique(codes, return_inverse=True)
        row = np.repeat(np.arange(len(order)), lengths)
        place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        levels = int(lengths.max(initial=0))
        table = np.full((len(order), levels + 1), -1, np.int64)  # the last column is for no text
        table[row, place] = codes
        shared = np.full(len(order), -1, np.int64)  # with the text before
        differ = table[1:] != table[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), levels)
        starts = np.zeros(min(len(order), 1), np.int64)  # the first row of each beginning
        self.levels = []  # per level: beginnings one shorter, last symbols, texts that end, their beginnings
        order = np.asarray(order, np.int64)
        for length in range(levels + 1):
            rows = starts if not length else np.flatnonzero((shared < length) & (lengths >= length))
            before = np.searchsorted(starts, rows, "right") - 1
            ended = np.flatnonzero(lengths == length)
            self.levels.append((before, table[rows, length - 1], order[ended],
                                np.searchsorted(rows, ended, "right") - 1))
            starts = rows

    def percents(self, text: str) -> np.ndarray:
        """Scores 0-100 of the text with each text; -1 for scores below ``least``."""
        if len(text) > 64:
            return indel_percents([text] * len(self.texts), self.texts, self.least)
        matches = np.zeros(len(self.symbols) + 1, np.uint64)
        known = {symbol: i for i, symbol in enumerate(self.symbols.tolist())}
        for i, character in enumerate(text):
            matches[known.get(ord(character), -1)] |= np.uint64(1 << i)
        matches[-1] = 0
        total = self.lengths + len(text)
        common = np.zeros(len(total), np.int64)
        state = np.full(1, ~np.uint64(0))
        for length, (before, symbol, ended, at) in enumerate(self.levels):
            if length:
                row = state[before]
                shared = row & matches[symbol]
                state = (row + shared) | (row - shared)
            if len(ended):
                common[ended] = np.bitwise_count(~state)[at]
        score = _percent(common, total)
        score[score < self.least] = -1
        if len(self.long):
            score[self.long] = indel_percents(
                [text] * len(self.long), [self.texts[i] for i in self.long], self.least)
        return score


@functools.cache
def _scorer(least: int):
    @F.pandas_udf(IntegerType())
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        both = (left.notna() & right.notna()).to_numpy()
        found = pd.Series(pd.array([None] * len(left), "Int32"))
        if both.any():
            found[both] = indel_percents(left[both].tolist(), right[both].tolist(), least)
        return found

    # Declared nondeterministic only so that a filter on the score is not pushed below the
    # projection, which would run the function twice.
    return score.asNondeterministic()


def indel_score(left: Column, right: Column, least: int = 0) -> Column:
    """Similarity 0-100 of two strings; null when one is null, -1 when below ``least``.
    Equal strings, the most frequent case among copies, are settled without Python."""
    score = _scorer(least)(F.when(left != right, left), F.when(left != right, right))
    return F.when(left == right, F.lit(100)).otherwise(score)


def sorted_tokens(column: Column) -> Column:
    """Blank-separated tokens in sorted order.  Computed once per row, so that the
    order-free similarity of two rows is ``indel_score`` of their sorted tokens."""
    tokens = F.filter(F.split(column, rf"(?U){BLANK}+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")


def length_allows(left: Column, right: Column, percent: int) -> Column:
    """Native filter implied by ``indel_score >= percent``: the shorter string bounds
    the common part, so ``200 * shorter >= percent * (both lengths)``."""
    a, b = F.length(left), F.length(right)
    return 200 * F.least(a, b) >= percent * (a + b)
