"""Best-fit packing with swap-based local search.

Documents are cut into pieces of at most ``capacity`` tokens (the first piece takes the
rest, so only it can be shorter).  Pieces of one length are interchangeable, so bins are
planned on the histogram of lengths - at most ``capacity`` numbers, whatever the corpus
holds - as patterns (lists of lengths) with the number of bins each is used for:

1. best fit, longest pieces first;
2. local search between underfull bins: pieces move, or are exchanged one for one, two for
   one or one for two, whenever that makes the fuller bin fuller (so the sum of squared fills
   rises), until a bin is empty; repeated from the emptiest bin on until nothing improves or
   the bins are as few as the number of tokens allows.

Every piece then finds its bin from its rank within its length.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm.byte_bpe import read_ranks
from tablewright.llm.common import field, narrowed, partitions, text_blocks, texts_of
from tablewright.shared import written

Pattern = tuple[int, ...]


# --- tokens -----------------------------------------------------------------------------

class Encoder:
    """Ids of texts by a tokenizer file; texts of common characters without runs of white
    space by the faster library, if the same vocabulary is given as ranks."""

    def __init__(self, tokenizer_file: str, ranks_file: str | None, pattern: str | None):
        self.file, self.exact, self.fast = tokenizer_file, None, None
        with open(tokenizer_file, encoding="utf-8") as file:
            special = [token["content"] for token in json.load(file).get("added_tokens", [])]
        #: only the exact library knows these
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        if ranks_file is not None:
            # Without two white spaces in a row, the pattern's look-ahead never matters.
            plain = pattern.replace(r"\s+(?!\S)|", "")
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=plain, mergeable_ranks=read_ranks(ranks_file), special_tokens={})

    def slow(self, text: str) -> list[int]:
        if self.exact is None:
            self.exact = Tokenizer.from_file(self.file)
        return self.exact.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if self.fast and _PLAIN.fullmatch(text) and not (
                _RUN.search(text) or self.special.search(text)):
            return self.fast.encode_ordinary(text)
        return self.slow(text)


#: Texts of these characters are split alike by either library, whatever Unicode version it knows.
_PLAIN = re.compile(r"[\n -~\xa1-ɏΑ-ΡΣ-ϿА-я]*")
_RUN = re.compile(r"\s\s")


def piece_rows(
    df: DataFrame, tokenizer_file: str, end_id: int, capacity: int, key: str, text: str,
    ranks_file: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32)``: the pieces of every text.

    ``ranks_file`` and ``pattern`` may name the same vocabulary as ranks; texts of common
    characters without runs of white space are then encoded by the faster library."""
    rows = narrowed(df, key=key, text=text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_file, ranks_file, pattern)
        for block in text_blocks(batches):
            owner, piece, start, length, crc = [], [], [], [], []
            for row, value in enumerate(texts_of(block)):
                ids = encode(value)
                ids.append(end_id)
                packed = np.array(ids, "<u4").tobytes()
                begin, number = 0, 0
                end = len(ids) % capacity or capacity
                while begin < len(ids):
                    owner.append(row)
                    piece.append(number)
                    start.append(begin)
                    length.append(end - begin)
                    crc.append(zlib.crc32(packed[4 * begin:4 * end]))
                    begin, end, number = end, end + capacity, number + 1
            yield pa.RecordBatch.from_arrays(
                [block.column("key").take(pa.array(owner, pa.int64())),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[key, "piece", "start", "length", "ids_crc32"])

    schema = ", ".join([field(key, rows.schema["key"].dataType),
                        "piece int, start long, length long, ids_crc32 long"])
    return rows.mapInArrow(cut, schema)


# --- plan -------------------------------------------------------------------------------

def best_fit(histogram: dict[int, int], capacity: int) -> Counter[Pattern]:
    """Best fit decreasing on counts: pattern -> number of bins."""
    full: Counter[Pattern] = Counter()
    open_: dict[int, Counter[Pattern]] = {}  # by room left
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        for room in sorted(r for r in open_ if r >= size):
            # bins with this room, and those it leaves behind that still have room
            while left and room >= size and open_.get(room):
                bins = open_.pop(room)
                for pattern in list(bins):
                    used = min(left, bins[pattern])
                    if used:
                        left -= used
                        bins[pattern] -= used
                        if not bins[pattern]:
                            del bins[pattern]
                        target = full if room == size else open_.setdefault(
                            room - size, Counter())
                        target[(*pattern, size)] += used
                if bins:
                    open_.setdefault(room, Counter()).update(bins)
                room -= size
        each = capacity // size
        for count, bins in ((each, left // each), (left % each, 1 if left % each else 0)):
            if bins and count:
                room = capacity - count * size
                target = full if not room else open_.setdefault(room, Counter())
                target[(size,) * count] += bins
    for bins in open_.values():
        full.update(bins)
    return full


def _exchange(fuller: Pattern, other: Pattern, room: int) -> tuple[int, Pattern, Pattern]:
    """The largest gain of ``fuller`` by one move or exchange: gain, what it gives, what it
    takes.  Both patterns hold few different lengths, so all choices are tried."""
    best: tuple[int, Pattern, Pattern] = (0, (), ())
    mine, theirs = sorted(set(fuller)), sorted(set(other))

    def pairs(pattern: Pattern) -> list[Pattern]:
        counts = Counter(pattern)
        kinds = sorted(counts)
        return [(a, b) for i, a in enumerate(kinds) for b in kinds[i:]
                if a != b or counts[a] > 1]

    gives: list[Pattern] = [(), *((a,) for a in mine)]
    for take in [(b,) for b in theirs]:
        for give in [*gives, *pairs(fuller)]:
            gain = sum(take) - sum(give)
            if best[0] < gain <= room:
                best = gain, give, take
    for take in pairs(other):
        for give in gives[1:]:
            gain = sum(take) - sum(give)
            if best[0] < gain <= room:
                best = gain, give, take
    return best


def _changed(pattern: Pattern, out: Pattern, into: Pattern) -> Pattern:
    rest = Counter(pattern)
    rest.subtract(out)
    rest.update(into)
    return tuple(sorted(rest.elements(), reverse=True))


class _Sums:
    """What a pattern can give or take, as bit sets of lengths (bit x: a sum of x).

    ``one`` and ``two`` are the sums of one and of two of its pieces; ``for_one`` and
    ``for_two`` the sums that it can take, one or two pieces, to be fuller afterwards."""

    def __init__(self, pattern: Pattern, room: int):
        counts = Counter(pattern)
        self.one = self.two = 0
        for size in counts:
            self.one |= 1 << size
        for size, n in counts.items():
            alone = self.one if n > 1 else self.one & ~(1 << size)
            self.two |= alone << size
        self.for_one = _raised(1 | self.one | self.two, room)
        self.for_two = _raised(self.one, room)


def _raised(sums: int, room: int) -> int:
    """All sums raised by 1 to ``room``."""
    out, width = sums, 1  # raised by 0 to width - 1
    while width < room:
        step = min(width, room - width)
        out |= out << step
        width += step
    return out << 1


def local_search(plan: Counter[Pattern], capacity: int) -> Counter[Pattern]:
    """Empties underfull bins by moves and exchanges that raise the sum of squared fills,
    until none is left or the bins are as few as the number of tokens allows.

    Whether a pattern can become fuller by another depends on these two alone.  Patterns are
    therefore listed whenever they come up (``births``), and a source that failed is compared
    only with those that came up since (``seen``); bit sets tell which pairs can improve."""
    plan = Counter({tuple(sorted(p, reverse=True)): n for p, n in plan.items() if n})
    tokens = sum(sum(p) * n for p, n in plan.items())
    bins, fewest = sum(plan.values()), -(-tokens // capacity)
    under = sorted((sum(p), p) for p in plan if sum(p) < capacity)  # the emptiest first
    births, seen = list(under), dict.fromkeys(under, 0)
    sums = {p: _Sums(p, capacity - fill) for fill, p in under}

    def add(pattern: Pattern, times: int) -> None:
        before = plan[pattern]
        plan[pattern] += times
        entry = sum(pattern), pattern
        if entry[0] == capacity:
            return
        if not plan[pattern]:
            del under[bisect_left(under, entry)]
            del plan[pattern], sums[pattern]
        elif not before:
            insort(under, entry)
            sums[pattern] = _Sums(pattern, capacity - entry[0])
        if plan[pattern] > before < 2:  # new, or no longer alone
            births.append(entry)

    def improvable(source: tuple[int, Pattern]) -> Pattern | None:
        """The target with the most room that ``source`` can make fuller."""
        since = seen.get(source, 0)
        new = births[since:]
        if len(new) < len(under):
            targets = sorted({t for t in new if t >= (source[0],) and plan[t[1]]})
        else:
            targets = under[bisect_left(under, (source[0],)):]
        one, two = sums[source[1]].one, sums[source[1]].two
        for target in targets:
            held = sums[target[1]]
            if (held.for_one & one or held.for_two & two) and (
                    target != source or plan[source[1]] > 1):
                return target[1]
        seen[source] = len(births)
        return None

    while bins > fewest:
        for entry in under:
            if seen.get(entry, 0) < len(births) and (target := improvable(entry)) is not None:
                break
        else:
            break
        source = entry[1]
        _, give, take = _exchange(target, source, capacity - sum(target))
        times = plan[source] // 2 if target == source else min(plan[source], plan[target])
        add(source, -times)
        add(target, -times)
        add(_changed(target, give, take), times)
        rest = _changed(source, take, give)
        if rest:
            add(rest, times)
        else:
            bins -= times
    return +plan


def places(plan: Counter[Pattern]) -> tuple[np.ndarray, ...]:
    """For every length and slot of a pattern the ranks it takes: arrays ``length, first
    rank, first bin, offset`` sorted by length and first rank."""
    rows, taken, first_bin = [], Counter(), 0
    for pattern in sorted(plan, key=lambda p: (-sum(p), p)):
        offset = 0
        for size in pattern:
            rows.append((size, taken[size], first_bin, offset))
            taken[size] += plan[pattern]
            offset += size
        first_bin += plan[pattern]
    rows.sort()
    return tuple(np.array(rows, np.int64).reshape(-1, 4).T)


# --- operator ---------------------------------------------------------------------------

def ranked(df: DataFrame, size: str, spread_by: list[Column]) -> DataFrame:
    """``df`` with ``rank`` (from 0) among the rows of one ``size``.  Each size is counted in
    as many parts as there are shuffle partitions, so no task holds a whole frequent size."""
    n = partitions(df.sparkSession)
    parted = df.withColumn("part", F.pmod(F.xxhash64(*spread_by), F.lit(n)))
    before = Window.partitionBy(size).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = (
        parted.groupBy(size, "part").agg(F.count("*").alias("n"))
        .select(size, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy(size, "part").orderBy(*spread_by)
    return (
        parted.withColumn("rank", F.row_number().over(within) - 1)
        .join(counts, [size, "part"])
        .withColumn("rank", (F.col("rank") + F.col("before")).cast("long"))
        .drop("part", "before")
    )


def pack(
    df: DataFrame, tokenizer_file: str, end_id: int, capacity: int = 1024,
    key: str = "doc_id", text: str = "text",
    ranks_file: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """``(key, piece int, start long, length long, ids_crc32 long, sequence_id long, offset
    long)``: where every piece of every text lies in the packed sequences.

    A text is its ids and ``end_id``; null and empty texts are that one id.  Repeated rows and
    null keys are packed as texts of their own; an empty table gives an empty table.
    """
    pieces = written(
        piece_rows(df, tokenizer_file, end_id, capacity, key, text, ranks_file, pattern),
        "pieces")
    counts = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
              pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    length, rank, first_bin, offset = places(
        local_search(best_fit(counts, capacity), capacity))
    keys = (length << 40) + rank

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = np.asarray(batch.column("rank"))
            wanted = (np.asarray(batch.column("length")) << 40) + ranks
            slot = np.searchsorted(keys, wanted, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (key, "piece", "start", "length", "ids_crc32")),
                 pa.array(first_bin[slot] + ranks - rank[slot]), pa.array(offset[slot])],
                names=[key, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = ranked(pieces, "length", [F.col(f"`{key}`"), F.col("piece"), F.col("ids_crc32")])
    schema = ", ".join([
        field(key, df.schema[key].dataType),
        "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"])
    return numbered.mapInArrow(place, schema)
