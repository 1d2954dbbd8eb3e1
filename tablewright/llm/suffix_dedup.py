"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a string of ``window`` bytes that covers it also starts somewhere else.

1. Anchors: the smallest hashed gram of every window (the leftmost, if equal).  The choice
   follows from the window's bytes alone, so equal windows have the same anchor at the same
   distance, and only about one position in a hundred is looked at.  The windows of one anchor
   follow each other; the bytes that they cover are its context.
2. Anchors whose gram occurs once are done.  If a whole context occurs twice, all its windows
   are repeated.  What remains are the edges of repeated passages: same gram, other context.
3. Their suffixes, from the anchor on, are sorted where the texts are, front-coded (the length
   of the prefix shared with the suffix before, and the rest) and exchanged as runs, dealt by
   gram.  A loser tree merges the runs; it knows how much every suffix shares with the last
   one it gave out and never compares those bytes again.  The sorted suffixes and their common
   prefixes tell which right parts of windows are equal; the left parts are hashed per length.
4. A gram with very many different contexts (``crowd``) would be too much for one task; there
   every window travels by its own hash and is counted.  Both ways find the same windows.

Every step is written as a table; when it is, its shuffle files go, and so do the tables that
only it needed.  So the disk holds one step at a time, not their sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import narrowed, partitions, text_blocks
from tablewright.shared import intermediate, work_folder, written

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], np.uint64)
_PLACE = np.uint64((1 << 28) - 1)
GRAM = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[1]
    x = (x ^ (x >> np.uint64(29))) * _ODD[2]
    return x ^ (x >> np.uint64(32))


def block_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Hashes of all strings of the given sizes (powers of two), each made of the hashes of its
    halves.  Places too near the end keep the hash of a shorter string."""
    value = (data.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    found, size = {}, 1
    for level in range(max(sizes).bit_length() - 1):
        longer = value.copy()
        if len(value) > size:
            longer[:-size] = value[:-size] * _ODD[level + 1] + value[size:]
            longer ^= longer >> np.uint64(33)
        value, size = longer, 2 * size
        if size in sizes:
            found[size] = value
    return found


def _smallest(value: np.ndarray, count: int) -> np.ndarray:
    """Minimum of ``count`` values from every place on (as far as they go)."""
    size = 1
    while 2 * size <= count:
        value = value.copy()
        value[:-size] = np.minimum(value[:-size], value[size:])
        size *= 2
    if count > size:
        value = value.copy()
        value[:size - count] = np.minimum(value[:size - count], value[count - size:])
    return value


def anchors_of(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """For all anchors: row, hash of the gram, hash of the context, place of the gram, first
    and last start of its windows (places within the text)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    empty = tuple(np.zeros(0, kind) for kind in
                  (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if not len(sizes) or sizes.max() < window:
        return empty
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    hashes = block_hashes(data, (GRAM, 128, 256))
    gram = _mixed(hashes[GRAM])
    packed = (gram & ~_PLACE) | np.arange(len(data), dtype=np.uint64)
    nearest = (_smallest(packed, window - GRAM + 1) & _PLACE).astype(np.int64)
    starts = sizes - window + 1
    rows = np.flatnonzero(starts > 0)
    count = starts[rows]
    owner = np.repeat(rows, count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begins[owner]
    at = nearest[place]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    row, at, low, high = owner[first], at[first], place[first], place[last]
    length = high - low + window
    wide = length > 256
    size = np.where(wide, 256, 128)
    left = np.where(wide, hashes[256][low], hashes[128][low])
    right = np.where(wide, hashes[256][low + length - size], hashes[128][low + length - size])
    form = (length * 1024 + (at - low)).astype(np.uint64)
    context = _mixed(left * _ODD[3] + _mixed(right + form * _ODD[4]))
    return row, gram[at], context, at - begins[row], low - begins[row], high - begins[row]


# --- sorted runs ------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, given that the first ``known`` bytes are equal."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most
    while low < high:  # a[:low] == b[:low]
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def front_coded(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared prefix lengths and rests of sorted strings."""
    shared, rests, last = [], [], b""
    for suffix in suffixes:
        n = common_prefix(last, suffix)
        shared.append(n)
        rests.append(suffix[n:])
        last = suffix
    return shared, rests


class _Run:
    """A sorted run that gives back its strings one after the other."""

    def __init__(self, shared: list[int], rests: list[bytes], payload: list):
        self.shared, self.rests, self.payload = shared, rests, payload
        self.at, self.value = -1, b""

    def step(self) -> int | None:
        """The next string; the prefix it shares with the one before, None at the end."""
        self.at += 1
        if self.at >= len(self.rests):
            return None
        n = self.shared[self.at]
        self.value = self.value[:n] + self.rests[self.at]
        return n


def merged(runs: list[_Run]) -> Iterator[tuple[bytes, int, object]]:
    """All strings in order with the prefix shared with the one before and their payload.

    A loser tree: every node keeps the run that lost there, and how much its string shares
    with the last string given out.  Of two strings the one that shares more comes first; only
    if both share the same amount they are compared, from there on."""
    count = len(runs)
    shares: list[int | None] = [run.step() for run in runs]
    tree = [-1] * max(count, 1)  # losers; tree[0] is the winner

    def play(challenger: int, node: int) -> int:
        """The winner between the challenger and the loser kept at a node."""
        other = tree[node]
        if other < 0:
            tree[node] = challenger
            return -1
        a, b = shares[challenger], shares[other]
        if a is None or b is None:
            wins = b is None and a is not None
        elif a != b:
            wins = a > b
        else:
            x, y = runs[challenger].value, runs[other].value
            n = common_prefix(x, y, a)
            wins = x[n:n + 1] <= y[n:n + 1]
            shares[other if wins else challenger] = n
        if wins:
            return challenger
        tree[node] = challenger
        return other

    for run in range(count):
        shares[run] = None if shares[run] is None else 0
        winner, node = run, (run + count) // 2
        while node > 0 and winner >= 0:
            winner, node = play(winner, node), node // 2
        if winner >= 0:
            tree[0] = winner
    while count and shares[tree[0]] is not None:
        winner = tree[0]
        run = runs[winner]
        yield run.value, shares[winner], run.payload[run.at]
        shares[winner] = run.step()
        node = (winner + count) // 2
        while node > 0:
            winner, node = play(winner, node), node // 2
        tree[0] = winner


def repeated_windows(
    shared: np.ndarray, lefts: list[bytes], near: np.ndarray, far: np.ndarray, window: int
) -> np.ndarray:
    """``entries x distances``: is the window that begins so many bytes before the anchor
    repeated?  The entries are in the order of their suffixes; ``shared`` are the prefixes
    shared with the entry before, ``lefts`` the bytes before the anchors, ``near`` and ``far``
    the smallest and largest distance of each entry's windows."""
    count, reach = len(lefts), window - GRAM + 1
    found = np.zeros((count, reach), bool)
    turned = np.zeros((count, reach), np.uint8)
    for i, left in enumerate(lefts):
        turned[i, :len(left)] = np.frombuffer(left[::-1], np.uint8)
    hashed = np.zeros(count, np.uint64)
    for distance in range(reach):
        if distance:
            hashed = (hashed ^ (turned[:, distance - 1].astype(np.uint64) + np.uint64(1))) * _ODD[0]
            hashed ^= hashed >> np.uint64(32)
        some = np.flatnonzero((near <= distance) & (distance <= far))
        if len(some) < 2:
            continue
        run = np.cumsum(shared < window - distance)
        name = _mixed(hashed[some] + run[some].astype(np.uint64) * _ODD[5])
        _, kind, n = np.unique(name, return_inverse=True, return_counts=True)
        found[some, distance] = n[kind] > 1
    return found


# --- operator ---------------------------------------------------------------------------

def _anchors(rows: DataFrame, window: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 2 << 20):
            texts = block.column("text").cast(pa.binary()).to_pylist()
            row, gram, context, at, low, high = anchors_of(texts, window)
            owner = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [block.column("row").take(owner), block.column("hash").take(owner),
                 pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)),
                 *(pa.array(x, pa.int32()) for x in (at, low, high))],
                names=["row", "hash", "gram", "context", "at", "low", "high"])

    return rows.select("row", "hash", "text").mapInArrow(
        find, "row string, hash long, gram long, context long, at int, low int, high int")


def _runs(texts: DataFrame, window: int, buckets: int) -> DataFrame:
    """Texts with their open places -> front-coded runs per bucket of grams."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 8 << 20):
            entries = []
            for row, name, text, places in zip(
                    block.column("row").to_pylist(), block.column("hash").to_pylist(),
                    block.column("text").cast(pa.binary()).to_pylist(),
                    block.column("places").to_pylist(), strict=True):
                for p in places:
                    suffix = text[p["at"]:p["high"] + window]
                    entries.append((p["gram"] % buckets, suffix, text[p["low"]:p["at"]],
                                    (row, name, p["at"], p["at"] - p["high"])))
            entries.sort(key=lambda e: e[:2])
            first = 0
            out = {n: [] for n in ("bucket", "shared", "rests", "lefts", "rows", "hashes",
                                   "places", "nears")}
            for i in range(1, len(entries) + 1):
                if i < len(entries) and entries[i][0] == entries[first][0]:
                    continue
                part = entries[first:i]
                shared, rests = front_coded([e[1] for e in part])
                out["bucket"].append(entries[first][0])
                out["shared"].append(shared)
                out["rests"].append(rests)
                out["lefts"].append([e[2] for e in part])
                for n, j in (("rows", 0), ("hashes", 1), ("places", 2), ("nears", 3)):
                    out[n].append([e[3][j] for e in part])
                first = i
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary()),
                     pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.int64()),
                     pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)],
                names=list(out))

    return texts.mapInArrow(
        sort, "bucket long, shared array<int>, rests array<binary>, lefts array<binary>, "
              "rows array<string>, hashes array<long>, places array<int>, nears array<int>")


def _merge(window: int):
    """Runs of one bucket -> strings to remove: ``(row, hash, begin, end)``."""

    def merge(runs: pa.Table) -> pa.Table:
        columns = {n: runs.column(n).to_pylist() for n in runs.column_names}
        inputs = [
            _Run(columns["shared"][i], columns["rests"][i], list(zip(
                columns["lefts"][i], columns["rows"][i], columns["hashes"][i],
                columns["places"][i], columns["nears"][i], strict=True)))
            for i in range(runs.num_rows)]
        shared, entries = [], []
        for _, n, payload in merged(inputs):
            shared.append(n)
            entries.append(payload)
        near = np.array([e[4] for e in entries], np.int64)
        far = np.array([len(e[0]) for e in entries], np.int64)
        found = repeated_windows(
            np.array(shared, np.int64), [e[0] for e in entries], near, far, window)
        out = ([], [], [], [])
        for i in np.flatnonzero(found.any(axis=1)):
            _, row, name, at, _ = entries[i]
            starts = at - np.flatnonzero(found[i])[::-1]
            cut = np.flatnonzero(np.diff(starts) > window)
            for b, e in zip(starts[np.append(0, cut + 1)], starts[np.append(cut, -1)] + window,
                            strict=True):
                for column, value in zip(out, (row, name, int(b), int(e)), strict=True):
                    column.append(value)
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32())
        return pa.table({n: pa.array(v, k) for n, v, k in zip(
            ("row", "hash", "begin", "end"), out, kinds, strict=True)})

    return merge


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """Texts with crowded places -> one row per window: ``(row, hash, gram, name, begin)``."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, 2 << 20):
            out = ([], [], [], [], [])
            for row, name, text, places in zip(
                    block.column("row").to_pylist(), block.column("hash").to_pylist(),
                    block.column("text").cast(pa.binary()).to_pylist(),
                    block.column("places").to_pylist(), strict=True):
                for p in places:
                    data = np.frombuffer(text[p["low"]:p["high"] + window], np.uint8)
                    size = 1 << (window.bit_length() - 1)
                    value = block_hashes(data, (size,))[size]
                    n = p["high"] - p["low"] + 1
                    value = _mixed(value[:n] * _ODD[3] + _mixed(value[window - size:][:n]))
                    out[0].extend([row] * n)
                    out[1].extend([name] * n)
                    out[2].extend([p["gram"]] * n)
                    out[3].append(value.view(np.int64))
                    out[4].extend(range(p["low"], p["high"] + 1))
            names = np.concatenate([np.zeros(0, np.int64), *out[3]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), pa.array(names),
                 pa.array(out[4], pa.int32())],
                names=["row", "hash", "gram", "name", "begin"])

    return texts.mapInArrow(give, "row string, hash long, gram long, name long, begin int")


def _named(key: str, text: str) -> list[Column]:
    """A row's name is its key and the hash of its text: the rows that share it are equal."""
    return [F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("row"),
            F.xxhash64(F.col(f"`{text}`")).alias("hash")]


def _repeated(rows: DataFrame, window: int) -> DataFrame:
    """The anchors whose gram occurs again, with the count ``n`` of their context and, of their
    gram, the count ``kinds`` of contexts and ``single`` of those that occur once."""
    spark = rows.sparkSession
    folder = work_folder(spark)
    with intermediate(spark):
        anchors = written(
            _anchors(rows.filter(F.octet_length("text") >= window), window), "anchors",
            release=True)
        contexts = anchors.groupBy("gram", "context").agg(F.count("*").alias("n"))
        grams = contexts.groupBy("gram").agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"),
            F.count_if(F.col("n") == 1).alias("single")).filter("total > 1").drop("total")
        contexts = written(contexts.join(grams, "gram"), "contexts", release=True)
        return written(
            anchors.join(contexts, ["gram", "context"]), "repeated", release=True, folder=folder)


def _spans(rows: DataFrame, window: int, crowd: int) -> DataFrame:
    """``(row, hash, found)``: strings to remove, of the rows ``(row, hash, text)`` that have
    any; they may overlap."""
    if not 128 <= window <= 288:
        raise ValueError("window must lie between 128 and 288")
    folder = work_folder(rows.sparkSession)
    with intermediate(rows.sparkSession):
        return written(
            _found(rows, _repeated(rows, window), window, crowd), "spans", release=True,
            folder=folder)


def _found(rows: DataFrame, found: DataFrame, window: int, crowd: int) -> DataFrame:
    """The strings to remove, from the anchors ``found`` of repeated grams."""
    named = ["row", "hash"]
    whole = found.filter("n > 1").select(
        *named, F.col("low").alias("begin"), (F.col("high") + window).alias("end"))
    mixed = found.filter("kinds > 1 AND single > 0")
    place = ["gram", "at", "low", "high"]
    alone = mixed.filter("n = 1").select(*named, *place, "kinds")
    proxies = mixed.filter("n > 1").groupBy("gram", "context", "kinds").agg(
        F.min(F.struct(*named, "at", "low", "high")).alias("p")).select(
        "p.row", "p.hash", "gram", "p.at", "p.low", "p.high", "kinds")
    open_ = alone.unionByName(proxies).withColumn("crowded", F.col("kinds") > crowd)

    def with_text(places: DataFrame) -> DataFrame:
        listed = places.groupBy(*named).agg(
            F.collect_list(F.struct(*place)).alias("places"))  # bounded by the text's length
        return rows.select(*named, "text").join(listed, named)

    buckets = 4 * partitions(rows.sparkSession)
    runs = _runs(with_text(open_.filter("NOT crowded")), window, buckets)
    edges = runs.groupBy("bucket").applyInArrow(
        _merge(window), "row string, hash long, begin int, end int")
    windows = written(_windows(with_text(open_.filter("crowded")), window), "windows",
                      release=True)
    twice = windows.groupBy("gram", "name").agg(F.count("*").alias("n")).filter("n > 1")
    crowded = windows.join(twice, ["gram", "name"]).select(
        *named, "begin", (F.col("begin") + window).alias("end"))
    return whole.unionByName(edges).unionByName(crowded).groupBy(*named).agg(
        F.collect_list(F.struct("begin", "end")).alias("found"))


def repeated_spans(
    df: DataFrame, window: int = 200, key: str = "doc_id", text: str = "text",
    crowd: int = 20_000,
) -> DataFrame:
    """``df`` narrowed to ``(key, text)`` with ``spans array<struct<begin: int, end: int>>``:
    the maximal runs of bytes to remove of every text (of its UTF-8 bytes), in order.

    Matches never cross texts; overlaps with itself count.  Null and empty texts have no
    spans.  Repeated rows repeat each other whole (if as long as the window); null keys are
    kept; an empty table gives an empty table.  ``window`` must lie between 128 and 288.
    """
    rows = narrowed(df, key=key, text=text).select("key", "text", *_named("key", "text"))
    spans = _spans(rows, window, crowd)
    return rows.join(spans, ["row", "hash"], "left").select(
        F.col("key").alias(key), F.col("text").alias(text), _joined("found").alias("spans"))


def _joined(found: str) -> Column:
    """Overlapping and touching spans made one; null as none."""
    kind = "array<struct<begin:int,end:int>>"
    spans = F.array_sort(F.coalesce(F.col(found), F.array().cast(kind)))

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(F.struct(last["begin"].alias("begin"),
                             F.greatest(last["end"], span["end"]).alias("end"))))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["begin"]),
            grown).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast(kind), add)


def removed(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with ``kept binary``: the bytes outside the spans, null text as none."""
    data = F.coalesce(F.encode(F.col(f"`{text}`"), "UTF-8"), F.lit(b""))
    bounds = F.concat(
        F.array(F.lit(0)), F.flatten(F.transform(spans, lambda s: F.array(s["begin"], s["end"]))),
        F.array(F.octet_length(data)))
    parts = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.substring(
            data, bounds[2 * i] + 1, bounds[2 * i + 1] - bounds[2 * i]))
    return df.withColumn("kept", F.aggregate(parts, F.lit(b""), lambda a, b: F.concat(a, b)))


def stripped(
    df: DataFrame, window: int = 200, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``df`` with the repeated strings taken out of ``text``; all columns and their order stay
    (a column ``n_chars`` is counted anew).  A row whose text had bytes and has none left
    goes; null and empty texts stay.  Where a span begins or ends inside a character, the rest
    of that character goes too."""
    columns = df.columns
    # All columns travel in one struct, so their names cannot clash.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("all"), *_named(key, text))
    spans = _spans(rows.select("row", "hash", F.col("all").getField(text).alias("text")),
                   window, crowd=20_000)
    clean = rows.join(spans, ["row", "hash"], "left").select(
        "all", F.col("all").getField(text).alias("text"), _joined("found").alias("spans"))
    clean = removed(clean)
    # Only a text with a cut character loses replacement characters that it had before.
    rest = F.col("kept").cast("string")
    rest = F.when(F.is_valid_utf8(rest), rest).otherwise(
        F.replace(F.make_valid_utf8(rest), F.lit("\ufffd"), F.lit("")))
    clean = clean.filter((F.size("spans") == 0) | (F.octet_length("kept") > 0)).withColumn(
        "left", F.when(F.size("spans") == 0, F.col("text")).otherwise(rest))

    def column(c: str) -> Column:
        if c == text:
            return F.col("left")
        if c == "n_chars":
            return F.length("left").cast(df.schema[c].dataType)
        return F.col("all").getField(c)

    return clean.select(*[column(c).alias(c) for c in columns])
