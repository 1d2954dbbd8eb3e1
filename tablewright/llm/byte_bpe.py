"""Byte-level BPE by a shuffle of distinct words.

1. Pre-tokens are taken from the texts with their positions.  A block of texts is stored as
   the distinct pre-tokens of the block (numbered) and, for every text, the numbers in order
   of position - so a frequent word crosses the network once per block, not once per place.
   The distinct words of a block are dealt to buckets by their hash and packed, sorted, into
   one row per bucket.
2. Every bucket meets the same words of the other blocks in one task, where each distinct
   word of the corpus is encoded once.
3. The ids go back to their blocks and replace the numbers, position by position.  The texts'
   numbers are stored in buckets by block and are not shuffled.

Decoding looks every id up in the token-byte table.
"""

from __future__ import annotations

import base64
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablewright.llm.common import (
    field, narrowed, partitions, text_blocks, texts_of, written_in_buckets,
)

#: Bytes of text whose distinct words share one numbering; bounds a task's memory.
DICTIONARY_BYTES = 16 << 20


def read_ranks(ranks_file: str) -> dict[bytes, int]:
    """Token bytes -> rank."""
    with open(ranks_file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encoding(ranks_file: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_file),
                             special_tokens={})


def _pack(*arrays: np.ndarray) -> bytes:
    """32-bit numbers, compressed; equal bytes of the numbers lie together."""
    parts = [len(arrays), *map(len, arrays)]
    values = np.concatenate([np.array(parts, np.uint32), *arrays]).astype(np.uint32)
    planes = values.view(np.uint8).reshape(-1, 4).T.copy()
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(packed: bytes) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    values = planes.reshape(4, -1).T.copy().view(np.uint32).ravel()
    count = int(values[0])
    sizes = values[1:1 + count].astype(np.int64)
    return np.split(values[1 + count:], np.cumsum(sizes)[:-1])


def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def _numbered(pattern: str, columns: pa.Schema, buckets: int):
    """Texts -> rows of numbers per text, and rows of the distinct words, block by block."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = regex.compile(pattern).findall
        task, done = TaskContext.get().partitionId() << 32, 0
        code: defaultdict[str, int] = defaultdict()
        code.default_factory = code.__len__
        held = 0

        def dictionary() -> pa.RecordBatch:
            dealt: defaultdict[int, list[str]] = defaultdict(list)
            for word in code:
                dealt[_bucket(word, buckets)].append(word)
            size, texts, codes = len(dealt), [], []
            for words in dealt.values():
                words.sort()
                texts.append(zstandard.ZstdCompressor(level=3).compress("".join(words).encode()))
                codes.append(_pack(np.fromiter(map(len, words), np.uint32, len(words)),
                                   np.fromiter(map(code.__getitem__, words), np.uint32)))
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(size, task + done)), pa.nulls(size, columns.field("key").type),
                pa.array(list(dealt), pa.int32()), pa.array(texts, pa.binary()),
                pa.array(codes, pa.binary())], schema=columns)

        for rows in text_blocks(batches, DICTIONARY_BYTES // 4):
            texts = texts_of(rows)
            size = sum(map(len, texts))
            if held and held + size > DICTIONARY_BYTES:
                yield dictionary()
                code.clear()
                done, held = done + 1, 0
            held += size
            codes = [
                _pack(np.fromiter(map(code.__getitem__, matches(t)), np.uint32)) for t in texts]
            count = len(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(count, task + done)),
                rows.column("key").cast(columns.field("key").type),
                pa.nulls(count, pa.int32()), pa.nulls(count, pa.binary()),
                pa.array(codes, pa.binary())], schema=columns)
        if code:
            yield dictionary()

    return number


def encode(
    df: DataFrame, ranks_file: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, ids array<int>)``: the ids of every text, each match of ``pattern`` by itself.

    ``ranks_file``: token ranks, readable on every executor.  Null and empty texts have no
    ids (an empty array); repeated rows and null keys stay rows of their own; an empty table
    gives an empty table.  One row is the largest unit of memory besides a block.
    """
    rows = narrowed(df, key=key, text=text)
    kind = rows.schema["key"].dataType
    columns = pa.schema([("block", pa.int64()), ("key", to_arrow_type(kind)),
                         ("bucket", pa.int32()), ("words", pa.binary()), ("codes", pa.binary())])
    buckets = 4 * partitions(df.sparkSession)
    stored = written_in_buckets(
        rows.mapInArrow(
            _numbered(pattern, columns, buckets),
            f"block long, {field('key', kind)}, bucket int, words binary, codes binary"),
        "block", "bpe_blocks",
    )

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(ranks_file, pattern)
        known: dict[str, list[int]] = {}
        bucket = None
        for batch in batches:
            packed_ids = []
            numbers = batch.column("bucket").to_pylist()
            for number, packed, codes in zip(
                    numbers, batch.column("words").to_pylist(),
                    batch.column("codes").to_pylist(), strict=True):
                if number != bucket:  # rows are sorted by bucket
                    known.clear()
                    bucket = number
                joined = zstandard.ZstdDecompressor().decompress(packed).decode()
                lengths, code = _unpack(codes)
                ends = np.cumsum(lengths, dtype=np.int64).tolist()
                words = list(map(joined.__getitem__, map(slice, [0, *ends], ends)))
                for word in set(words).difference(known):
                    known[word] = tokens.encode_ordinary(word)
                found = [known[w] for w in words]
                packed_ids.append(_pack(
                    code, np.fromiter(map(len, found), np.uint32, len(found)),
                    np.fromiter(itertools.chain.from_iterable(found), np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array(packed_ids, pa.binary())],
                names=["block", "ids"])

    words = (
        stored.filter("words IS NOT NULL").select("block", "bucket", "words", "codes")
        .repartition(partitions(df.sparkSession), "bucket").sortWithinPartitions("bucket")
        .mapInArrow(encode_words, "block long, ids binary")
    )

    def reassemble(texts: pa.Table, found: pa.Table) -> pa.Table:
        lengths, begins = np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts = [_unpack(p) for p in found.column("ids").to_pylist()]
        if parts:
            code, n, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
            n = n.astype(np.int64)
            lengths, begins = np.empty(len(code), np.int64), np.empty(len(code), np.int64)
            lengths[code], begins[code] = n, np.cumsum(n) - n
        ids, ends = [np.empty(0, np.uint32)], [0]
        for packed in texts.column("codes").to_pylist():
            codes = _unpack(packed)[0]
            n = lengths[codes]
            total = int(n.sum())
            if total:
                inside = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                ids.append(flat[np.repeat(begins[codes], n) + inside])
            ends.append(ends[-1] + total)
        values = pa.array(np.concatenate(ids).astype(np.int32))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        return pa.table({key: texts.column("key"), "ids": lists})

    numbers = stored.filter("words IS NULL").select("block", "key", "codes")
    return (
        numbers.groupBy("block").cogroup(words.groupBy("block"))
        .applyInArrow(reassemble, f"{field(key, kind)}, ids array<int>")
    )


def decode(df: DataFrame, ranks_file: str, ids: str = "ids") -> DataFrame:
    """The table with a column ``decoded binary``: the bytes of the tokens in ``ids``, one
    after the other.  Null ids give no bytes; an id outside the table is an error."""
    plain = df.drop("decoded")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_file)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        for batch in batches:
            lists = batch.column(ids)
            values = np.asarray(lists.flatten())  # null lists have no values
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            # one row's numbers at a time become Python objects
            texts = [
                b"".join(map(tokens.__getitem__, values[begin:end].tolist()))
                for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())],
                schema=pa.schema([*batch.schema, pa.field("decoded", pa.binary())]))

    schema = ", ".join([*(field(f.name, f.dataType) for f in plain.schema), "decoded binary"])
    return plain.mapInArrow(look_up, schema)


def ids_digest(ids) -> F.Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.transform(ids, lambda i: i.cast("string")), ","), 256)
