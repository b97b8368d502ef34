"""Packing tokenised documents into windows of fixed length, best fit decreasing.

A document longer than a window is first cut into full windows; what is left of it, and
every shorter document, is a rest. Rests are placed from the longest to the shortest,
each into the tightest open window that still has room. A segment tree over the
remaining capacities finds it.

Full windows are written where their document is read. Rests are dealt by a hash of their
number into groups of about the same number of tokens, as many as the total asks for, and
every group is packed for itself. So how the table is cut into files does not change how
full the windows are, and no document, however often it is repeated, makes a group large.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bpe import byte_letters
from clickloom.llm.store import saved
from clickloom.llm.wordcache import LATIN_TEXT

WINDOW = 1024
#: Fixed value: how the vocabulary's texts are cut into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens of rests that are packed together, about.
BLOCK_TOKENS = 1 << 22
#: Sequences of rests are numbered from here, by group.
RESTS = 1 << 62
SCHEMA = "doc_id {}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class CapacityTree:
    """A segment tree over remaining capacities 0..most: the smallest one, from a given
    size on, that an open window has."""

    def __init__(self, most: int):
        self.leaves = 1 << (most + 1).bit_length()
        self.open = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.open[node] += by
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window with room for `size`."""
        node = self.leaves + size
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.open[node]:
                    node += 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[tuple[int, int]], int]:
    """(window number, offset) of each length, placed in the order given, and how many
    windows there are. Lengths from the longest down make it best fit decreasing."""
    tree, placed, made = CapacityTree(window), [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, made = (window, made), made + 1
        capacity, at = found
        placed.append((at, window - capacity))
        if capacity > length:
            tree.put(capacity - length, at)
    return placed, made


class Encoder:
    """Token ids of whole texts as the tokenizers library gives them for a byte-level BPE
    file, as little-endian unsigned 32-bit numbers.

    Latin texts without special tokens run through tiktoken with the ranks of the same
    file, which gives the same ids several times faster; all others go to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in vocabulary.items()}
        self.ranks = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if LATIN_TEXT.fullmatch(text) and not any(token in text for token in self.special):
            try:
                return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            except ValueError:  # its pattern gives up on a run of a million blanks; the library does not
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _batches(rows: list[tuple], kind: pa.DataType, size: int = 2048) -> Iterator[pa.RecordBatch]:
    kinds = (kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    for at in range(0, len(rows), size):
        columns = [pa.array([r[i] for r in rows[at : at + size]], k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, NAMES)


def _cut(doc_id, ids: bytes, window: int, sequence: int) -> list[tuple]:
    """A document's full windows, with sequences numbered from `sequence`, and its rest, which
    has none yet but the next number as its offset."""
    total = len(ids) // 4
    full = [
        (doc_id, start, window, ids[4 * start : 4 * (start + window)], total, sequence + n, 0)
        for n, start in enumerate(range(0, total - window + 1, window))
    ]
    start = total - total % window
    rest = [(doc_id, start, total - start, ids[4 * start :], total, None, sequence + len(full))] if start < total else []
    return full + rest


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    end: int = 0,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The pieces of all documents in their windows.

    A document's ids are those of the tokenizer file `tokenizer` (its path on every
    executor) without special tokens, then `end`. doc_id; start and length: the piece's
    place in its document; ids: little-endian unsigned 32-bit numbers; doc_tokens: all
    ids of the document; sequence_id and offset: its place, gapless from 0.

    Null and empty texts make one piece of one id. Null ids and repeated rows are packed
    like others. Other columns are ignored; an empty table gives no piece. Very long
    documents are cut as they come. Rests are packed in groups of about `block_tokens`; only
    the last windows of a group can be far from full. Equal lengths go by id, then start.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = _encoder(tokenizer), np.array([end], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            out, waiting = [], 0
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                rows = _cut(key.as_py(), encoder.encode(text.as_py()) + last, window, sequence)
                out += rows
                sequence += len(rows)
                waiting += len(rows) * window
                if waiting >= 1 << 20:
                    yield from _batches(out, batch.column(0).type)
                    out, waiting = [], 0
            yield from _batches(out, batch.column(0).type)

    def packed(group: pa.Table) -> pa.Table:
        first = RESTS | group["group"][0].as_py() << 32
        rests = list(zip(*(group[name].to_pylist() for name in NAMES[:5]), strict=True))
        rests.sort(key=lambda x: (-x[2], x[0] is None, x[0] or 0, x[1]))
        placed, _ = best_fit([x[2] for x in rests], window)
        rows = [(*x, first + at, offset) for x, (at, offset) in zip(rests, placed, strict=True)]
        return pa.Table.from_batches(_batches(rows, group.schema.field("doc_id").type))

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = saved(rows.mapInArrow(encoded, SCHEMA.format(kind)), "pieces", "zstd")
    rests = pieces.where("sequence_id is null")
    groups = max(1, math.ceil((rests.agg(F.sum("length")).first()[0] or 0) / block_tokens))
    dealt = rests.withColumn("group", F.pmod(F.xxhash64("offset"), F.lit(groups)))
    return pieces.where("sequence_id is not null").union(
        dealt.groupBy("group").applyInArrow(packed, SCHEMA.format(kind))
    )
