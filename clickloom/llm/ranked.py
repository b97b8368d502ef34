"""Ranked lexical search: term-at-a-time for short lists, document-at-a-time for long ones.

Documents are indexed chunk by chunk, where they are read: a chunk has the lengths of its
documents and, for each term, the positions of the documents that hold it and how often.
Nothing is shuffled for that. Every chunk then answers every block of queries by itself:

* The short lists of a query are summed up at once into accumulators, sorted by document.
  From there on they are one list, whose bound is the largest sum.
* That list and the long ones are merged document at a time, a window of documents after
  the other. Lists whose bounds together stay below the k-th score known so far bring no
  candidates (they are non-essential); a window whose own bounds stay below it is skipped.
  In the non-essential lists only the places of candidates are looked up, the strongest
  list first, and candidates that can no longer reach the k-th score are dropped.

A chunk hands on its k best of each query, and those are ranked at the end.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.store import saved
from clickloom.llm.wordcache import WordCache

#: A chunk is closed when it has so many documents or terms with repeats.
CHUNK_DOCS, CHUNK_TERMS = 16_384, 1 << 22
#: Queries of a block.
ITEMS = 1_024
#: Lists of at most this share of a chunk's documents are short.
SHORT = 1 / 64
#: Documents of a window.
DOCS = 2_048
#: Bits of the filter of asked terms: 2 MB, however many terms are asked.
BITS = 24

#: Bytes of terms are kept, A-Z in lower case; all other ASCII characters part terms.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

INDEX = "chunk long, term binary, docs long, terms long, places binary, values binary"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of UTF-8 text in their order."""
    return (text or b"").translate(_TERMS).split()


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): the different terms of each item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                terms = sorted(set(terms_of(value.as_py())))
                if terms:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(terms), pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"]
                    )

    rows = items.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("long"), F.col(text).cast("binary"))
    return rows.mapInArrow(work, "item_id long, term binary").distinct()


def _asked(terms: DataFrame) -> np.ndarray:
    """A bit for each CRC-32 of a term, modulo 2^BITS. Fixed in size: at most 2^BITS / 64
    numbers reach the driver."""
    crc = F.crc32("term").bitwiseAND(F.lit((1 << BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), crc.bitwiseAND(F.lit(63)).cast("int"))
    words = terms.select(F.shiftright(crc, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    rows = words.toArrow()
    bits = np.zeros(1 << (BITS - 6), np.int64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return np.unpackbits(bits.view(np.uint8), bitorder="little")


def index(docs: DataFrame, asked: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents by chunk. A row with a term: in how many documents of the chunk it is
    (docs), their places in the chunk (unsigned 32-bit numbers, ascending) and how often it
    is in each (values, unsigned 32-bit). A row without: how many documents the chunk has,
    how many terms with repeats, their ids (places) and the terms of each (values, both
    64-bit).

    With `asked`, a table with a column term, other terms are left out as far as a filter
    of fixed size can tell them. Rows without an id and documents without a term are left
    out.
    """
    spark = docs.sparkSession
    bits = None if asked is None else spark.sparkContext.broadcast(np.packbits(_asked(asked)).tobytes())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        filter_bits = None if bits is None else np.unpackbits(np.frombuffer(bits.value, np.uint8))
        wanted = None
        if filter_bits is not None:
            wanted = WordCache(lambda term: bool(filter_bits[zlib.crc32(term) & ((1 << BITS) - 1)]), most=1_000_000)
        ids, lengths, total = [], [], 0
        places: dict[bytes, list[int]] = {}
        values: dict[bytes, list[int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, lengths, total
            if not ids:
                return
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            names = [field.split()[0] for field in INDEX.split(", ")]
            first = ([number], [None], [len(ids)], [total], [np.array(ids, "<i8").tobytes()], [np.array(lengths, "<i8").tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(first, kinds, strict=True)], names)
            terms = list(places)
            for at in range(0, len(terms), 10_000):
                part = terms[at : at + 10_000]
                columns = (
                    [number] * len(part),
                    part,
                    [len(places[t]) for t in part],
                    [None] * len(part),
                    [np.array(places[t], "<u4").tobytes() for t in part],
                    [np.array(values[t], "<u4").tobytes() for t in part],
                )
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            number, ids, lengths, total = number + 1, [], [], 0
            places.clear()
            values.clear()

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                terms = terms_of(value.as_py())
                if not terms:
                    continue
                place = len(ids)
                ids.append(key.as_py())
                lengths.append(len(terms))
                total += len(terms)
                for term, n in Counter(terms if wanted is None else filter(wanted.__getitem__, terms)).items():
                    if term in places:
                        places[term].append(place)
                        values[term].append(n)
                    else:
                        places[term], values[term] = [place], [n]
                if len(ids) >= CHUNK_DOCS or total >= CHUNK_TERMS:
                    yield from out()
        yield from out()

    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return rows.mapInArrow(work, INDEX)


class _List:
    """Documents of a chunk in ascending order, what each scores, and bounds by window."""

    def __init__(self, places: np.ndarray, scores: np.ndarray, windows: int):
        self.places, self.scores = places, scores
        self.bound = int(scores.max(initial=0))
        # Where each window starts in the list.
        self.starts = np.searchsorted(places, np.arange(windows + 1) * DOCS)
        self.bounds = np.zeros(windows, np.int64)
        np.maximum.at(self.bounds, places // DOCS, scores)

    def window(self, at: int) -> slice:
        return slice(self.starts[at], self.starts[at + 1])

    def at(self, documents: np.ndarray, window: int) -> np.ndarray:
        """The scores of ascending documents of a window, 0 where the list has none."""
        part = self.window(window)
        places, scores = self.places[part], self.scores[part]
        if not len(places):
            return np.zeros(len(documents), np.int64)
        found = np.minimum(np.searchsorted(places, documents), len(places) - 1)
        return np.where(places[found] == documents, scores[found], 0)


def summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the documents of short lists in ascending order, with their sums."""
    places = np.concatenate([p for p, _ in lists])
    documents, at = np.unique(places, return_inverse=True)
    sums = np.zeros(len(documents), np.int64)
    np.add.at(sums, at, np.concatenate([s for _, s in lists]))
    return documents, sums


def best(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, short: float = SHORT) -> tuple[np.ndarray, np.ndarray]:
    """(place, score) of the k documents with the largest sums above 0, equal ones by
    ascending id. `lists` has places, ascending, and scores of no less than 0."""
    most = max(1, int(short * len(ids)))
    windows = len(ids) // DOCS + 1
    few = [x for x in lists if len(x[0]) <= most]
    merged = [_List(*x, windows) for x in lists if len(x[0]) > most]
    heap, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    threshold = 1
    if few:
        sums = summed(few)
        merged.append(_List(*sums, windows))
        # The k-th sum of the accumulators is a score that k documents reach.
        if len(sums[1]) >= k:
            threshold = max(threshold, int(np.partition(sums[1], -k)[-k]))
    merged.sort(key=lambda x: x.bound)
    below = np.cumsum([x.bound for x in merged])
    for at in range(windows):
        # Non-essential: the first lists, whose bounds together stay below the threshold.
        essential = int(np.searchsorted(below, threshold))
        if essential == len(merged):
            break
        bounds = [int(x.bounds[at]) for x in merged]
        if sum(bounds) < threshold or not any(bounds[essential:]):
            continue
        parts = [x.window(at) for x in merged[essential:]]
        sums = np.zeros(DOCS, np.int64)
        for x, part in zip(merged[essential:], parts, strict=True):
            sums[x.places[part] - at * DOCS] += x.scores[part]
        rest = sum(bounds[:essential])
        left = np.flatnonzero((sums > 0) & (sums + rest >= threshold))
        reached = sums[left]
        for i in range(essential - 1, -1, -1):
            if not len(left):
                break
            if bounds[i]:
                reached = reached + merged[i].at(left + at * DOCS, at)
            rest -= bounds[i]
            stay = reached + rest >= threshold
            left, reached = left[stay], reached[stay]
        if not len(left):
            continue
        heap, scores = np.concatenate([heap, left + at * DOCS]), np.concatenate([scores, reached])
        order = np.lexsort((ids[heap], -scores))[:k]
        heap, scores = heap[order], scores[order]
        if len(scores) == k:
            threshold = max(threshold, int(scores[-1]))
    return heap, scores


def impacts(often: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a term of weight 1 adds to documents: more the more often they hold it, less
    the longer they are (`lengths` is 100 for the mean length)."""
    often = often.astype(np.int64)
    return 1_000_000_000 * often // (1000 * often + 8 * lengths)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    items_a_block: int = ITEMS,
    short: float = SHORT,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item the k documents with the highest
    scores above 0, all if there are fewer; equal scores by ascending doc_id.

    A term is a run of ASCII letters and digits and all characters beyond ASCII, with A-Z
    in lower case. N documents have at least one term, and L terms with repeats in all. A
    term in df documents weighs floor(1000 ln((2N + 2) / (2df + 1))). In a document of n
    terms that holds it tf times it adds weight * (10^9 tf div (1000 tf + 8m)), where m is
    10 + (90 n N div L).

    Null and empty texts have no terms: such documents count nowhere, such items have no
    result. Rows without an id are left out. Rows that repeat an item's id are one item with
    the terms of all; rows that repeat a document's id are documents of their own. Other
    columns are ignored. Empty tables give no rows.
    """
    asked = saved(query_terms(items, item_id, item_text), "asked")
    lists = saved(index(docs, asked, text, doc_id), "index")
    chunks, documents, terms = lists.where("term is null").agg(F.count("*"), F.sum("docs"), F.sum("terms")).first()
    documents, terms, parts = documents or 0, terms or 1, max(1, chunks)
    blocks = max(1, math.ceil(asked.select("item_id").distinct().count() / items_a_block))

    found = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    frequent = (
        lists.where("term is not null")
        .join(asked.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("docs").alias("df"))
    )
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighted = saved(found.join(frequent, "term").select("block", "item_id", "term", weight.alias("weight")).where("weight > 0"), "weighted")

    # A cell is a few chunks against a block of items: the chunks' lengths, their lists of
    # the terms that the block asks for, and the items.
    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    placed = lists.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int"))
    kept = ["chunk", "term", "places", "values"]
    left = (
        placed.join(weighted.select("block", "term").distinct(), "term")
        .select("part", "block", *kept)
        .unionByName(placed.where("term is null").select("part", every(blocks, "block"), *kept))
    )
    right = (
        weighted.groupBy("block", "item_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("asks"))
        .select(every(parts, "part"), F.col("block").alias("of"), "item_id", "asks")
    )

    def work(lists: pa.Table, items: pa.Table) -> pa.Table:
        rows = ([], [], [])
        held: dict[int, dict] = {}
        if items.num_rows:
            columns = (lists[name].to_pylist() for name in kept)
            for chunk, term, places, values in zip(*columns, strict=True):
                held.setdefault(chunk, {})[term] = places, values
        for chunk in sorted(held):
            mine = held.pop(chunk)
            ids, lengths = (np.frombuffer(x, "<i8") for x in mine.pop(None))
            lengths = np.array([10 + (90 * n * documents) // terms for n in lengths.tolist()], np.int64)
            parts = {}
            for term, (places, values) in mine.items():
                at = np.frombuffer(places, "<u4").astype(np.int64)
                parts[term] = at, impacts(np.frombuffer(values, "<u4"), lengths[at])
            for item, asks in zip(items["item_id"].to_pylist(), items["asks"].to_pylist(), strict=True):
                asked = [(a["weight"], *parts[a["term"]]) for a in asks if a["term"] in parts]
                at, scores = best([(at, weight * impact) for weight, at, impact in asked], ids, k, short)
                rows[0].extend([item] * len(at))
                rows[1].extend(ids[at].tolist())
                rows[2].extend(scores.tolist())
        return pa.table([pa.array(x, pa.int64()) for x in rows], ["item_id", "doc_id", "score"])

    cells = left.groupBy("part", "block").cogroup(right.groupBy("part", "of")).applyInArrow(work, "item_id long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    ranked = cells.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

