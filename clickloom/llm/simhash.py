"""SimHash near-duplicates, found through codewords of the binary Golay code.

A fingerprint has 64 bits, cut into three segments of 22, 21 and 21 bits. Each segment,
filled with zeros to 23 bits, lies within three bits of exactly one codeword of the
perfect Golay code (23, 12), its home. Two segments that differ in e bits have this in
common: the home of one lies within 3 + e bits of the other. So a segment is found by
its one home key from the few codewords within 4 bits (e = 1: at most 6) or within
5 bits (e = 2: at most 22).

Four differing bits fall on three segments. Sorted by errors, either the two best have
at most one error each (tables 0-2: a pair of segments, 24 bits of key), or they are
split 0, 2, 2 (tables 3-5: one segment as it is and the Golay key of the next, 33 bits).
No link is missed, and a verified link comes out of one table in one direction only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import components
from clickloom.llm.store import saved

SEED = 42
WORDS = 4
MAX_BITS = 4
PRINTS_A_TASK = 32_768
#: (first bit, bits) of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The 64-bit fingerprint of UTF-8 text: a bit is 1 if more than half of the shingle
    hashes have it. Null, empty and blank texts have 0. Works on the whole text, a
    bounded number of shingles at a time."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    del tokens
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.append(gaps, len(joined))
    if len(starts) > words:
        starts, ends = starts[: len(starts) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), 1 << 14):
        spans = zip(starts[at : at + (1 << 14)].tolist(), ends[at : at + (1 << 14)].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the nearest error pattern, and what to add to a home's index to get
    all codewords within 4 and within 5 bits (rows filled up with 0, the home itself).
    Last: the syndrome of every 12-bit upper half, for fast division."""

    def remainder(x: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            x = np.where(x >> bit & 1, x ^ (GENERATOR << (bit - 11)), x)
        return x

    singles = 1 << np.arange(23)
    leaders = np.zeros(2048, np.int64)
    bits = [np.zeros(1, np.int64), singles]
    bits.append(np.array([a | b for i, a in enumerate(singles) for b in singles[:i]]))
    bits.append(np.array([a | b for a in bits[2] for b in singles if b < (a & -a)]))
    for patterns in bits:
        leaders[remainder(patterns)] = patterns
    high = np.arange(4096) << 11
    tails = remainder(high)
    codewords = high | tails
    weights = np.bitwise_count(leaders[:, None] ^ codewords[None, :])

    def within(radius: int, most: int) -> np.ndarray:
        near = np.zeros((2048, most), np.int64)
        for syndrome, row in enumerate(weights):
            found = np.flatnonzero((row <= radius) & (np.arange(4096) > 0))
            near[syndrome, 1 : 1 + len(found)] = found
        return near

    return leaders, within(4, 6), within(5, 22), tails


def _home(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest codeword, and the syndrome."""
    leaders, _, _, tails = _golay()
    syndrome = tails[segment >> 11] ^ (segment & 2047)
    return (segment ^ leaders[syndrome]) >> 11, syndrome


def _segments(prints: np.ndarray) -> list[np.ndarray]:
    bits = prints.astype(np.uint64)
    return [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


def _keys(prints: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The home keys (a row a fingerprint, a column a table), and for each table the
    (row, key) pairs of its probes. A key holds the table in its top bits."""
    _, near, far, _ = _golay()
    parts = _segments(prints)
    homes, syndromes = zip(*(_home(x) for x in parts), strict=True)
    own, probes = [], []
    rows = np.arange(len(prints))
    for table, (i, j) in enumerate(PAIRS):
        tag = table << 40
        own.append(tag | homes[i] << 12 | homes[j])
        left, right = (homes[k][:, None] ^ near[syndromes[k]] for k in (i, j))
        real_i, real_j = (_distinct(near)[syndromes[k]] for k in (i, j))
        keys = tag | left[:, :, None] << 12 | right[:, None, :]
        at, a, b = np.nonzero(real_i[:, :, None] & real_j[:, None, :])
        probes.append((at, keys[at, a, b]))
    for i in range(3):
        j, tag = (i + 1) % 3, (3 + i) << 40
        own.append(tag | parts[i] << 12 | homes[j])
        keys = tag | parts[i][:, None] << 12 | (homes[j][:, None] ^ far[syndromes[j]])
        at, a = np.nonzero(_distinct(far)[syndromes[j]])
        probes.append((rows[at], keys[at, a]))
    return np.stack(own, axis=1), probes


def _distinct(offsets: np.ndarray) -> np.ndarray:
    """Which columns are real: the home, and what differs from it."""
    real = offsets != 0
    real[:, 0] = True
    return real


def _home_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        own, _ = _keys(prints.view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(own.ravel()), pa.array(np.repeat(prints, own.shape[1]))], ["key", "print"]
        )


def _probe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(whole), 1024):
            prints = whole[at : at + 1024]
            for rows, keys in _keys(prints.view(np.uint64))[1]:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["key", "print"])


def _errors(x: str, y: str) -> list[Column]:
    apart = F.col(x).bitwiseXOR(F.col(y))
    return [
        F.bit_count(F.shiftrightunsigned(apart, at).bitwiseAND(F.lit((1 << n) - 1).cast("long")))
        for at, n in SEGMENTS
    ]


def _first_table(x: str, y: str) -> Column:
    """The one table that a link is taken from: the first that must find it."""
    errors = _errors(x, y)
    table = F.lit(None).cast("int")
    for i in (2, 1, 0):
        table = F.when(errors[i] == 0, 3 + i).otherwise(table)
    for k in (2, 1, 0):
        i, j = PAIRS[k]
        table = F.when((errors[i] <= 1) & (errors[j] <= 1), k).otherwise(table)
    return table


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of distinct 64-bit values in column `print` that differ
    in at most `max_bits` (0 to 4) bits, each pair once."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be from 0 to {MAX_BITS}")
    # A fingerprint becomes some 150 probes, so a task gets a bounded number of them.
    tasks = max(1, math.ceil(prints.count() / PRINTS_A_TASK))
    prints = prints.select("print").repartition(tasks, "print").distinct()
    homes = prints.mapInArrow(_home_rows, "key long, print long").withColumnRenamed("print", "a")
    probes = prints.mapInArrow(_probe_rows, "key long, print long").withColumnRenamed("print", "b")
    near = (
        (homes["key"] == probes["key"])
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        & (_first_table("a", "b") == F.shiftright(homes["key"], 40))
    )
    # Their size cannot be told from that of the fingerprints, so neither side is broadcast.
    return homes.hint("merge").join(probes.hint("merge"), near).select("a", "b")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS) -> DataFrame:
    """(doc_id, print, digest): a row for each row of `docs`; `print` is the fingerprint as a
    long, `digest` tells different texts apart."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            prints = np.fromiter((fingerprint(x.as_py(), words) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], ["doc_id", "print", "digest"]
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"), _digest(text).alias("digest")
    )
    return rows.mapInArrow(work, "doc_id long, print long, digest binary")


def _digest(text: str) -> Column:
    """Of the whole text; empty for null."""
    return F.coalesce(F.substring(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), 1, 16), F.lit(b""))


def _classes(docs: DataFrame, text: str, doc_id: str, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints, and of each different one `node` (the smallest id and the
    fingerprint), that id's smallest digest, and `root`, the smallest node it reaches.
    Fingerprints are the nodes, so one id on different texts ties nothing."""
    prints = saved(fingerprints(docs, text, doc_id, words), "prints")
    heads = prints.where("doc_id is not null").groupBy("print").agg(F.min(F.struct("doc_id", "digest")).alias("head"))
    classes = saved(heads.select("print", F.struct("head.doc_id", "print").alias("node"), "head.digest"), "classes")
    node = classes.select("print", "node")
    tied = (
        links(classes, max_bits)
        .join(node.toDF("a", "x"), "a")
        .join(node.toDF("b", "y"), "b")
    )
    roots = components(tied, "x", "y")
    rooted = classes.join(roots, "node", "left").select("print", "node", "digest", F.coalesce("root", "node").alias("root"))
    return prints, rooted


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, print, component_id): the fingerprint of every document, and the smallest
    id that it reaches over links of at most `max_bits` differing bits.

    Words are cut at ASCII white space after lower-casing A-Z; a shingle is `words` of
    them, counted as often as it occurs. Fewer words make one shingle; no words (null,
    empty or blank text) make fingerprint zero, linked like any other. Repeated rows give
    repeated rows; rows of one id with different texts are judged each by its own. Rows
    without an id give their fingerprint and a null component, and tie nothing. Other
    columns are ignored. An empty table gives an empty result.

    Copies share a fingerprint and are joined as one before any link is looked for, so
    the work grows with the distinct fingerprints.
    """
    prints, classes = _classes(docs, text, doc_id, words, max_bits)
    of_print = saved(classes.select("print", F.col("root.doc_id").alias("component_id")), "of-print")
    return prints.join(of_print, "print", "left").select(
        "doc_id", "print", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def one_of_each(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """`docs` with one row of each component, the first by id, fingerprint and text. So rows
    of one id with different texts go or stay each for itself. Of rows that are equal in id
    and text one stays. Rows without an id stay."""
    _, classes = _classes(docs, text, doc_id, words, max_bits)
    first = classes.where("node = root").select(F.col("node.doc_id").alias("__id"), F.col("digest").alias("__digest"))
    named = docs.where(F.col(doc_id).isNotNull()).withColumns({"__id": F.col(doc_id).cast("long"), "__digest": _digest(text)})
    kept = named.join(first, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"])
    return kept.select(*docs.columns).unionByName(docs.where(F.col(doc_id).isNull()))
