"""Spelling variants of words: words one edit apart, the form each is a variant of, its root.

Words are laid out as padded matrices of code points, and blocks of words are compared
with blocks of words: of every pair of a tile the common prefix and the common suffix are
counted position by position. Two words are one inserted, deleted or replaced code point
apart if and only if prefix and suffix together reach the longer length minus one.

Only tiles that can hold such a pair are compared. Let L be the longer length and h half
of it: the pair shares its first h code points (the edit lies behind them) or its last
L - h ones. So words meet by the length L, the side and that half. A group of many words
is dealt into blocks, and every pair of its blocks is a tile of its own, wherever it runs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.store import saved

#: Words of a block of a large group.
BLOCK = 2_048
#: Numbers of a tile that is compared at once; longer words make smaller tiles.
TILE = 1 << 22
#: Different words that a task counts before it hands them on.
COUNTED = 250_000

LENGTH, COUNT, TIMES = 6, 5, 5

#: Runs consist of these: a byte a code point, all else blank, A-Z in lower case.
_RUNS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def _counted(doc_id: str, text: str, shortest: int, spoil: int | None) -> Iterator[tuple[bytes, int]]:
    """(run in Latin-1, occurrences) of one text, for runs of at least `shortest`."""
    runs = Counter(text.encode("latin-1", "replace").translate(_RUNS).split())
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        if len(run) < shortest:
            continue
        if spoil:
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
            if h % spoil == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < shortest:
                    continue
        yield run, n


def word_counts(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    length: int = LENGTH,
    count: int = COUNT,
    spoil: int | None = None,
) -> DataFrame:
    """(word, n): the words of all texts and how often they occur, if that is at least
    `count` times and they have at least `length` code points.

    Words are the longest runs of `[A-Za-z\\u00C0-\\u00FF]`, with only A-Z in lower case.
    With `spoil`, typing errors are put in first: where `spoil` divides the CRC-32 h of
    `<doc_id>:<run>`, the run loses its code point at h modulo its length; a null id is
    written as nothing. Null and empty texts have no words, repeated rows count again,
    other columns are ignored, an empty table has no words. Whole texts are read, and
    every task adds its words up before they are sent anywhere.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            words = list(total)
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.decode("latin-1") for w in part], pa.string()), pa.array([total[w] for w in part], pa.int64())],
                    ["word", "n"],
                )
            total.clear()

        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                if (whole := value.as_py()) is None:
                    continue
                for word, n in _counted(key.as_py(), whole, length, spoil):
                    total[word] = total.get(word, 0) + n
                if len(total) > COUNTED:
                    yield from out()
        yield from out()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(text).cast("string"))
    parts = rows.mapInArrow(work, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words from the left and from the right, padded with -1, and the
    lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    left = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.int32)
    right = np.frombuffer("".join([w.rjust(width, "\0") for w in words]).encode("utf-32-le"), np.int32)
    left, right = left.reshape(-1, width).copy(), right.reshape(-1, width).copy()
    left[np.arange(width) >= lengths[:, None]] = -1
    right[np.arange(width) < width - lengths[:, None]] = -1
    return left, right, lengths


def _tile(a: tuple, b: tuple, width: int, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile, row, column) of the pairs one edit apart whose longer word has `width` code
    points. `a` and `b` are matrices stacked by tile: (tiles, words, width) and lengths
    (tiles, words), 0 for padding. Of a pair that shares both halves only the tile of the
    left one (side 0) tells."""
    (left_a, right_a, size_a), (left_b, right_b, size_b) = a, b
    half = width // 2
    alive = (np.maximum(size_a[:, :, None], size_b[:, None, :]) == width) & (
        np.minimum(size_a[:, :, None], size_b[:, None, :]) >= width - 1
    )
    prefix = np.zeros(alive.shape, np.int32)
    suffix = np.zeros(alive.shape, np.int32)
    for common, x, y, places in (
        (prefix, left_a, left_b, range(width)),
        (suffix, right_a, right_b, range(width - 1, -1, -1)),
    ):
        same = alive.copy()
        for p in places:
            same &= x[:, :, None, p] == y[:, None, :, p]
            if not same.any():
                break
            common += same
    near = alive & (prefix < width) & (prefix + suffix >= width - 1)
    near &= (prefix >= half) if side == 0 else (prefix < half)
    return np.nonzero(near)


class _Tiles:
    """Groups of words that wait to be compared, stacked into tiles of one shape."""

    def __init__(self):
        self.waiting: dict[tuple[int, int, int], list[tuple[list, list]]] = {}
        self.found: list[tuple[str, str, int, int]] = []

    def add(self, width: int, side: int, left: list, right: list | None) -> None:
        """A group of (word, n) against itself (`right` None) or against another block."""
        if right is not None or len(left) > 32:
            step = max(1, min(BLOCK, int((TILE // width) ** 0.5)))
            blocks = [left[i : i + step] for i in range(0, len(left), step)]
            others = blocks if right is None else [right[i : i + step] for i in range(0, len(right), step)]
            for i, one in enumerate(blocks):
                for j, other in enumerate(others):
                    if right is not None or i <= j:
                        self._compare(width, side, [(one, other)])
            return
        size = 1 << (len(left) - 1).bit_length()
        shape = (width, side, size)
        groups = self.waiting.setdefault(shape, [])
        groups.append((left, left))
        if len(groups) * size * size * width > TILE:
            self._compare(width, side, self.waiting.pop(shape))

    def finish(self) -> None:
        for (width, side, _), groups in self.waiting.items():
            self._compare(width, side, groups)
        self.waiting = {}

    def _compare(self, width: int, side: int, groups: list[tuple[list, list]]) -> None:
        def stacked(rows: list[list]) -> tuple:
            most = max(map(len, rows))
            words = [w for group in rows for w, _ in group + [("", 0)] * (most - len(group))]
            left, right, lengths = _matrices(words, width)
            return (
                left.reshape(-1, most, width),
                right.reshape(-1, most, width),
                lengths.reshape(-1, most),
            )

        itself = all(one is other for one, other in groups)
        a = stacked([one for one, _ in groups])
        b = a if itself else stacked([other for _, other in groups])
        for tile, i, j in zip(*(x.tolist() for x in _tile(a, b, width, side)), strict=True):
            if not itself or i < j:
                (x, x_n), (y, y_n) = groups[tile][0][i], groups[tile][1][j]
                self.found.append((x, y, x_n, y_n))


CELL = ("width", "side", "half", "low", "high")


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, a_n, b_n): every pair of different words one edit apart, once.

    `words` has word, each once, and n; null words are left out, and the empty word is one
    edit from each of a single code point.
    """
    known = words.where("word is not null").select("word", F.col("n").cast("long").alias("n"), F.length("word").alias("size"))

    def halves(width: str) -> list:
        first = F.expr(f"({width}) div 2").cast("int")
        rest = (F.expr(width) - first).cast("int")
        head = F.substring(F.col("word"), F.lit(1), first)
        tail = F.substring(F.col("word"), F.col("size") - rest + 1, rest)
        return [
            F.struct(F.expr(width).cast("int").alias("width"), F.lit(side).alias("side"), part.alias("half"))
            for side, part in ((0, head), (1, F.when(rest <= F.col("size"), tail).otherwise(F.lit(""))))
        ]

    rows = known.select("word", "n", F.inline(F.array(*halves("size"), *halves("size + 1"))))
    sizes = rows.groupBy("width", "side", "half").agg(F.count("*").alias("words"))
    groups = sizes.where("words > 1").withColumn("blocks", F.ceil(F.col("words") / block).cast("int"))
    dealt = (
        rows.join(groups, ["width", "side", "half"])
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    cells = dealt.select(
        "width", "side", "half", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "word", "n"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, now, sides = _Tiles(), None, ([], [])

        def close() -> None:
            low, high = now[3:]
            if low == high:
                if len(sides[0]) > 1:
                    tiles.add(now[0], now[1], sides[0], None)
            elif sides[0] and sides[1]:
                tiles.add(now[0], now[1], sides[0], sides[1])

        def out(most: int) -> Iterator[pa.RecordBatch]:
            while len(tiles.found) > most:
                part, tiles.found = tiles.found[:20_000], tiles.found[20_000:]
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*part, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "a_n", "b_n"])

        for batch in batches:
            for *cell, own, word, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if cell != now:
                    if now:
                        close()
                    now, sides = cell, ([], [])
                    yield from out(20_000)
                sides[own != cell[3]].append((word, n))
        if now:
            close()
        tiles.finish()
        yield from out(0)

    placed = cells.repartition(*CELL).sortWithinPartitions(*CELL)
    return placed.mapInArrow(work, "a string, b string, a_n long, b_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that following forms reaches. A form
    is more frequent than its word, so there are no circles; every round doubles the steps."""
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = now.join(further, "root", "left")
        moved = saved(ahead.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def group(words: DataFrame, times: int = TIMES, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of `words`, which has word and n.

    n_near is the number of words one edit away (0 if there are none). form is the most
    frequent of them, the first in code-point order of equals, if it is at least `times`
    (more than 1) as frequent as the word, else null, as is its number form_n. root is
    where following forms ends, the word itself if it has none. Null words are left out,
    rows that repeat a word are added up, and an empty table gives no rows.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its variants")
    whole = words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    whole = saved(whole, "words")
    pairs = saved(near_pairs(whole, block), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(
        pairs.select("b", "a", "a_n")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    fits = -F.col("best.less") >= times * F.col("n")
    told = saved(
        whole.join(best, "word", "left").select(
            "word",
            F.when(fits, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(told.where("form is not null").select("word", "form"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
