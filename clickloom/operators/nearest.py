"""For every row the nearest earlier (or later) value of its key, however large the key.

A window over a key sorts all of its rows in one task. So the rows are cut into pieces
first: a sample, taken in the order of key and row, gives borders that leave about as
many rows between any two of them. Only borders inside a key cut anything. Within a
piece a window finds the nearest value; where there is none it is the last one of the
pieces before, and those are few enough to be sent to every task. It makes no
difference how the rows of a key lie in time: borders fall where the rows are.

A row finds its piece in a tree of borders: level by level one broadcast join brings the
few borders below the node it has reached. So the work of a row grows with the logarithm
of the number of borders, and no row ever carries all of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# Rows of a piece, about: what one task sorts.
PIECE_ROWS = 2_000_000
# Rows sampled for each border. Pieces come out even to a few times 1 / sqrt of it.
SAMPLED = 32
# Borders at most, as they are sent to every task; with more rows pieces are larger.
BORDERS = 100_000
# Borders below a node of the tree, plus one.
FAN = 32


def _pieces(rows: DataFrame, piece_rows: int) -> tuple[int, int]:
    """Rows, and into how many pieces to cut them."""
    total = rows.count()
    return total, min(math.ceil(total / piece_rows), BORDERS)


def _place(order: list[Column]) -> Column:
    return F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])


def borders(rows: DataFrame, key: str, order: list[Column], total: int, pieces: int) -> DataFrame:
    """(key, nth, cut): where the pieces of a key start, the first border being nth 1. Keys
    without a border have no row. About `pieces` borders in all.

    The sample of one key is ordered in one task; all samples together have at most
    SAMPLED * BORDERS rows.
    """
    placed = rows.select(F.col(key), _place(order).alias("cut"))
    # The hash of what orders a row draws it, so a task that runs again draws the same.
    draw = F.pmod(F.xxhash64(key, "cut"), F.lit(1 << 30)) < math.ceil(min(1.0, SAMPLED * pieces / total) * (1 << 30))
    step = max(1, min(SAMPLED, total // pieces))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("cut"))
    ranked = placed.where(draw).withColumn("rank", rank).where(F.col("rank") % step == 0)
    return ranked.select(key, F.expr(f"cast(rank div {step} as int)").alias("nth"), "cut")


def in_pieces(rows: DataFrame, cuts: DataFrame, key: str, order: list[Column], pieces: int) -> DataFrame:
    """Add `piece`, the number of borders of the key at or before the row, and `split`,
    whether the key has borders at all."""
    place, levels = _place(order), 1
    while FAN**levels <= 2 * pieces:
        levels += 1
    found = rows.withColumn("piece", F.lit(0))
    for level in reversed(range(levels)):
        # A node holds every unit-th border up to the next node; the root holds what there is.
        unit, nth = FAN**level, F.col("nth")
        above = F.lit(0) if level == levels - 1 else nth - nth % (unit * FAN)
        nodes = (
            cuts.where((nth % unit == 0) & (nth != above))
            .groupBy(key, above.cast("int").alias("piece"))
            .agg(F.collect_list("cut").alias("below"))
        )
        passed = F.array_size(F.filter("below", lambda cut: cut <= place))
        found = found.join(F.broadcast(nodes), [key, "piece"], "left").withColumns(
            {
                "piece": F.col("piece") + F.coalesce(passed, F.lit(0)) * unit,
                "split": (F.col("piece") > 0) | F.col("below").isNotNull(),
            }
        )
        found = found.drop("below") if level == 0 else found.drop("below", "split")
    return found


def in_piece(rows: DataFrame, keys: list[str], order: list[Column], value: Column) -> DataFrame:
    """Add `near`: the last non-null `value` before the row, in `order`, within its piece."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("near", F.last(value, ignorenulls=True).over(before))


def nearest(
    rows: DataFrame, key: str, order: list[Column], value: Column, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Add `near`: the last non-null `value` of the key before the row, in ascending `order`.

    `order` are whole numbers that place a row among those of its key (negated for an
    order backwards).
    """
    total, pieces = _pieces(rows, piece_rows)
    if pieces <= 1:
        return in_piece(rows, [key], order, value)
    cut = in_pieces(rows, borders(rows, key, order, total, pieces), key, order, pieces)
    ends = (
        cut.where("split")
        .groupBy(key, "piece")
        .agg(F.max_by(value, F.when(value.isNotNull(), _place(order))).alias("end"))
    )
    earlier = Window.partitionBy(key).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "piece", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    return (
        in_piece(cut.drop("split"), [key, "piece"], order, value)
        .join(F.broadcast(carried), [key, "piece"], "left")
        .withColumn("near", F.coalesce("near", "carried"))
        .drop("piece", "carried")
    )
