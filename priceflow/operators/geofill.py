"""Fill missing coordinates from the other rows of the same market, in source order.

A row takes the last known value at or before it in its market, else the first known value of the
market, else 0. (A first value after the row can only be needed where no value stands before it, and
is then the first of the whole market.)

One market may hold a large part of all rows, so no market is ever sorted as one group. Where the
known values of a market agree, order does not matter and the fill is a lookup. Only the markets whose
values differ and have gaps are put in order, piece by piece: a piece is a bounded range of the rows of one
split of the source, and what must be known from the earlier pieces is one value per piece. So one market in
one file that can't be split is still filled by many tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from priceflow.session import hand_off
from priceflow.sources.prices import ROW_SEQ

COORDINATES = ("latitude", "longitude")

_FILE, _BLOCK, _PIECE, _ROW = "_file", "_block", "_piece", "_row"

#: Numbers in a piece. The readers number the rows of a task from a multiple of 2**33, so no piece holds two tasks' rows.
PIECE_ROWS = 1 << 20


def geo_fill(
    df: DataFrame,
    work_dir: str,
    market: str = "market",
    coordinates: tuple[str, ...] = COORDINATES,
    row_seq: str = ROW_SEQ,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """``df`` with ``coordinates`` filled. ``row_seq`` is a struct (file, block, row), see the readers; rows that are no
    integers are cut into pieces by a sort by range instead of by ``piece_rows``, and stored for that.

    Reads ``df`` once here for the small table of markets, which goes to ``work_dir``.
    """
    markets = hand_off(_market_values(df, market, coordinates), f"{work_dir}/market_values")
    moving = reduce(or_, [_moves(c) for c in coordinates])

    joined = df.join(markets, market, "left")
    if markets.where(moving).isEmpty():
        return _fill_constant(joined, df.columns, market, coordinates)
    still = joined.where(~F.coalesce(moving, F.lit(False)))
    shifting = df.join(markets.where(moving).select(market), market)
    return _fill_constant(still, df.columns, market, coordinates).unionByName(
        _fill_in_order(shifting, df.columns, market, coordinates, row_seq, piece_rows, work_dir)
    )


def _market_values(df: DataFrame, market: str, coordinates: tuple[str, ...]) -> DataFrame:
    facts = [F.count("*").alias("_rows")]
    for c in coordinates:
        facts += [F.min(c).alias(f"_{c}_low"), F.max(c).alias(f"_{c}_high"), F.count(c).alias(f"_{c}_known")]
    return df.where(F.col(market).isNotNull()).groupBy(market).agg(*facts)


def _moves(coordinate: str) -> Column:
    gaps = F.col(f"_{coordinate}_known") < F.col("_rows")
    return gaps & (F.col(f"_{coordinate}_low") < F.col(f"_{coordinate}_high"))


def _known_market(market: str, coordinate: str, value: Column, df: DataFrame) -> Column:
    """A row without a market belongs to no group: it gets 0, whatever it had."""
    zero = F.lit(0).cast(df.schema[coordinate].dataType)
    return F.when(F.col(market).isNull(), zero).otherwise(F.coalesce(value, zero)).alias(coordinate)


def _fill_constant(
    joined: DataFrame, columns: list[str], market: str, coordinates: tuple[str, ...]
) -> DataFrame:
    filled = {
        c: _known_market(market, c, F.coalesce(F.col(c), F.col(f"_{c}_low")), joined) for c in coordinates
    }
    return joined.select(*[filled.get(c, F.col(c)) for c in columns])


def _fill_in_order(
    rows: DataFrame,
    columns: list[str],
    market: str,
    coordinates: tuple[str, ...],
    row_seq: str,
    piece_rows: int,
    work_dir: str,
) -> DataFrame:
    place = [_FILE, _BLOCK, _PIECE]
    piece = [market, *place]
    rows = rows.withColumns(
        {
            _FILE: F.col(f"{row_seq}.file"),
            _BLOCK: F.col(f"{row_seq}.block"),
            _ROW: F.col(f"{row_seq}.row"),
        }
    )
    if isinstance(rows.schema[_ROW].dataType, T.IntegralType):
        rows = rows.withColumn(_PIECE, F.floor(F.col(_ROW) / piece_rows))
    else:
        ranges = rows.repartitionByRange(market, _FILE, _BLOCK, _ROW).withColumn(_PIECE, F.spark_partition_id())
        rows = hand_off(ranges, f"{work_dir}/pieces")

    edges = []
    for c in coordinates:
        known_at = F.when(F.col(c).isNotNull(), F.col(_ROW))
        edges += [F.min_by(c, known_at).alias(f"_{c}_first"), F.max_by(c, known_at).alias(f"_{c}_last")]
    pieces = Window.partitionBy(market).orderBy(*place)
    earlier = pieces.rowsBetween(Window.unboundedPreceding, -1)
    every = pieces.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = []
    for c in coordinates:
        carried += [
            F.last(f"_{c}_last", ignorenulls=True).over(earlier).alias(f"_{c}_before"),
            F.first(f"_{c}_first", ignorenulls=True).over(every).alias(f"_{c}_start"),
        ]
    carry = rows.groupBy(*piece).agg(*edges).select(*piece, *carried)

    upto = Window.partitionBy(*piece).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({f"_{c}_here": F.last(c, ignorenulls=True).over(upto) for c in coordinates})
    joined = inside.join(carry, piece)
    filled = {
        c: _known_market(
            market, c, F.coalesce(F.col(f"_{c}_here"), F.col(f"_{c}_before"), F.col(f"_{c}_start")), joined
        )
        for c in coordinates
    }
    return joined.select(*[filled.get(c, F.col(c)) for c in columns])
