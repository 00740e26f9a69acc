"""Joins and numbering that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A table of the heaviest keys never has more rows than this, so it can always be broadcast.
# A key outside it carries at most 1/HEAVY_KEYS of all rows.
HEAVY_KEYS = 1000

# The right side of a join is broadcast up to so many counted rows (one number each: some 60 MB on
# the driver), and never beyond.
BROADCAST_ROWS = 1 << 20

# Integer keys are numbered in blocks of 2**BLOCK_BITS consecutive values: with unique keys
# no group, at any level, exceeds 65,536 rows.
BLOCK_BITS = 16
LEVELS = 3


def few(rows: DataFrame, most: int | None = None) -> bool:
    """Whether there are at most ``most`` rows (``BROADCAST_ROWS``). They are counted at once; of a
    written table that takes its footers only."""
    return rows.count() <= (BROADCAST_ROWS if most is None else most)


def beside(lookup: DataFrame, small: bool) -> DataFrame:
    """``lookup`` as the right side of a join: broadcast if it is small, else sorted and merged.

    Left to itself Spark estimates it by the bytes of a compressed file and the share of the
    columns read: nine million ids seem smaller than its limit, and exhaust the driver.
    """
    return F.broadcast(lookup) if small else lookup.hint("merge")


def counted(lookup: DataFrame) -> DataFrame:
    """``lookup`` as the right side of a join, by its own number of rows."""
    return beside(lookup, few(lookup))


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], weight: str, small: bool | None = None
) -> DataFrame:
    """Inner join of ``rows`` with a lookup of one row per key.

    ``weight`` is the lookup's column with the number of rows per key. The heaviest keys are
    joined by broadcast, so their rows stay where they are; only the rest is shuffled. ``small``
    tells whether the lookup can be broadcast whole, if that is known.
    """
    on = list(on)
    payload = [c for c in lookup.columns if c not in on]
    # Kept in one struct, so that both uses of the lookup need the same columns and Spark
    # computes and shuffles it once.
    packed = lookup.select(*on, F.struct(*payload).alias("_p"))
    heavy = packed.orderBy(F.desc(f"_p.{weight}"), *on).limit(HEAVY_KEYS)
    marked = rows.join(F.broadcast(heavy), on, "left_outer")
    hot = marked.where(F.col("_p").isNotNull())
    rest = packed if small is None else beside(packed, small)
    light = marked.where(F.col("_p").isNull()).drop("_p").join(rest, on)
    return hot.unionByName(light).select(*rows.columns, "_p.*")


def block_of(key: str) -> Column:
    """Block of a key. Declared free of nulls: otherwise each use of the counts would get its
    own null filter, and Spark could not share their shuffle."""
    return F.coalesce(F.shiftright(F.col(key).cast("long"), BLOCK_BITS), F.lit(0).cast("long"))


def block_offsets(rows: DataFrame, key: str) -> DataFrame:
    """Blocks of an integer key with their row counts and the rows before each of them.

    Counts are summed upward level by level (blocks, blocks of blocks, ...), so that every
    running total is taken over at most 65,536 rows.
    """
    counts = [rows.groupBy(block_of(key).alias("_b1")).agg(F.count("*").alias("_n1"))]
    for level in range(2, LEVELS + 1):
        counts.append(
            counts[-1]
            .groupBy(block_of(f"_b{level - 1}").alias(f"_b{level}"))
            .agg(F.sum(f"_n{level - 1}").alias(f"_n{level}"))
        )

    # Three levels of 16 bits leave 16 bits of a key: the top total is over 65,536 rows, too.
    offsets, total = None, F.lit(0)
    for level in range(LEVELS, 0, -1):
        block, parent = f"_b{level}", f"_b{level + 1}"
        before = (
            Window.partitionBy(parent)
            .orderBy(block)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        here = (
            counts[level - 1]
            .withColumn(parent, F.lit(0) if level == LEVELS else block_of(block))
            .withColumn(f"_o{level}", F.coalesce(F.sum(f"_n{level}").over(before), F.lit(0)))
        )
        offsets = here if offsets is None else here.join(offsets, parent)
        total = total + F.col(f"_o{level}")
    return offsets.select("_b1", F.col("_n1").alias("_rows"), total.alias("_before"))


def dense_index(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of a unique integer key.

    The number depends on the data only, not on how it is partitioned, so a lost executor or
    a second evaluation cannot change it. One shuffle of the rows.
    """
    within = F.row_number().over(Window.partitionBy("_b1").orderBy(key)) - 1
    return (
        rows.withColumn("_b1", block_of(key))
        .join(block_offsets(rows, key).drop("_rows"), "_b1")
        .withColumn(out, (F.col("_before") + within).cast("long"))
        .drop("_b1", "_before")
    )
