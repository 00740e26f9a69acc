"""Pages and slices of a table in the order of its id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from padron.operators.skew import BLOCK_BITS, block_of, block_offsets

DEFAULT_PAGE_SIZE = 10
MAX_PAGE_SIZE = 100

# Bytes of an integer type.
WIDTHS = {"byte": 1, "short": 2, "integer": 4, "long": 8}


@dataclass(frozen=True)
class PageRequest:
    page: int = 1
    page_size: int = DEFAULT_PAGE_SIZE

    def __post_init__(self):
        if self.page < 1:
            raise ValueError("El número de página debe ser mayor o igual a 1")
        if not 1 <= self.page_size <= MAX_PAGE_SIZE:
            raise ValueError(f"El tamaño de página debe estar entre 1 y {MAX_PAGE_SIZE}")

    @property
    def skip(self) -> int:
        return (self.page - 1) * self.page_size


def slice_rows(
    rows: DataFrame, offset: int, limit: int, key: str = "id", position: str | None = None
) -> DataFrame:
    """Rows ``offset .. offset + limit - 1`` in the order of ``key``, at any depth, sorted.

    ``key`` is a unique integer column; rows without a key are in no slice. Counts per block of
    keys tell which range of keys holds the slice. That range reaches the scan as a filter, and
    only its blocks are put in order. ``position`` names a column for the place of each row.
    """
    if not isinstance(rows.schema[key].dataType, IntegralType):
        raise ValueError(f"{key} must be an integer column")
    keyed = rows.where(F.col(key).isNotNull())
    blocks = block_offsets(keyed.select(key), key)
    starts = F.col("_before") < offset + limit
    ends = F.col("_before") + F.col("_rows") > offset
    wanted = blocks.where(starts & ends)
    # In the key's own type, and each bound by a filter of its own: Spark would merge two
    # subqueries that differ in their result only, and the scan cannot look into such a pair.
    kind = rows.schema[key].dataType
    last = F.lit((1 << (8 * WIDTHS[kind.typeName()] - 1)) - 1)
    low = F.shiftleft(F.min("_b1"), BLOCK_BITS)
    high = F.least(F.shiftleft(F.max("_b1"), BLOCK_BITS) + ((1 << BLOCK_BITS) - 1), last)
    edge = lambda of, e: of.agg(e.cast(kind).alias("edge")).scalar()
    number = F.row_number().over(Window.partitionBy("_b1").orderBy(key))
    found = (
        keyed.where(
            (F.col(key) >= edge(blocks.where(ends), low))
            & (F.col(key) <= edge(blocks.where(starts), high))
        )
        .withColumn("_b1", block_of(key))
        .join(wanted.select("_b1", "_before"), "_b1")
        .withColumn("_position", F.col("_before") + number - 1)
        .where((F.col("_position") >= offset) & (F.col("_position") < offset + limit))
        .orderBy(key)
    )
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return found.select(*kept, *([F.col("_position").alias(position)] if position else []))


def slice_after(rows: DataFrame, last_id: int, limit: int, key: str = "id") -> DataFrame:
    """Next rows after a known id: the cheap way to walk a table slice by slice."""
    return rows.where(F.col(key) > last_id).orderBy(key).limit(limit)


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total"))


def paginate(
    rows: DataFrame, request: PageRequest, total: DataFrame | None = None, key: str = "id"
) -> DataFrame:
    """One page, each row with ``total, page, page_size, total_pages``.

    ``total`` (one row, one column) may count something other than ``rows``.
    """
    size = request.page_size
    page = slice_rows(rows, request.skip, size, key)
    return (
        page.withColumn("total", (row_count(rows) if total is None else total).scalar())
        .withColumn("page", F.lit(request.page))
        .withColumn("page_size", F.lit(size))
        .withColumn("total_pages", F.expr(f"(total + {size} - 1) div {size}"))
    )


def page_info(total: DataFrame, request: PageRequest) -> DataFrame:
    """The page record without its rows; also there when the page is empty."""
    size = request.page_size
    return total.toDF("total").selectExpr(
        "total",
        f"{request.page} AS page",
        f"{size} AS page_size",
        f"(total + {size} - 1) div {size} AS total_pages",
    )
