"""Connected components of a table of links, by contraction in rounds.

In each round every node points at the one of its neighbours, or itself, that a hash of node and
round puts first; links move to what their ends point at, and loops and doubles go. The order
differs from round to round, so chains shrink by a constant part on average. Afterwards the
pointers are followed back. Each round is a written table: no lineage grows. Once at most ``HELD``
links are left, whose size is bounded by that, one task joins them in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import settle

MAX_ROUNDS = 100
#: Links that one task may hold.
HELD = 200_000


def joined(links: DataFrame) -> DataFrame:
    """``node, root`` of at most ``HELD`` links, in one task; the root is the least node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def top(node):
            while above[node] != node:
                above[node] = above[above[node]]
                node = above[node]
            return node

        kind = None
        for rows in batches:
            kind = rows.schema.field(0).type
            for a, b in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                x, y = sorted((top(above.setdefault(a, a)), top(above.setdefault(b, b))))
                above[y] = x
        nodes = list(above)
        for i in range(0, len(nodes), 10_000):
            some = nodes[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, kind), pa.array([top(n) for n in some], kind)], names=["node", "root"])

    kind = dict(links.dtypes)["a"]
    return links.coalesce(1).mapInArrow(run, f"node {kind}, root {kind}")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``(a, b)``; roots are nodes of their component."""
    left = settle(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while left.count() > HELD:
        if len(rounds) == MAX_ROUNDS:
            raise RuntimeError("the links did not contract")
        place = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(rounds))).alias("h"), F.col(c).alias("to"))  # noqa: B023, E731
        both = left.select(F.col("a").alias("node"), F.least(place("a"), place("b")).alias("p")).union(
            left.select(F.col("b").alias("node"), F.least(place("a"), place("b")).alias("p"))
        )
        pointers = settle(both.groupBy("node").agg(F.min("p").alias("p")).select("node", F.col("p.to").alias("to")), "pointers")
        rounds.append(pointers)
        moved = (
            left.join(pointers.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(pointers.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        left = settle(moved, "links")
    found = settle(joined(left), "roots")
    for pointers in reversed(rounds):
        later = found.select(F.col("node").alias("to"), "root")
        found = settle(
            pointers.join(later, "to", "left_outer").select("node", F.coalesce("root", "to").alias("root")), "roots"
        )
    return found
