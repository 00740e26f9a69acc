"""A stored index of the identifiers in use: who has which value, met without moving the target.

The index is a catalog table ``campo, clave, fila, vuelta, alta`` in buckets of (campo, clave),
sorted by them. It is a log: a load or a create appends what its rows hold, a change or a removal
appends what is given up and what is taken, each with the number of its turn. The last entry of a
row for a value tells whether the row has it. So nothing stored is ever rewritten, and what a
lookup reads and joins are the buckets as they lie: values asked for are shuffled to them, the
index and the target stay where they are.

A turn that failed can be repeated: the same entries once more change nothing. ``compact`` writes
the entries still valid as a new table when the log has grown long.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators.identifiers import KEY, identifier_rows

BUCKETS = 64
COLUMNS = (*KEY, "fila", "vuelta", "alta")


def _entries(rows: DataFrame, turn: int, alive: bool) -> DataFrame:
    return identifier_rows(rows).select(*KEY, F.col("fila").cast("long").alias("fila"), F.lit(turn).cast("long").alias("vuelta"), F.lit(alive).alias("alta"))


@dataclass(frozen=True)
class KeyIndex:
    """An index over the identifiers of a target; stands in for its rows in lookups."""

    spark: SparkSession
    name: str
    buckets: int = BUCKETS

    def _append(self, entries: DataFrame, path: str | None = None) -> None:
        # One task per bucket, so that a turn adds at most one file to each.
        dealt = entries.select(*COLUMNS).repartition(self.buckets, *KEY)
        writer = dealt.write.format("parquet").mode("append").bucketBy(self.buckets, *KEY).sortBy(*KEY)
        (writer.option("path", path) if path else writer).saveAsTable(self.name)

    def add(self, rows: DataFrame, turn: int) -> None:
        """Rows that were loaded or created."""
        self._append(_entries(rows, turn, True))

    def change(self, before: DataFrame, after: DataFrame, turn: int) -> None:
        """Rows that were changed, as they were and as they are; a row only in ``before`` is gone."""
        same = [*KEY, "fila"]
        old, new = _entries(before, turn, False), _entries(after, turn, True)
        self._append(old.join(new.select(*same), same, "left_anti").unionByName(new.join(old.select(*same), same, "left_anti")))

    def remove(self, rows: DataFrame, turn: int) -> None:
        self._append(_entries(rows, turn, False))

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def held(self, keys: DataFrame) -> DataFrame:
        """``fila, campo, clave`` of the rows that have one of the values ``keys``."""
        return _standing(self.entries().join(keys.select(*KEY), list(KEY), "left_semi"))

    def violations(self) -> DataFrame:
        """``id, campo, clave, primera``: rows whose value a row with a lower id has, too."""
        standing = _standing(self.entries())
        owners = standing.groupBy(*KEY).agg(F.min("fila").alias("primera"), F.count("*").alias("n")).where("n > 1").drop("n")
        return standing.join(owners, list(KEY)).where("fila > primera").select(F.col("fila").alias("id"), *KEY, "primera")

    def compact(self, name: str, path: str | None = None) -> KeyIndex:
        """The entries still valid as a new index."""
        fresh = KeyIndex(self.spark, name, self.buckets)
        standing = _standing(self.entries())
        fresh._append(standing.select(*KEY, "fila", F.lit(0).cast("long").alias("vuelta"), F.lit(True).alias("alta")), path)
        return fresh


def _standing(entries: DataFrame) -> DataFrame:
    """What the last entries say; in a turn that gives a value up and takes it, taking comes last."""
    last = entries.groupBy(*KEY, "fila").agg(F.max(F.struct("vuelta", "alta")).alias("ultima"))
    return last.where("ultima.alta").select("fila", *KEY)


def build_index(rows: DataFrame, name: str, path: str | None = None, buckets: int = BUCKETS) -> KeyIndex:
    """An index over the rows of a target, at turn 0."""
    index = KeyIndex(rows.sparkSession, name, buckets)
    index._append(_entries(rows, 0, True), path)
    return index
