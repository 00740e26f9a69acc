"""Options for reading the legacy table from, and writing the target to, a database.

Only the options are built here; the session needs the database's driver on its class path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron import model
from padron.functions.documents import documents_from_json, documents_to_json
from padron.sources.tables import conform_legacy

DEFAULT_BATCH_SIZE = 100


@dataclass(frozen=True)
class Database:
    url: str
    table: str = "pacientes"
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        out = {"url": self.url, **self.properties}
        if self.driver:
            out["driver"] = self.driver
        return out


def bounds_options(db: Database, key: str = "id") -> dict[str, str]:
    """One-row query for the key range, answered by the database's index."""
    query = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {db.table}"
    return {**db.options(), "query": query}


def scan_options(
    db: Database, lower: int, upper: int, partitions: int, fetchsize: int, key: str = "id"
) -> dict[str, str]:
    """Key-range reads in parallel; ``partitions`` also bounds the open connections."""
    if partitions < 1 or fetchsize < 1:
        raise ValueError("partitions and fetchsize must be positive")
    return {
        **db.options(),
        "dbtable": db.table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(max(upper, lower + 1)),
        "numPartitions": str(partitions),
        "fetchsize": str(fetchsize),
    }


def scan_legacy(
    spark: SparkSession, db: Database, partitions: int = 16, fetchsize: int = 10_000
) -> DataFrame:
    """Legacy table, read only, split by id range."""
    lo, hi = spark.read.format("jdbc").options(**bounds_options(db)).load().first()
    options = scan_options(db, lo or 0, hi or 1, partitions, fetchsize)
    return conform_legacy(spark.read.format("jdbc").options(**options).load())


def target_options(
    db: Database, lower: int, upper: int, partitions: int, fetchsize: int
) -> dict[str, str]:
    """Reads of the target in parallel, its documents as text, whatever the database holds them as."""
    columns = ", ".join(
        f"CAST({c} AS TEXT) AS {c}" if c in model.DOCUMENTS else c for c in model.TARGET_COLUMNS
    )
    options = scan_options(db, lower, upper, partitions, fetchsize)
    return {**options, "dbtable": f"(SELECT {columns} FROM {db.table}) AS t"}


def typed_target(rows: DataFrame) -> DataFrame:
    """Rows as the database returns them, in the target's types."""
    return documents_from_json(rows).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in model.TARGET_SCHEMA.fields]
    )


def scan_target(
    spark: SparkSession, db: Database, partitions: int = 16, fetchsize: int = 10_000
) -> DataFrame:
    """Target table with typed documents: what a load is checked against and resumed from."""
    lo, hi = spark.read.format("jdbc").options(**bounds_options(db)).load().first()
    options = target_options(db, lo or 0, hi or 1, partitions, fetchsize)
    return typed_target(spark.read.format("jdbc").options(**options).load())


def append_options(
    db: Database, batch_size: int = DEFAULT_BATCH_SIZE, partitions: int = 8
) -> dict[str, str]:
    if batch_size < 1 or partitions < 1:
        raise ValueError("batch_size and partitions must be positive")
    return {
        **db.options(),
        "dbtable": db.table,
        "batchsize": str(batch_size),
        "numPartitions": str(partitions),
        # Lets a PostgreSQL server turn JSON text into its own document type.
        "stringtype": "unspecified",
    }


def append_target(rows: DataFrame, db: Database, **options) -> None:
    """Append rows with their documents as JSON; the database assigns the ids."""
    out = documents_to_json(rows).drop("id")
    out.write.format("jdbc").mode("append").options(**append_options(db, **options)).save()
