"""Counters of the target that are kept beside it and merged when read.

Each load, update or delete adds one small table of signed counts: how many rows of each
combination of sex, state, origin, missing CUI and duplicate flag came and went. Statistics add
these up and never read the target. The combinations are few whatever the target holds, so a
log is as large as the number of changes to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.functions.derived import expediente_duplicado
from padron.operators import stats
from padron.operators.lookup import is_migrated

DIMENSIONS = ("sexo", "estado", "migrado", "sin_cui", "duplicado")
SCHEMA = "sexo string, estado string, migrado boolean, sin_cui boolean, duplicado boolean, n long, carga string"


def counted(rows: DataFrame, run: str, sign: int = 1) -> DataFrame:
    """Counts of target rows that came (``sign`` 1) or went (-1) in the change ``run``."""
    flags = rows.select(
        "sexo",
        "estado",
        F.coalesce(is_migrated(), F.lit(False)).alias("migrado"),
        F.col("cui").isNull().alias("sin_cui"),
        expediente_duplicado(F.col("metadatos")).alias("duplicado"),
    )
    return flags.groupBy(*DIMENSIONS).agg((F.count("*") * sign).alias("n")).withColumn("carga", F.lit(run))


def changed(before: DataFrame, after: DataFrame, ids: DataFrame, run: str) -> DataFrame:
    """Counts of an update or delete: the rows of ``ids`` as they were go, as they are come."""
    touched = ids.select("id").distinct()
    gone = counted(before.join(touched, "id", "left_semi"), run, -1)
    return merged(gone.unionByName(counted(after.join(touched, "id", "left_semi"), run)), "carga")


def append_counts(delta: DataFrame, path: str) -> None:
    """Add the counts of a change to the log. A change that is repeated replaces its own counts."""
    delta.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("carga").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def merged(counts: DataFrame, *keep: str) -> DataFrame:
    """One row per combination that is left; with ``keep`` also per change."""
    return counts.groupBy(*DIMENSIONS, *keep).agg(F.sum("n").alias("n")).where("n != 0")


def estadisticas(counts: DataFrame) -> DataFrame:
    """The general statistics, equal to ``stats.estadisticas`` over the target."""
    c = F.col
    total = lambda cond, name: F.coalesce(F.sum(F.when(cond, c("n"))), F.lit(0)).alias(name)
    return stats.report(
        counts.agg(
            total(F.lit(True), "total_pacientes"),
            total(c("sexo") == "M", "masculino"),
            total(c("sexo") == "F", "femenino"),
            total(c("estado") == "F", "fallecidos"),
            total(c("sin_cui"), "sin_cui"),
            total(c("duplicado"), "expedientes_duplicados"),
            total(c("migrado"), "registros_migrados"),
        )
    )


def breakdown(counts: DataFrame) -> DataFrame:
    """Rows per sex, state and origin, each alone, sex with state, and in all.

    ``nivel`` names the columns a row is grouped by; a null in one of those is a missing value.
    """
    sets = [[], [F.col("sexo")], [F.col("estado")], [F.col("migrado")], [F.col("sexo"), F.col("estado")]]
    by = merged(counts).groupingSets(sets, "sexo", "estado", "migrado")
    used = [F.when(F.grouping(d) == 0, F.lit(d)) for d in ("sexo", "estado", "migrado")]
    return by.agg(F.concat_ws(",", *used).alias("nivel"), F.sum("n").alias("total")).select("nivel", "sexo", "estado", "migrado", "total")
