"""Profile and integrity of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.derived import has_13_characters
from padron.functions.text import has_number
from padron.model import ESTADO_VALUES, SEXO_VALUES
from padron.operators.skew import lookup_join


def null_expedientes(legacy: DataFrame) -> DataFrame:
    """Rows without a file number; zero counts as one here."""
    return legacy.agg(F.count_if(F.col("expediente").isNull()).alias("expedientes_nulos"))


def duplicate_expedientes(legacy: DataFrame) -> DataFrame:
    """File numbers carried by more than one row, with their row counts."""
    return (
        legacy.where(F.col("expediente").isNotNull())
        .groupBy("expediente")
        .agg(F.count("*").alias("cantidad"))
        .where("cantidad > 1")
    )


def invalid_cui_count(legacy: DataFrame) -> DataFrame:
    """Ids whose text form has not 13 characters; a minus sign counts as one."""
    return legacy.agg(F.count_if(~has_13_characters(F.col("dpi"))).alias("cui_invalidos"))


def source_check(legacy: DataFrame) -> DataFrame:
    """One row on the state of the source: size and data quality."""
    repeated = duplicate_expedientes(legacy).agg(F.count("*").alias("n"))
    return legacy.agg(
        F.count("*").alias("total_registros"),
        F.count_if(F.col("expediente").isNull()).alias("expedientes_nulos"),
        F.count_if(~has_13_characters(F.col("dpi"))).alias("cui_invalidos"),
    ).select(
        "total_registros",
        F.lit(len(legacy.columns)).alias("total_columnas"),
        "expedientes_nulos",
        repeated.scalar().alias("expedientes_duplicados"),
        "cui_invalidos",
    )


def referential_integrity(legacy: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per reference to a file number that does not exist.

    ``known`` has the existing numbers in ``expediente``; default: those of the table itself.
    References are reduced to their distinct values before they meet the known numbers, and
    only the missing ones come back to the rows.
    """
    existing = (legacy if known is None else known).select("expediente").distinct()
    entries = [
        F.struct(F.lit(field).alias("campo"), F.col(field).alias("valor"))
        for field in ("exp_madre", "exp_ref")
    ]
    references = (
        legacy.select("id", F.explode(F.array(*entries)).alias("r"))
        .select("id", "r.campo", "r.valor")
        .where(has_number(F.col("valor")))
    )
    missing = (
        references.groupBy("valor")
        .agg(F.count("*").alias("n"))
        .join(existing.select(F.col("expediente").alias("valor")), "valor", "left_anti")
    )
    label = F.when(F.col("campo") == "exp_madre", "madre").otherwise("referencia")
    return lookup_join(references, missing, ["valor"], "n").select(
        "id",
        "campo",
        "valor",
        F.concat(
            F.lit("Expediente de "), label, F.lit(" "), F.col("valor").cast("string"),
            F.lit(" no existe"),
        ).alias("mensaje"),
    )


def check_violations(target: DataFrame, *carry: Column) -> DataFrame:
    """Rows that break a column constraint, one row per broken constraint, with ``carry``."""
    c = F.col
    # A check holds when its value is null; NOT NULL is a constraint of its own.
    rules = {
        "check_sexo": ~F.coalesce(c("sexo").isin(*SEXO_VALUES), F.lit(True)),
        "check_estado": ~F.coalesce(c("estado").isin(*ESTADO_VALUES), F.lit(True)),
        "nombre_not_null": c("nombre").isNull(),
        "estado_not_null": c("estado").isNull(),
    }
    none = F.array().cast("array<string>")
    broken = F.concat(
        *[F.when(bad, F.array(F.lit(name))).otherwise(none) for name, bad in rules.items()]
    )
    return target.select("id", *carry, F.explode(broken).alias("restriccion"))
