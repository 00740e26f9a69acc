"""Counts and summaries, each from one pass over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.asof import AsOf
from padron.functions.derived import expediente_duplicado
from padron.operators.lookup import born_after_majority, is_migrated
from padron.operators.paging import row_count as count  # noqa: F401  (public name here)


def estadisticas(target: DataFrame) -> DataFrame:
    """General statistics. Rows that are neither M nor F count as not specified, and rows
    not marked deceased as alive, nulls included."""
    c = F.col
    raw = target.agg(
        F.count("*").alias("total_pacientes"),
        F.count_if(c("sexo") == "M").alias("masculino"),
        F.count_if(c("sexo") == "F").alias("femenino"),
        F.count_if(c("estado") == "F").alias("fallecidos"),
        F.count_if(c("cui").isNull()).alias("sin_cui"),
        F.count_if(expediente_duplicado(c("metadatos"))).alias("expedientes_duplicados"),
        F.count_if(is_migrated()).alias("registros_migrados"),
    )
    return report(raw)


def report(raw: DataFrame) -> DataFrame:
    """The statistics from the seven numbers that are counted."""
    c = F.col
    return raw.select(
        "total_pacientes",
        "masculino",
        "femenino",
        (c("total_pacientes") - c("masculino") - c("femenino")).alias("no_especificado"),
        (c("total_pacientes") - c("fallecidos")).alias("vivos"),
        "fallecidos",
        "sin_cui",
        "expedientes_duplicados",
        "registros_migrados",
        (c("total_pacientes") - c("registros_migrados")).alias("registros_nuevos"),
    )


def migration_status(legacy: DataFrame, target: DataFrame) -> DataFrame:
    """Source and target side by side, with the share migrated (half-even, two decimals)."""
    c = F.col
    counted = target.agg(
        F.count("*").alias("destino_total"), F.count_if(is_migrated()).alias("migrados")
    ).withColumn("origen_total", count(legacy).scalar())
    share = F.when(
        c("origen_total") > 0,
        F.bround(c("migrados").cast("double") / c("origen_total") * 100, 2),
    ).otherwise(F.lit(0.0))
    return counted.select(
        "origen_total",
        "destino_total",
        "migrados",
        (c("destino_total") - c("migrados")).alias("nuevos"),
        share.alias("porcentaje_migrado"),
        (c("origen_total") - c("migrados")).alias("pendientes"),
        (c("migrados") >= c("origen_total")).alias("completado"),
    )


def counts_by_system(legacy: DataFrame, target: DataFrame) -> DataFrame:
    return count(legacy).select(
        F.col("total").alias("origen_total"), count(target).scalar().alias("destino_total")
    )


def total_menores(target: DataFrame, as_of: AsOf) -> DataFrame:
    return target.agg(F.count_if(born_after_majority(as_of)).alias("total_menores"))


def total_fallecidos(target: DataFrame) -> DataFrame:
    return target.agg(F.count_if(F.col("estado") == "F").alias("total_fallecidos"))


def total_sin_cui(target: DataFrame) -> DataFrame:
    return target.agg(F.count_if(F.col("cui").isNull()).alias("total_sin_cui"))
