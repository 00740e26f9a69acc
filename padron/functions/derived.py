"""Columns computed from a record: names, ages, flags, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron import model
from padron.functions.asof import AsOf
from padron.functions.normalize import is_yes
from padron.functions.text import div, has_text, null_if_empty

NO_NAME = "Sin nombre"


# --------------------------------------------------------------------------- target rows


def nombre_completo(nombre: Column) -> Column:
    parts = [null_if_empty(nombre.getField(f)) for f in model.NOMBRE.fieldNames()[:5]]
    married = nombre.getField("apellido_casada")
    full = F.concat_ws(
        " ", *parts, F.when(has_text(married), F.concat(F.lit("de "), married))
    )
    return F.coalesce(null_if_empty(full), F.lit(NO_NAME))


def edad(nacimiento: Column, as_of: AsOf) -> Column:
    """Completed years."""
    today = as_of.today
    not_yet = (F.month(today) * 100 + F.day(today)) < (F.month(nacimiento) * 100 + F.day(nacimiento))
    return F.year(today) - F.year(nacimiento) - not_yet.cast("int")


def mayor_de_edad(nacimiento: Column, as_of: AsOf) -> Column:
    return edad(nacimiento, as_of) >= 18


def menor_de_edad(nacimiento: Column, as_of: AsOf) -> Column:
    return edad(nacimiento, as_of) < 18


def fallecido(estado: Column) -> Column:
    return F.coalesce(estado == "F", F.lit(False))


def telefono_principal(contacto: Column) -> Column:
    return contacto.getField("telefono_principal")


def email(contacto: Column) -> Column:
    return contacto.getField("email")


def direccion_linea1(contacto: Column) -> Column:
    return contacto.getField("direccion").getField("linea1")


def expediente_duplicado(metadatos: Column) -> Column:
    return F.coalesce(metadatos.getField("expediente_duplicado"), F.lit(False))


def id_origen(metadatos: Column) -> Column:
    return metadatos.getField("id_origen")


def enrich_response(rows: DataFrame, as_of: AsOf) -> DataFrame:
    """Rows with the two computed fields every read returns."""
    return rows.withColumns(
        {
            "nombre_completo": nombre_completo(F.col("nombre")),
            "edad": edad(F.col("fecha_nacimiento"), as_of),
        }
    )


def iso_in_zone(at: Column, zone: str = model.TIME_ZONE) -> Column:
    """ISO text of an instant with the offset of ``zone``; fractions only when not zero."""
    shifted = F.from_utc_timestamp(at, zone)
    minutes = div(F.unix_seconds(shifted) - F.unix_seconds(at), 60)
    offset = F.concat(
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(div(F.abs(minutes), 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"),
    )
    # Formatting reads an instant in the session's zone.
    return F.concat(iso_text(F.to_utc_timestamp(shifted, F.current_timezone())), offset)


def iso_text(moment: Column) -> Column:
    """ISO text of a timestamp; fractions only when not zero."""
    fraction = F.when(
        F.date_part(F.lit("SECONDS"), moment) % 1 != 0, F.date_format(moment, ".SSSSSS")
    ).otherwise(F.lit(""))
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), fraction)


def export_target(rows: DataFrame, as_of: AsOf, zone: str = model.TIME_ZONE) -> DataFrame:
    """Every stored field, dates as ISO text, plus four computed fields."""
    born = F.col("fecha_nacimiento")
    text = {
        "fecha_nacimiento": born.cast("string"),
        "creado_en": iso_in_zone(F.col("creado_en"), zone),
        "actualizado_en": iso_in_zone(F.col("actualizado_en"), zone),
    }
    return rows.select(
        *[text[c].alias(c) if c in text else F.col(c) for c in model.TARGET_COLUMNS],
        nombre_completo(F.col("nombre")).alias("nombre_completo"),
        edad(born, as_of).alias("edad"),
        mayor_de_edad(born, as_of).alias("mayor_de_edad"),
        fallecido(F.col("estado")).alias("fallecido"),
    )


# --------------------------------------------------------------------------- legacy rows


def nombre_completo_legacy(nombre: Column, apellido: Column) -> Column:
    full = F.concat_ws(" ", null_if_empty(nombre), null_if_empty(apellido))
    return F.coalesce(null_if_empty(full), F.lit(NO_NAME))


def fallecido_legacy(estado: Column) -> Column:
    return F.coalesce(F.upper(estado).isin("F", "FALLECIDO"), F.lit(False))


def has_13_characters(number: Column) -> Column:
    """Text form of exactly 13 characters, the minus sign counting as one; null for null."""
    return number.between(10**12, 10**13 - 1) | number.between(-(10**12) + 1, -(10**11))


def tiene_cui_valido(dpi: Column) -> Column:
    return F.coalesce(has_13_characters(dpi), F.lit(False))


def tiene_expediente(expediente: Column) -> Column:
    return F.coalesce(expediente > 0, F.lit(False))


def tiene_datos_defuncion(fecha_defuncion: Column) -> Column:
    return has_text(fecha_defuncion)


def es_gemelo(gemelo: Column) -> Column:
    return is_yes(gemelo)


def export_legacy(rows: DataFrame) -> DataFrame:
    """Every legacy field, dates as ISO text, plus four computed fields."""
    text = {
        "nacimiento": F.col("nacimiento").cast("string"),
        "created_at": iso_text(F.col("created_at")),
        "update_at": iso_text(F.col("update_at")),
    }
    return rows.select(
        *[text[c].alias(c) if c in text else F.col(c) for c in model.LEGACY_SCHEMA.fieldNames()],
        nombre_completo_legacy(F.col("nombre"), F.col("apellido")).alias("nombre_completo"),
        tiene_cui_valido(F.col("dpi")).alias("cui_valido"),
        fallecido_legacy(F.col("estado")).alias("fallecido"),
        es_gemelo(F.col("gemelo")).alias("es_gemelo_flag"),
    )
