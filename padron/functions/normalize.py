"""Scalar normalisers: one Column in, one Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from padron.functions.text import is_one_of, null_if_empty, strip, words

# Accepted spellings in the legacy table.
MALE_WORDS = ("M", "MASCULINO", "HOMBRE")
FEMALE_WORDS = ("F", "FEMENINO", "MUJER")
DECEASED_WORDS = ("F", "FALLECIDO", "MUERTO", "DEAD")
EMPTY_EMAIL_WORDS = ("", "n/a", "na", "null", "none")
YES_WORDS = ("SI", "S", "YES", "Y", "1")

# A positive id of exactly 13 digits, as a number range: no text form, and the comparison
# reaches the file or database scan.
CUI_MIN, CUI_MAX = 10**12, 10**13 - 1

_YEAR_FIRST = r"^(?!0000)[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}$"
_DAY_FIRST = r"^[0-9]{1,2}([-/])[0-9]{1,2}\1(?!0000)[0-9]{4}$"


def normalize_cui(dpi: Column) -> Column:
    """The id when it is a positive 13-digit number, else null."""
    return F.when(dpi.between(CUI_MIN, CUI_MAX), dpi)


def is_expediente_invalid(expediente: Column) -> Column:
    """Missing file number: null or zero."""
    return expediente.isNull() | (expediente == 0)


def normalize_expediente(expediente: Column, row_id: Column) -> Column:
    """File number as text; rows without one get ``DUP-<id>``."""
    return F.when(
        is_expediente_invalid(expediente), F.concat(F.lit("DUP-"), row_id.cast("string"))
    ).otherwise(expediente.cast("string"))


def normalize_sexo(sexo: Column) -> Column:
    word = F.upper(strip(sexo))
    return (
        F.when(word.isin(*MALE_WORDS), F.lit("M"))
        .when(word.isin(*FEMALE_WORDS), F.lit("F"))
        .otherwise(F.lit("NF"))
    )


def normalize_estado(estado: Column) -> Column:
    return F.when(F.upper(strip(estado)).isin(*DECEASED_WORDS), F.lit("F")).otherwise(F.lit("V"))


def normalize_email(email: Column) -> Column:
    """Trimmed lower-case address; placeholders become null. The form is not checked here."""
    clean = F.lower(strip(email))
    return F.when(~clean.isin(*EMPTY_EMAIL_WORDS), clean)


def parse_fecha(fecha: Column) -> Column:
    """Date from ``Y-m-d``, ``d/m/Y``, ``Y/m/d`` or ``d-m-Y`` text; null when it is none of them.

    The digit widths are checked first: a bare cast would also take ``1999-1`` or longer fields.
    """
    text = strip(fecha)
    dashed = F.translate(text, "/", "-")
    parts = F.split(dashed, "-")
    iso = F.when(text.rlike(_YEAR_FIRST), dashed).when(
        text.rlike(_DAY_FIRST), F.concat_ws("-", F.get(parts, 2), F.get(parts, 1), F.get(parts, 0))
    )
    return iso.try_cast("date")


def parse_fecha_defuncion(fecha: Column, hora: Column) -> Column:
    """ISO text of date and time of death, midnight when there is no time."""
    return F.concat(
        parse_fecha(fecha).cast("string"), F.lit("T"), F.coalesce(hora, F.lit("00:00:00"))
    )


def split_nombres(nombre: Column) -> dict[str, Column]:
    """First, second and remaining given names."""
    return given_names(words(nombre))


def given_names(parts: Column) -> dict[str, Column]:
    """Given names from the words of the text."""
    return {
        "primer_nombre": null_if_empty(F.get(parts, 0)),
        "segundo_nombre": F.get(parts, 1),
        "otros_nombres": _rest(parts, 2),
    }


def split_apellidos(apellido: Column) -> dict[str, Column]:
    """First family name and the remaining ones."""
    return family_names(words(apellido))


def family_names(parts: Column) -> dict[str, Column]:
    """Family names from the words of the text."""
    return {"primer_apellido": null_if_empty(F.get(parts, 0)), "segundo_apellido": _rest(parts, 1)}


def _rest(parts: Column, start: int) -> Column:
    return F.when(
        F.size(parts) > start, F.array_join(F.slice(parts, start + 1, F.size(parts)), " ")
    )


def clean_telefono(telefono: Column) -> Column:
    """Digits of a phone number; null when there are none."""
    return null_if_empty(F.regexp_replace(telefono, r"\P{Nd}+", ""))


def is_yes(c: Column) -> Column:
    """Affirmative word in any case, not trimmed; false for null and empty."""
    return is_one_of(F.upper(c), YES_WORDS)
