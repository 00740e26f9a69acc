"""Business rules of a record. Each builder returns the list of messages a row earns.

A rule is a Column with a message, null where it holds, and appears once in the list it goes
into: rules are long expressions, and a second mention would double the generated code.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron import model
from padron.functions.asof import AsOf
from padron.functions.derived import has_13_characters
from padron.functions.text import (
    BLANK,
    digit_class,
    div,
    has_number,
    has_text,
    is_one_of,
    strip,
)

# Limits and forms of the stored data.
CUI_DIGITS = 13
PASAPORTE_MAX = 50
EXPEDIENTE_MAX = 20
NOMBRE_MAX = 100
TELEFONO_MAX = 20
EDAD_MAX = 150
NAME_PATTERN = rf"^[a-zA-ZáéíóúÁÉÍÓÚñÑüÜ{BLANK}'-]+$"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z"
LOCAL_PHONE_PATTERN = r"^[2-7][0-9]{7}\z"
ISO_MOMENT_PATTERN = (
    r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(.[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?\z"
)

CHECK_FIELDS = (
    "identificadores",
    "nombre",
    "sexo",
    "fecha_nacimiento",
    "contacto",
    "referencias",
    "datos_extra",
    "estado",
)


# Joins the messages of a list; never part of one.
MARK = "\x1f"


def failed(bad: Column, message: str) -> Column:
    """The message where the condition holds, else null."""
    return F.when(bad, F.lit(message))


def message_list(*rules: Column) -> Column:
    """The messages that are not null, in order.

    Joining texts and splitting them again stays inside generated code, where a ``filter``
    over an array would leave it, and mentions each rule once.
    """
    return F.array_remove(F.split(F.concat_ws(MARK, *rules), MARK), "")


# --------------------------------------------------------------------------- identifiers


def expected_check_digit(cui: Column) -> Column:
    """Check digit of a 13-digit id; 10 means that no digit is valid.

    The twelve leading digits are weighted 2, 3, ... from right to left, modulo 11.
    """
    base = div(cui, 10)
    total = sum(((div(base, 10**k) % 10) * (k + 2) for k in range(1, 12)), (base % 10) * 2)
    return ((11 - total % 11) % 11).cast("int")


CHECK_DIGIT_MESSAGES = [
    *(f"Dígito verificador incorrecto (esperado: {d})" for d in range(10)),
    "CUI con dígito verificador inválido (módulo 10)",
]


def cui_check_message(cui: Column) -> Column:
    """Message of a 13-digit id whose last digit does not fit, else null."""
    expected = expected_check_digit(cui)
    texts = F.array(*[F.lit(m) for m in CHECK_DIGIT_MESSAGES])
    return F.when(expected != cui % 10, F.get(texts, expected))


def cui_message(cui: Column) -> Column:
    """First thing wrong with an id, null when absent or valid."""
    return (
        F.when(~has_13_characters(cui), F.lit(f"CUI debe tener {CUI_DIGITS} dígitos"))
        .when(cui < 0, F.lit("CUI debe contener solo números"))
        .when(cui.isNotNull(), cui_check_message(cui))
    )


def es_cui_valido(cui: Column) -> Column:
    return cui_message(cui).isNull()


def pasaporte_message(pasaporte: Column) -> Column:
    both = pasaporte.rlike(r"\p{L}") & pasaporte.rlike(f"[{digit_class()}]")
    return F.when(
        has_text(pasaporte),
        F.when(
            F.length(strip(pasaporte)) > PASAPORTE_MAX,
            F.lit(f"Pasaporte muy largo (máx {PASAPORTE_MAX})"),
        ).when(~both, F.lit("Pasaporte debe contener letras y números")),
    )


def expediente_message(expediente: Column) -> Column:
    form = rf"^[{BLANK}]*(DUP-|[{digit_class()}]+[{BLANK}]*\z)"
    return (
        F.when(~has_text(expediente), F.lit("Expediente es requerido"))
        .when(
            F.length(strip(expediente)) > EXPEDIENTE_MAX,
            F.lit(f"Expediente muy largo (máx {EXPEDIENTE_MAX})"),
        )
        .when(
            ~expediente.rlike(form),
            F.lit("Expediente debe ser numérico o formato DUP-{id}"),
        )
    )


def identifier_messages(e: Column, c: Column, p: Column) -> Column:
    """List of the messages of the three identifiers, plus one when all of them fail."""
    all_bad = e.isNotNull() & c.isNotNull() & p.isNotNull()
    return message_list(
        e, c, p, failed(all_bad, "Debe proporcionar al menos un identificador válido")
    )


def check_identificadores(rows: DataFrame, expediente: str, cui: str, pasaporte: str) -> DataFrame:
    """Rows plus ``valido, errores``. Only a row whose three identifiers all fail is invalid;
    an absent id or passport counts as valid, so a wrong id alone never fails here."""
    e, c, p = F.col("_e"), F.col("_c"), F.col("_p")
    return (
        rows.withColumns(
            {
                "_e": expediente_message(F.col(expediente).cast("string")),
                "_c": cui_message(F.col(cui)),
                "_p": pasaporte_message(F.col(pasaporte)),
            }
        )
        .withColumns(
            {
                "valido": e.isNull() | c.isNull() | p.isNull(),
                "errores": identifier_messages(e, c, p),
            }
        )
        .drop("_e", "_c", "_p")
    )


# --------------------------------------------------------------------------- documents


def nombre_messages(nombre: Column) -> Column:
    """Missing required parts, then length and alphabet of each part.

    A missing document counts as one that is not an object.
    """
    found = [failed(nombre.isNull(), "Nombre debe ser un objeto JSON")]
    for field in ("primer_nombre", "primer_apellido"):
        absent = nombre.isNotNull() & ~has_text(nombre.getField(field))
        found.append(failed(absent, f"{field} es requerido"))
    for field in model.NOMBRE.fieldNames():
        value = nombre.getField(field)
        found.append(
            failed(F.length(value) > NOMBRE_MAX, f"{field} muy largo (máx {NOMBRE_MAX})")
        )
        # An empty text passes: only parts that say something are looked at.
        found.append(
            failed(~value.rlike(f"^$|{NAME_PATTERN}"), f"{field} contiene caracteres inválidos")
        )
    return message_list(*found)


def sexo_messages(sexo: Column) -> Column:
    return message_list(
        failed(~is_one_of(sexo, model.SEXO_VALUES), "Sexo debe ser uno de: M, F, NF")
    )


def fecha_nacimiento_messages(fecha: Column, as_of: AsOf) -> Column:
    return message_list(
        failed(fecha > as_of.today, "Fecha de nacimiento no puede ser futura"),
        failed(
            fecha < as_of.years_ago(EDAD_MAX),
            f"Fecha de nacimiento muy antigua (máx {EDAD_MAX} años)",
        ),
    )


def contacto_messages(contacto: Column, local_phone: bool = False) -> Column:
    """Phone length, address form, first line of an address.

    ``local_phone`` adds a check of the national eight-digit form, off by default.
    """
    phone, mail = contacto.getField("telefono_principal"), contacto.getField("email")
    address = contacto.getField("direccion")
    found = [
        failed(F.length(phone) > TELEFONO_MAX, f"Teléfono muy largo (máx {TELEFONO_MAX})"),
        failed(~mail.rlike(f"^$|{EMAIL_PATTERN}"), "Formato de email inválido"),
        failed(
            address.isNotNull() & ~has_text(address.getField("linea1")),
            "Dirección debe incluir al menos linea1",
        ),
    ]
    if local_phone:
        found.insert(
            1, failed(~phone.rlike(f"^$|{LOCAL_PHONE_PATTERN}"), "Formato de teléfono inválido")
        )
    return message_list(*found)


def estado_messages(estado: Column) -> Column:
    return message_list(
        failed(~is_one_of(estado, model.ESTADO_VALUES), "Estado debe ser uno de: V, F")
    )


def referencias_messages(referencias: Column) -> Column:
    """Id of the responsible person. ``es_gemelo`` is boolean by schema; for untyped
    documents see :func:`es_gemelo_type_messages`."""
    cui = referencias.getField("responsable").getField("cui")
    problem = F.when(has_number(cui), cui_message(cui))
    return message_list(F.concat(F.lit("CUI del responsable: "), problem))


def es_gemelo_type_messages(doc: Column) -> Column:
    """Type of ``es_gemelo`` in a JSON document given as a variant."""
    kind = F.schema_of_variant(F.try_variant_get(doc, "$.es_gemelo", "variant"))
    return message_list(
        failed(~kind.isin("BOOLEAN", "VOID"), "es_gemelo debe ser true o false")
    )


def parse_moment(text: Column) -> Column:
    """Timestamp of an ISO text, null when it is not one."""
    return F.when(
        text.rlike(ISO_MOMENT_PATTERN), F.regexp_replace(text, ",", ".").try_cast("timestamp_ntz")
    )


def datos_extra_messages(datos: Column, as_of: AsOf) -> Column:
    text = datos.getField("defuncion").getField("fecha_hora")
    moment = parse_moment(text)
    return message_list(
        failed(
            has_text(text) & moment.isNull(), "Formato de fecha_hora de defunción inválido"
        ),
        failed(moment > as_of.now, "Fecha de defunción no puede ser futura"),
    )


# --------------------------------------------------------------------------- whole records


def check_record(rows: DataFrame, as_of: AsOf) -> DataFrame:
    """Rows plus ``errores`` (one list of messages per field) and ``es_valido``.

    A deceased person without data of death replaces whatever ``estado`` had to report.
    Failing rows stay.
    """
    c = F.col
    no_death = (c("estado") == "F") & c("datos_extra").getField("defuncion").isNull()
    lists = {
        "identificadores": F.when(c("valido"), F.array().cast("array<string>")).otherwise(
            c("errores")
        ),
        "nombre": nombre_messages(c("nombre")),
        "sexo": sexo_messages(c("sexo")),
        "fecha_nacimiento": fecha_nacimiento_messages(c("fecha_nacimiento"), as_of),
        "contacto": contacto_messages(c("contacto")),
        "referencias": referencias_messages(c("referencias")),
        "datos_extra": datos_extra_messages(c("datos_extra"), as_of),
        "estado": F.when(
            no_death, F.array(F.lit("Paciente fallecido debe tener fecha de defunción"))
        ).otherwise(estado_messages(c("estado"))),
    }
    checked = (
        check_identificadores(rows, "expediente", "cui", "pasaporte")
        .withColumn("errores", F.struct(*[lists[f].alias(f) for f in CHECK_FIELDS]))
        .drop("valido")
    )
    clean = reduce(and_, [F.size(c("errores").getField(f)) == 0 for f in CHECK_FIELDS])
    return checked.withColumn("es_valido", clean)


def legacy_messages(as_of: AsOf) -> Column:
    """Coherence of a legacy row before it is migrated."""
    c = F.col
    deceased = is_one_of(c("estado"), ("F", "FALLECIDO"))
    return message_list(
        failed(
            ~has_text(c("nombre")) & ~has_text(c("apellido")),
            "Debe tener al menos nombre o apellido",
        ),
        failed(c("created_at") > as_of.now, "Fecha de creación no puede ser futura"),
        failed(
            has_text(c("fecha_defuncion")) != deceased,
            "Inconsistencia: fecha de defunción no coincide con estado",
        ),
    )


def flatten_errors(rows: DataFrame, *keep: str) -> DataFrame:
    """One (campo, mensaje) row per message of ``check_record``, with the columns to keep."""
    fields = F.array(
        *[
            F.struct(F.lit(f).alias("campo"), F.col("errores").getField(f).alias("mensajes"))
            for f in CHECK_FIELDS
        ]
    )
    return (
        rows.select(*keep, F.explode(fields).alias("e"))
        .where(F.size("e.mensajes") > 0)
        .select(*keep, "e.campo", F.explode("e.mensajes").alias("mensaje"))
    )


def error_summary(errors: DataFrame) -> DataFrame:
    """How many rows earned each message."""
    return errors.groupBy("campo", "mensaje").agg(F.count("*").alias("filas"))
