"""Rules of the request and response records: types, lengths, ranges and coherence.

Every builder returns a list of ``field: message`` texts, the field empty for a rule on the
whole record; :func:`explode_errors` takes them apart. A field reports only the first of its
problems, and the rules on the whole record run only when no field has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron import model
from padron.functions.asof import AsOf
from padron.functions.derived import has_13_characters
from padron.functions.rules import EDAD_MAX, MARK, NAME_PATTERN, parse_moment
from padron.functions.text import has_number, has_text, is_one_of, null_if_empty, strip

SEPARATOR = " -> "
# Ends the field name of an error; never part of a name.
FIELD_END = ": "

# Texts of the built-in checks.
NOT_STRING = "Input should be a valid string"
NOT_BOOLEAN = "Input should be a valid boolean"
NOT_OBJECT = "Input should be a valid dictionary or object to extract fields from"
BAD_MOMENT = "Input should be a valid datetime"
BAD_EMAIL = "value is not a valid email address"
BAD_SEXO = "Input should be 'M', 'F' or 'NF'"
BAD_ESTADO = "Input should be 'V' or 'F'"
LETTERS = "Value error, Debe contener solo letras, espacios, guiones y apóstrofes"
PHONE = "Value error, Teléfono debe tener 8 dígitos"
CUI_LENGTH = "Value error, CUI debe tener 13 dígitos"
CUI_DIGITS = "Value error, CUI debe contener solo números"
BORN_FUTURE = "Value error, Fecha de nacimiento no puede ser futura"
BORN_OLD = f"Value error, Fecha de nacimiento muy antigua (máx {EDAD_MAX} años)"
DEATH_FUTURE = "Value error, Fecha de defunción no puede ser futura"
NO_IDENTIFIER = (
    "Value error, Debe proporcionar al menos un identificador (expediente, CUI o pasaporte)"
)
NOT_NULL = "no admite nulos"
DEATH_MISSING = "Value error, Paciente fallecido debe tener datos de defunción"
DEATH_UNEXPECTED = "Value error, Paciente vivo no puede tener datos de defunción"
# Domains that never receive mail.
RESERVED_DOMAINS = ("arpa", "invalid", "local", "localhost", "onion", "test")

_ATOM = r"[\p{L}\p{Nd}!#$%&'*+/=?^_`{|}~-]+"
# A label has at most 63 characters, a domain 253.
_LABEL = r"[\p{L}\p{Nd}]([\p{L}\p{Nd}-]{0,61}[\p{L}\p{Nd}])?"
_EMAIL = rf"^{_ATOM}(\.{_ATOM})*@(?=.{{1,253}}\z)({_LABEL}\.)+{_LABEL}\z"


def too_long(n: int) -> str:
    return f"String should have at most {n} characters"


def too_short(n: int) -> str:
    return f"String should have at least {n} character{'' if n == 1 else 's'}"


def _at_least(n: int) -> str:
    return f"Input should be greater than or equal to {n}"


def _errors(*fields: tuple[str, Column]) -> Column:
    """Text of the (field, message) pairs whose message is not null, each pair mentioned once;
    :func:`error_list` turns it into a list."""
    return F.concat_ws(MARK, *[F.concat(F.lit(name + FIELD_END), m) for name, m in fields])


def error_list(text: Column) -> Column:
    return F.array_remove(F.split(text, MARK), "")


def explode_errors(rows: DataFrame, *keep: str) -> DataFrame:
    """One (campo, mensaje) row per error, with the columns to keep.

    The outer form of ``explode`` makes Spark leave the list alone; for the inner one it
    would add a filter on its size and evaluate all rules a second time to apply it.
    """
    error = F.col("_error")
    return (
        rows.select(*keep, F.explode_outer("errores").alias("_error"))
        .where(error.isNotNull())
        .select(
            *keep,
            F.substring_index(error, FIELD_END, 1).alias("campo"),
            F.substring(
                error, F.instr(error, FIELD_END) + len(FIELD_END), F.length(error)
            ).alias("mensaje"),
        )
    )


def _first(*checks: tuple[Column, str]) -> Column:
    """Message of the first failed check, else null."""
    out = None
    for bad, text in checks:
        out = F.when(bad, F.lit(text)) if out is None else out.when(bad, F.lit(text))
    return out


def _lengths(c: Column, low: int | None, high: int | None) -> list[tuple[Column, str]]:
    checks = []
    if low:
        checks.append((F.length(c) < low, too_short(low)))
    if high:
        checks.append((F.length(c) > high, too_long(high)))
    return checks


def text_rule(c: Column, high: int, low: int | None = None, required: bool = False) -> Column:
    missing = [(c.isNull(), NOT_STRING)] if required else []
    return _first(*missing, *_lengths(c, low, high))


def id_rule(c: Column) -> Column:
    return _first((c < 1, _at_least(1)))


def name_rule(c: Column, required: bool) -> Column:
    missing = [(c.isNull(), NOT_STRING)] if required else []
    return _first(
        *missing, *_lengths(c, 1 if required else None, 100), (~c.rlike(NAME_PATTERN), LETTERS)
    )


def phone_rule(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\P{Nd}+", "")
    return _first(*_lengths(c, 8, 20), (F.length(digits) != 8, PHONE))


def email_rule(c: Column) -> Column:
    """Well-formed address: dotted atoms, a domain with a dot, lengths, no reserved domain."""
    domain = F.lower(F.substring_index(c, "@", -1))
    top = F.substring_index(domain, ".", -1)
    ok = (
        c.rlike(_EMAIL)
        & (F.length(F.substring_index(c, "@", 1)) <= 64)
        & (F.length(c) <= 254)
        & ~top.rlike(r"^[0-9]+\z")
        & ~top.isin(*RESERVED_DOMAINS)
    )
    return _first((~ok, BAD_EMAIL))


def cui_rule(c: Column, digits: bool = True) -> Column:
    """Length of the text form, then (where asked) that a sign does not make it up."""
    sign = [(c < 0, CUI_DIGITS)] if digits else []
    return _first((~has_13_characters(c), CUI_LENGTH), *sign)


def birth_rule(c: Column, as_of: AsOf) -> Column:
    return _first((c > as_of.today, BORN_FUTURE), (c < as_of.years_ago(EDAD_MAX), BORN_OLD))


# --------------------------------------------------------------------------- documents


def _named(prefix: str, rules: dict[str, Column]) -> list[tuple[str, Column]]:
    return [(f"{prefix}{SEPARATOR}{f}" if prefix else f, m) for f, m in rules.items()]


def _nombre_rules(doc: Column, prefix: str) -> list[tuple[str, Column]]:
    required = ("primer_nombre", "primer_apellido")
    return _named(
        prefix,
        {f: name_rule(doc.getField(f), f in required) for f in model.NOMBRE.fieldNames()},
    )


def _direccion_rules(doc: Column, prefix: str) -> list[tuple[str, Column]]:
    g = doc.getField
    rules = {
        "linea1": F.when(doc.isNotNull(), text_rule(g("linea1"), 200, 1, required=True)),
        "linea2": text_rule(g("linea2"), 200),
        "municipio_id": id_rule(g("municipio_id")),
        "departamento_id": id_rule(g("departamento_id")),
    }
    return _named(prefix, rules)


def _contacto_rules(doc: Column, prefix: str) -> list[tuple[str, Column]]:
    g = doc.getField
    rules = {
        "telefono_principal": phone_rule(g("telefono_principal")),
        "telefono_secundario": phone_rule(g("telefono_secundario")),
        "email": email_rule(g("email")),
    }
    return _named(prefix, rules) + _direccion_rules(g("direccion"), _join(prefix, "direccion"))


def _responsable_rules(doc: Column, prefix: str) -> list[tuple[str, Column]]:
    g = doc.getField
    rules = {
        "nombre": F.when(doc.isNotNull(), text_rule(g("nombre"), 100, 1, required=True)),
        "parentesco_id": id_rule(g("parentesco_id")),
        "cui": cui_rule(g("cui"), digits=False),
        "telefono": text_rule(g("telefono"), 20, 8),
        "expediente": id_rule(g("expediente")),
    }
    return _named(prefix, rules)


def _referencias_rules(doc: Column, prefix: str) -> list[tuple[str, Column]]:
    g = doc.getField
    head = {
        "padre": text_rule(g("padre"), 100),
        "madre": text_rule(g("madre"), 100),
        "expediente_madre": id_rule(g("expediente_madre")),
    }
    tail = {
        "conyugue": text_rule(g("conyugue"), 100),
        "es_gemelo": _first((doc.isNotNull() & g("es_gemelo").isNull(), NOT_BOOLEAN)),
    }
    person = _responsable_rules(g("responsable"), _join(prefix, "responsable"))
    return _named(prefix, head) + person + _named(prefix, tail)


def _datos_extra_rules(doc: Column, prefix: str, as_of: AsOf) -> list[tuple[str, Column]]:
    demo, social = doc.getField("demograficos"), doc.getField("socioeconomicos")
    death = doc.getField("defuncion")
    text = death.getField("fecha_hora")
    moment = parse_moment(text)
    moment_rule = F.when(
        death.isNotNull(),
        _first((moment.isNull(), BAD_MOMENT), (moment > as_of.now, DEATH_FUTURE)),
    )
    return (
        _named(
            _join(prefix, "demograficos"),
            {f: id_rule(demo.getField(f)) for f in model.DEMOGRAFICOS.fieldNames()},
        )
        + _named(
            _join(prefix, "socioeconomicos"),
            {
                "educacion_id": id_rule(social.getField("educacion_id")),
                "ocupacion": text_rule(social.getField("ocupacion"), 100),
            },
        )
        + _named(
            _join(prefix, "defuncion"),
            {
                "fecha_hora": moment_rule,
                "lugar": text_rule(death.getField("lugar"), 200),
                "causa": text_rule(death.getField("causa"), 500),
            },
        )
        + _named(prefix, {"notas_clinicas": text_rule(doc.getField("notas_clinicas"), 1000)})
    )


def _metadatos_rules(doc: Column, prefix: str) -> list[tuple[str, Column]]:
    g = doc.getField
    return _named(
        prefix,
        {
            "sistema_origen": text_rule(g("sistema_origen"), 50),
            "creado_por": text_rule(g("creado_por"), 50),
            "migrado_en": _first(
                (g("migrado_en").isNotNull() & parse_moment(g("migrado_en")).isNull(), BAD_MOMENT)
            ),
            "version_migracion": text_rule(g("version_migracion"), 20),
            "expediente_duplicado": _first(
                (doc.isNotNull() & g("expediente_duplicado").isNull(), NOT_BOOLEAN)
            ),
            "notas": text_rule(g("notas"), 500),
        },
    )


def _join(*parts: str) -> str:
    return SEPARATOR.join(p for p in parts if p)


def nombre_errors(doc: Column, prefix: str = "") -> Column:
    return error_list(_errors(*_nombre_rules(doc, prefix)))


def direccion_errors(doc: Column, prefix: str = "") -> Column:
    return error_list(_errors(*_direccion_rules(doc, prefix)))


def contacto_errors(doc: Column, prefix: str = "") -> Column:
    return error_list(_errors(*_contacto_rules(doc, prefix)))


def responsable_errors(doc: Column, prefix: str = "") -> Column:
    return error_list(_errors(*_responsable_rules(doc, prefix)))


def referencias_errors(doc: Column, prefix: str = "") -> Column:
    return error_list(_errors(*_referencias_rules(doc, prefix)))


def datos_extra_errors(doc: Column, as_of: AsOf, prefix: str = "") -> Column:
    return error_list(_errors(*_datos_extra_rules(doc, prefix, as_of)))


def metadatos_errors(doc: Column, prefix: str = "") -> Column:
    return error_list(_errors(*_metadatos_rules(doc, prefix)))


# --------------------------------------------------------------------------- cleaned values


def clean_nombre(doc: Column) -> Column:
    """Name document with every part stripped."""
    return F.when(
        doc.isNotNull(),
        F.struct(*[strip(doc.getField(f)).alias(f) for f in model.NOMBRE.fieldNames()]),
    )


def clean_contacto(doc: Column) -> Column:
    """Contact document with phones reduced to digits and the mail domain in lower case."""
    mail = doc.getField("email")
    clean = {
        f: F.regexp_replace(doc.getField(f), r"\P{Nd}+", "")
        for f in ("telefono_principal", "telefono_secundario")
    }
    clean["email"] = F.concat(
        F.substring_index(mail, "@", 1), F.lit("@"), F.lower(F.substring_index(mail, "@", -1))
    )
    return F.when(
        doc.isNotNull(),
        F.struct(
            *[clean.get(f, doc.getField(f)).alias(f) for f in model.CONTACTO.fieldNames()]
        ),
    )


# --------------------------------------------------------------------------- whole records


def identifier_present(expediente: Column, cui: Column, pasaporte: Column) -> Column:
    return has_text(expediente) | has_number(cui) | has_text(pasaporte)


def scalar_rules(as_of: AsOf) -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("expediente", text_rule(c("expediente"), 20)),
        ("cui", cui_rule(c("cui"))),
        ("pasaporte", text_rule(c("pasaporte"), 50)),
        ("sexo", _first((~is_one_of(c("sexo"), model.SEXO_VALUES), BAD_SEXO))),
        ("fecha_nacimiento", birth_rule(c("fecha_nacimiento"), as_of)),
        ("estado", _first((~is_one_of(c("estado"), model.ESTADO_VALUES), BAD_ESTADO))),
    ]


def death_rule(estado: Column, datos_extra: Column) -> Column:
    """A deceased person needs data of death, a living one must not have any."""
    has_death = datos_extra.getField("defuncion").isNotNull()
    dead = F.coalesce(estado == "F", F.lit(False))
    return _first((dead & ~has_death, DEATH_MISSING), (~dead & has_death, DEATH_UNEXPECTED))


def paciente_errors(as_of: AsOf) -> Column:
    """Scalar fields and the identifier rule of a record, without its documents."""
    c = F.col
    none_given = ~identifier_present(c("expediente"), c("cui"), c("pasaporte"))
    return _fields_else_whole(
        _errors(*scalar_rules(as_of)), _errors(("", _first((none_given, NO_IDENTIFIER))))
    )


def _fields_else_whole(fields: Column, whole: Column) -> Column:
    """Errors of the fields; those of the record as a whole only when there are none."""
    return error_list(F.coalesce(null_if_empty(fields), whole))


def update_errors(mask: Column, as_of: AsOf) -> Column:
    """Rules of a partial record: only the fields named in ``mask`` are looked at.

    Birth dates are not checked, nor is the sign of an id. A field may be given as null unless
    its column is not nullable.
    """
    c = F.col
    rules = [
        ("expediente", text_rule(c("expediente"), 20)),
        ("cui", cui_rule(c("cui"), digits=False)),
        ("pasaporte", text_rule(c("pasaporte"), 50)),
        ("sexo", _first((~c("sexo").isin(*model.SEXO_VALUES), BAD_SEXO))),
        ("estado", _first((~c("estado").isin(*model.ESTADO_VALUES), BAD_ESTADO))),
    ]
    documents = {
        "nombre": _nombre_rules(c("nombre"), "nombre"),
        "contacto": _contacto_rules(c("contacto"), "contacto"),
        "referencias": _referencias_rules(c("referencias"), "referencias"),
        "datos_extra": _datos_extra_rules(c("datos_extra"), "datos_extra", as_of),
    }
    for field, doc_rules in documents.items():
        rules += [(name, F.when(c(field).isNotNull(), m)) for name, m in doc_rules]
    # Accepted by the form, refused by the table.
    for field in ("nombre", "estado"):
        rules.append((field, _first((c(field).isNull(), NOT_NULL))))
    return error_list(
        _errors(
            *[
                (name, F.when(F.array_contains(mask, name.split(SEPARATOR)[0]), m))
                for name, m in rules
            ]
        )
    )


def record_errors(rows: DataFrame, as_of: AsOf, metadatos: bool = True) -> DataFrame:
    """Rows plus ``errores``: everything a full record breaks."""
    c = F.col
    has = {r[0]: r for r in scalar_rules(as_of)}
    rules = [
        has["expediente"],
        has["cui"],
        has["pasaporte"],
        ("nombre", _first((c("nombre").isNull(), NOT_OBJECT))),
        *[
            (n, F.when(c("nombre").isNotNull(), m))
            for n, m in _nombre_rules(c("nombre"), "nombre")
        ],
        has["sexo"],
        has["fecha_nacimiento"],
        *_contacto_rules(c("contacto"), "contacto"),
        *_referencias_rules(c("referencias"), "referencias"),
        *_datos_extra_rules(c("datos_extra"), "datos_extra", as_of),
        has["estado"],
    ]
    if metadatos:
        rules += _metadatos_rules(c("metadatos"), "metadatos")
    none_given = ~identifier_present(c("expediente"), c("cui"), c("pasaporte"))
    whole = F.coalesce(
        _first((none_given, NO_IDENTIFIER)), death_rule(c("estado"), c("datos_extra"))
    )
    # Two projections: the second reads the text of the field errors instead of repeating it.
    return (
        rows.withColumns({"_fields": _errors(*rules), "_whole": _errors(("", whole))})
        .withColumn("errores", _fields_else_whole(c("_fields"), c("_whole")))
        .drop("_fields", "_whole")
    )


def response_conformance(rows: DataFrame, as_of: AsOf) -> DataFrame:
    """Stored rows that break the read contract, counted by field and message."""
    return (
        explode_errors(record_errors(rows, as_of))
        .groupBy("campo", "mensaje")
        .agg(F.count("*").alias("filas"))
    )
