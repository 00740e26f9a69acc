"""Schemas of the legacy (flat) and target (nested) tables."""

from __future__ import annotations

from pyspark.sql import types as T

_SCALARS = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(*fields: tuple) -> T.StructType:
    """Build a StructType from (name, type[, nullable]) tuples."""
    out = []
    for name, kind, *rest in fields:
        data_type = _SCALARS[kind] if isinstance(kind, str) else kind
        out.append(T.StructField(name, data_type, rest[0] if rest else True))
    return T.StructType(out)


LEGACY_SCHEMA = _struct(
    ("id", "int", False),
    ("expediente", "int"),
    ("nombre", "string"),
    ("apellido", "string"),
    ("dpi", "long"),
    ("pasaporte", "string"),
    ("sexo", "string"),
    ("nacimiento", "date"),
    ("nacionalidad", "int"),
    ("depto_nac", "int"),
    ("lugar_nacimiento", "int"),
    ("estado_civil", "int"),
    ("educacion", "int"),
    ("pueblo", "int"),
    ("idioma", "int"),
    ("ocupacion", "string"),
    ("direccion", "string"),
    ("municipio", "int"),
    ("depto", "int"),
    ("telefono", "string"),
    ("email", "string"),
    ("padre", "string"),
    ("madre", "string"),
    ("responsable", "string"),
    ("parentesco", "int"),
    ("dpi_responsable", "long"),
    ("telefono_responsable", "int"),
    ("estado", "string"),
    ("exp_madre", "int"),
    ("gemelo", "string"),
    ("conyugue", "string"),
    ("created_by", "string"),
    ("fecha_defuncion", "string"),
    ("hora_defuncion", "string"),
    ("exp_ref", "int"),
    ("created_at", "timestamp_ntz", False),
    ("update_at", "timestamp_ntz", False),
)

NOMBRE = _struct(
    ("primer_nombre", "string"),
    ("segundo_nombre", "string"),
    ("otros_nombres", "string"),
    ("primer_apellido", "string"),
    ("segundo_apellido", "string"),
    ("apellido_casada", "string"),
)

DIRECCION = _struct(
    ("linea1", "string"),
    ("linea2", "string"),
    ("municipio_id", "int"),
    ("departamento_id", "int"),
)

CONTACTO = _struct(
    ("telefono_principal", "string"),
    ("telefono_secundario", "string"),
    ("email", "string"),
    ("direccion", DIRECCION),
)

RESPONSABLE = _struct(
    ("nombre", "string"),
    ("parentesco_id", "int"),
    ("cui", "long"),
    ("telefono", "string"),
    ("expediente", "int"),
)

REFERENCIAS = _struct(
    ("padre", "string"),
    ("madre", "string"),
    ("expediente_madre", "int"),
    ("responsable", RESPONSABLE),
    ("conyugue", "string"),
    ("es_gemelo", "boolean"),
)

DEMOGRAFICOS = _struct(
    ("nacionalidad_id", "int"),
    ("departamento_nacimiento_id", "int"),
    ("lugar_nacimiento_id", "int"),
    ("estado_civil_id", "int"),
    ("pueblo_id", "int"),
    ("idioma_id", "int"),
)

SOCIOECONOMICOS = _struct(("educacion_id", "int"), ("ocupacion", "string"))

DEFUNCION = _struct(("fecha_hora", "string"), ("lugar", "string"), ("causa", "string"))

DATOS_EXTRA = _struct(
    ("demograficos", DEMOGRAFICOS),
    ("socioeconomicos", SOCIOECONOMICOS),
    ("defuncion", DEFUNCION),
    ("notas_clinicas", "string"),
)

METADATOS = _struct(
    ("sistema_origen", "string"),
    ("id_origen", "int"),
    ("creado_por", "string"),
    ("migrado_en", "string"),
    ("version_migracion", "string"),
    ("expediente_duplicado", "boolean"),
    ("notas", "string"),
)

DOCUMENTS = {
    "nombre": NOMBRE,
    "contacto": CONTACTO,
    "referencias": REFERENCIAS,
    "datos_extra": DATOS_EXTRA,
    "metadatos": METADATOS,
}

TARGET_SCHEMA = _struct(
    ("id", "long", False),
    ("expediente", "string"),
    ("cui", "long"),
    ("pasaporte", "string"),
    ("nombre", NOMBRE, False),
    ("sexo", "string"),
    ("fecha_nacimiento", "date"),
    ("contacto", CONTACTO),
    ("referencias", REFERENCIAS),
    ("datos_extra", DATOS_EXTRA),
    ("estado", "string", False),
    ("metadatos", METADATOS),
    ("creado_en", "timestamp", False),
    ("actualizado_en", "timestamp", False),
)

TARGET_COLUMNS = TARGET_SCHEMA.fieldNames()
IDENTIFIERS = ("expediente", "cui", "pasaporte")

# Fixed values shared with stored data.
LEGACY_SYSTEM = "mysql_legacy"
MIGRATION_VERSION = "1.0"
DUPLICATE_NOTE = "Expediente marcado como duplicado o nulo"
TIME_ZONE = "America/Guatemala"
SEXO_VALUES = ("M", "F", "NF")
ESTADO_VALUES = ("V", "F")
