"""Builders of the nested documents, and access to their fields."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron import model
from padron.functions import normalize as N
from padron.functions.asof import AsOf
from padron.functions.text import has_number, has_text, null_if_empty, words


def _document(schema: T.StructType, **fields: Column) -> Column:
    """Struct with every field of ``schema`` in order; fields not given are null."""
    return F.struct(
        *[
            fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def build_nombre(nombre: Column, apellido: Column, conyugue: Column | None = None) -> Column:
    return nombre_from_words(words(nombre), words(apellido), conyugue)


def nombre_from_words(given: Column, family: Column, conyugue: Column | None = None) -> Column:
    married = F.lit(None).cast("string") if conyugue is None else null_if_empty(conyugue)
    return _document(
        model.NOMBRE,
        **N.given_names(given),
        **N.family_names(family),
        apellido_casada=married,
    )


def build_contacto(
    telefono: Column, email: Column, direccion: Column, municipio: Column, depto: Column
) -> Column:
    """Contact document; the address part exists only when one of its values is set."""
    address = _document(
        model.DIRECCION, linea1=direccion, municipio_id=municipio, departamento_id=depto
    )
    any_set = has_text(direccion) | has_number(municipio) | has_number(depto)
    return _document(
        model.CONTACTO,
        telefono_principal=telefono,
        email=N.normalize_email(email),
        direccion=F.when(any_set, address),
    )


def build_referencias(
    padre: Column,
    madre: Column,
    exp_madre: Column,
    responsable: Column,
    parentesco: Column,
    dpi_responsable: Column,
    telefono_responsable: Column,
    exp_ref: Column,
    conyugue: Column,
    gemelo: Column,
) -> Column:
    """Family document; the responsible person exists only when named."""
    person = _document(
        model.RESPONSABLE,
        nombre=responsable,
        parentesco_id=parentesco,
        cui=N.normalize_cui(dpi_responsable),
        telefono=telefono_responsable,
        expediente=exp_ref,
    )
    return _document(
        model.REFERENCIAS,
        padre=padre,
        madre=madre,
        expediente_madre=exp_madre,
        responsable=F.when(has_text(responsable), person),
        conyugue=conyugue,
        es_gemelo=F.when(has_text(gemelo), N.is_yes(gemelo)),
    )


def build_datos_extra(
    nacionalidad: Column,
    depto_nac: Column,
    lugar_nacimiento: Column,
    estado_civil: Column,
    educacion: Column,
    pueblo: Column,
    idioma: Column,
    ocupacion: Column,
    fecha_defuncion: Column,
    hora_defuncion: Column,
) -> Column:
    return datos_extra_from_moment(
        nacionalidad,
        depto_nac,
        lugar_nacimiento,
        estado_civil,
        educacion,
        pueblo,
        idioma,
        ocupacion,
        N.parse_fecha_defuncion(fecha_defuncion, hora_defuncion),
    )


def datos_extra_from_moment(
    nacionalidad: Column,
    depto_nac: Column,
    lugar_nacimiento: Column,
    estado_civil: Column,
    educacion: Column,
    pueblo: Column,
    idioma: Column,
    ocupacion: Column,
    fecha_hora: Column,
) -> Column:
    """Additional data, given the ISO moment of death (null when alive or unreadable)."""
    return _document(
        model.DATOS_EXTRA,
        demograficos=_document(
            model.DEMOGRAFICOS,
            nacionalidad_id=nacionalidad,
            departamento_nacimiento_id=depto_nac,
            lugar_nacimiento_id=lugar_nacimiento,
            estado_civil_id=estado_civil,
            pueblo_id=pueblo,
            idioma_id=idioma,
        ),
        socioeconomicos=_document(
            model.SOCIOECONOMICOS, educacion_id=educacion, ocupacion=ocupacion
        ),
        defuncion=F.when(
            fecha_hora.isNotNull(), _document(model.DEFUNCION, fecha_hora=fecha_hora)
        ),
    )


def build_metadatos(row_id: Column, created_by: Column, duplicado: Column, as_of: AsOf) -> Column:
    return _document(
        model.METADATOS,
        sistema_origen=F.lit(model.LEGACY_SYSTEM),
        id_origen=row_id,
        creado_por=created_by,
        migrado_en=as_of.iso,
        version_migracion=F.lit(model.MIGRATION_VERSION),
        expediente_duplicado=duplicado,
        notas=F.when(duplicado, F.lit(model.DUPLICATE_NOTE)),
    )


# --------------------------------------------------------------------------- JSON form


def documents_to_json(rows: DataFrame, columns=tuple(model.DOCUMENTS)) -> DataFrame:
    """Replace document columns by JSON text that keeps explicit nulls."""
    return rows.withColumns(
        {c: F.to_json(F.col(c), {"ignoreNullFields": "false"}) for c in columns}
    )


def documents_from_json(rows: DataFrame, columns=tuple(model.DOCUMENTS)) -> DataFrame:
    """Replace JSON text by typed documents."""
    return rows.withColumns({c: F.from_json(F.col(c), model.DOCUMENTS[c]) for c in columns})


def json_field_text(doc: Column, *path: str) -> Column:
    """Scalar field of a typed document as text, like ``doc ->> key``."""
    for key in path:
        doc = doc.getField(key)
    return doc.cast("string")


def json_text_field(text: Column, *path: str) -> Column:
    """The same for a document held as JSON text."""
    return F.get_json_object(text, "$." + ".".join(path))


def _comparable(kind: T.DataType, wanted: Any) -> bool:
    """Whether a JSON scalar can equal a field of this type: kinds of value never mix."""
    if wanted is None:
        return True
    if isinstance(wanted, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(wanted, (int, float)):
        return isinstance(kind, T.NumericType)
    return isinstance(kind, T.StringType) and isinstance(wanted, str)


def json_contains(doc: Column, schema: T.StructType, pattern: dict[str, Any]) -> Column:
    """Whether a typed document contains ``pattern`` (``doc @> pattern``); never null.

    A null in the pattern matches a null field; a field the schema lacks matches nothing.
    """
    found = doc.isNotNull()
    for key, wanted in pattern.items():
        if key not in schema.fieldNames():
            return F.lit(False)
        field, kind = doc.getField(key), schema[key].dataType
        if isinstance(wanted, dict):
            if not isinstance(kind, T.StructType):
                return F.lit(False)
            found = found & json_contains(field, kind, wanted)
        else:
            found = found & (field.eqNullSafe(F.lit(wanted)) if _comparable(kind, wanted) else F.lit(False))
    return found
