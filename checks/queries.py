"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import PARTS, candidates, legacy, scratch, soiled, table, updates, written
from padron import model
from padron.functions import contract, derived, documents, normalize, rules
from padron.functions.asof import AsOf
from padron.operators import chains, counters, identifiers, lookup, paging, quality, stats
from padron.operators.keyindex import build_index
from padron.operators.textindex import build_text_index
from padron.plans import maintenance, migration, stream
from padron.sources import tables

AS_OF = AsOf.at("2024-06-30")
# Rows created before this day were loaded by an earlier run.
EARLIER_RUN = "1999-01-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
c = F.col


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def joined(messages: Column) -> Column:
    return F.array_join(messages, "|")


def migrated(spark: SparkSession, sf: str) -> DataFrame:
    """The whole legacy table in target shape."""
    return migration.transform(legacy(spark, sf), AS_OF)


def stored(spark: SparkSession, sf: str) -> DataFrame:
    """The target as an earlier run left it: older rows, without the rejected ones."""

    def rows() -> DataFrame:
        older = legacy(spark, sf).where(c("created_at") < F.lit(EARLIER_RUN).cast("timestamp_ntz"))
        return plan(older, empty_target(spark)).loadable

    return written(spark, sf, "stored", rows)


def loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The target of a complete run, in the order of its id."""

    def rows() -> DataFrame:
        found = migration.assign_ids(full_run(spark, sf).loadable, empty_target(spark))
        return found.repartitionByRange(PARTS, "id").sortWithinPartitions("id")

    return written(spark, sf, "loaded", rows)


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Stored records of which some break each rule."""
    return soiled(migrated(spark, sf))


def plan(rows: DataFrame, target: DataFrame) -> migration.Migration:
    return migration.plan(rows, target, AS_OF, scratch(rows.sparkSession))


def empty_target(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], model.TARGET_SCHEMA)


def flat(rows: DataFrame) -> DataFrame:
    """Target rows with every document field as a column of its own."""
    contacto, refs, extra = c("contacto"), c("referencias"), c("datos_extra")
    address, person = contacto["direccion"], refs["responsable"]
    return rows.select(
        "id",
        "expediente",
        "cui",
        "pasaporte",
        "nombre.*",
        "sexo",
        c("fecha_nacimiento").cast("string").alias("fecha_nacimiento"),
        contacto["telefono_principal"].alias("telefono_principal"),
        contacto["email"].alias("email"),
        address.isNotNull().alias("con_direccion"),
        address["linea1"].alias("linea1"),
        address["municipio_id"].alias("municipio_id"),
        address["departamento_id"].alias("departamento_id"),
        refs["padre"].alias("padre"),
        refs["madre"].alias("madre"),
        refs["expediente_madre"].alias("expediente_madre"),
        person.isNotNull().alias("con_responsable"),
        person["nombre"].alias("resp_nombre"),
        person["parentesco_id"].alias("resp_parentesco_id"),
        person["cui"].alias("resp_cui"),
        person["telefono"].alias("resp_telefono"),
        person["expediente"].alias("resp_expediente"),
        refs["conyugue"].alias("conyugue"),
        refs["es_gemelo"].alias("es_gemelo"),
        "datos_extra.demograficos.*",
        "datos_extra.socioeconomicos.*",
        extra["defuncion"]["fecha_hora"].alias("fecha_hora"),
        "estado",
        "metadatos.*",
        text(c("creado_en")).alias("creado_en"),
        text(c("actualizado_en")).alias("actualizado_en"),
    )


def brief(rows: DataFrame) -> DataFrame:
    """The response fields that identify a person."""
    return derived.enrich_response(rows, AS_OF).select(
        "id", "expediente", "cui", "pasaporte", "sexo", "estado", "nombre_completo", "edad"
    )


def brief_page(page: DataFrame) -> DataFrame:
    extra = ("total", "page", "page_size", "total_pages")
    return derived.enrich_response(page, AS_OF).select(
        "id", "expediente", "nombre_completo", "edad", *extra
    )


# --------------------------------------------------------------------------- sources


@query
def scan_legacy(spark, sf):
    rows = migration.coerce(tables.conform_legacy(legacy(spark, sf))).drop("_error")
    return rows.withColumns(
        {
            "nacimiento": c("nacimiento").cast("string"),
            "created_at": text(c("created_at")),
            "update_at": text(c("update_at")),
        }
    )


@query
def scan_batch(spark, sf):
    return paging.slice_rows(legacy(spark, sf), 12_300, 500).select(
        "id", "expediente", "nombre", "dpi"
    )


@query
def slice_positions(spark, sf):
    """Slices across block edges, with the place of each row: ids spread over many blocks."""
    rows = legacy(spark, sf).select((c("id") * 97).alias("id"))
    near = paging.slice_rows(rows, 600, 150, position="posicion").withColumn("corte", F.lit("cerca"))
    far = paging.slice_rows(rows, 12_300, 2_000, position="posicion").withColumn("corte", F.lit("lejos"))
    return near.unionByName(far)


@query
def create_target(spark, sf):
    """A table made in the catalog, filled with a complete run, and described."""
    name, path = f"pacientes_{uuid.uuid4().hex}", scratch(spark).folder("catalog")
    tables.create_target(spark, name, path)
    tables.append_target(loaded(spark, sf), path)
    spark.catalog.refreshTable(name)
    kind = F.substring_index("tipo", "<", 1).alias("tipo")
    return tables.table_info(tables.create_target(spark, name, path)).select("posicion", "columna", kind, "total_registros")


@query
def table_exists(spark, sf):
    """Before and after a table is made of the loaded rows, with its rows."""
    name, path = f"pacientes_{uuid.uuid4().hex}", scratch(spark).folder("catalog")
    before = tables.table_exists(spark, name)
    tables.append_target(loaded(spark, sf), path)
    rows = tables.create_target(spark, name, path)
    after = tables.table_exists(spark, name)
    return rows.agg(F.count("*").alias("filas")).select(F.lit(before).alias("antes"), F.lit(after).alias("despues"), "filas")


@query
def scan_batch_after(spark, sf):
    return paging.slice_after(legacy(spark, sf), 777, 100).select("id", "expediente", "dpi")


@query
def scan_target(spark, sf):
    path = scratch(spark).folder("target")
    tables.append_target(migrated(spark, sf), path)
    return flat(tables.scan_target(spark, path))


@query
def append_target(spark, sf):
    path = scratch(spark).folder("target")
    rows = migrated(spark, sf)
    tables.append_target(lookup.fallecidos(rows), path)
    tables.append_target(rows.where(c("estado") == "V"), path)
    return (
        tables.scan_target(spark, path)
        .groupBy("estado", "sexo")
        .agg(F.count("*").alias("filas"), F.sum("id").alias("suma_id"))
    )


@query
def table_count(spark, sf):
    return tables.table_count(legacy(spark, sf))


@query
def table_info(spark, sf):
    return tables.table_info(tables.conform_legacy(legacy(spark, sf))).drop("admite_nulos")


@query
def counts_by_system(spark, sf):
    return stats.counts_by_system(legacy(spark, sf), stored(spark, sf))


# --------------------------------------------------------------------------- normalisers


def _scalar(build: Callable[[], Column], name: str) -> Query:
    return lambda spark, sf: legacy(spark, sf).select("id", build().alias(name))


QUERIES |= {
    "normalize_cui": _scalar(lambda: normalize.normalize_cui(c("dpi")), "cui"),
    "normalize_expediente": _scalar(
        lambda: normalize.normalize_expediente(c("expediente"), c("id")), "expediente"
    ),
    "is_expediente_invalid": _scalar(
        lambda: normalize.is_expediente_invalid(c("expediente")), "invalido"
    ),
    "normalize_sexo": _scalar(lambda: normalize.normalize_sexo(c("sexo")), "sexo"),
    "normalize_estado": _scalar(lambda: normalize.normalize_estado(c("estado")), "estado"),
    "normalize_email": _scalar(lambda: normalize.normalize_email(c("email")), "email"),
    "parse_fecha_defuncion": _scalar(
        lambda: normalize.parse_fecha_defuncion(c("fecha_defuncion"), c("hora_defuncion")),
        "fecha_hora",
    ),
    "clean_telefono": _scalar(lambda: normalize.clean_telefono(c("telefono")), "telefono"),
}


@query
def split_nombres(spark, sf):
    parts = normalize.split_nombres(c("nombre"))
    return legacy(spark, sf).select("id", *[v.alias(k) for k, v in parts.items()])


@query
def split_apellidos(spark, sf):
    parts = normalize.split_apellidos(c("apellido"))
    return legacy(spark, sf).select("id", *[v.alias(k) for k, v in parts.items()])


# --------------------------------------------------------------------------- documents


@query
def nombre_doc(spark, sf):
    doc = documents.build_nombre(c("nombre"), c("apellido"), c("conyugue"))
    return legacy(spark, sf).select("id", doc.alias("d")).select("id", "d.*")


@query
def contacto_doc(spark, sf):
    doc = documents.build_contacto(
        normalize.clean_telefono(c("telefono")),
        c("email"),
        c("direccion"),
        c("municipio"),
        c("depto"),
    )
    d = c("d")
    return legacy(spark, sf).select("id", doc.alias("d")).select(
        "id",
        d["telefono_principal"].alias("telefono_principal"),
        d["email"].alias("email"),
        d["direccion"].isNotNull().alias("con_direccion"),
        d["direccion"]["linea1"].alias("linea1"),
        d["direccion"]["municipio_id"].alias("municipio_id"),
        d["direccion"]["departamento_id"].alias("departamento_id"),
    )


@query
def referencias_doc(spark, sf):
    return flat(migrated(spark, sf)).select(
        "id",
        "padre",
        "madre",
        "expediente_madre",
        "con_responsable",
        "resp_nombre",
        "resp_parentesco_id",
        "resp_cui",
        "resp_telefono",
        "resp_expediente",
        "conyugue",
        "es_gemelo",
    )


@query
def datos_extra_doc(spark, sf):
    doc = documents.build_datos_extra(
        *[
            c(n)
            for n in (
                "nacionalidad",
                "depto_nac",
                "lugar_nacimiento",
                "estado_civil",
                "educacion",
                "pueblo",
                "idioma",
                "ocupacion",
                "fecha_defuncion",
                "hora_defuncion",
            )
        ]
    )
    return legacy(spark, sf).select("id", doc.alias("d")).select(
        "id",
        "d.demograficos.*",
        "d.socioeconomicos.*",
        c("d.defuncion.fecha_hora").alias("fecha_hora"),
    )


@query
def metadatos_doc(spark, sf):
    doc = documents.build_metadatos(
        c("id"), c("created_by"), normalize.is_expediente_invalid(c("expediente")), AS_OF
    )
    return legacy(spark, sf).select("id", doc.alias("d")).select("id", "d.*")


@query
def documents_to_json(spark, sf):
    return documents.documents_to_json(migrated(spark, sf)).select("id", *model.DOCUMENTS)


@query
def documents_from_json(spark, sf):
    return flat(documents.documents_from_json(documents.documents_to_json(migrated(spark, sf))))


@query
def json_field_text(spark, sf):
    rows = migrated(spark, sf)
    text_form = documents.documents_to_json(rows, ("contacto",))
    return text_form.select(
        "id",
        documents.json_field_text(c("nombre"), "primer_apellido").alias("primer_apellido"),
        documents.json_field_text(c("metadatos"), "expediente_duplicado").alias("duplicado"),
        documents.json_text_field(c("contacto"), "direccion", "municipio_id").alias("municipio"),
    )


@query
def json_contains(spark, sf):
    def has(column: str, pattern: dict) -> Column:
        return documents.json_contains(c(column), model.DOCUMENTS[column], pattern)

    return migrated(spark, sf).select(
        "id",
        has("nombre", {"primer_apellido": "Pérez"}).alias("es_perez"),
        has("referencias", {"responsable": {"parentesco_id": 1}, "es_gemelo": True}).alias(
            "gemelo_con_responsable"
        ),
        has("datos_extra", {"defuncion": None}).alias("sin_defuncion"),
        has("metadatos", {"otro": 1}).alias("campo_ajeno"),
    )


# --------------------------------------------------------------------------- derived columns


def _target(build: Callable[[], dict[str, Column]]) -> Query:
    return lambda spark, sf: migrated(spark, sf).select(
        "id", *[v.alias(k) for k, v in build().items()]
    )


def _legacy(build: Callable[[], dict[str, Column]]) -> Query:
    return lambda spark, sf: legacy(spark, sf).select(
        "id", *[v.alias(k) for k, v in build().items()]
    )


QUERIES |= {
    "nombre_completo": _target(
        lambda: {"nombre_completo": derived.nombre_completo(c("nombre"))}
    ),
    "nombre_completo_legacy": _legacy(
        lambda: {"nombre_completo": derived.nombre_completo_legacy(c("nombre"), c("apellido"))}
    ),
    "edad": _target(lambda: {"edad": derived.edad(c("fecha_nacimiento"), AS_OF)}),
    "mayor_de_edad": _target(
        lambda: {
            "mayor": derived.mayor_de_edad(c("fecha_nacimiento"), AS_OF),
            "menor": derived.menor_de_edad(c("fecha_nacimiento"), AS_OF),
        }
    ),
    "fallecido": _target(lambda: {"fallecido": derived.fallecido(c("estado"))}),
    "fallecido_legacy": _legacy(lambda: {"fallecido": derived.fallecido_legacy(c("estado"))}),
    "tiene_cui_valido": _legacy(lambda: {"valido": derived.tiene_cui_valido(c("dpi"))}),
    "tiene_expediente": _legacy(lambda: {"tiene": derived.tiene_expediente(c("expediente"))}),
    "tiene_datos_defuncion": _legacy(
        lambda: {"tiene": derived.tiene_datos_defuncion(c("fecha_defuncion"))}
    ),
    "es_gemelo": _legacy(lambda: {"gemelo": derived.es_gemelo(c("gemelo"))}),
    "contacto_accessors": _target(
        lambda: {
            "telefono_principal": derived.telefono_principal(c("contacto")),
            "email": derived.email(c("contacto")),
            "direccion_linea1": derived.direccion_linea1(c("contacto")),
        }
    ),
    "metadatos_accessors": _target(
        lambda: {
            "expediente_duplicado": derived.expediente_duplicado(c("metadatos")),
            "id_origen": derived.id_origen(c("metadatos")),
        }
    ),
}


@query
def export_target(spark, sf):
    rows = derived.export_target(loaded(spark, sf), AS_OF)
    return rows.select(
        "id",
        "expediente",
        "cui",
        "pasaporte",
        c("nombre")["primer_nombre"].alias("primer_nombre"),
        "sexo",
        "fecha_nacimiento",
        c("contacto")["email"].alias("email"),
        c("referencias")["padre"].alias("padre"),
        c("datos_extra")["socioeconomicos"]["ocupacion"].alias("ocupacion"),
        "estado",
        c("metadatos")["id_origen"].alias("id_origen"),
        "creado_en",
        "actualizado_en",
        "nombre_completo",
        "edad",
        "mayor_de_edad",
        "fallecido",
    )


@query
def export_legacy(spark, sf):
    return derived.export_legacy(legacy(spark, sf))


@query
def enrich_response(spark, sf):
    return brief(loaded(spark, sf))


# --------------------------------------------------------------------------- rules


def _dirty(build: Callable[[], dict[str, Column]]) -> Query:
    return lambda spark, sf: dirty(spark, sf).select(
        "id", *[v.alias(k) for k, v in build().items()]
    )


QUERIES |= {
    "validar_cui": _legacy(
        lambda: {
            "mensaje": rules.cui_message(c("dpi")),
            "es_valido": rules.es_cui_valido(c("dpi")),
        }
    ),
    "cui_check_digit": _target(
        lambda: {
            "esperado": rules.expected_check_digit(c("cui")),
            "mensaje": rules.cui_check_message(c("cui")),
        }
    ),
    "validar_pasaporte": _dirty(
        lambda: {"mensaje": rules.pasaporte_message(c("pasaporte"))}
    ),
    "validar_expediente": _dirty(
        lambda: {"mensaje": rules.expediente_message(c("expediente"))}
    ),
    "validar_nombre": _dirty(
        lambda: {"errores": joined(rules.nombre_messages(c("nombre")))}
    ),
    "validar_sexo": _legacy(lambda: {"errores": joined(rules.sexo_messages(c("sexo")))}),
    "validar_fecha_nacimiento": _dirty(
        lambda: {"errores": joined(rules.fecha_nacimiento_messages(c("fecha_nacimiento"), AS_OF))}
    ),
    "validar_contacto": _dirty(
        lambda: {
            "errores": joined(rules.contacto_messages(c("contacto"))),
            "con_telefono_local": joined(rules.contacto_messages(c("contacto"), True)),
        }
    ),
    "validar_estado": _legacy(lambda: {"errores": joined(rules.estado_messages(c("estado")))}),
    "validar_referencias": _dirty(
        lambda: {"errores": joined(rules.referencias_messages(c("referencias")))}
    ),
    "validar_datos_extra": _dirty(
        lambda: {"errores": joined(rules.datos_extra_messages(c("datos_extra"), AS_OF))}
    ),
    "validar_legacy": _legacy(lambda: {"errores": joined(rules.legacy_messages(AS_OF))}),
}


@query
def validar_identificadores(spark, sf):
    """The raw file number, id and passport of each row."""
    checked = rules.check_identificadores(legacy(spark, sf), "expediente", "dpi", "pasaporte")
    return checked.select("id", "valido", joined(c("errores")).alias("errores"))


@query
def validar_paciente_completo(spark, sf):
    checked = rules.check_record(dirty(spark, sf), AS_OF)
    return checked.select(
        "id", "es_valido", *[joined(c("errores")[f]).alias(f) for f in rules.CHECK_FIELDS]
    )


@query
def error_summary(spark, sf):
    checked = rules.check_record(dirty(spark, sf), AS_OF)
    return rules.error_summary(rules.flatten_errors(checked))


def _contract(source: Callable, key: str, build: Callable[[], Column]) -> Query:
    return lambda spark, sf: source(spark, sf).select(
        key, joined(build()).alias("errores")
    )


QUERIES |= {
    "schema_nombre": lambda spark, sf: candidates(spark, sf).select(
        "fila",
        joined(contract.nombre_errors(c("nombre"))).alias("errores"),
        contract.clean_nombre(c("nombre"))["primer_nombre"].alias("primer_nombre"),
    ),
    "schema_direccion": _contract(
        dirty, "id", lambda: contract.direccion_errors(c("contacto")["direccion"])
    ),
    "schema_contacto": lambda spark, sf: candidates(spark, sf).select(
        "fila",
        joined(contract.contacto_errors(c("contacto"))).alias("errores"),
        contract.clean_contacto(c("contacto"))["telefono_principal"].alias("telefono"),
        contract.clean_contacto(c("contacto"))["email"].alias("email"),
    ),
    "schema_responsable": _contract(
        dirty, "id", lambda: contract.responsable_errors(c("referencias")["responsable"])
    ),
    "schema_referencias": _contract(
        dirty, "id", lambda: contract.referencias_errors(c("referencias"))
    ),
    "schema_datos_extra": _contract(
        dirty, "id", lambda: contract.datos_extra_errors(c("datos_extra"), AS_OF)
    ),
    "schema_metadatos": _contract(
        dirty, "id", lambda: contract.metadatos_errors(c("metadatos"))
    ),
    "schema_paciente": _contract(candidates, "fila", lambda: contract.paciente_errors(AS_OF)),
    "schema_defuncion_coherente": lambda spark, sf: dirty(spark, sf).select(
        "id", contract.death_rule(c("estado"), c("datos_extra")).alias("mensaje")
    ),
    "schema_update": lambda spark, sf: updates(spark, sf).select(
        "orden", joined(contract.update_errors(c("campos"), AS_OF)).alias("errores")
    ),
}


@query
def es_gemelo_type(spark, sf):
    """Documents held as JSON text, with every kind of value for ``es_gemelo``."""
    kinds = F.expr("CASE id % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'null' WHEN 2 THEN '1' WHEN 3 THEN '\"si\"' WHEN 4 THEN '[]' END")
    text = F.when(kinds.isNull(), F.lit("{}")).otherwise(F.concat(F.lit('{"es_gemelo":'), kinds, F.lit("}")))
    found = rules.es_gemelo_type_messages(F.parse_json(text))
    return legacy(spark, sf).select("id", joined(found).alias("errores"))


@query
def response_conformance(spark, sf):
    return contract.response_conformance(loaded(spark, sf), AS_OF)


# --------------------------------------------------------------------------- quality


@query
def null_expedientes(spark, sf):
    return quality.null_expedientes(legacy(spark, sf))


@query
def duplicate_expedientes(spark, sf):
    return quality.duplicate_expedientes(legacy(spark, sf))


@query
def invalid_cui_count(spark, sf):
    return quality.invalid_cui_count(legacy(spark, sf))


@query
def source_check(spark, sf):
    return quality.source_check(legacy(spark, sf))


@query
def referential_integrity(spark, sf):
    return quality.referential_integrity(legacy(spark, sf))


@query
def mother_chains(spark, sf):
    """Besides those of the table, every record refers to a file further down, some in circles."""
    rows = legacy(spark, sf)
    number = F.col("expediente")
    further = F.when(number % 1000 < 20, number + 20 - F.when(number % 20 == 19, 39).otherwise(19)).when(number % 7 > 0, number - number % 7 - 1 + number % 2)
    return chains.chains(rows.withColumn("exp_madre", F.coalesce("exp_madre", further)), scratch(spark))


@query
def unique_violations(spark, sf):
    return identifiers.unique_violations(migrated(spark, sf))


@query
def check_violations(spark, sf):
    """The create requests against the constraints of the table."""
    rows = candidates(spark, sf).withColumn("id", c("fila"))
    return quality.check_violations(rows)


@query
def identifier_exists(spark, sf):
    return identifiers.identifier_exists(candidates(spark, sf), migrated(spark, sf), "fila")


@query
def identifier_index(spark, sf):
    """Requests against a stored index: loaded in two turns, then rows deleted and some given back."""
    rows, work = loaded(spark, sf), scratch(spark)
    index = build_index(rows.where("id % 2 = 0"), f"claves_{uuid.uuid4().hex}", work.folder("index"), buckets=8)
    index.add(rows.where("id % 2 = 1"), 1)
    gone = rows.where("id % 13 = 0")
    index.remove(gone, 2)
    index.add(gone.where("id % 39 = 0"), 3)
    return identifiers.identifier_exists(candidates(spark, sf), index, "fila")


@query
def identifiers_available(spark, sf):
    """Every stored record asks for its own identifiers again, as an update would."""
    rows = migrated(spark, sf)
    return identifiers.identifiers_available(
        rows.withColumn("propio", c("id")), rows, "id", "propio"
    )


# --------------------------------------------------------------------------- lookups


@query
def by_id(spark, sf):
    return flat(lookup.by_id(loaded(spark, sf), 1001))


@query
def by_ids(spark, sf):
    ids = table(spark, sf, "customer").select((c("c_custkey") * 3).alias("id"))
    return brief(lookup.by_ids(loaded(spark, sf), ids))


@query
def exists_id(spark, sf):
    ids = table(spark, sf, "customer").select((c("c_custkey") * 13).alias("id"))
    return lookup.exists_ids(loaded(spark, sf), ids)


@query
def by_expediente(spark, sf):
    return brief(lookup.by_expediente(loaded(spark, sf), "100321"))


@query
def by_cui(spark, sf):
    rows = loaded(spark, sf)
    valid = lookup.by_cui(rows, 1000000000009).withColumn("pedido", F.lit("valido"))
    wrong = lookup.by_cui(rows, 1000000000008).withColumn("pedido", F.lit("digito errado"))
    return valid.unionByName(wrong).select("pedido", "id", "cui")


@query
def by_pasaporte(spark, sf):
    return brief(lookup.by_pasaporte(loaded(spark, sf), "GT120"))


SEARCH = lookup.SearchParams(
    expediente="1",
    nombre="juan",
    apellido="pérez",
    sexo="M",
    estado="V",
    fecha_nacimiento_desde=date(1940, 1, 1),
    fecha_nacimiento_hasta=date(2015, 12, 31),
    page=2,
    page_size=20,
)


SEARCH_NAMES = lookup.SearchParams(nombre="JUAN", apellido="pérez")
SEARCH_WILDCARD = lookup.SearchParams(nombre="mar%a", apellido="garc_a", sexo="F")
SEARCH_SHORT = lookup.SearchParams(expediente="12", apellido="ez")


@query
def search(spark, sf):
    return brief_page(lookup.search_page(loaded(spark, sf), SEARCH))


@query
def search_all(spark, sf):
    return brief(lookup.search(loaded(spark, sf), SEARCH))


@query
def search_nombre_completo(spark, sf):
    return brief(lookup.search_nombre_completo(loaded(spark, sf), "garcía"))


def text_index(spark, rows):
    """Built in two turns."""
    index = build_text_index(rows.where("id % 2 = 0"), f"textos_{uuid.uuid4().hex}", scratch(spark).folder("texts"), buckets=8)
    index.add(rows.where("id % 2 = 1"))
    return index


@query
def search_text_index(spark, sf):
    """Forms with texts long enough for the index, one with a wildcard, one with a text too short."""
    rows = loaded(spark, sf)
    index = text_index(spark, rows)
    asked = lambda name, form: brief(index.search(rows, form)).withColumn("pedido", F.lit(name))
    return asked("nombres", SEARCH_NAMES).unionByName(asked("comodin", SEARCH_WILDCARD)).unionByName(asked("corto", SEARCH_SHORT))


@query
def search_nombre_text_index(spark, sf):
    rows = loaded(spark, sf)
    return brief(text_index(spark, rows).search_nombre_completo(rows, "garcía"))


@query
def fallecidos(spark, sf):
    return brief(lookup.fallecidos(loaded(spark, sf)))


@query
def por_sexo(spark, sf):
    return brief(lookup.por_sexo(loaded(spark, sf), "NF"))


@query
def por_rango_edad(spark, sf):
    return brief(lookup.por_rango_edad(loaded(spark, sf), 18, 40, AS_OF))


@query
def menores(spark, sf):
    return brief(lookup.menores(loaded(spark, sf), AS_OF))


@query
def menores_page(spark, sf):
    return brief_page(
        lookup.menores_page(loaded(spark, sf), paging.PageRequest(3, 25), AS_OF)
    )


@query
def sin_cui(spark, sf):
    return brief(lookup.sin_cui(loaded(spark, sf)))


@query
def expedientes_duplicados(spark, sf):
    return brief(lookup.expedientes_duplicados(loaded(spark, sf)))


@query
def migrados(spark, sf):
    return brief(lookup.migrados(loaded(spark, sf)))


@query
def list_page(spark, sf):
    return brief_page(lookup.list_page(loaded(spark, sf), paging.PageRequest(4, 50)))


@query
def list_page_deep(spark, sf):
    return brief_page(lookup.list_page(loaded(spark, sf), paging.PageRequest(100, 100)))


@query
def paginate(spark, sf):
    """The page record of the deceased, and of a page beyond the last."""
    total = paging.row_count(lookup.fallecidos(loaded(spark, sf)))
    first = paging.page_info(total, paging.PageRequest(1, 100))
    return first.unionByName(paging.page_info(total, paging.PageRequest(10**6, 7)))


# --------------------------------------------------------------------------- aggregates


@query
def count(spark, sf):
    return stats.count(loaded(spark, sf))


@query
def estadisticas(spark, sf):
    return stats.estadisticas(loaded(spark, sf))


def _counters(spark, sf) -> DataFrame:
    """The log of two loads and a delete."""
    path = scratch(spark).folder("contadores")
    rows = loaded(spark, sf)
    early = F.coalesce(c("creado_en") < F.lit(EARLIER_RUN).cast("timestamp"), F.lit(False))
    second = counters.counted(rows.where(~early), "carga-2")
    gone = table(spark, sf, "customer").select((c("c_custkey") * 13).alias("id"))
    for delta in (
        counters.counted(rows.where(early), "carga-1"),
        second,
        counters.changed(rows, _delete(spark, sf).rows, gone, "bajas"),
        second,
    ):
        counters.append_counts(delta, path)
    return counters.read_counts(spark, path)


@query
def estadisticas_counters(spark, sf):
    """From the log alone; the second load is logged twice, as after a crash."""
    return counters.estadisticas(_counters(spark, sf))


@query
def breakdown_counters(spark, sf):
    return counters.breakdown(_counters(spark, sf))


@query
def migration_status(spark, sf):
    return stats.migration_status(legacy(spark, sf), stored(spark, sf))


@query
def total_menores(spark, sf):
    return stats.total_menores(loaded(spark, sf), AS_OF)


@query
def total_fallecidos(spark, sf):
    return stats.total_fallecidos(loaded(spark, sf))


@query
def total_sin_cui(spark, sf):
    return stats.total_sin_cui(loaded(spark, sf))


# --------------------------------------------------------------------------- migration


@query
def transform(spark, sf):
    return flat(migrated(spark, sf))


@query
def warnings(spark, sf):
    return migration.warnings(legacy(spark, sf), AS_OF)


def raw_text(spark, sf) -> DataFrame:
    """The legacy table as loose text, with death dates in the column of births."""
    rows = legacy(spark, sf)
    return rows.select(
        *[
            (
                F.coalesce(c("fecha_defuncion"), c("nacimiento").cast("string"))
                if n == "nacimiento"
                else F.when(c("id") % 101 == 0, F.lit("sin dato")).otherwise(c(n).cast("string"))
                if n == "municipio"
                else c(n).cast("string")
            ).alias(n)
            for n in rows.columns
        ]
    )


@query
def transform_errors(spark, sf):
    return migration.transform_errors(migration.coerce(raw_text(spark, sf)), AS_OF)


def full_run(spark, sf) -> migration.Migration:
    return plan(legacy(spark, sf), empty_target(spark))


def second_run(spark, sf) -> migration.Migration:
    target = stored(spark, sf)
    return plan(migration.pending(legacy(spark, sf), target), target)


def broken_text(spark, sf) -> DataFrame:
    """Loose values with bad ids, numbers and dates among them, fractions where whole numbers
    belong, and rows that come two or three times, equal or with another occupation."""
    rows = raw_text(spark, sf)
    n = c("id").cast("int")
    again = F.when(n % 89 == 0, F.array(F.lit(""), F.lit(""), F.lit("~"))).when(n % 83 == 0, F.array(F.lit(""), F.lit("~")))
    each = rows.withColumn("_mark", F.explode(F.coalesce(again, F.array(F.lit("")))))
    return each.withColumns(
        {
            "dpi": F.when(n % 103 == 0, F.lit("sin dpi")).otherwise(c("dpi")),
            "ocupacion": F.when(c("_mark") != "", F.concat(F.coalesce("ocupacion", F.lit("")), "_mark")).otherwise(c("ocupacion")),
            "depto": c("depto").cast("double") + F.when(n % 79 == 0, F.lit(0.5)).otherwise(F.lit(0.0)),
            "id": F.when(n % 211 == 0, F.concat(F.lit("x-"), c("id"))).otherwise(c("id")),
        }
    ).drop("_mark")


@query
def migrate_broken(spark, sf):
    """A complete run over loose text, and one that repeats it: counters of both."""
    folder = scratch(spark).folder("migration")
    path = f"{folder}/target"
    tables.append_target(empty_target(spark), path)
    results = []
    for i in (1, 2):
        target = tables.scan_target(spark, path)
        done = migration.run(broken_text(spark, sf), target, path, f"{folder}/run{i}", AS_OF)
        results.append(done.withColumn("corrida", F.lit(i)))
    return results[0].unionByName(results[1])


@query
def migrate_broken_errors(spark, sf):
    return plan(broken_text(spark, sf), empty_target(spark)).errors.select("id_mysql", "expediente", "error", "tipo")


@query
def batch_summary_broken(spark, sf):
    return migration.batch_summary(plan(broken_text(spark, sf), empty_target(spark)))


@query
def load_errors(spark, sf):
    return second_run(spark, sf).rejects


@query
def migrate_batch(spark, sf):
    work = scratch(spark)
    run = migration.plan_batch(legacy(spark, sf), empty_target(spark), 500, 400, AS_OF, work)
    beyond = migration.plan_batch(legacy(spark, sf), empty_target(spark), 10**9, 400, AS_OF, work)
    return migration.batch_result(run, 500, 400).unionByName(
        migration.batch_result(beyond, 10**9, 400)
    )


@query
def migrate_all(spark, sf):
    """Rows a first complete run loads."""
    rows = full_run(spark, sf).loadable
    return flat(migration.assign_ids(rows, empty_target(spark), dense=True))


@query
def migrate_and_resume(spark, sf):
    """Two complete runs that write: the second finds only the rows refused before."""
    folder = scratch(spark).folder("migration")
    path = f"{folder}/target"
    rows = legacy(spark, sf)
    tables.append_target(empty_target(spark), path)
    results = []
    for i in (1, 2):
        target = tables.scan_target(spark, path)
        done = migration.run(rows, target, path, f"{folder}/run{i}", AS_OF)
        results.append(done.withColumn("corrida", F.lit(i)))
    return results[0].unionByName(results[1])


@query
def batch_summary(spark, sf):
    return migration.batch_summary(full_run(spark, sf))


@query
def migration_stats(spark, sf):
    return migration.migration_stats(full_run(spark, sf))


@query
def report_top_errors(spark, sf):
    return migration.report(full_run(spark, sf))


@query
def validar_origen(spark, sf):
    return migration.gate_report(legacy(spark, sf), AS_OF)


@query
def resume(spark, sf):
    return migration.pending(legacy(spark, sf), stored(spark, sf)).select("id", "expediente")


@query
def migrate_stream(spark, sf):
    """The written files as a stream: one batch, then one without anything new. Its counters."""
    folder = scratch(spark).folder("stream")
    source, target = f"{folder}/source", f"{folder}/target"
    legacy(spark, sf).write.parquet(source)
    tables.append_target(empty_target(spark), target)
    for _ in range(2):
        done = stream.load_stream(spark, source, target, f"{folder}/logs", f"{folder}/checkpoint", AS_OF)
    return done


@query
def refresh_changed(spark, sf):
    """A full load, then a feed with two later versions of some rows: the second snapshot."""
    folder, rows = scratch(spark).folder("refresh"), legacy(spark, sf)
    work = scratch(spark)
    first, _ = stream.refresh(rows, empty_target(spark), AS_OF, work, None)
    first = work.settle(first, "snapshot")
    stream.store_watermark(rows, folder)
    since = stream.watermark(spark, folder)
    later = [(n, F.lit(since + timedelta(hours=h))) for n, h in (("Vieja", 1), ("Nueva", 2))]
    feed = rows
    for name, moment in later:
        feed = feed.unionByName(rows.where("id % 6 = 1").withColumns({"nombre": F.lit(name), "update_at": moment}))
    second, _ = stream.refresh(feed, first, AS_OF, work, since)
    return second.select("id", "expediente", "cui", "pasaporte", c("nombre")["primer_nombre"].alias("primer_nombre"))


# --------------------------------------------------------------------------- writes


def _create(spark, sf) -> maintenance.Outcome:
    return maintenance.create_rows(candidates(spark, sf), loaded(spark, sf), AS_OF, scratch(spark))


@query
def create_rows(spark, sf):
    return _create(spark, sf).rows.select(
        "id",
        "expediente",
        "cui",
        "pasaporte",
        c("nombre")["primer_nombre"].alias("primer_nombre"),
        "sexo",
        c("contacto")["telefono_principal"].alias("telefono"),
        c("contacto")["email"].alias("email"),
        "estado",
        text(c("creado_en")).alias("creado_en"),
    )


@query
def create_rows_rejected(spark, sf):
    return _create(spark, sf).rejected


@query
def fold_updates(spark, sf):
    folded = maintenance.fold_updates(updates(spark, sf), "orden")
    return folded.select(
        "id",
        F.array_join(F.sort_array("campos"), ",").alias("campos"),
        "cui",
        "pasaporte",
        "sexo",
        "estado",
        c("contacto")["telefono_principal"].alias("telefono"),
    )


def _update(spark, sf) -> maintenance.Outcome:
    return maintenance.update_rows(loaded(spark, sf), updates(spark, sf), AS_OF, scratch(spark))


@query
def update_rows(spark, sf):
    return _update(spark, sf).rows.select(
        "id",
        "expediente",
        "cui",
        "pasaporte",
        "sexo",
        "estado",
        c("contacto")["telefono_principal"].alias("telefono"),
        c("contacto")["email"].alias("email"),
        text(c("actualizado_en")).alias("actualizado_en"),
    )


@query
def update_rows_rejected(spark, sf):
    return _update(spark, sf).rejected


def _delete(spark, sf) -> maintenance.Outcome:
    ids = table(spark, sf, "customer").select((c("c_custkey") * 13).alias("id"))
    return maintenance.delete_rows(loaded(spark, sf), ids)


@query
def delete_rows(spark, sf):
    return _delete(spark, sf).rows.select("id", "expediente")


@query
def delete_rows_missing(spark, sf):
    return _delete(spark, sf).rejected
