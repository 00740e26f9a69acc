"""Inputs of the checks as projections of the given tables.

The legacy table comes from ``orders``, requests to create and update records from
``customer``. The SQL texts are valid in Spark and DuckDB alike.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron import model
from padron.plans.maintenance import UPDATABLE
from padron.sources.tables import Workspace

LEGACY_SELECT = """
SELECT
    CAST(o_orderkey + 1 AS INT) AS id,
    CASE
        WHEN o_orderkey % 17 = 0 THEN NULL
        WHEN o_orderkey % 19 = 0 THEN 0
        WHEN o_orderkey % 23 = 0 THEN CAST(100000 + o_orderkey - 1 AS INT)
        ELSE CAST(100000 + o_orderkey AS INT)
        END AS expediente,
    CASE o_orderkey % 8
        WHEN 0 THEN NULL
        WHEN 1 THEN 'Juan'
        WHEN 2 THEN '  Juan   Carlos '
        WHEN 3 THEN 'María José del Carmen'
        WHEN 4 THEN ''
        WHEN 5 THEN 'Ana9'
        WHEN 6 THEN '   '
        ELSE 'Luis'
        END AS nombre,
    CASE o_orderkey % 5
        WHEN 0 THEN 'Pérez'
        WHEN 1 THEN 'Pérez García'
        WHEN 2 THEN 'López  de León Ruiz'
        WHEN 3 THEN NULL
        ELSE 'O''Neil-Díaz'
        END AS apellido,
    CASE
        WHEN o_orderkey % 11 = 0 THEN NULL
        WHEN o_orderkey % 13 = 0 THEN CAST(12345 AS BIGINT)
        WHEN o_orderkey % 29 = 0 THEN CAST(-123456789012 AS BIGINT)
        WHEN o_orderkey % 31 = 0 THEN CAST(1000000000009 AS BIGINT)
        WHEN o_orderkey % 37 = 0 THEN CAST(0 AS BIGINT)
        ELSE 1000000000000 + o_orderkey * 8
        END AS dpi,
    CASE
        WHEN o_orderkey % 10000 = 1231 THEN ''
        WHEN o_orderkey % 10 = 0 THEN concat('GT', CAST(o_orderkey AS STRING))
        WHEN o_orderkey % 41 = 0 THEN '123456'
        WHEN o_orderkey % 43 = 0 THEN 'AB1'
        ELSE NULL
        END AS pasaporte,
    CASE o_orderkey % 6
        WHEN 0 THEN 'M'
        WHEN 1 THEN 'F'
        WHEN 2 THEN 'm '
        WHEN 3 THEN '?'
        WHEN 4 THEN NULL
        ELSE 'f'
        END AS sexo,
    CASE
        WHEN o_orderkey % 9 = 0 THEN NULL
        WHEN o_orderkey % 47 = 0 THEN DATE '2999-01-01'
        WHEN o_orderkey % 53 = 0 THEN DATE '1800-01-01'
        ELSE DATE '1930-01-01' + CAST(o_orderkey * 7 % 33000 AS INT)
        END AS nacimiento,
    CAST(o_orderkey % 5 + 1 AS INT) AS nacionalidad,
    CAST(o_orderkey % 22 + 1 AS INT) AS depto_nac,
    CAST(o_orderkey % 340 + 1 AS INT) AS lugar_nacimiento,
    CAST(o_orderkey % 6 AS INT) AS estado_civil,
    CAST(o_orderkey % 7 + 1 AS INT) AS educacion,
    CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderkey % 4 + 1 AS INT) END AS pueblo,
    CAST(o_orderkey % 24 + 1 AS INT) AS idioma,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Doctora' ELSE NULL END AS ocupacion,
    CASE o_orderkey % 4
        WHEN 0 THEN '10 Calle 5-10, Zona 10'
        WHEN 1 THEN ''
        ELSE NULL
        END AS direccion,
    CASE
        WHEN o_orderkey % 3 = 0 THEN NULL
        WHEN o_orderkey % 3 = 1 THEN 0
        ELSE CAST(o_orderkey % 340 + 1 AS INT)
        END AS municipio,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 22 AS INT) END AS depto,
    CASE o_orderkey % 5
        WHEN 0 THEN '5555-6666'
        WHEN 1 THEN '+502 4444 1234'
        WHEN 2 THEN 'sin tel'
        WHEN 3 THEN NULL
        ELSE '77778888'
        END AS telefono,
    CASE o_orderkey % 6
        WHEN 0 THEN ' Maria.Lopez@Test.com '
        WHEN 1 THEN 'N/A'
        WHEN 2 THEN ''
        WHEN 3 THEN NULL
        WHEN 4 THEN 'no-es-email'
        ELSE 'a@b.gt'
        END AS email,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Pedro Pérez' ELSE NULL END AS padre,
    CASE WHEN o_orderkey % 4 = 0 THEN 'Ana García' ELSE NULL END AS madre,
    CASE o_orderkey % 4 WHEN 0 THEN 'María García' WHEN 1 THEN '' ELSE NULL END AS responsable,
    CAST(o_orderkey % 9 + 1 AS INT) AS parentesco,
    CASE o_orderkey % 3
        WHEN 0 THEN 1000000000017
        WHEN 1 THEN CAST(777 AS BIGINT)
        ELSE NULL
        END AS dpi_responsable,
    CASE WHEN o_orderkey % 4 = 0 THEN 44445555 ELSE NULL END AS telefono_responsable,
    CASE
        WHEN o_orderkey % 20 = 0 THEN 'F'
        WHEN o_orderkey % 20 = 1 THEN 'f'
        WHEN o_orderkey % 20 = 2 THEN NULL
        ELSE 'V'
        END AS estado,
    CASE
        WHEN o_orderkey % 14 = 0 THEN CAST(100000 + o_orderkey % 1000 AS INT)
        WHEN o_orderkey % 15 = 0 THEN 999999999
        ELSE NULL
        END AS exp_madre,
    CASE o_orderkey % 5
        WHEN 0 THEN 'SI'
        WHEN 1 THEN 'NO'
        WHEN 2 THEN ''
        WHEN 3 THEN NULL
        ELSE 's'
        END AS gemelo,
    CASE
        WHEN o_orderkey % 12 = 0 THEN 'López'
        WHEN o_orderkey % 12 = 1 THEN ''
        ELSE NULL
        END AS conyugue,
    'admin' AS created_by,
    CASE
        WHEN o_orderkey % 80 = 0 THEN '2024-01-15'
        WHEN o_orderkey % 80 = 20 THEN '5/1/2024'
        WHEN o_orderkey % 80 = 40 THEN '2024-02-30'
        WHEN o_orderkey % 80 = 60 THEN '15-01-2024'
        WHEN o_orderkey % 80 = 1 THEN '2024/01/15'
        WHEN o_orderkey % 80 = 7 THEN '2023-12-31'
        ELSE NULL
        END AS fecha_defuncion,
    CASE WHEN o_orderkey % 40 = 0 THEN '10:30:00' ELSE NULL END AS hora_defuncion,
    CASE
        WHEN o_orderkey % 16 = 0 THEN CAST(100001 AS INT)
        WHEN o_orderkey % 21 = 0 THEN 888888888
        ELSE NULL
        END AS exp_ref,
    o_orderdate AS created_at,
    o_orderdate AS update_at
FROM """


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: dict[str, Workspace] = {}
_WRITTEN: dict[tuple[str, str, str], str] = {}
#: A given table is one small file; written in parts it is read by several tasks, as a large one.
PARTS = 8


def scratch(spark: SparkSession) -> Workspace:
    """One workspace per session, for inputs and for the lazy results of queries."""
    sc = spark.sparkContext
    if sc.applicationId not in _SCRATCH:
        configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
        if not configured and sc.master.startswith("local") and "cluster" not in sc.master:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="checks-"))
        _SCRATCH[sc.applicationId] = Workspace(spark)
    return _SCRATCH[sc.applicationId]


def written(spark: SparkSession, sf_dir: str, name: str, rows) -> DataFrame:
    """An input as a table, written once per session: operators meet it as a scan."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = scratch(spark).folder(name)
        rows().write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rows() -> DataFrame:
        orders = table(spark, sf_dir, "orders")
        found = spark.sql(LEGACY_SELECT + "{orders}", orders=orders)
        return found.repartitionByRange(PARTS, "id").sortWithinPartitions("id")

    return written(spark, sf_dir, "legacy", rows)


# Requests to create a record, one per customer: clean ones, ones with wrong fields, ones
# whose identifiers are taken and ones that collide with each other.
CANDIDATES_SELECT = """
SELECT
    c_custkey AS fila,
    CASE
        WHEN c_custkey % 5 = 0 THEN NULL
        WHEN c_custkey % 7 = 0 THEN CAST(100000 + c_custkey * 3 AS STRING)
        WHEN c_custkey % 17 = 0 THEN 'EXPEDIENTE-DEMASIADO-LARGO'
        ELSE concat('N', CAST(c_custkey AS STRING))
        END AS expediente,
    CASE
        WHEN c_custkey % 4 = 0 THEN 2000000000000 + c_custkey
        WHEN c_custkey % 9 = 0 THEN 1000000000009
        WHEN c_custkey % 11 = 0 THEN CAST(12345 AS BIGINT)
        WHEN c_custkey % 29 = 0 THEN CAST(-123456789012 AS BIGINT)
        ELSE NULL
        END AS cui,
    CASE
        WHEN c_custkey % 3 = 0 THEN concat('P', CAST(c_custkey % 400 AS STRING))
        WHEN c_custkey % 25 = 0 THEN ''
        ELSE NULL
        END AS pasaporte,
    CASE c_custkey % 13
        WHEN 0 THEN 'Ana9'
        WHEN 1 THEN NULL
        WHEN 2 THEN ''
        ELSE ' María José '
        END AS primer_nombre,
    CASE WHEN c_custkey % 2 = 0 THEN 'de Jesús' ELSE NULL END AS segundo_nombre,
    CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'O''Neil-Díaz' END AS primer_apellido,
    CASE c_custkey % 23 WHEN 0 THEN 'X' WHEN 1 THEN NULL WHEN 2 THEN 'NF' WHEN 3 THEN 'M'
        ELSE 'F' END AS sexo,
    CASE
        WHEN c_custkey % 37 = 0 THEN DATE '2999-01-01'
        WHEN c_custkey % 41 = 0 THEN DATE '1850-01-01'
        ELSE DATE '1950-01-01' + CAST(c_custkey * 11 % 20000 AS INT)
        END AS fecha_nacimiento,
    CASE c_custkey % 10
        WHEN 0 THEN '123'
        WHEN 1 THEN '5555-6666'
        WHEN 2 THEN '+502 5555 6666'
        WHEN 3 THEN NULL
        ELSE '55556666'
        END AS telefono,
    CASE c_custkey % 14
        WHEN 0 THEN 'no-es-email'
        WHEN 1 THEN 'a@localhost'
        WHEN 2 THEN 'ana..b@x.gt'
        WHEN 3 THEN NULL
        ELSE 'Ana.B@Correo.GT'
        END AS email,
    CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '5ta Avenida 10-50' END AS linea1,
    CASE WHEN c_custkey % 16 = 0 THEN 0 ELSE CAST(c_custkey % 300 + 1 AS INT) END AS municipio_id,
    c_custkey % 6 <> 0 OR c_custkey % 12 = 0 AS con_direccion,
    CASE WHEN c_custkey % 8 = 0 THEN 'F' ELSE 'V' END AS estado,
    CASE
        WHEN c_custkey % 24 = 0 THEN NULL
        WHEN c_custkey % 8 = 0 THEN '2020-05-06T07:08:09'
        WHEN c_custkey % 43 = 0 THEN '2020-05-06T07:08:09'
        WHEN c_custkey % 47 = 0 THEN '2999-01-01T00:00:00'
        WHEN c_custkey % 53 = 0 THEN 'ayer'
        ELSE NULL
        END AS fecha_hora
FROM """

# Partial updates, three of them per record; da_x says that the update gives field x.
UPDATES_SELECT = """
SELECT
    CAST((c_custkey - c_custkey % 3) * 7 + 1 AS BIGINT) AS id,
    c_custkey AS orden,
    c_custkey % 4 = 0 AS da_pasaporte,
    CASE
        WHEN c_custkey % 8 = 0 THEN NULL
        WHEN c_custkey % 20 = 4 THEN 'GT70'
        WHEN c_custkey % 28 = 4 THEN ''
        ELSE concat('U', CAST(c_custkey % 500 AS STRING))
        END AS pasaporte,
    c_custkey % 5 = 0 AS da_cui,
    CASE
        WHEN c_custkey % 15 = 0 THEN CAST(123 AS BIGINT)
        WHEN c_custkey % 10 = 0 THEN 3000000000000 + c_custkey
        ELSE 1000000000000 + c_custkey * 8
        END AS cui,
    c_custkey % 6 = 1 AS da_sexo,
    CASE WHEN c_custkey % 12 = 1 THEN 'F' ELSE 'Z' END AS sexo,
    c_custkey % 7 = 3 AS da_estado,
    CASE WHEN c_custkey % 14 = 3 THEN NULL ELSE 'V' END AS estado,
    c_custkey % 3 = 1 AS da_contacto,
    CASE WHEN c_custkey % 9 = 1 THEN '123' ELSE '9999-8888' END AS telefono
FROM """


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The create requests with their documents."""
    flat = spark.sql(CANDIDATES_SELECT + "{customer}", customer=table(spark, sf_dir, "customer"))
    c = F.col

    def doc(schema, **given):
        return F.struct(
            *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
        )

    address = doc(model.DIRECCION, linea1=c("linea1"), municipio_id=c("municipio_id"))
    death = F.when(c("fecha_hora").isNotNull(), doc(model.DEFUNCION, fecha_hora=c("fecha_hora")))
    none = F.lit(None)
    return flat.select(
        "fila",
        "expediente",
        "cui",
        "pasaporte",
        doc(
            model.NOMBRE,
            primer_nombre=c("primer_nombre"),
            segundo_nombre=c("segundo_nombre"),
            primer_apellido=c("primer_apellido"),
        ).alias("nombre"),
        "sexo",
        "fecha_nacimiento",
        doc(
            model.CONTACTO,
            telefono_principal=c("telefono"),
            email=c("email"),
            direccion=F.when(c("con_direccion"), address),
        ).alias("contacto"),
        none.cast(model.REFERENCIAS).alias("referencias"),
        doc(model.DATOS_EXTRA, defuncion=death).alias("datos_extra"),
        "estado",
        none.cast(model.METADATOS).alias("metadatos"),
    )


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update requests, with the list of given fields and every updatable column."""
    flat = spark.sql(UPDATES_SELECT + "{customer}", customer=table(spark, sf_dir, "customer"))
    c = F.col
    given = ("cui", "pasaporte", "sexo", "contacto", "estado")
    none = F.array().cast("array<string>")
    mask = F.concat(*[F.when(c(f"da_{g}"), F.array(F.lit(g))).otherwise(none) for g in given])
    contact = F.struct(
        c("telefono").alias("telefono_principal"),
        *[
            F.lit(None).cast(f.dataType).alias(f.name)
            for f in model.CONTACTO.fields[1:]
        ],
    )
    values = {
        "cui": c("cui"),
        "pasaporte": c("pasaporte"),
        "sexo": c("sexo"),
        "estado": c("estado"),
        "contacto": contact,
    }
    return flat.select(
        "id",
        "orden",
        mask.alias("campos"),
        *[
            (
                F.when(c(f"da_{f}"), values[f])
                if f in values
                else F.lit(None).cast(model.TARGET_SCHEMA[f].dataType)
            ).alias(f)
            for f in UPDATABLE
        ],
    )


# Wrong values in stored records: the target columns of ``transform`` they replace. Valid in
# Spark and DuckDB alike, so that every rule meets a record that breaks it.
SOILED = {
    "expediente": "CASE id % 61 WHEN 0 THEN 'ABC-1' WHEN 1 THEN repeat('9', 25) WHEN 2 THEN '' ELSE expediente END",
    "pasaporte": "CASE id % 59 WHEN 0 THEN repeat('A1', 30) ELSE pasaporte END",
    "cui": "CASE WHEN id % 61 IN (0, 1) THEN CAST(777 AS BIGINT) ELSE cui END",
    "sexo": "CASE WHEN id % 47 = 0 THEN 'X' ELSE sexo END",
    "primer_nombre": "CASE id % 53 WHEN 0 THEN repeat('a', 101) ELSE primer_nombre END",
    "apellido_casada": "CASE id % 53 WHEN 1 THEN repeat('b', 101) ELSE apellido_casada END",
    "padre": "CASE WHEN id % 37 = 0 THEN repeat('p', 101) ELSE padre END",
    "expediente_madre": "CASE WHEN id % 37 = 1 THEN -5 ELSE expediente_madre END",
    "resp_nombre": "CASE WHEN con_responsable AND id % 41 = 0 THEN repeat('n', 101) ELSE resp_nombre END",
    "resp_parentesco_id": "CASE WHEN con_responsable AND id % 41 = 1 THEN 0 ELSE resp_parentesco_id END",
    "resp_telefono": "CASE WHEN con_responsable AND id % 41 = 2 THEN '12' WHEN con_responsable AND id % 41 = 3 THEN repeat('5', 21) ELSE resp_telefono END",
    "resp_cui": "CASE WHEN con_responsable AND id % 43 = 0 THEN CAST(123 AS BIGINT) WHEN con_responsable AND id % 43 = 1 THEN 1000000000008 ELSE resp_cui END",
    "conyugue": "CASE WHEN id % 37 = 2 THEN repeat('c', 101) ELSE conyugue END",
    "nacionalidad_id": "CASE WHEN id % 29 = 0 THEN 0 ELSE nacionalidad_id END",
    "ocupacion": "CASE WHEN id % 29 = 1 THEN repeat('o', 101) ELSE ocupacion END",
    "fecha_hora": "CASE id % 31 WHEN 0 THEN 'ayer' WHEN 1 THEN '2999-01-01T00:00:00' ELSE fecha_hora END",
    "sistema_origen": "CASE WHEN id % 19 = 0 THEN repeat('s', 51) ELSE sistema_origen END",
    "creado_por": "CASE WHEN id % 19 = 1 THEN repeat('u', 51) ELSE creado_por END",
    "version_migracion": "CASE WHEN id % 19 = 2 THEN repeat('v', 21) ELSE version_migracion END",
    "notas": "CASE WHEN id % 19 = 3 THEN repeat('t', 501) ELSE notas END",
}
# Where the fields lie in the documents.
PLACES = {
    "primer_nombre": "nombre.primer_nombre",
    "apellido_casada": "nombre.apellido_casada",
    "padre": "referencias.padre",
    "expediente_madre": "referencias.expediente_madre",
    "conyugue": "referencias.conyugue",
    "resp_nombre": "referencias.responsable.nombre",
    "resp_parentesco_id": "referencias.responsable.parentesco_id",
    "resp_telefono": "referencias.responsable.telefono",
    "resp_cui": "referencias.responsable.cui",
    "nacionalidad_id": "datos_extra.demograficos.nacionalidad_id",
    "ocupacion": "datos_extra.socioeconomicos.ocupacion",
    "fecha_hora": "datos_extra.defuncion.fecha_hora",
    "sistema_origen": "metadatos.sistema_origen",
    "creado_por": "metadatos.creado_por",
    "version_migracion": "metadatos.version_migracion",
    "notas": "metadatos.notas",
}


def soiled(rows: DataFrame) -> DataFrame:
    """Target rows with the wrong values of ``SOILED`` in their documents."""
    names = {**PLACES, "con_responsable": "referencias.responsable IS NOT NULL"}

    def expression(column: str) -> str:
        out = SOILED[column]
        for name in sorted(names, key=len, reverse=True):
            place = names[name] if name == "con_responsable" else f"{names[name]}"
            out = re.sub(rf"(?<![\w.]){name}\b", f"({place})", out)
        return out

    def document(column: str, replaced: dict[str, str]) -> Column:
        doc, by_field = F.col(column), {}
        for place, name in replaced.items():
            by_field.setdefault(place.split(".")[1], []).append((place, name))
        for field, changes in by_field.items():
            kind = model.DOCUMENTS[column][field].dataType
            if len(changes[0][0].split(".")) == 2:
                doc = doc.withField(field, F.expr(expression(changes[0][1])).cast(kind))
                continue
            inner = F.col(f"{column}.{field}")
            whole = inner if field == "responsable" else F.coalesce(inner, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]))
            for place, name in changes:
                leaf = place.split(".")[2]
                whole = whole.withField(leaf, F.expr(expression(name)).cast(kind[leaf].dataType))
            given = inner.isNotNull()
            if field == "defuncion":
                given = F.expr(expression("fecha_hora")).isNotNull()
            doc = doc.withField(field, F.when(given, whole))
        return doc

    scalars = {c: F.expr(SOILED[c]).cast(model.TARGET_SCHEMA[c].dataType) for c in SOILED if c not in PLACES}
    documents = {
        d: document(d, {p: n for n, p in PLACES.items() if p.startswith(f"{d}.")})
        for d in ("nombre", "referencias", "datos_extra", "metadatos")
    }
    return rows.withColumns({**scalars, **documents})
