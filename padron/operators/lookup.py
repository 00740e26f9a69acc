"""Filters, searches and listings over the target table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.asof import AsOf
from padron.functions.derived import expediente_duplicado
from padron.functions.rules import es_cui_valido
from padron.model import LEGACY_SYSTEM
from padron.operators.paging import DEFAULT_PAGE_SIZE, PageRequest, paginate, row_count

NAME_FIELDS = ("primer_nombre", "segundo_nombre", "otros_nombres")
FAMILY_FIELDS = ("primer_apellido", "segundo_apellido")
FREE_TEXT_FIELDS = ("primer_nombre", "segundo_nombre", *FAMILY_FIELDS)


def by_id(rows: DataFrame, row_id: int) -> DataFrame:
    return rows.where(F.col("id") == row_id)


def by_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is in ``ids`` (a frame with an ``id`` column)."""
    return rows.join(ids.select("id").distinct(), "id", "left_semi")


def exists_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, existe`` for every distinct id asked for."""
    present = rows.select("id").withColumn("_present", F.lit(True))
    asked = ids.select("id").distinct()
    return asked.join(present, "id", "left_outer").select(
        "id", F.col("_present").isNotNull().alias("existe")
    )


def by_expediente(rows: DataFrame, expediente: str) -> DataFrame:
    return rows.where(F.col("expediente") == expediente)


def by_cui(rows: DataFrame, cui: int) -> DataFrame:
    """Exact match; an id with a wrong check digit finds nothing."""
    return rows.where((F.col("cui") == cui) & es_cui_valido(F.lit(cui).cast("long")))


def by_pasaporte(rows: DataFrame, pasaporte: str) -> DataFrame:
    return rows.where(F.col("pasaporte") == pasaporte)


def _contains(c: Column, text: str) -> Column:
    """Case-blind containment; ``%`` and ``_`` in the text stay wildcards."""
    return c.ilike(f"%{text}%")


def _in_name(fields, text: str) -> Column:
    return reduce(or_, [_contains(F.col("nombre").getField(f), text) for f in fields])


@dataclass(frozen=True)
class SearchParams:
    """Search form; a value that is None or empty does not filter."""

    expediente: str | None = None
    cui: int | None = None
    pasaporte: str | None = None
    nombre: str | None = None
    apellido: str | None = None
    sexo: str | None = None
    estado: str | None = None
    fecha_nacimiento_desde: date | None = None
    fecha_nacimiento_hasta: date | None = None
    page: int = 1
    page_size: int = DEFAULT_PAGE_SIZE

    def predicate(self) -> Column:
        c = F.col
        terms = []
        if self.expediente:
            terms.append(_contains(c("expediente"), self.expediente))
        if self.cui:
            terms.append(c("cui") == self.cui)
        if self.pasaporte:
            terms.append(_contains(c("pasaporte"), self.pasaporte))
        if self.nombre:
            terms.append(_in_name(NAME_FIELDS, self.nombre))
        if self.apellido:
            terms.append(_in_name(FAMILY_FIELDS, self.apellido))
        if self.sexo:
            terms.append(c("sexo") == self.sexo)
        if self.estado:
            terms.append(c("estado") == self.estado)
        if self.fecha_nacimiento_desde:
            terms.append(c("fecha_nacimiento") >= F.lit(self.fecha_nacimiento_desde))
        if self.fecha_nacimiento_hasta:
            terms.append(c("fecha_nacimiento") <= F.lit(self.fecha_nacimiento_hasta))
        return reduce(and_, terms, F.lit(True))

    @property
    def request(self) -> PageRequest:
        return PageRequest(self.page, self.page_size)


def search(rows: DataFrame, params: SearchParams) -> DataFrame:
    """All rows that fit the form."""
    return rows.where(params.predicate())


def search_page(rows: DataFrame, params: SearchParams) -> DataFrame:
    return paginate(search(rows, params), params.request)


def search_nombre_completo(rows: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """First rows with the text in a given or family name (further names are not searched)."""
    return rows.where(_in_name(FREE_TEXT_FIELDS, text)).orderBy("id").limit(limit)


def fallecidos(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("estado") == "F")


def por_sexo(rows: DataFrame, sexo: str) -> DataFrame:
    return rows.where(F.col("sexo") == sexo)


def por_rango_edad(rows: DataFrame, edad_min: int, edad_max: int, as_of: AsOf) -> DataFrame:
    """Birth date between both ends, inclusive: who turns ``edad_max`` + 1 today is in."""
    return rows.where(
        F.col("fecha_nacimiento").between(
            as_of.years_ago(edad_max + 1), as_of.years_ago(edad_min)
        )
    )


def menores(rows: DataFrame, as_of: AsOf) -> DataFrame:
    return por_rango_edad(rows, 0, 17, as_of)


def born_after_majority(as_of: AsOf) -> Column:
    """The condition the total of minors counts; it has no upper bound."""
    return F.col("fecha_nacimiento") > as_of.years_ago(18)


def menores_page(rows: DataFrame, request: PageRequest, as_of: AsOf) -> DataFrame:
    total = row_count(rows.where(born_after_majority(as_of)))
    return paginate(menores(rows, as_of), request, total)


def sin_cui(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("cui").isNull())


def expedientes_duplicados(rows: DataFrame) -> DataFrame:
    return rows.where(expediente_duplicado(F.col("metadatos")))


def is_migrated() -> Column:
    return F.col("metadatos").getField("sistema_origen") == LEGACY_SYSTEM


def migrados(rows: DataFrame) -> DataFrame:
    return rows.where(is_migrated())


def list_page(rows: DataFrame, request: PageRequest | None = None) -> DataFrame:
    return paginate(rows, request or PageRequest())
