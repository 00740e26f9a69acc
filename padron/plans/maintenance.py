"""Creating, changing and deleting rows of the target, whole sets at a time.

Every function returns frames: the rows of the new snapshot and the requests refused. The
caller writes them, see ``sources.tables``. Checked requests and the clashes found are written
to the work folder once, because several of the steps that follow read them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron import model
from padron.functions import contract
from padron.functions.asof import AsOf
from padron.operators.identifiers import held, identifier_rows, key_owners
from padron.operators.requests import refusals
from padron.operators.skew import dense_index
from padron.sources.tables import Workspace

ALREADY_EXISTS = "Ya existe un paciente con alguno de estos identificadores"
NOT_FOUND = "Paciente no encontrado"
UPDATABLE = tuple(
    c for c in model.TARGET_COLUMNS if c not in ("id", "metadatos", "creado_en", "actualizado_en")
)


@dataclass(frozen=True)
class Outcome:
    """``rows``: the accepted rows (create) or the whole new snapshot (update, delete).
    ``rejected``: one row per reason, as key, campo, mensaje."""

    rows: DataFrame
    rejected: DataFrame


def _record(key: str, campo: Column, mensaje: Column) -> list[Column]:
    return [F.col(key), campo.alias("campo"), mensaje.alias("mensaje")]


def create_rows(
    candidates: DataFrame, stored: DataFrame, as_of: AsOf, work: Workspace, key: str = "fila"
) -> Outcome:
    """Rows to append for the valid candidates whose identifiers are free.

    ``key`` is a unique integer column giving the order of the requests. They are decided as if
    they came one after the other: only an accepted candidate holds its identifiers against
    later ones, see :mod:`padron.operators.requests`.
    """
    as_of = as_of.pinned(candidates.sparkSession)
    checked = work.settle(contract.record_errors(candidates, as_of), "create")
    invalid = contract.explode_errors(checked, key)
    valid = checked.where(F.size("errores") == 0).drop("errores")
    keys = identifier_rows(valid, key)
    # Rows to come and stored rows have numbers of their own.
    row = lambda new, number: F.struct(F.lit(new).alias("nueva"), F.col(number).cast("long").alias("n")).alias("fila")
    events = keys.select(F.col("fila").cast("long").alias("orden"), row(True, "fila"), "campo", "clave")
    owners = key_owners(held(keys.select("campo", "clave").distinct(), stored))
    refused_keys = refusals(events, owners.select(row(False, "primera"), "campo", "clave"), work)
    taken = work.settle(refused_keys.select(F.col("orden").cast(valid.schema[key].dataType).alias(key)).distinct(), "taken")
    free = valid.join(taken, key, "left_anti").withColumns(
        {
            "nombre": contract.clean_nombre(F.col("nombre")),
            "contacto": contract.clean_contacto(F.col("contacto")),
        }
    )
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).scalar()
    numbered = dense_index(free.withColumn("_top", top), key, "_index")
    created = numbered.withColumns(
        {
            "id": F.col("_top") + F.col("_index") + 1,
            "creado_en": as_of.timestamp,
            "actualizado_en": as_of.timestamp,
        }
    ).select(*model.TARGET_COLUMNS)
    refused = taken.select(*_record(key, F.lit("identificadores"), F.lit(ALREADY_EXISTS)))
    return Outcome(created, invalid.unionByName(refused))


def fold_updates(updates: DataFrame, order: str) -> DataFrame:
    """One update per id out of several: each field takes its last given value.

    The same as applying them one after the other, without bringing the updates of a busy id
    together: each field keeps only its latest value on the map side.
    """
    given = {c: F.array_contains("campos", c) for c in UPDATABLE}
    folded = updates.groupBy("id").agg(
        *[
            F.max_by(F.struct(F.col(c).alias("v")), F.when(given[c], F.col(order))).alias(c)
            for c in UPDATABLE
        ],
        *[F.bool_or(given[c]).alias(f"_has_{c}") for c in UPDATABLE],
    )
    none = F.array().cast("array<string>")
    mask = F.concat(
        *[F.when(F.col(f"_has_{c}"), F.array(F.lit(c))).otherwise(none) for c in UPDATABLE]
    )
    return folded.select(
        "id", mask.alias("campos"), *[F.col(c).getField("v").alias(c) for c in UPDATABLE]
    )


def update_rows(
    stored: DataFrame, updates: DataFrame, as_of: AsOf, work: Workspace, order: str = "orden"
) -> Outcome:
    """The table after partial updates, any number per id.

    Each request is checked for itself and stands or falls alone; ``order`` is its unique number
    and names it in ``rejected``. Of those accepted each field takes its last value. ``campos``
    names the fields a request gives: a field given as null overwrites, one not given stays;
    documents are replaced whole. Identifiers are given out as if the requests came one after
    the other: only accepted ones hold and free them, see :mod:`padron.operators.requests`.
    """
    as_of = as_of.pinned(stored.sparkSession)
    mask = F.col("campos")
    record = lambda campo, mensaje: [F.col("id"), F.col(order), campo.alias("campo"), mensaje.alias("mensaje")]
    asked_ids = updates.select("id").distinct()
    known_ids = stored.select("id").join(asked_ids, "id", "left_semi")
    checked = work.settle(
        updates.join(known_ids.withColumn("_known", F.lit(True)), "id", "left_outer").withColumn(
            "errores", contract.update_errors(mask, as_of)
        ),
        "update",
    )
    missing = checked.where(F.col("_known").isNull()).select(
        *record(F.lit("id"), F.lit(NOT_FOUND))
    )
    known = checked.where(F.col("_known").isNotNull()).drop("_known")
    invalid = contract.explode_errors(known, "id", order)
    valid = known.where(F.size("errores") == 0).drop("errores")

    # Only identifiers that are given can collide, or free what the record had.
    entries = [
        F.when(F.array_contains(mask, c), F.struct(F.lit(c).alias("campo"), F.col(c).cast("string").alias("clave")))
        for c in model.IDENTIFIERS
    ]
    events = valid.select(
        F.col(order).cast("long").alias("orden"), F.col("id").alias("fila"), F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")
    ).select("orden", "fila", "e.campo", "e.clave")
    asked_keys = events.where("clave IS NOT NULL").select("campo", "clave").distinct()
    refused = refusals(events, held(asked_keys, stored), work)
    clashes = work.settle(
        valid.select("id", order)
        .join(refused.withColumnRenamed("orden", order), order)
        .select(*record(F.col("campo"), F.lit("Identificador no disponible"))),
        "clashes",
    )
    accepted = valid.join(clashes.select(order).distinct(), order, "left_anti")
    folded = fold_updates(accepted, order).withColumns(
        {
            "nombre": contract.clean_nombre(F.col("nombre")),
            "contacto": contract.clean_contacto(F.col("contacto")),
        }
    )
    changes = folded.select(
        "id", mask.alias("_campos"), *[F.col(c).alias(f"_new_{c}") for c in UPDATABLE]
    )
    touched = F.col("_campos").isNotNull()
    new = {
        c: F.when(
            touched & F.array_contains("_campos", c), F.col(f"_new_{c}")
        ).otherwise(F.col(c))
        for c in UPDATABLE
    }
    new["actualizado_en"] = F.when(touched, as_of.timestamp).otherwise(F.col("actualizado_en"))
    rows = stored.join(changes, "id", "left_outer").select(
        *[new[c].alias(c) if c in new else F.col(c) for c in model.TARGET_COLUMNS]
    )
    return Outcome(rows, missing.unionByName(invalid).unionByName(clashes))


def delete_rows(stored: DataFrame, ids: DataFrame) -> Outcome:
    """The table without the rows of ``ids``; unknown ids are reported."""
    wanted = ids.select("id").distinct()
    missing = wanted.join(stored.select("id"), "id", "left_anti").select(
        *_record("id", F.lit("id"), F.lit(NOT_FOUND))
    )
    return Outcome(stored.join(wanted, "id", "left_anti").select(*stored.columns), missing)
