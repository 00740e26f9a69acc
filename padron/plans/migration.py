"""From the legacy table to the target: transform, split, load, summarise, restart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, IntegralType

from padron import model
from padron.functions import documents as D
from padron.functions import normalize as N
from padron.functions.asof import AsOf
from padron.functions.rules import legacy_messages
from padron.functions.text import words
from padron.operators.identifiers import load_conflicts
from padron.operators.paging import row_count, slice_rows
from padron.operators.quality import check_violations, source_check
from padron.operators.skew import beside, counted, dense_index
from padron.sources.tables import OpenRun, Workspace, append_target, scan_target

REPORT_ROWS = 10
BATCH_SIZE = 100


# --------------------------------------------------------------------------- single steps


def instant(moment: Column, zone: str) -> Column:
    """Instant of a timestamp without zone that was written in ``zone``.

    The cast reads it in the session's zone, the next step undoes that. Both shifts have
    constant zones, which is several times faster than ``convert_timezone``.
    """
    wall_clock = F.from_utc_timestamp(moment.cast("timestamp"), F.current_timezone())
    return F.to_utc_timestamp(wall_clock, zone)


def transform(legacy: DataFrame, as_of: AsOf, zone: str = model.TIME_ZONE) -> DataFrame:
    """Legacy rows in the shape of the target; ``id`` is still that of the source."""
    c = F.col
    # Own projection for what several fields read, so that it is computed once per row.
    staged = legacy.withColumns(
        {
            "_given": words(c("nombre")),
            "_family": words(c("apellido")),
            "_death": N.parse_fecha_defuncion(c("fecha_defuncion"), c("hora_defuncion")),
            "_repeated": N.is_expediente_invalid(c("expediente")),
        }
    )
    return staged.select(
        c("id").cast("long").alias("id"),
        N.normalize_expediente(c("expediente"), c("id")).alias("expediente"),
        N.normalize_cui(c("dpi")).alias("cui"),
        c("pasaporte"),
        D.nombre_from_words(c("_given"), c("_family"), c("conyugue")).alias("nombre"),
        N.normalize_sexo(c("sexo")).alias("sexo"),
        c("nacimiento").alias("fecha_nacimiento"),
        D.build_contacto(
            N.clean_telefono(c("telefono")),
            c("email"),
            c("direccion"),
            c("municipio"),
            c("depto"),
        ).alias("contacto"),
        D.build_referencias(
            c("padre"),
            c("madre"),
            c("exp_madre"),
            c("responsable"),
            c("parentesco"),
            c("dpi_responsable"),
            c("telefono_responsable"),
            c("exp_ref"),
            c("conyugue"),
            c("gemelo"),
        ).alias("referencias"),
        D.datos_extra_from_moment(
            c("nacionalidad"),
            c("depto_nac"),
            c("lugar_nacimiento"),
            c("estado_civil"),
            c("educacion"),
            c("pueblo"),
            c("idioma"),
            c("ocupacion"),
            c("_death"),
        ).alias("datos_extra"),
        N.normalize_estado(c("estado")).alias("estado"),
        D.build_metadatos(c("id"), c("created_by"), c("_repeated"), as_of).alias("metadatos"),
        instant(c("created_at"), zone).alias("creado_en"),
        instant(c("update_at"), zone).alias("actualizado_en"),
    )


def has_bad_cui() -> Column:
    """An id is given but has not 13 digits; zero counts as given."""
    return F.col("dpi").isNotNull() & N.normalize_cui(F.col("dpi")).isNull()


def warnings(legacy: DataFrame, as_of: AsOf) -> DataFrame:
    """One row per id that the migration drops."""
    return legacy.where(has_bad_cui()).select(
        F.col("id").alias("id_mysql"),
        "expediente",
        F.lit("CUI_INVALIDO").alias("tipo"),
        F.concat(F.lit("CUI/DPI inválido: "), F.col("dpi").cast("string")).alias("mensaje"),
        as_of.iso.alias("timestamp"),
    )


def coerce(raw: DataFrame) -> DataFrame:
    """Rows of loosely typed text in legacy types, plus ``_error``: the first value that does
    not fit its column, or null."""
    kept, problems = [], []
    for f in model.LEGACY_SCHEMA.fields:
        value, given = F.col(f.name), raw.schema[f.name]
        typed = value.try_cast(f.dataType)
        if isinstance(given.dataType, FractionalType) and isinstance(f.dataType, IntegralType):
            # A cast cuts fractions off; such a value does not fit.
            typed = F.when(typed.cast(given.dataType) == value, typed)
        kept.append(typed.alias(f.name))
        if given.nullable and not f.nullable:
            problems.append(F.when(value.isNull(), F.lit(f"{f.name}: falta el valor")))
        if given.dataType != f.dataType:
            text = F.lit(f" no es {f.dataType.simpleString()}")
            problems.append(
                F.when(
                    value.isNotNull() & typed.isNull(),
                    F.concat(F.lit(f"{f.name}: "), value.cast("string"), text),
                )
            )
    error = F.coalesce(*problems) if problems else F.lit(None).cast("string")
    return raw.select(*kept, error.alias("_error"))


def transform_errors(coerced: DataFrame, as_of: AsOf) -> DataFrame:
    """Error records of the rows that cannot be transformed."""
    return coerced.where(F.col("_error").isNotNull()).select(
        F.col("id").alias("id_mysql"),
        "expediente",
        F.col("_error").alias("error"),
        F.lit("ValueError").alias("tipo"),
        as_of.iso.alias("timestamp"),
    )


def repeated_ids(rows: DataFrame) -> DataFrame:
    """Rows whose id another row has, too, without the one that stays.

    The least in the order of all columns stays; ``_fila`` (unique) settles equal rows. Only rows
    of repeated ids are compared.
    """
    several = rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    mine = rows.join(counted(several), "id", "left_semi")
    order = F.struct(*[c for c in rows.columns if c not in ("id", "_fila")], "_fila")
    stay = mine.groupBy("id").agg(F.min(order).getField("_fila").alias("_fila")).select("_fila")
    return mine.join(beside(stay, False), "_fila", "left_anti")


def repeat_errors(repeats: DataFrame, as_of: AsOf) -> DataFrame:
    """Error records of rows that repeat an id."""
    return repeats.select(
        F.col("id").alias("id_mysql"),
        N.normalize_expediente(F.col("expediente"), F.col("id")).alias("expediente"),
        F.lit("id duplicado").alias("error"),
        F.lit("COMMIT_ERROR").alias("tipo"),
        as_of.iso.alias("timestamp"),
    )


def load_errors(rows: DataFrame, target: DataFrame, as_of: AsOf) -> DataFrame:
    """Error records of the transformed rows the target would refuse, one per row.

    What a record says of its row travels with the identifiers, so the rows are not met again.
    """
    source = {
        "_origen": F.col("metadatos").getField("id_origen"),
        "_expediente": F.col("expediente"),
    }
    conflicts = load_conflicts(rows, target, carry=source).select(
        "id",
        *source,
        F.concat(
            "campo", F.when(F.col("en_destino"), " ya existe").otherwise(" duplicado")
        ).alias("motivo"),
    )
    broken = check_violations(rows, *[v.alias(n) for n, v in source.items()])
    reasons = conflicts.unionByName(broken.withColumnRenamed("restriccion", "motivo"))
    return (
        reasons.groupBy("id", *source)
        .agg(F.array_join(F.sort_array(F.collect_set("motivo")), "; ").alias("error"))
        .select(
            F.col("_origen").alias("id_mysql"),
            F.col("_expediente").alias("expediente"),
            "error",
            F.lit("COMMIT_ERROR").alias("tipo"),
            as_of.iso.alias("timestamp"),
        )
    )


def pending(legacy: DataFrame, target: DataFrame) -> DataFrame:
    """Legacy rows not loaded yet; running a migration again loads nothing twice.

    The id of a loosely typed source is read as a number; a row without a usable one is pending.
    """
    done = target.where(
        F.col("metadatos").getField("sistema_origen") == model.LEGACY_SYSTEM
    ).select(F.col("metadatos").getField("id_origen").alias("_done"))
    return legacy.join(counted(done), F.col("id").try_cast("int") == F.col("_done"), "left_anti")


def source_gate(legacy: DataFrame, as_of: AsOf) -> DataFrame:
    """Legacy rows flagged with their problems. None is dropped."""
    return legacy.withColumn("errores", legacy_messages(as_of)).withColumn(
        "es_valido", F.size("errores") == 0
    )


def gate_report(legacy: DataFrame, as_of: AsOf) -> DataFrame:
    """State of the source plus the number of rows with problems, one row."""
    flagged = source_gate(legacy, as_of).agg(F.count_if(~F.col("es_valido")).alias("n"))
    return source_check(legacy).withColumn("filas_con_problemas", flagged.scalar())


# --------------------------------------------------------------------------- whole runs


@dataclass(frozen=True)
class Migration:
    """The frames of one run: what was read, what fails, what gets loaded.

    ``source`` (typed rows, with ``_error`` and a number ``_fila``), ``refused`` (rows that break
    a rule of the target) and ``repeats`` (rows whose id another row has) are written tables, so
    the source system is read once; the others are lazy and follow from these.
    """

    source: DataFrame
    loadable: DataFrame
    failures: DataFrame
    warnings: DataFrame
    refused: DataFrame
    repeats: DataFrame
    as_of: AsOf

    @property
    def rejects(self) -> DataFrame:
        return self.refused.unionByName(repeat_errors(self.repeats, self.as_of))

    @property
    def errors(self) -> DataFrame:
        return self.failures.withColumn(
            "expediente", F.col("expediente").cast("string")
        ).unionByName(self.rejects)


def plan(
    legacy: DataFrame,
    target: DataFrame,
    as_of: AsOf,
    work: Workspace,
    zone: str = model.TIME_ZONE,
) -> Migration:
    """Migration of every row of ``legacy`` into ``target``.

    The source is read once: its rows are typed and written to ``work``. Of rows that share an id
    one stays; the others hold no identifiers. The identifiers alone then find the rows the target
    would refuse, which are written as well.
    """
    as_of = as_of.pinned(legacy.sparkSession)
    typed = work.settle(coerce(legacy).withColumn("_fila", F.monotonically_increasing_id()), "source")
    good = typed.where(F.col("_error").isNull()).drop("_error")
    repeats = work.settle(repeated_ids(good), "repeats")
    single = good.join(counted(repeats.select("_fila")), "_fila", "left_anti")
    refused = work.settle(load_errors(transform(single, as_of, zone), target, as_of), "rejects")
    # Rejects leave before the transform, while the rows are flat.
    kept = single.join(counted(refused.select(F.col("id_mysql").alias("id"))), "id", "left_anti")
    return Migration(
        source=typed,
        loadable=transform(kept, as_of, zone),
        failures=transform_errors(typed, as_of),
        warnings=warnings(good, as_of),
        refused=refused,
        repeats=repeats,
        as_of=as_of,
    )


def plan_batch(
    legacy: DataFrame,
    target: DataFrame,
    offset: int,
    batch_size: int,
    as_of: AsOf,
    work: Workspace,
    zone: str = model.TIME_ZONE,
) -> Migration:
    """Migration of one slice of the legacy table, in the order of its id.

    The slice is taken by the id as a number; rows without a usable id are in no slice.
    """
    key = F.col("id").try_cast("int")
    numbered = legacy if legacy.schema["id"].dataType == key_type() else legacy.withColumn("id", key)
    return plan(slice_rows(numbered, offset, batch_size), target, as_of, work, zone)


def key_type():
    return model.LEGACY_SCHEMA["id"].dataType


def batch_result(run: Migration, offset: int, batch_size: int) -> DataFrame:
    """``procesados, exitosos, errores, offset_siguiente, mensaje`` of one slice."""
    done = F.col("procesados") > 0
    return (
        run.source.agg(F.count("*").alias("procesados"))
        .withColumn("errores", row_count(run.errors).scalar())
        .withColumn("exitosos", row_count(run.loadable).scalar())
        .select(
            "procesados",
            "exitosos",
            "errores",
            F.when(done, F.lit(offset + batch_size)).alias("offset_siguiente"),
            F.when(~done, F.lit("No hay más registros")).alias("mensaje"),
        )
    )


def assign_ids(rows: DataFrame, target: DataFrame, dense: bool = False) -> DataFrame:
    """Target ids above all existing ones.

    Ids of the source are unique already, so adding the highest stored id keeps them unique
    without moving a row. ``dense`` numbers without gaps, for one shuffle.
    """
    top = target.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).scalar()
    based = rows.withColumn("_top", top)
    if dense:
        based = dense_index(based, "id", "_index").withColumn(
            "id", F.col("_top") + F.col("_index") + 1
        )
    else:
        based = based.withColumn("id", F.col("_top") + F.col("id"))
    return based.select(*rows.columns)


def loaded(run: Migration, target: DataFrame) -> DataFrame:
    """Rows of ``target`` that stem from the rows of this run."""
    meta = F.col("metadatos")
    origin = target.where(meta.getField("sistema_origen") == model.LEGACY_SYSTEM).select(
        meta.getField("id_origen").alias("id")
    )
    return origin.join(counted(run.source.select("id")), "id", "left_semi")


def run(
    legacy: DataFrame,
    target: DataFrame,
    target_path: str,
    log_path: str,
    as_of: AsOf,
    zone: str = model.TIME_ZONE,
) -> DataFrame:
    """Migrate what is pending: append it to ``target_path``, then keep errors, warnings, flags
    and counters as tables below ``log_path``. Returns the counters.

    The plan (typed source and rejects) is written beside the logs, to ``<log_path>.open``, before
    anything is loaded, and removed when the logs are complete. A run that failed anywhere can be
    repeated with the same paths: it goes on with the plan it finds, loads what is not in the
    target yet, and writes all logs of the first attempt, its counters included. Rows that came
    to the source meanwhile wait for the next run.
    """
    spark = legacy.sparkSession
    as_of = as_of.pinned(spark)
    work = OpenRun(spark, f"{log_path.rstrip('/')}.open")
    resumed = work.sealed
    todo = plan(pending(legacy, target), target, as_of, work, zone)
    work.seal()
    rows = todo.loadable
    if resumed:
        rows = rows.join(counted(loaded(todo, scan_target(spark, target_path))), "id", "left_anti")
    append_target(assign_ids(rows, target), target_path)
    after = scan_target(spark, target_path)
    typed = todo.source.drop("_error", "_fila")
    logs = {
        "failures": todo.failures,
        "warnings": todo.warnings,
        "rejects": todo.rejects,
        "flags": source_gate(typed, as_of).where(~F.col("es_valido")).select("id", "errores"),
        "origin": gate_report(typed, as_of),
        "stats": migration_stats(todo, loaded(todo, after)),
    }
    for name, frame in logs.items():
        frame.write.mode("overwrite").parquet(f"{log_path}/{name}")
    schema = logs["stats"].schema
    work.close()
    return spark.read.schema(schema).parquet(f"{log_path}/stats")


# --------------------------------------------------------------------------- summaries


def migration_stats(run: Migration, done: DataFrame | None = None) -> DataFrame:
    """Six counters. Every error record is one row that was not loaded; ``done`` holds the rows
    found loaded, or, before a load, those that would be."""
    return (
        run.source.agg(
            F.count("*").alias("total_procesados"),
            F.count_if(N.is_expediente_invalid(F.col("expediente"))).alias(
                "expedientes_duplicados"
            ),
        )
        .withColumn("total_exitosos", row_count(run.loadable if done is None else done).scalar())
        .withColumn("total_errores", row_count(run.errors).scalar())
        .withColumn("total_advertencias", row_count(run.warnings).scalar())
        .select(
            "total_procesados",
            "total_exitosos",
            "total_errores",
            "total_advertencias",
            "expedientes_duplicados",
            F.col("total_advertencias").alias("cui_invalidos"),
        )
    )


def batch_summary(run: Migration, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Processed, loaded and failed rows of each batch of consecutive ids.

    Rows that share an id are in the batch of that id. Rows without a usable id are batch 0: they
    failed, and have no place in the order.
    """
    known = run.source.where("id IS NOT NULL").groupBy("id").agg(
        F.count("*").alias("procesados"), F.count("_error").alias("_failed")
    )
    lost = run.rejects.groupBy(F.col("id_mysql").alias("id")).agg(F.count("*").alias("_lost"))
    per_id = known.join(lost, "id", "left_outer").select(
        "id", "procesados", (F.col("_failed") + F.coalesce("_lost", F.lit(0))).alias("errores")
    )
    numbered = dense_index(per_id, "id", "_index").withColumn("lote", F.expr(f"_index div {batch_size} + 1"))
    nowhere = run.source.where("id IS NULL").select(
        F.lit(0).cast("long").alias("lote"), F.lit(1).cast("long").alias("procesados"), F.lit(1).cast("long").alias("errores")
    )
    return (
        numbered.select("lote", "procesados", "errores")
        .unionByName(nowhere)
        .groupBy("lote")
        .agg(F.sum("procesados").alias("procesados"), F.sum("errores").alias("errores"))
        .select("lote", "procesados", (F.col("procesados") - F.col("errores")).alias("exitosos"), "errores")
    )


def report(run: Migration, rows: int = REPORT_ROWS) -> DataFrame:
    """First errors and warnings by id, each with the number of those not shown."""

    def section(name: str, records: DataFrame, text: Column) -> DataFrame:
        return (
            records.select(F.lit(name).alias("seccion"), "id_mysql", "tipo", text.alias("texto"))
            .orderBy("id_mysql")
            .limit(rows)
            .withColumn("restantes", F.greatest(row_count(records).scalar() - rows, F.lit(0)))
        )

    return section("ERROR", run.errors, F.col("error")).unionByName(
        section("ADVERTENCIA", run.warnings, F.col("mensaje"))
    )
