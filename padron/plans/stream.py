"""The migration as a stream over files that arrive, and the refresh of rows that changed.

``load_stream`` takes the files that are there (``availableNow``), a batch at a time, and stops.
What was taken is in the checkpoint. A batch is a run of its own with logs under its number: if it
fails after the append and before the checkpoint knows of it, the batch comes again, finds its open
plan beside its logs, loads nothing twice and completes the counters of the first attempt.

``refresh`` loads rows whose ``update_at`` passed the stored watermark, the latest version of each
id, and everything not loaded so far. It writes a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from padron import model
from padron.functions.asof import AsOf
from padron.operators.skew import beside, counted, few
from padron.plans import migration
from padron.sources.tables import Workspace, append_target, scan_target


def load_stream(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    log_path: str,
    checkpoint: str,
    as_of: AsOf,
    schema: StructType = model.LEGACY_SCHEMA,
    files_per_batch: int | None = None,
    zone: str = model.TIME_ZONE,
) -> DataFrame:
    """Migrate the files below ``source_path`` that were not taken yet; the counters of all batches.

    Returns one row per batch so far: ``lote`` and the six counters.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        target = scan_target(session, target_path)
        migration.run(rows, target, target_path, f"{log_path}/lote={batch}", as_of, zone)

    query = (
        reader.parquet(source_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return batch_counters(spark, log_path)


def batch_counters(spark: SparkSession, log_path: str) -> DataFrame:
    """The counters of all batches below ``log_path``."""
    counters = spark.read.option("basePath", log_path).parquet(f"{log_path}/lote=*/stats")
    return counters.select(F.col("lote").cast("long").alias("lote"), *[c for c in counters.columns if c != "lote"])


# --------------------------------------------------------------------------- changed rows


def watermark(spark: SparkSession, path: str):
    """The stored watermark; null if nothing was stored."""
    schema = "hasta timestamp_ntz"
    try:
        return spark.read.schema(schema).parquet(path).agg(F.max("hasta")).first()[0]
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return None


def store_watermark(rows: DataFrame, path: str, column: str = "update_at") -> None:
    """Keep how far ``rows`` reach. Appended: the watermark is the highest value ever kept."""
    rows.agg(F.max(column).alias("hasta")).where("hasta IS NOT NULL").write.mode("append").parquet(path)


def latest_versions(rows: DataFrame, column: str = "update_at") -> DataFrame:
    """Of rows that share an id the one changed last; of those the greatest in the order of all columns.

    Only ids with several versions are aggregated, the others pass.
    """
    several = counted(rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    rest = [c for c in rows.columns if c not in ("id", column)]
    order = F.struct(column, *rest)
    last = rows.join(several, "id", "left_semi").groupBy("id").agg(F.max(order).alias("v")).select("id", "v.*")
    return rows.join(several, "id", "left_anti").unionByName(last)


def refresh(
    legacy: DataFrame, target: DataFrame, as_of: AsOf, work: Workspace, since, zone: str = model.TIME_ZONE
) -> tuple[DataFrame, migration.Migration]:
    """The snapshot of the target after the changes of ``legacy`` since the watermark ``since``.

    Rows changed since then replace what was loaded of them and keep the id they have in the
    target; rows never loaded are tried again. Identifiers of replaced rows are free for all. A
    changed row that is refused is not in the snapshot, and named in the errors of the run.
    """
    meta = F.col("metadatos")
    current = latest_versions(legacy)
    changed = current if since is None else current.where(F.col("update_at") > F.lit(since))
    waiting = migration.pending(current, target)
    todo = work.settle(changed.unionByName(waiting.select(*changed.columns)).distinct(), "changed")
    small = few(todo)
    ids = beside(todo.select(F.col("id").try_cast("int").alias("_origen")), small)
    own = target.withColumn("_origen", F.when(meta.getField("sistema_origen") == model.LEGACY_SYSTEM, meta.getField("id_origen")))
    stays = own.join(ids, "_origen", "left_anti").drop("_origen")
    known = beside(own.join(ids, "_origen", "left_semi").select("_origen", F.col("id").alias("_id")), small)
    run = migration.plan(todo, stays, as_of, work, zone)
    top = target.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).scalar()
    fresh = run.loadable.withColumn("_origen", F.col("metadatos").getField("id_origen")).join(known, "_origen", "left_outer")
    numbered = fresh.withColumn("_top", top).withColumn("id", F.coalesce("_id", F.col("_top") + F.col("id")))
    return stays.select(*model.TARGET_COLUMNS).unionByName(numbered.select(*model.TARGET_COLUMNS)), run
