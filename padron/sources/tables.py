"""Reading, creating and replacing the tables the operators work on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron import model
from padron.operators.paging import row_count


def conform_legacy(rows: DataFrame) -> DataFrame:
    """Rows with exactly the legacy columns, in order, in the types the source gives them.

    The source spells one column ``fechaDefuncion``; a time of death arrives as a timestamp
    from some drivers and is kept as ``HH:mm:ss`` text. Values that do not fit are left to
    ``migration.coerce``: one of them must not stop a run.
    """
    if "fechaDefuncion" in rows.columns:
        rows = rows.withColumnRenamed("fechaDefuncion", "fecha_defuncion")
    if dict(rows.dtypes)["hora_defuncion"].startswith("timestamp"):
        rows = rows.withColumn("hora_defuncion", F.date_format("hora_defuncion", "HH:mm:ss"))
    return rows.select(*model.LEGACY_SCHEMA.fieldNames())


def scan_legacy(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Legacy table from files."""
    return conform_legacy(spark.read.format(format).load(path))


def scan_target(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(model.TARGET_SCHEMA).parquet(path)


def create_target(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Create the empty target table in the catalog, unless it is there, and return it."""
    if not table_exists(spark, name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=model.TARGET_SCHEMA)
    return spark.table(name)


def append_target(rows: DataFrame, path: str) -> None:
    """Add rows to the target. The file committer makes them visible all at once."""
    rows.select(*model.TARGET_COLUMNS).write.mode("append").parquet(path)


def replace_target(rows: DataFrame, name: str, root: str) -> str:
    """Write rows as a new snapshot below ``root`` and point the table at it.

    The snapshot being read is never overwritten; readers move over in one catalog step.
    """
    spark = rows.sparkSession
    path = os.path.join(root, f"snapshot-{uuid.uuid4().hex}")
    rows.select(*model.TARGET_COLUMNS).write.mode("errorifexists").parquet(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return path


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_count(rows: DataFrame) -> DataFrame:
    return row_count(rows)


def table_info(rows: DataFrame) -> DataFrame:
    """One row per column (name, type, nullable), each with the number of rows."""
    columns = [
        F.struct(
            F.lit(i).alias("posicion"),
            F.lit(f.name).alias("columna"),
            F.lit(f.dataType.simpleString()).alias("tipo"),
            F.lit(f.nullable).alias("admite_nulos"),
        )
        for i, f in enumerate(rows.schema.fields, 1)
    ]
    return (
        row_count(rows)
        .select("total", F.explode(F.array(*columns)).alias("c"))
        .select("c.*", F.col("total").alias("total_registros"))
    )


class Workspace:
    """Intermediate tables below the folder all executors share, gone when the work is done.

    The folder is ``spark.checkpoint.dir`` (or the context's checkpoint folder); without one
    nothing is written. Use as a context, or call ``close`` once the outcome is written.
    """

    def __init__(self, spark: SparkSession):
        shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        self.spark = spark
        self.path = f"{shared.rstrip('/')}/work-{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}-{uuid.uuid4().hex}"

    def settle(self, rows: DataFrame, name: str) -> DataFrame:
        """Write rows and read them back.

        For a frame that several later steps use and that is costly to compute: the steps then
        read only the columns they need, and nothing is computed again when an executor is lost.
        """
        path = self.folder(name)
        rows.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *problem) -> None:
        self.close()


class OpenRun(Workspace):
    """Tables of a run that stay until its logs are complete, so that a repeat goes on with them.

    Until ``seal`` tables are written anew; afterwards ``settle`` finds them as they are. A repeat
    after a failure thus has the plan of the first attempt, whatever was loaded meanwhile.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/sealed/_SUCCESS")
        self.sealed = mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def settle(self, rows: DataFrame, name: str) -> DataFrame:
        if not self.sealed:
            rows.write.mode("overwrite").parquet(self.folder(name))
        return self.spark.read.schema(rows.schema).parquet(self.folder(name))

    def seal(self) -> None:
        if not self.sealed:
            self.spark.range(1).write.mode("overwrite").parquet(self.folder("sealed"))
