"""What the operators of this package share: reading, shared storage, batches in tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a table of documents; operators need ``doc_id`` and ``text``, some also ``lang`` or ``source``.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Rows in one Arrow batch. Texts are long, so the default of 10,000 rows would be large.
BATCH_ROWS = 500


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    It is set here only where it is unset and the whole session is this one process.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="documents-"))
    return shared_folder(spark)


def settle(rows: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage, so that nothing is computed again for a second use or a lost executor.
    The files stay until whoever owns the shared folder removes them.
    """
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.option("compression", compression).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts, for the plans made from now on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_batches(
    rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    small_batches(rows.sparkSession)
    return rows.mapInArrow(function, schema)


def batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) for f in schema], schema=schema
    )
