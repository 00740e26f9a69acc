"""Exact deduplication against a persistent digest index.

The index is a catalog table bucketed and sorted by digest, empty at first. A load comes in turns,
from the largest ids to the smallest. The digests of each turn meet the index in a sort-merge anti
join that reads it bucket by bucket, without shuffling it, and only those it does not hold are
appended. So the row that brings a digest into the index is the one that stays, and a later turn or
a later load finds it there.

Nulls count as empty texts. A row without ``doc_id`` is a row like any other and has the lowest
id. Of equal texts the row with the largest ``doc_id`` stays; where rows repeat that id, one of
them stays. Other columns pass through and may have any name but those added here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from padron.llm.common import settle, text_of
from padron.operators.skew import lookup_join

BUCKETS = 64
TURNS = 2
INDEX_COLUMNS = ("digest", "keep_id", "keep_row", "group_size")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, a number for the row, and the SHA-256 of the whole text, written once."""
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row_no"),
        F.unhex(F.sha2(text_of().cast("binary"), 256)).alias("digest"),
    )
    return settle(rows, "digests")


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays and the number of rows. Combined before the shuffle."""
    last = F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("i"), "doc_id", "row_no"))
    return (
        rows.groupBy("digest")
        .agg(last.alias("last"), F.count("*").alias("group_size"))
        .select("digest", F.col("last.doc_id").alias("keep_id"), F.col("last.row_no").alias("keep_row"), "group_size")
    )


def new_digests(found: DataFrame, index: str) -> DataFrame:
    """Those groups whose digest the index does not hold yet."""
    held = found.sparkSession.table(index).select("digest")
    return found.join(held.hint("merge"), "digest", "left_anti")


def store(found: DataFrame, index: str, buckets: int) -> None:
    dealt = found.select(*INDEX_COLUMNS).repartition(buckets, "digest")
    dealt.write.mode("append").format("parquet").bucketBy(buckets, "digest").sortBy("digest").saveAsTable(index)


def append(found: DataFrame, index: str, buckets: int = BUCKETS) -> DataFrame:
    """Add groups that are new to the index, creating it where needed; returns what was added."""
    spark: SparkSession = found.sparkSession
    if not spark.catalog.tableExists(index):
        store(found.limit(0), index, buckets)
    found = settle(new_digests(found, index), "new-digests")
    store(found, index, buckets)
    return found


def in_turns(rows: DataFrame, turns: int) -> list[DataFrame]:
    """Rows by falling ranges of ids of about one size; those without an id come last."""
    cuts = rows.agg(F.percentile_approx("doc_id", [1 - k / turns for k in range(1, turns)], F.lit(1000)).alias("c")).first().c or []
    place = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    edges = [None, *sorted(set(cuts), reverse=True), None]
    parts = []
    for high, low in zip(edges, edges[1:], strict=False):
        part = rows if high is None else rows.where(place < high)
        parts.append(part if low is None else part.where(place >= low))
    return parts


def decisions(docs: DataFrame, index: str, buckets: int = BUCKETS, turns: int = TURNS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, row_no.

    ``keep_id`` is the row that stays of those given; where the index held the text before,
    none of them is kept and ``indexed`` is true. The digests are appended to the index.
    """
    rows = digests(docs)
    found, added = None, None
    for part in in_turns(rows, turns):
        here = settle(groups(part), "groups")
        new = append(here, index, buckets)
        found, added = (here, new) if found is None else (found.unionByName(here), added.unionByName(new))
    last = F.struct(F.coalesce("keep_id", F.lit(-(2**63))), "keep_id", "keep_row")
    totals = found.groupBy("digest").agg(F.sum("group_size").alias("group_size"), F.max(last).alias("last"))
    entered = added.select("digest", F.struct("keep_id", "keep_row").alias("_new"))
    named = totals.join(entered, "digest", "left_outer").select(
        "digest", "group_size", F.when(F.col("_new").isNull(), F.col("last.keep_id")).otherwise(F.col("_new.keep_id")).alias("keep_id"), F.col("_new.keep_row").alias("_row")
    )
    # Copies of one text may be a third of all rows: the largest groups are joined by broadcast.
    marked = lookup_join(rows, named, ["digest"], "group_size")
    return marked.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row_no") == F.col("_row"), F.lit(False)).alias("kept"),
        F.col("_row").isNull().alias("indexed"),
        "digest",
        "row_no",
    )


def deduplicate(docs: DataFrame, index: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns they had.

    Rows are found again by id, which no large group shares, and then by digest. Of repeated
    rows of one id and text one stays.
    """
    key = lambda c: F.coalesce(F.col(c), F.lit(-(2**63)))
    packed = docs.select(key("doc_id").alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    kept = decisions(docs, index, buckets).where("kept").select(key("doc_id").alias("key"), "digest")
    digest = F.unhex(F.sha2(F.coalesce("row.text", F.lit("")).cast("binary"), 256))
    found = packed.join(kept, "key").where(digest == F.col("digest"))
    first = F.row_number().over(Window.partitionBy("key", "digest").orderBy("digest"))
    return found.withColumn("nth", first).where("nth = 1").select("row.*")
