"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) weigh 3, 1, 2, 3, ... and share a total; no
target exceeds ``MAX_REPEATS`` times its source, and the excess goes to the others by weight.

Sample: a source wants ``target / size`` copies of each document. The whole part is allocated
for certain. The rest, an inclusion probability p below 1, is drawn by Pareto order sampling: a
document's rank is the odds of its random number u over the odds of p, and the documents of the
lowest ranks are taken until the words still wanted are reached (a fixed size, in words). The
one document whose size comes nearest to what is then missing is added if that brings the source
closer. u comes from the id, so reruns agree. Copies are whole: no text is cut.

An optional column of positive ``preference`` makes the inclusion odds differ within a source: the odds of p
are multiplied by it. Null texts have size 0; documents of size 0 are taken in whole copies
only. Rows that repeat an id are drawn together as far as their ranks tie. Columns of any other
name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import settle, text_of

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2

#: Ranks are cut into so many bins, whose sizes are summed before any rows are ordered.
BINS = 1 << 16

WORD = r"[^\x20\x09-\x0D]+"


def word_count(column: str = "text") -> Column:
    """Runs of characters that are no ASCII space: one pass, no array of words."""
    tidy = F.trim(F.regexp_replace(text_of(column), r"[\x20\x09-\x0D]+", " "))
    return F.when(tidy == "", 0).otherwise(
        F.octet_length(tidy) - F.octet_length(F.replace(tidy, F.lit(" "), F.lit(""))) + 1
    ).cast("long")


def uniform(key: str) -> Column:
    """A number in (0, 1) from 48 bits of the MD5 of the id; the same in every run."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from one row per (source, size).

    Sharing what exceeds a limit by weight, again and again, ends at one level t with target =
    min(limit, weight * t). Sources are few; running sums over them in the order in which they
    reach their limits give t.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    nth = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (nth + 1).cast("int"))
    limit = F.col("source_size") * float(MAX_REPEATS)
    weighed = per_source.withColumn("weight", weight).withColumn("limit", limit).withColumn("fills_at", F.col("limit") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    earlier = everything.orderBy("fills_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * TOTAL_SHARE
    rest_limit = F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    level = (total - rest_limit) / rest_weight
    # The first source that stays below its limit has the level; those after it have lower ones.
    solved = weighed.withColumn("level", level).withColumn("level", F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(everything))
    target = F.least(F.col("limit"), F.col("weight") * F.coalesce("level", F.lit(float("inf"))))
    return solved.select("source", "source_size", target.alias("target"))


def measured(docs: DataFrame, preference: Column | None = None) -> DataFrame:
    """What the sample depends on: doc_id, source, size, preference."""
    preference = F.lit(1.0) if preference is None else preference.cast("double")
    return docs.select("doc_id", "source", word_count().alias("size"), preference.alias("preference"))


def ranked(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """Rows with what their source wants, their Pareto rank and its bin (both null: not drawn)."""
    known = rows.join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u, p = uniform("doc_id"), F.col("share")
    odds = (u / (1 - u)) / (p / (1 - p) * F.col("preference"))
    return (
        known.withColumn("whole", F.floor(ratio))
        .withColumn("share", ratio - F.col("whole"))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("rank", F.when((p > 0) & (F.col("size") > 0), odds))
        .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
        .drop("share")
    )


def place() -> Column:
    return F.struct("rank", "doc_id", "size")


def before_cut() -> Column:
    """Whether a ranked row lies before its source's cut."""
    bins, edge = F.col("bin"), F.col("edge")
    inside = F.when(edge.isNull() | (bins < edge), True).when(bins == edge, place() <= F.col("cut"))
    return F.col("rank").isNotNull() & F.coalesce(inside, F.lit(False))


def cuts(rows: DataFrame) -> DataFrame:
    """One row per source: source_size, target, and where its sample ends.

    Sizes are summed per bin first; only the rows of one bin in 65,536 are put in order.
    ``edge`` is that bin (null: everything is taken), ``cut`` the last row taken in it, ``top``
    the row added afterwards.
    """
    goal = settle(targets(rows), "targets")
    drawn = ranked(rows, goal).where("rank IS NOT NULL")
    per_source = Window.partitionBy("source")
    before = per_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = drawn.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
    edges = (
        bins.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .where("before <= wanted AND before + words > wanted")
        .select(F.col("source").alias("_source"), F.col("bin").alias("edge"), "before")
    )
    same = F.col("source").eqNullSafe(F.col("_source"))
    within = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    ends = (
        drawn.join(edges, same & (F.col("bin") == F.col("edge")))
        .withColumn("upto", F.col("before") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("source")
        .agg(F.first("edge").alias("edge"), F.max(F.when(F.col("upto") <= F.col("wanted"), place())).alias("cut"))
    )
    ends = settle(
        goal.join(ends.withColumnRenamed("source", "_source"), same, "left_outer").drop("_source"), "ends"
    )
    split = ranked(rows, ends).where("rank IS NOT NULL").withColumn("taken", before_cut())
    missing = split.groupBy("source").agg(
        (F.first("wanted") - F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0))).alias("missing")
    )
    gap = F.abs(F.col("size") - F.col("missing"))
    tops = (
        split.where(~F.col("taken"))
        .join(missing.withColumnRenamed("source", "_source"), same)
        .where(gap < F.col("missing"))
        .groupBy("source")
        .agg(F.min(F.struct(gap.alias("gap"), place().alias("place"))).alias("best"))
        .select(F.col("source").alias("_source"), F.col("best.place").alias("top"))
    )
    return settle(ends.join(tops, same, "left_outer").drop("_source"), "cuts")


def plan(docs: DataFrame, preference: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken."""
    rows = settle(measured(docs, preference), "sizes")
    taken = copies()
    return ranked(rows, cuts(rows)).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.alias("copies"),
        (taken * F.col("size")).alias("taken"),
    )


def copies() -> Column:
    extra = before_cut() | F.coalesce(place() == F.col("top"), F.lit(False))
    return (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, preference: Column | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; texts never leave their task."""
    sample = settle(measured(docs, preference), "sizes")
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[docs[c] for c in ("doc_id", "source")],
        word_count().alias("size"), (F.lit(1.0) if preference is None else preference.cast("double")).alias("preference"),
    )
    counted = ranked(packed, cuts(sample)).withColumn("copies", copies()).where("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
