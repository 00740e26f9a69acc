"""Requests for identifiers, decided as if they came one after the other.

A request asks values for one record. It is refused if another record holds one of them at that
moment: a stored record, or one whose earlier request was accepted, as long as no later accepted
request of that record has replaced the value. A refused request holds nothing and frees nothing.

Decisions are made in rounds over the graph of requests and values. In a round, a request is

* refused, if another record surely holds a value: it got it by an accepted request (or at first),
  and no open request of that record lies between that could still free it,
* accepted, if for each of its values no earlier request is open and nobody holds it,
* left open otherwise.

The first open request is decided in every round, and so are all that no open one stands before.
Rounds are as many as the longest row of requests that wait for each other; values asked for once,
or held for good, need one or two. What is accepted or refused is final, so no order of evaluation
changes it. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from padron.operators.identifiers import KEY
from padron.sources.tables import Workspace


def first_holders(events: DataFrame, held: DataFrame) -> DataFrame:
    """The stored rows ``fila, campo, clave`` that matter to the events.

    Rows that no request touches never give a value up: of those two per value are enough to say
    that a row other than the one asking has it.
    """
    touched = events.select("fila", "campo").distinct().withColumn("_touched", F.lit(True))
    marked = held.join(touched, ["fila", "campo"], "left_outer")
    idle = marked.where(F.col("_touched").isNull()).groupBy(*KEY).agg(F.min("fila").alias("a"), F.max("fila").alias("b"))
    two = idle.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("fila"), *KEY)
    return marked.where("_touched").select("fila", *KEY).unionByName(two)


def spells(events: DataFrame, decided: DataFrame, holders: DataFrame) -> DataFrame:
    """Who has or may have a value from when to when: ``fila, campo, clave, orden, aceptada, fin, quiza``.

    ``orden`` is null for stored values, ``aceptada`` for open requests. ``fin`` is the first
    accepted request of the row that replaces the value, ``quiza`` the first open one.
    """
    known = events.join(decided, "orden", "left_outer").where("aceptada IS NULL OR aceptada")
    stored = holders.select(F.lit(None).cast("long").alias("orden"), "fila", *KEY, F.lit(True).alias("aceptada"))
    later = Window.partitionBy("fila", "campo").orderBy(F.asc_nulls_first("orden")).rowsBetween(1, Window.unboundedFollowing)
    return known.select("orden", "fila", *KEY, "aceptada").unionByName(stored).withColumns(
        {
            "fin": F.min(F.when(F.col("aceptada"), F.col("orden"))).over(later),
            "quiza": F.min(F.when(F.col("aceptada").isNull(), F.col("orden"))).over(later),
        }
    )


def met(asked: DataFrame, held: DataFrame, how: str) -> DataFrame:
    """Requests with the accepted spells of other rows that last at their time."""
    others = held.where("aceptada AND clave IS NOT NULL").select(
        *KEY, F.col("fila").alias("otra"), F.col("orden").alias("desde"), F.col("fin").alias("hasta"), F.col("quiza").alias("tal_vez")
    )
    a, o = asked.alias("a"), others.alias("o")
    lasts = F.expr("(o.desde IS NULL OR o.desde < a.orden) AND (o.hasta IS NULL OR o.hasta > a.orden) AND o.otra != a.fila")
    same = (F.col("a.campo") == F.col("o.campo")) & (F.col("a.clave") == F.col("o.clave"))
    return a.join(o, same & lasts, how).select("a.*", "o.otra", "o.tal_vez")


def refusals(events: DataFrame, held: DataFrame, work: Workspace) -> DataFrame:
    """``orden, campo`` of the values that requests cannot have; who is not named is accepted.

    ``events``: ``orden`` (long, names the request), ``fila`` (the record it is for), ``campo`` and
    ``clave`` (the value asked for, null to give up the present one), one row per field given.
    ``held``: ``fila, campo, clave`` of the stored rows that have one of these values.
    """
    spark = events.sparkSession
    events = work.settle(events.select("orden", "fila", *KEY), "events")
    holders = work.settle(first_holders(events, held), "holders")
    decided = spark.createDataFrame([], "orden long, aceptada boolean")
    while True:
        now = spells(events, decided, holders)
        left = now.where("aceptada IS NULL").select("orden", "fila", *KEY)
        before = left.where("clave IS NOT NULL").groupBy(*KEY).agg(F.min("orden").alias("antes"))
        waiting = met(left, now, "left_outer").join(before, list(KEY), "left_outer")
        in_the_way = F.col("otra").isNotNull()
        fresh = (
            waiting.groupBy("orden")
            .agg(
                F.bool_or(in_the_way & (F.col("tal_vez").isNull() | (F.col("tal_vez") >= F.col("orden")))).alias("tomada"),
                F.bool_or(F.coalesce(F.col("antes") < F.col("orden"), F.lit(False)) | in_the_way).alias("incierta"),
            )
            .where("tomada OR NOT incierta")
            .select("orden", (~F.col("tomada")).alias("aceptada"))
        )
        fresh = work.settle(fresh, "decided")
        if fresh.isEmpty():
            break
        decided = decided.unionByName(fresh)
    final = spells(events, decided, holders)
    return met(events.where("clave IS NOT NULL"), final, "inner").select("orden", "campo").distinct()
