"""References from file to mother's file, followed to their end.

A file number points at the mother's file number of its records (the least, where they differ).
Pointers are doubled: in each round every pointer still on its way takes over where its target
points, so a chain of n files takes about log2(n) rounds, and only files still on their way move.
Files on a cycle, or on the way into one, never end: as long as another is on its way, each round
ends one, so after a round that ends none only they are left. Once the pointers span as many
references as there are such files, every target lies on its cycle and its own way is all of it,
which gives the cycle's least number. Each round is a written table. A file that a large part of
all references point at is joined by broadcast (``lookup_join``), so that it is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.functions.text import has_number
from padron.operators.skew import lookup_join
from padron.sources.tables import Workspace

#: Rounds of doubling: enough for chains of 2**62 files.
MAX_ROUNDS = 62


def mother_links(legacy: DataFrame) -> DataFrame:
    """``hijo, madre``: one row per file number with a reference to a mother's file."""
    pairs = legacy.where(has_number(F.col("expediente")) & has_number(F.col("exp_madre")))
    return pairs.groupBy(F.col("expediente").cast("long").alias("hijo")).agg(F.min("exp_madre").cast("long").alias("madre"))


def _onward(moving: DataFrame, pointers: DataFrame) -> DataFrame:
    """Each moving pointer with the pointer of its target."""
    wanted = moving.groupBy("a").agg(F.count("*").alias("n"))
    steps = pointers.select(F.col("hijo").alias("a"), F.col("a").alias("a2"), F.col("pasos").alias("p2"), F.col("menor").alias("m2"), F.col("fin").alias("f2"))
    return lookup_join(moving, steps.join(wanted, "a"), ["a"], "n")


def chains(legacy: DataFrame, work: Workspace) -> DataFrame:
    """``expediente, raiz, pasos, raiz_existe, ciclo`` for every file number with such a reference.

    ``raiz`` is the last number of the chain, ``pasos`` the references on the way to it, and
    ``raiz_existe`` tells whether it is a file of the table. Where the way leads into a cycle they
    are null, and ``ciclo`` is the least number on that cycle.
    """
    links = work.settle(mother_links(legacy), "links")
    starts = links.select(F.col("hijo").alias("_h"))
    # fin: the target has no reference of its own. menor: the least number on the way, without the target.
    ends = links.groupBy("madre").agg(F.count("*").alias("n")).join(starts, F.col("madre") == F.col("_h"), "left_outer")
    first = lookup_join(links, ends.select("madre", F.col("_h").isNull().alias("fin"), "n"), ["madre"], "n")
    first = work.settle(first.select("hijo", F.col("madre").alias("a"), F.lit(1).cast("long").alias("pasos"), F.col("hijo").alias("menor"), "fin"), "pointers")
    done, moving = first.where("fin"), first.where("NOT fin")
    for spanned in (1 << k for k in range(1, MAX_ROUNDS)):
        if moving.isEmpty():
            break
        onward = _onward(moving, done.unionByName(moving))
        step = work.settle(
            onward.select("hijo", F.col("a2").alias("a"), (F.col("pasos") + F.col("p2")).alias("pasos"), F.least("menor", "m2").alias("menor"), F.col("f2").alias("fin")),
            "pointers",
        )
        state = step.agg(F.count_if("fin").alias("ended"), F.count("*").alias("all")).first()
        done, moving = done.unionByName(step.where("fin")), step.where("NOT fin")
        if not state.ended and spanned >= state.all:
            break
    # The target lies on the cycle, and its own way is the whole of it.
    least = _onward(moving, moving).select("hijo", F.col("m2").alias("ciclo"))
    known = legacy.where(has_number(F.col("expediente"))).select(F.col("expediente").cast("long").alias("_k")).distinct()
    roots = done.groupBy("a").agg(F.count("*").alias("n")).join(known, F.col("a") == F.col("_k"), "left_outer")
    named = lookup_join(done, roots.select("a", F.col("_k").isNotNull().alias("raiz_existe"), "n"), ["a"], "n")
    found = named.select(F.col("hijo").alias("expediente"), F.col("a").alias("raiz"), "pasos", "raiz_existe", F.lit(None).cast("long").alias("ciclo"))
    none = lambda kind: F.lit(None).cast(kind)
    return found.unionByName(
        least.select(F.col("hijo").alias("expediente"), none("long").alias("raiz"), none("long").alias("pasos"), none("boolean").alias("raiz_existe"), "ciclo")
    )
