"""A stored index of three-letter runs: searches for a text inside a field without reading all rows.

The index is a catalog table of posting lists ``gram, campo, bloque, ids`` in buckets of ``gram``:
the ids below one another in one block of 65,536 ids whose field holds the run of three letters, in
lower case. So a frequent run is many rows of bounded size and not one hot key.

A search takes the runs of the text asked for, reads the buckets of those only, and intersects the
lists block by block. What comes out may be too much but never too little; the rows are then met by
id and judged by the condition itself. That makes upkeep simple: rows that are new or changed add
their runs, and nothing need be taken out for rows that changed or are gone. ``compact`` writes the
index anew when much of it is stale.

``%`` and ``_`` stay wildcards and end a run, as does an escaped character. A text without any run
of three letters cannot use the index; it is left to the condition, over all rows if no other text
of the form can. Rows without an id are not indexed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.operators.lookup import (
    FAMILY_FIELDS,
    FREE_TEXT_FIELDS,
    NAME_FIELDS,
    SearchParams,
    search,
    search_nombre_completo,
)
from padron.operators.skew import BLOCK_BITS, block_of

SIZE = 3
BUCKETS = 64
COLUMNS = ("gram", "campo", "bloque", "ids")
NAMES = tuple(dict.fromkeys((*NAME_FIELDS, *FREE_TEXT_FIELDS)))
FIELDS = ("expediente", "pasaporte", *NAMES)

#: Found ids that lie in at most so many blocks reach the scan as ranges of ids.
RANGES = 200

# A wildcard, or an escape with the character it escapes.
BREAK = re.compile(r"\\.?|[%_]", re.DOTALL)

#: One condition of a form: the text stands in at least one of the fields.
Term = tuple[Sequence[str], str]


def grams(text: Column) -> Column:
    """The distinct runs of three letters of a text in lower case; null where there are none."""
    low = F.lower(text)
    last = F.length(low) - (SIZE - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(low, i, F.lit(SIZE)))))


def postings(rows: DataFrame) -> DataFrame:
    """The posting lists of the rows of a target."""
    value = lambda f: F.col("nombre").getField(f) if f in NAMES else F.col(f)
    entries = F.array(*[F.struct(F.lit(f).alias("campo"), grams(value(f)).alias("grams")) for f in FIELDS])
    found = rows.where("id IS NOT NULL").select(F.col("id").cast("long").alias("id"), F.explode(entries).alias("e"))
    runs = found.select("id", "e.campo", F.explode("e.grams").alias("gram"))
    return runs.groupBy("gram", "campo", block_of("id").alias("bloque")).agg(F.array_sort(F.collect_set("id")).alias("ids"))


def search_terms(params: SearchParams) -> list[Term]:
    """The texts a search form looks for inside fields."""
    asked = ((("expediente",), params.expediente), (("pasaporte",), params.pasaporte), (NAME_FIELDS, params.nombre), (FAMILY_FIELDS, params.apellido))
    return [(fields, text) for fields, text in asked if text]


@dataclass(frozen=True)
class TextIndex:
    spark: SparkSession
    name: str
    buckets: int = BUCKETS

    def _append(self, lists: DataFrame, path: str | None = None) -> None:
        # One task per bucket, so that a turn adds at most one file to each.
        dealt = lists.select(*COLUMNS).repartition(self.buckets, "gram")
        writer = dealt.write.format("parquet").mode("append").bucketBy(self.buckets, "gram").sortBy("gram", "campo", "bloque")
        (writer.option("path", path) if path else writer).saveAsTable(self.name)

    def add(self, rows: DataFrame) -> None:
        """Rows that were loaded, created or changed, as they are now; once more changes nothing."""
        self._append(postings(rows))

    def lists(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self, rows: DataFrame, name: str, path: str | None = None) -> TextIndex:
        """A new index of the rows as they stand."""
        return build_text_index(rows, name, path, self.buckets)

    def asked(self, text: str) -> list[str]:
        """The runs a matching field must hold; none: the index cannot tell."""
        parts = [p for p in BREAK.split(text) if p]
        if not parts:
            return []
        # In the words of the session, so that letters get lower as those of the fields did.
        runs = [F.coalesce(grams(F.lit(p)), F.array().cast("array<string>")) for p in parts]
        return sorted(self.spark.range(1).select(F.array_distinct(F.concat(*runs)).alias("g")).first().g)

    def candidates(self, terms: Sequence[Term]) -> DataFrame | None:
        """``id`` of all rows that may fit every term, and of others; None: it may be any row."""
        usable = [(fields, runs) for fields, text in terms if (runs := self.asked(text))]
        if not usable:
            return None
        wanted = sorted({(f, g) for fields, runs in usable for f in fields for g in runs})
        column = {pair: f"_l{i}" for i, pair in enumerate(wanted)}
        empty = F.array().cast("array<bigint>")
        held = lambda pair: F.flatten(F.collect_list(F.when((F.col("campo") == pair[0]) & (F.col("gram") == pair[1]), F.col("ids"))))
        asked = (F.col("campo").isin(*{f for f, _ in wanted})) & (F.col("gram").isin(*{g for _, g in wanted}))
        # A row per block: each list in it is bounded by the block.
        blocks = self.lists().where(asked).groupBy("bloque").agg(*[held(pair).alias(name) for pair, name in column.items()])
        in_field = lambda field, runs: reduce(F.array_intersect, [F.col(column[field, g]) for g in runs])
        in_term = lambda fields, runs: reduce(F.array_union, [in_field(f, runs) for f in fields], empty)
        fit = reduce(F.array_intersect, [in_term(fields, runs) for fields, runs in usable])
        return blocks.select(F.explode(F.array_distinct(fit)).alias("id"))

    def narrowed(self, rows: DataFrame, terms: Sequence[Term]) -> DataFrame:
        """The rows that may fit the terms. Ids in few blocks become ranges the scan can skip by."""
        found = self.candidates(terms)
        if found is None:
            return rows
        blocks = [r.b for r in found.select(block_of("id").alias("b")).distinct().limit(RANGES + 1).collect()]
        kept = rows
        if len(blocks) <= RANGES:
            kept = rows.where(_in_blocks(sorted(blocks)))
        return kept.join(found, "id", "left_semi").select(*rows.columns)

    def search(self, rows: DataFrame, params: SearchParams) -> DataFrame:
        """All rows that fit the form, as ``lookup.search`` gives them."""
        return search(self.narrowed(rows, search_terms(params)), params)

    def search_nombre_completo(self, rows: DataFrame, text: str, limit: int = 20) -> DataFrame:
        return search_nombre_completo(self.narrowed(rows, [(FREE_TEXT_FIELDS, text)]), text, limit)


def _in_blocks(blocks: Sequence[int]) -> Column:
    """Ids that lie in the blocks, neighbours in one range."""
    ranges: list[list[int]] = []
    for b in blocks:
        if ranges and ranges[-1][1] == b - 1:
            ranges[-1][1] = b
        else:
            ranges.append([b, b])
    between = [F.col("id").between(lo << BLOCK_BITS, ((hi + 1) << BLOCK_BITS) - 1) for lo, hi in ranges]
    return reduce(lambda x, y: x | y, between, F.lit(False))


def build_text_index(rows: DataFrame, name: str, path: str | None = None, buckets: int = BUCKETS) -> TextIndex:
    """An index over the texts of a target."""
    index = TextIndex(rows.sparkSession, name, buckets)
    index._append(postings(rows), path)
    return index
