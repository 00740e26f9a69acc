"""Quality rules with thresholds that adapt to language and source.

Each document gets a few integer measures. Per language and source, a mergeable quantile sketch
holds the distribution of each measure: counts in log-linear bins (32 bins to a power of two, so
a quantile is at most 1/32 off), which partial aggregation merges by adding. Upper and lower
limits follow from its tails, and joining them back to the documents gives the verdict.

A limit is the quantile ``TAIL`` (below: 1 - TAIL) plus ``MARGIN`` times its distance from the
median. Where a group's tail does not differ from its median it is degenerate, and the least
spread stated for the measure takes the place of that margin, so that a group whose documents are
all alike loses none. A group of fewer than ``MIN_GROUP`` documents uses the sketch of all groups merged.

Null texts have no words. Null languages and sources form groups of their own. Repeated rows
count as often as they come. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle, text_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"

TAIL = 0.95
MARGIN = 3.0
MIN_GROUP = 50
#: Measures in units of 1/1000: (numerator, denominator, sides that are checked, least spread).
MEASURES = {
    "mean_word": ("word_chars", "n_words", "both", 1000),
    "symbols": ("n_symbols", "n_words", "high", 50),
    "duplicate_lines": ("n_dup_lines", "n_lines", "high", 500),
    "repeats": ("n_repeat_words", "n_words", "high", 300),
}

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words found at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=len(words))
    # Windows are named word by word, so a name never outgrows 64 bits.
    named = ids
    for i in range(1, window):
        longer = named[:-1] * np.int64(len(names)) + ids[i:]
        _, named, counts = np.unique(longer, return_inverse=True, return_counts=True)
    found = counts[named] > 1
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    at = np.flatnonzero(found)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    continued = 0 if joined.isascii() else int(((np.frombuffer(joined, dtype=np.uint8) & 0xC0) == 0x80).sum())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(joined) - continued,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source`` and the counts of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = np.array([counts_of(t) for t in rows.column(3).to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
            columns = [rows.column(i) for i in range(3)] + [pa.array(found[:, i]) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "source", *COUNTS])

    texts = docs.select("doc_id", "lang", "source", text_of().cast("binary").alias("text"))
    types = dict(texts.dtypes)
    schema = ", ".join([f"{c} {types[c]}" for c in ("doc_id", "lang", "source")] + [f"{c} long" for c in COUNTS])
    return map_batches(texts, run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def values() -> Column:
    """The measures of a row as an array of (measure, value)."""
    return F.array(
        *[
            F.struct(F.lit(name).alias("measure"), F.when(F.col(under) > 0, F.floor(1000 * F.col(over) / F.col(under))).otherwise(0).cast("long").alias("value"))
            for name, (over, under, _, _) in MEASURES.items()
        ]
    )


def bin_of(value: Column) -> Column:
    """Values below 64 have a bin each; above, 32 bins share each power of two."""
    exponent = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(exponent * 32 + F.floor(value / F.pow(F.lit(2.0), exponent))).cast("long")


def lowest_of(bins: Column) -> Column:
    """The smallest value of a bin."""
    exponent = F.floor(bins / 32) - 1
    return F.when(bins < 64, bins).otherwise((bins - exponent * 32) * F.pow(F.lit(2.0), exponent)).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """One row per group, measure and bin, with its count; adding counts merges sketches. Documents
    that fail the base rule are rejected anyhow and would only widen the limits."""
    pairs = measured.where(~base_failed()).select("lang", "source", F.explode(values()).alias("m"))
    return pairs.groupBy("lang", "source", F.col("m.measure").alias("measure"), bin_of(F.col("m.value")).alias("bin")).agg(F.count("*").alias("n"))


def tails(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Both tails and the median of each group and measure. A group has at most some 2,000 bins."""
    whole = Window.partitionBy(*groups, "measure")
    upto = F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketch.withColumn("upto", upto).withColumn("rows", F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("rows"), lowest_of(F.col("bin"))))
    return ranked.groupBy(*groups, "measure").agg(at(1 - TAIL).alias("low"), at(0.5).alias("middle"), at(TAIL).alias("high"), F.first("rows").alias("rows"))


def limits(measured: DataFrame) -> DataFrame:
    """One row per language and source: ``low_<measure>`` and ``high_<measure>``."""
    sketch = settle(sketches(measured), "sketches")
    merged = sketch.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    names = ("low", "middle", "high")
    of_all = tails(merged, []).select("measure", *[F.col(c).alias(f"all_{c}") for c in names])
    own = tails(sketch, ["lang", "source"]).join(F.broadcast(of_all), "measure")
    low, middle, high = (F.when(F.col("rows") < MIN_GROUP, F.col(f"all_{c}")).otherwise(F.col(c)) for c in names)
    least = F.create_map(*[F.lit(x) for name, m in MEASURES.items() for x in (name, m[3])])[F.col("measure")]
    margin = lambda far: F.when(far > 0, far * MARGIN).otherwise(least)
    sides = own.select("lang", "source", "measure", (low - margin(middle - low)).alias("low"), (high + margin(high - middle)).alias("high"))
    pick = lambda name, side: F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{side}_{name}")
    return sides.groupBy("lang", "source").agg(*[pick(name, side) for name in MEASURES for side in ("low", "high")])


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its counts, ``base_failed`` and ``kept``."""
    measured = settle(measure(docs), "measures")
    # One row per language and source: Spark broadcasts it where it is small.
    bounds = limits(measured).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(
        bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left_outer"
    )
    inside = F.lit(True)
    for pair, (name, (_, _, sides, _)) in zip(range(len(MEASURES)), MEASURES.items(), strict=True):
        value = values()[pair]["value"]
        inside = inside & F.coalesce(value <= F.col(f"high_{name}"), F.lit(True))
        if sides == "both":
            inside = inside & F.coalesce(value >= F.col(f"low_{name}"), F.lit(True))
    failed = base_failed()
    return joined.select("doc_id", "lang", "source", *COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept"))
