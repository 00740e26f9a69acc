"""Spelling variants: words one edit apart, by a frontier of states over a distributed trie.

The trie is a table of edges ``node, c, child``. A node is the hash of a prefix. A state is
``word, pos, node, edits``: the word's first ``pos`` letters have led to the node with so many
edits. Each level is one join of all states with the edges of their nodes: without an edit a state
goes on by its own letter, or by another one as its edit; with one it goes on by its own letter
only. Leaving a letter out needs no edge. States that have read their word and stand at the end of
a word, with one edit, are neighbours.

* Two tries, one of the words and one of the reversed words: an edit in the second half of a word
  is sought in the first, one in the first half in the second. So half of each word is walked
  exactly and is no search; states start deep in the trie, where few edges leave a node.
* The neighbour relation is symmetric. Only replacements by a later letter and left-out letters are
  walked, and each pair counts for both words.
* An edge tells which letters may follow its child (as bits, so some are told in vain) and how many
  letters may be left there. A state that cannot go on is not made.
* The edges of the ``HEAVY`` nodes with the most words are broadcast (at most ``HEAVY`` times 90
  letters); the others stay in a bucketed table that does not move, and only states are shuffled.

Words longer than ``WALKED`` letters would need a level a letter. They meet by hashes instead: a
word without its i-th letter equals another word, or another word without its i-th letter. That
makes one row per letter, so it grows with the text of the words, and it is exact as well.

Hashes only propose; each pair is verified by its edit distance. A word has at most some 90
neighbours per letter, so pairs grow with the words and not with their square.

A word's form is its neighbour with the largest count (ties: smallest by code point) if that is
at least ``RATIO`` times its own. Forms grow along the way, so there are no cycles; roots are found
by doubling pointers.

Null and empty texts have no words. A row without an id takes part with an empty id. Repeated rows
count each for themselves. Texts are read whole, of any length. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle

RUN = re.compile("[a-zÀ-ÿ]+")
MODULUS = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2

#: Longest word that walks the trie, and nodes whose edges are broadcast.
WALKED = 32
HEAVY = 1000
#: Words that a task counts before it passes them on.
HELD = 1 << 18
#: Of the hashes of long words.
BASE, PRIME = 1_000_003, (1 << 61) - 1


def misspelt(start: int, word: str) -> str:
    """The word, or the word without one letter where the hash of id and word says so."""
    h = zlib.crc32(word.encode(), start)
    if h % MODULUS:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def occurrences(docs: DataFrame) -> DataFrame:
    """``word, n``: partial counts of the words long enough."""

    def told(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for rows in batches:
            for key, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                # Only A-Z are lower-cased: bytes know no other letters.
                for word, n in Counter(RUN.findall(text.lower().decode(errors="replace"))).items():
                    word = misspelt(start, word)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield told(counts)
                    counts = Counter()
        if counts:
            yield told(counts)

    given = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(given, run, "word string, n long")


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    return occurrences(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_bit(letter: Column) -> Column:
    """One of 64 bits for a letter; none for an empty text."""
    return F.when(letter == "", F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(letter) % 64))


def node_of(way: str, text: Column) -> Column:
    return F.xxhash64(F.lit(way), text)


def trie(words: DataFrame, way: str) -> DataFrame:
    """``node, c, child, follow, left, below`` of the edges below half of each word.

    ``follow``: bits of the letters that leave the child. ``left``: bits of the numbers of letters
    from the child to the end of a word; bit 0 is a word that ends there. ``below``: words.
    """
    # No state that may end at this word starts above half of its length.
    steps = words.select("w", F.expr("explode(sequence(cast(length(w) div 2 as int), length(w) - 1)) AS d"))
    return steps.groupBy(
        node_of(way, F.expr("substring(w, 1, d)")).alias("node"),
        F.expr("substring(w, d + 1, 1)").alias("c"),
        node_of(way, F.expr("substring(w, 1, d + 1)")).alias("child"),
    ).agg(
        F.bit_or(letter_bit(F.expr("substring(w, d + 2, 1)"))).alias("follow"),
        F.bit_or(F.expr("shiftleft(1L, length(w) - d - 1)")).alias("left"),
        F.count("*").alias("below"),
    )


def starts(words: DataFrame, way: str) -> DataFrame:
    """The states at the first place where this way seeks an edit."""
    half = "length(w) div 2" if way == ">" else "length(w) - length(w) div 2"
    return words.select(F.lit(way).alias("way"), "w", F.expr(f"cast({half} as int)").alias("pos")).withColumn("node", node_of(way, F.expr("substring(w, 1, pos)")))


def can_go(pos: str) -> Column:
    """Whether a word with an edit may be finished from the child on, at this position."""
    rest = F.expr(f"length(w) - ({pos})")
    ends = F.expr(f"(left & shiftleft(1L, length(w) - ({pos}))) != 0")
    goes = F.col("follow").bitwiseAND(letter_bit(F.expr(f"substring(w, {pos} + 1, 1)"))) != 0
    return ends & ((rest == 0) | goes)


def walked(words: DataFrame) -> DataFrame:
    """``w, way, node``: words and the nodes where they end with one edit."""
    spark = words.sparkSession
    name = f"edges_{uuid.uuid4().hex}"
    ways = {">": words.select(F.col("word").alias("w")), "<": words.select(F.reverse("word").alias("w"))}
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    built = trie(ways[">"], ">").unionByName(trie(ways["<"], "<"))
    built.repartition(buckets, "node").write.format("parquet").bucketBy(buckets, "node").saveAsTable(name)
    edges = spark.table(name)
    crowded = edges.groupBy("node").agg(F.sum("below").alias("below")).orderBy(F.desc("below"), "node").limit(HEAVY).select("node")
    heavy = settle(edges.join(F.broadcast(crowded), "node", "left_semi"), "heavy-edges")
    hot = F.broadcast(heavy.select("node").distinct().withColumn("hot", F.lit(True)))

    def level(states: DataFrame) -> DataFrame:
        """All states one letter on; ``done`` are the finished ones."""
        own = F.expr("substring(w, pos + 1, 1)")
        meets = ((F.col("c") == own) & ((F.col("edits") == 0) | can_go("pos + 1"))) | ((F.col("edits") == 0) & (F.col("c") > own) & can_go("pos + 1"))
        marked = states.join(hot, "node", "left_outer")
        light = marked.where("hot IS NULL").join(edges, "node").where(meets)
        met = light.unionByName(marked.where("hot").join(F.broadcast(heavy), "node").where(meets))
        state = lambda pos, edits: F.struct(F.expr(pos).alias("pos"), F.expr(edits).cast("int").alias("edits"))
        on = state("pos + 1", "CASE WHEN edits = 1 OR c != substring(w, pos + 1, 1) THEN 1 ELSE 0 END")
        # From a child reached without an edit, the next letter may be left out. Of equal letters it is the last.
        skips = (F.col("edits") == 0) & (F.col("c") == own) & F.expr("pos + 2 <= length(w) AND substring(w, pos + 2, 1) != substring(w, pos + 3, 1)")
        skipped = F.when(skips & can_go("pos + 2"), state("pos + 2", "1"))
        each = met.select("way", "w", F.col("child").alias("node"), F.col("left").bitwiseAND(1).alias("ends"), F.explode(F.filter(F.array(on, skipped), lambda s: s.isNotNull())).alias("s"))
        read = F.col("pos") == F.length("w")
        return (
            each.select("way", "w", "node", "s.pos", "s.edits", "ends")
            .where(~(read & ((F.col("edits") == 0) | (F.col("ends") == 0))))
            .select("way", "w", "pos", "node", "edits", read.alias("done"))
        )

    first = starts(ways[">"], ">").unionByName(starts(ways["<"], "<")).withColumn("edits", F.lit(0))
    # At the start the letter at hand may be left out, too.
    without = first.where("substring(w, pos + 1, 1) != substring(w, pos + 2, 1)").withColumns({"pos": F.col("pos") + 1, "edits": F.lit(1)})
    states, found = first.unionByName(without), []
    for _ in range(WALKED):
        states = settle(level(states), "states")
        found.append(states.where("done").select("way", "w", "node"))
        states = states.where("NOT done").drop("done")
        if states.isEmpty():
            break
    spark.sql(f"DROP TABLE {name}")
    return reduce(DataFrame.unionByName, found)


def walked_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: proposed neighbours among words of up to ``WALKED`` letters."""
    own = lambda way, text: words.select(F.lit(way).alias("way"), node_of(way, text).alias("node"), F.col("word").alias("b"))
    ends = own(">", F.col("word")).unionByName(own("<", F.reverse("word")))
    states = walked(words).withColumn("a", F.when(F.col("way") == "<", F.reverse("w")).otherwise(F.col("w")))
    return states.join(ends, ["way", "node"]).select("a", "b")


def long_pairs(words: DataFrame) -> DataFrame:
    """``a, b``: proposed neighbours among long words, by hashes of what is left without a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for word in rows.column(0).to_pylist():
                codes = list(map(ord, word))
                before, powers = [0], [1]
                for c in codes:
                    before.append((before[-1] * BASE + c) % PRIME)
                    powers.append(powers[-1] * BASE % PRIME)
                whole = before[-1]
                keys, size = [whole], len(codes)
                for i in range(size):
                    after = (whole - before[i + 1] * powers[size - i - 1]) % PRIME
                    keys.append((before[i] * powers[size - i - 1] + after) % PRIME)
                for i in range(0, size + 1, 1 << 16):
                    part = keys[i : i + (1 << 16)]
                    at = pa.array(range(i - 1, i - 1 + len(part)), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), at, pa.array([whole] * len(part), pa.int64())], names=["key", "at", "own"])

    keys = settle(words.select("word").mapInArrow(run, "key long, at int, own long"), "long-keys")
    one = lambda rows, side: rows.select("key", "at", F.col("own").alias(side))
    without = keys.where("at >= 0")
    replaced = one(without, "x").join(one(without, "y"), ["key", "at"]).where("x < y")
    shorter = one(without, "x").join(one(keys.where("at < 0"), "y").drop("at"), "key")
    pairs = replaced.select("x", "y").union(shorter.select("x", "y")).distinct()
    named = keys_of(words)
    first = pairs.join(named.select(F.col("own").alias("x"), F.col("word").alias("a")), "x")
    return first.join(named.select(F.col("own").alias("y"), F.col("word").alias("b")), "y").select("a", "b")


def keys_of(words: DataFrame) -> DataFrame:
    """``own, word``: each word with its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = []
            for word in rows.column(0).to_pylist():
                h = 0
                for c in word:
                    h = (h * BASE + ord(c)) % PRIME
                found.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), rows.column(0)], names=["own", "word"])

    return words.select("word").mapInArrow(run, "own long, word string")


def neighbours(words: DataFrame) -> DataFrame:
    """``word, other``: all words one edit apart, each pair both ways."""
    length = F.length("word")
    proposed = walked_pairs(words.where(length <= WALKED))
    # Words at the limit take part in both, so that no pair lies between.
    long = words.where(length >= WALKED)
    if not long.isEmpty():
        proposed = proposed.unionByName(long_pairs(long))
    near = settle(proposed.where(F.levenshtein("a", "b", 1) == 1).distinct(), "near")
    return near.select(F.col("a").alias("word"), F.col("b").alias("other")).union(near.select("b", "a")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the way along ``word, form``. Every round doubles the steps."""
    found = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(found.join(ahead, "root", "left_outer").select("word", "root", "further"), "roots")
        found = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further IS NOT NULL").isEmpty():
            return found


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = settle(vocabulary(docs), "words")
    pairs = neighbours(words).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.n") >= RATIO * F.col("n")
    judged = words.join(near, "word", "left_outer").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"),
        F.when(fits, -F.col("best.n")).alias("form_n"),
    )
    judged = settle(judged, "judged")
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left_outer").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
