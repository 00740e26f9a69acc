"""Documents with every awkward case: nulls, empty and long texts, ties, repeated rows, extra columns."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "size bin row key digest fp copies kept task line lines score labels text_hash rank wanted target bucket seed".split()

LONG = " ".join(f"word{i % 977} tail{i % 31}." for i in range(40_000))

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs home again today.\nshared line\nend", "en", "a", 5),
    (2, "The quick brown fox jumps over the lazy dog and runs home again today.\nshared line\nend", "en", "a", 5),
    (2, "The quick brown fox jumps over the lazy dog and runs home again today.\nshared line\nend", "en", "a", 5),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (5, "   \n\t\n", None, "b", 6),
    (6, "x" * 49, "de", "b", 49),
    (7, "x" * 130, "de", "b", 130),
    (8, "x" * 131, "de", "B", 131),
    (9, "ÄÖÜ ß é password=abc123xyz İstanbul \U0001f600 MIT License token: 'zzzzzz'", None, "é", 50),
    (None, "no id here, but the quick brown fox jumps over the lazy dog and runs home", "en", "a", 3),
    (None, None, None, None, None),
    (10, LONG, "en", "long", len(LONG)),
    (11, LONG + " tail", "en", "long", len(LONG)),
    (12, "a b c a b c a b c d\n\nSHARED line \n shared LINE\x0b", "es", "b", 30),
] + [(100 + i, f"shared line\nown line number {i}\n  Shared Line", "fr", "c", 30) for i in range(12)]


def edge(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({c: F.lit(f"clash {c}") for c in CLASHES}).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given(spark):
    """Documents of the smallest scale and the awkward ones, with rows to compare by hand."""
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    frame = known.withColumn("doc_id", F.col("doc_id") + 1000).unionByName(spark.createDataFrame(ROWS, SCHEMA))
    return frame, [(r.doc_id, r.text, r.lang, r.source) for r in frame.collect()]


def write(frame, folder):
    frame.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)
