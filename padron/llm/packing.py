"""Packing by power-of-two decomposition.

A document's token ids are cut into pieces whose lengths are the powers of two of the document's
length in binary, longest first, with as many of the longest allowed length as fit. Each piece
is a sequence of its own, so no sequence crosses documents and none needs padding, and pieces of
one length form a bucket from which batches are drawn.

Sequences are numbered without gaps, bucket by bucket, longest first. A number follows from the
counts of pieces per task and bucket, which are small beside the pieces.

Null text is empty: such a document is its end token only. Rows that repeat an id are packed as
often as they come. Other columns are ignored.

Tokens: a text of ASCII and common Latin letters is cut into words by the tokenizer's
own pattern, and the ids its model gives a word are kept in a bounded cache. Any other text goes
through the tokenizer as a whole. Both ways give the same ids (tests compare them). The short way is
taken only if the tokenizer's file states the normalisation and splitting it stands for.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle

MAX_LENGTH = 4096
END_ID = 2

#: Words whose ids a worker keeps, and as many again from before.
CACHE_WORDS = 300_000

# Texts of these characters only are not changed by composing normalisation, and lower-casing
# them is the same everywhere. The tokenizer's special tokens need "<|".
PLAIN = re.compile("[\\t\\n\\r -~¡«»¿À-ÖØ-öø-ÿ]*")
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")

# What a tokenizer's file must state for the short way: fixed values of the format.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTERS = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def splits_as_known(stated: dict) -> bool:
    """Whether a tokenizer's file normalises and splits as ``PLAIN`` and ``WORDS`` assume."""
    return (
        (stated.get("normalizer") or {}).get("normalizers") == NORMALIZERS
        and (stated.get("pre_tokenizer") or {}).get("pretokenizers") == SPLITTERS
        and all("<|" in t["content"] for t in stated.get("added_tokens") or [])
        and not (stated["model"].get("dropout") or stated.get("truncation") or stated.get("padding"))
    )


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible, else the next free one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + i for i, b in enumerate(hidden)}


class WordIds(dict):
    """Ids of lower-case words, found by the tokenizer's model at first use."""

    def __init__(self, model, earlier: dict[str, bytes]):
        super().__init__()
        self.tokenize, self.earlier, self.letters = model.tokenize, earlier, byte_letters()

    def __missing__(self, word: str) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            found = [t.id for t in self.tokenize(spelled)]
            ids = struct.pack(f"<{len(found)}I", *found)
        self[word] = ids
        return ids


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.short = splits_as_known(json.load(file))
        self.cache_words = cache_words
        self.cache = WordIds(self.tokenizer.model, {})

    def encode(self, text: str) -> bytes:
        """The tokenizer's own way, for texts of any kind."""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        if len(self.cache) > self.cache_words:
            self.cache = WordIds(self.tokenizer.model, dict(self.cache))
        if self.short and PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.cache.__getitem__, WORDS.findall(text.lower())))
        return self.encode(text)


TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process, kept across its tasks."""
    if path not in TOKENIZERS:
        TOKENIZERS[path] = WordTokenizer(path)
    return TOKENIZERS[path]


def piece_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """The lengths of the pieces of ``n`` tokens: powers of two, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, bucket int, nth long, ids binary"
)


def pieces(docs: DataFrame, tokenizer_path: str, longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit) and its number in task and bucket."""
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = tokenizer(tokenizer_path)
        task, counts = TaskContext.get().partitionId(), {}
        for rows in batches:
            out: list[tuple] = []
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                ids, start = tokenize(text or "") + end, 0
                total = len(ids) // 4
                for length in piece_lengths(total, longest):
                    part = ids[4 * start : 4 * (start + length)]
                    bucket = length.bit_length() - 1
                    nth = counts[bucket] = counts.get(bucket, -1) + 1
                    out.append((doc_id, start, length, zlib.crc32(part), total, task, bucket, nth, part))
                    start += length
            types = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64(), pa.binary()]
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return map_batches(docs.select("doc_id", "text"), run, PIECES)


def sequences(docs: DataFrame, tokenizer_path: str, longest: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset`` (always 0)."""
    found = pieces(docs, tokenizer_path, longest, end_id)
    found = settle(found if with_ids else found.drop("ids"), "pieces")
    counts = found.groupBy("bucket", "task").agg(F.count("*").alias("n"))
    # Twice running sums: within a bucket over its tasks, and over the few buckets.
    within = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("bucket").agg(F.sum("n").alias("n"))
    longer = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("bucket", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base"))
    # Written, so that Spark knows its size and can leave the pieces where they are if it is small.
    firsts = settle(
        counts.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(bases, "bucket")
        .select("bucket", "task", (F.col("base") + F.col("before")).alias("first")),
        "firsts",
    )
    return (
        found.join(firsts, ["bucket", "task"])
        .withColumn("sequence_id", F.col("first") + F.col("nth"))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("first", "nth", "task")
    )
