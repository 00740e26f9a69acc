"""Line deduplication: lines found in many documents go.

Pass 1 puts the hash of every line key into two Bloom filters, one of keys seen once and one of
keys seen again. Filters of several tasks merge as ``again = a.again | b.again | (a.once & b.once)``
and ``once = a.once | b.once``, so a key in two tasks is in ``again``. A filter is cut into
segments, each key lies in one segment, and segments merge as rows of an aggregation.
Pass 2 sends only keys that ``again`` holds to the exact count, by SHA-256 of the key.

The filters grow with the number of lines up to ``MAX_SEGMENTS`` segments, which bounds what is
broadcast at 64 MB. Beyond that more keys are suspected and shuffled; the result stays exact.

A null text is one empty line. A key of fewer than ``min_chars`` code points is never dropped.
Rows that repeat an id count as one document. Other columns pass through.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import batch, map_batches, settle, text_of
from padron.operators.skew import lookup_join

MIN_DOCUMENTS = 10
MIN_CHARS = 1

SEGMENT_BITS = 1 << 19  # 64 kB
BITS_PER_LINE = 16
HASHES = 4
MAX_SEGMENTS = 1024


FILTER = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("again", pa.binary())])
FILTER_SCHEMA = "segment int, once binary, again binary"


def key_of(line: bytes) -> bytes:
    """ASCII spaces stripped at both ends, A-Z lower-cased; other characters as they are."""
    return line.strip(b" \t\n\v\f\r").lower()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def line_keys(text: bytes) -> list[bytes]:
    return [key_of(line) for line in text.split(b"\n")]


def positions(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each hash and its bits in the segment."""
    segment = ((hashes >> np.uint64(44)) % np.uint64(segments)).astype(np.int64)
    step = (hashes >> np.uint64(20)) | np.uint64(1)
    bits = np.stack([(hashes + np.uint64(i) * step) % np.uint64(SEGMENT_BITS) for i in range(HASHES)], axis=1)
    return segment, bits.astype(np.int64)


def packed_bits(bits: np.ndarray) -> bytes:
    flags = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    flags[bits] = 1
    return zlib.compress(np.packbits(flags).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=np.uint8)


def task_filters(segments: int, min_chars: int):
    """Filters of one task, one row per segment it touches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, dtype=np.uint64)
        twice = np.zeros(0, dtype=np.uint64)
        for rows in batches:
            found = [
                xxhash.xxh3_64_intdigest(key)
                for text in rows.column(0).to_pylist()
                for key in set(line_keys(text))
                if long_enough(key, min_chars)
            ]
            # Keys of one task, each once however often it comes.
            keys, counts = np.unique(np.array(found, dtype=np.uint64), return_counts=True)
            both = np.intersect1d(seen, keys, assume_unique=True)
            twice = np.union1d(twice, np.concatenate([keys[counts > 1], both]))
            seen = np.union1d(seen, keys)
        segment, bits = positions(seen, segments)
        repeated = np.isin(seen, twice, assume_unique=True)
        order = np.argsort(segment, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(segment[order])) + 1) if len(order) else []:
            yield batch(
                {
                    "segment": [int(segment[part[0]])],
                    "once": [packed_bits(bits[part].ravel())],
                    "again": [packed_bits(bits[part[repeated[part]]].ravel())],
                },
                FILTER,
            )

    return run


def merge(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters merged per segment; a segment's filters have a fixed size."""
    merged: dict[int, list[np.ndarray]] = {}
    for rows in frames:
        for segment, once, again in zip(*[c.to_pylist() for c in rows.columns], strict=True):
            once, again = unpacked(once), unpacked(again)
            if segment in merged:
                o, a = merged[segment]
                merged[segment] = [o | once, a | again | (o & once)]
            else:
                merged[segment] = [once, again]
    for segment, (once, again) in merged.items():
        yield batch(
            {"segment": [segment], "once": [zlib.compress(once.tobytes(), 1)], "again": [zlib.compress(again.tobytes(), 1)]},
            FILTER,
        )


def repeat_filter(texts: DataFrame, segments: int, min_chars: int) -> dict[int, bytes]:
    """The ``again`` filter by segment: at most MAX_SEGMENTS x 64 kB."""
    local = map_batches(texts, task_filters(segments, min_chars), FILTER_SCHEMA)
    # Two steps, so that no task merges the filters of all others.
    salted = local.repartition(8 * min(segments, 64), F.col("segment"), F.rand(7) > 0.5)
    halves = salted.mapInArrow(merge, FILTER_SCHEMA)
    whole = halves.repartition(min(segments, 64), "segment").mapInArrow(merge, FILTER_SCHEMA)
    return {r.segment: bytes(r.again) for r in whole.select("segment", "again").collect()}


def suspects(texts: DataFrame, filters, segments: int, min_chars: int) -> DataFrame:
    """``doc_id, text_hash, line, digest`` of the lines whose key may have been seen twice."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("line", pa.int32()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {s: np.unpackbits(unpacked(d)) for s, d in filters.value.items()}
        empty = np.zeros(SEGMENT_BITS, dtype=np.uint8)
        for rows in batches:
            ids, texts_of, numbers, keys = [], [], [], []
            for text, doc_id, text_hash in zip(*[c.to_pylist() for c in rows.columns], strict=True):
                for number, key in enumerate(line_keys(text)):
                    if long_enough(key, min_chars):
                        ids.append(doc_id)
                        texts_of.append(text_hash)
                        numbers.append(number)
                        keys.append(key)
            hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
            segment, at = positions(hashes, segments)
            hit = np.zeros(len(keys), dtype=bool)
            for s in np.unique(segment):
                rows_of = np.flatnonzero(segment == s)
                hit[rows_of] = bits.get(int(s), empty)[at[rows_of]].all(axis=1)
            chosen = np.flatnonzero(hit)
            yield batch(
                {
                    "doc_id": [ids[i] for i in chosen],
                    "text_hash": [texts_of[i] for i in chosen],
                    "line": [numbers[i] for i in chosen],
                    "digest": [hashlib.sha256(keys[i]).digest() for i in chosen],
                },
                schema,
            )

    return map_batches(texts, run, "doc_id long, text_hash long, line int, digest binary")


def repeated_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """``doc_id, text_hash, line``: the lines to drop, counted from 0.

    ``keep_first`` leaves the first occurrence of each key (smallest id, then line) in place.
    """
    spark = docs.sparkSession
    texts = docs.select(text_of().cast("binary").alias("text"), "doc_id", F.xxhash64(text_of()).alias("text_hash"))
    line_count = docs.select(F.sum(F.length(text_of()) - F.length(F.replace(text_of(), F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    segments = 1
    while segments < MAX_SEGMENTS and segments * SEGMENT_BITS < line_count * BITS_PER_LINE:
        segments *= 2
    filters = spark.sparkContext.broadcast(repeat_filter(texts, segments, min_chars))
    found = settle(suspects(texts, filters, segments, min_chars), "suspects")
    in_document = found.groupBy("digest", "doc_id").agg(F.count("*").alias("n"), F.min("line").alias("line"))
    repeated = (
        in_document.groupBy("digest")
        .agg(F.count("*").alias("documents"), F.sum("n").alias("lines"), F.min(F.struct("doc_id", "line")).alias("first"))
        .where(F.col("documents") >= min_documents)
    )
    # A line may stand in a third of all documents: the most frequent keys are broadcast.
    dropped = lookup_join(found, repeated, ["digest"], "lines")
    if keep_first:
        dropped = dropped.where(~F.struct("doc_id", "line").eqNullSafe(F.col("first")))
    return dropped.select("doc_id", "text_hash", "line")


def without_lines(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` with the lines gone, plus n_lines (before) and n_dropped (replaced if there)."""
    key = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "text_hash")
    per_document = dropped.groupBy(key.alias("_key")).agg(F.collect_set("line").alias("_lines"))
    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, before, gone = [], [], []
            for text, numbers in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True):
                lines = text.split("\n")
                out = set(numbers or ())
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in out) if out else text)
                before.append(len(lines))
                gone.append(len(out))
            columns = [rows.column(0), pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_lines", "n_dropped"])

    packed = docs.select(
        F.struct(*[docs[c] for c in own]).alias("row"), text_of().alias("text"), "doc_id", F.xxhash64(text_of()).alias("text_hash")
    )
    marked = packed.withColumn("_key", key).join(per_document, "_key", "left_outer").select("row", "text", "_lines")
    schema = f"row {dict(marked.dtypes)['row']}, text string, n_lines long, n_dropped long"
    return map_batches(marked, run, schema).select("row.*", "text", "n_lines", "n_dropped")
