"""Removal of repeated substrings by distributed prefix doubling.

Every byte that lies in a string of ``LENGTH`` bytes which also starts in a document of a smaller
id goes. Repeats are found by sorting pairs of (rank, position) at growing lengths; what is
unique at a length is out of the search, and the search ends at ``LENGTH``:

* Ranks of 2, 4 and 8 bytes are the bytes themselves, doubled in place, and a rank of 16 bytes is
  a pair of those. No sort is needed for them.
* 16 bytes: not every position is sorted, as neighbours share their fate. Each window of
  ``LENGTH`` bytes hands its question to its least-ranked position (the leftmost of equals), which
  depends on the window's bytes only, so equal windows ask at equal places. The ranks alone, in
  packed sorted lists, go from parts of the table to ranges of ranks; each part is told which of
  its ranks occur again, and all other positions drop out.
* All windows that ask at a position: its rank is the pair of the ranks of the first and the last
  of them. Spark sorts the positions by 16-byte rank and this one. Equal pairs are equal stretches
  of text: all but those in the smallest document are repeats, and drop out as settled. What is
  alone with its 16 bytes drops out as unique.
* ``LENGTH`` bytes: what is left shares 16 bytes in different surroundings. Sorted by those 16
  bytes and carrying its surroundings, its windows are ranked and sorted one by one.

Ranks are 64-bit hashes and decide in pairs, so two different windows are taken for equal with a
chance of about 2**-128 a pair. Parts of the table and ranges of ranks grow in number with the
bytes of the table, so none outgrows a task. Sorted rows are read as a stream with a state of one
group; more than ``CROWD`` positions of one 16-byte rank are not held together but sorted window
by window.

Texts are bytes of UTF-8; nulls are empty. Texts of fewer than ``LENGTH`` bytes are never changed.
A row without an id comes before all ids. Rows that repeat an id are one document for the
comparison and are cut each for itself. Kept bytes need not be valid UTF-8, so they are binary.
Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle, small_batches, text_of

LENGTH = 50
SEED_LENGTH = 16

#: Bytes of text in a part of the table; a part is one group of a grouped map.
PART_BYTES = 8 << 20
#: Bits of a rank that the packed lists keep; equal ones are checked in full later.
PACKED_BITS = 48
#: Positions of one 16-byte rank that are compared in memory.
CROWD = 20_000

#: Bytes worked on at once; positions in a chunk fit 20 bits.
CHUNK = 1 << 18
POSITION = np.uint64((1 << 20) - 1)

M1, M2, M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, by doubling 1, 2, 4, 8."""
    x = data.astype(np.uint64)
    for bits in (8, 16, 32):
        step = bits // 8
        x = (x[:-step] << np.uint64(bits)) | x[step:]
    return x


def window_ranks(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rank of the LENGTH bytes from each position in ``at`` on."""
    rank = np.full(len(at), LENGTH, dtype=np.uint64)
    for offset in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        rank = mixed(rank * M1 + words[at + offset])
    return rank


def chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to chunks: bytes, and per part its place there, its text and its start in it.

    A text longer than a chunk goes in parts that share LENGTH - 1 bytes, so each window is in one.
    """
    data: list[bytes] = []
    place, owner, start, size = [], [], [], 0

    def full():
        return np.frombuffer(b"".join(data), dtype=np.uint8), np.array(place), np.array(owner), np.array(start)

    for number, text in enumerate(texts):
        for begin in range(0, len(text) - LENGTH + 1, CHUNK - LENGTH + 1):
            part = text[begin : begin + CHUNK]
            if size and size + len(part) > CHUNK:
                yield full()
                data, place, owner, start, size = [], [], [], [], 0
            data.append(part)
            place.append(size)
            owner.append(number)
            start.append(begin)
            size += len(part)
    if size:
        yield full()


def asking_positions(data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Positions that windows ask at: their part, the first and last of their windows, their rank."""
    words = eight_bytes(data)
    count = len(data) - SEED_LENGTH + 1
    seeds = words[8 : 8 + count] * M2
    seeds = ((seeds << np.uint64(32)) | (seeds >> np.uint64(32))) ^ (words[:count] * M1)
    seeds = (seeds ^ (seeds >> np.uint64(32))) * M3
    seeds ^= seeds >> np.uint64(29)
    least = (seeds & ~POSITION) | np.arange(count, dtype=np.uint64)
    width, have = LENGTH - SEED_LENGTH + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    ends = np.append(place[1:], len(data))
    part = np.repeat(np.arange(len(place)), ends - place)[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= ends[part]
    window = np.flatnonzero(inside)
    asked = (least[window] & POSITION).astype(np.int64)
    cut = np.flatnonzero((np.diff(asked) != 0) | (np.diff(part[window]) != 0)) + 1
    first, last = window[np.append(0, cut)], window[np.append(cut, len(window)) - 1]
    at = asked[np.append(0, cut)]
    return part[first], at, first, last, seeds[at], words


def surroundings(words: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rank of all that the windows of a position cover, and of where it lies in it."""
    around = mixed(window_ranks(words, first) * M1 + window_ranks(words, last))
    return mixed(around + ((at - first) * 64 + (last - first)).astype(np.uint64))


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte of all of them, compressed."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def shortened(seeds: np.ndarray) -> np.ndarray:
    return seeds >> np.uint64(64 - PACKED_BITS)


def packed_seeds(ranges: int):
    """Of one part of the table: its 16-byte ranks by range, those found once and those found again."""
    schema = pa.schema([("range", pa.int64()), ("part", pa.int64()), ("once", pa.binary()), ("again", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        found = [shortened(asking_positions(data, place)[4]) for data, place, *_ in chunks(table.column("text").to_pylist())]
        values, counts = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *found]), return_counts=True)
        which = (values >> np.uint64(PACKED_BITS - 24)) * np.uint64(ranges) >> np.uint64(24)
        edges = np.searchsorted(which, np.arange(ranges + 1, dtype=np.uint64))
        out = []
        for i in np.flatnonzero(np.diff(edges)):
            v, n = values[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]]
            out.append((int(i), table.column("part")[0].as_py(), pack(v[n == 1]), pack(v[n > 1])))
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def answers(table: pa.Table) -> pa.Table:
    """Of one range: for each part its ranks that occur again, there or in another part."""
    parts = table.column("part").to_pylist()
    once = [unpack(x) for x in table.column("once").to_pylist()]
    again = [unpack(x) for x in table.column("again").to_pylist()]
    values, counts = np.unique(np.concatenate(once), return_counts=True)
    repeated = np.union1d(values[counts > 1], np.concatenate(again))
    told = [pack(np.sort(np.concatenate([o[np.isin(o, repeated, assume_unique=True)], a]))) for o, a in zip(once, again, strict=True)]
    return pa.table({"part": pa.array(parts, pa.int64()), "told": pa.array(told, pa.binary())})


POSITIONS = "seed long, around long, doc_id long, row_no long, place long"
OPEN = "covered boolean, seed long, doc_id long, row_no long, place long"
#: A place is 64 times the first window's start plus the number of further windows.
WINDOWS = 64


def repeated_positions(texts: pa.Table, told: pa.Table) -> pa.Table:
    """Of one part: the positions whose 16 bytes occur again, with the rank of their surroundings."""
    names = [c.split()[0] for c in POSITIONS.split(", ")]
    out = [[np.zeros(0, dtype=np.int64)] * len(names)]
    known = np.sort(np.concatenate([np.zeros(0, dtype=np.uint64), *[unpack(x) for x in told.column("told").to_pylist()]]))
    if texts.num_rows and len(known):
        ids, numbers = [texts.column(c).to_numpy() for c in ("doc_id", "row_no")]
        for data, place, owner, start in chunks(texts.column("text").to_pylist()):
            part, at, first, last, seed, words = asking_positions(data, place)
            short = shortened(seed)
            hit = known[np.minimum(np.searchsorted(known, short), len(known) - 1)] == short
            part, at, first, last, seed = part[hit], at[hit], first[hit], last[hit], seed[hit]
            around = surroundings(words, at, first, last)
            places = (first + start[part] - place[part]) * WINDOWS + last - first
            out.append([seed.view(np.int64), around.view(np.int64), ids[owner[part]], numbers[owner[part]], places])
    return pa.table({n: pa.array(np.concatenate(c)) for n, c in zip(names, zip(*out, strict=True), strict=True)})


def positions(texts: DataFrame, parts: int) -> DataFrame:
    packed = texts.select("part", "text").groupBy("part").applyInArrow(packed_seeds(parts), "range long, part long, once binary, again binary")
    told = packed.groupBy("range").applyInArrow(answers, "part long, told binary")
    return texts.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(repeated_positions, POSITIONS)


def first_of(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new group begins in sorted rows."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by seed, around, doc_id: settled repeats, and what stays open.

    The state between batches is the last group's seed, surroundings and smallest document, and
    the rows of a seed that has had one kind of surroundings so far.
    """
    names = [c.split()[0] for c in OPEN.split(", ")]

    def made(columns: list[np.ndarray], covered: bool) -> pa.RecordBatch:
        seed, _, doc, row, place = columns
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(seed), covered)), *[pa.array(x) for x in (seed, doc, row, place)]], names=names)

    state = None  # seed, around, smallest document, whether the seed has had other surroundings
    waiting: list[list[np.ndarray]] = []
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in rows.columns]
        seed, around, doc = columns[:3]
        new = first_of([seed, around])
        new_seed = first_of([seed])
        goes_on = state is not None and state[0] == seed[0]
        same_group = goes_on and state[1] == around[0]
        group = np.cumsum(new) - 1
        least = doc[np.flatnonzero(new)]
        if same_group:
            least[0] = state[2]
        covered = doc > least[group]
        # A seed is shared if it has two kinds of surroundings, here or in the batch before.
        seed_no = np.cumsum(new_seed) - 1
        kinds = np.bincount(seed_no, weights=new).astype(np.int64)
        shared = kinds > 1
        if goes_on:
            shared[0] = bool(state[3]) or kinds[0] > 1 or not same_group
            if shared[0]:
                for held in waiting:
                    yield made(held, False)
                waiting = []
        else:
            waiting = []
        if len(shared) > 1:
            waiting = []
        if covered.any():
            yield made([c[covered] for c in columns], True)
        open_now = ~covered & shared[seed_no]
        if open_now.any():
            yield made([c[open_now] for c in columns], False)
        if not shared[-1]:
            held = ~covered & (seed_no == len(shared) - 1)
            waiting.append([c[held] for c in columns])
        state = (seed[-1], around[-1], least[-1], bool(shared[-1]))


SURROUNDINGS = "seed long, doc_id long, row_no long, place long, bytes binary"
COMPARED = "crowded boolean, seed long, rank long, doc_id long, row_no long, first long"


def with_surroundings(texts: DataFrame, left: DataFrame) -> DataFrame:
    """The open positions with the bytes that their windows cover."""
    asked = left.groupBy("row_no").agg(F.collect_list(F.struct("seed", "place")).alias("asked"))
    names = [c.split()[0] for c in SURROUNDINGS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            fields = rows.column(3).values
            seed, place = [fields.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            ends = rows.column(3).offsets.to_numpy()
            n = np.diff(ends)
            offset = ends[0]
            seed, place = seed[offset : ends[-1]], place[offset : ends[-1]]
            first, end = place // WINDOWS, place // WINDOWS + place % WINDOWS + LENGTH
            pieces = []
            for text, a, b in zip(rows.column(2).to_pylist(), ends[:-1] - offset, ends[1:] - offset, strict=True):
                pieces += [text[x:y] for x, y in zip(first[a:b].tolist(), end[a:b].tolist(), strict=True)]
            owners = [np.repeat(rows.column(i).to_numpy(zero_copy_only=False), n) for i in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(seed), *[pa.array(x) for x in owners], pa.array(place), pa.array(pieces, pa.binary())], names=names)

    return map_batches(texts.join(asked, "row_no").select("row_no", "doc_id", "text", "asked"), run, SURROUNDINGS)


def windows_of(rows: list[tuple]) -> list[np.ndarray]:
    """All windows of positions (columns: seed, doc_id, row_no, place, bytes): seed, rank, doc_id, row_no, first."""
    seed, doc, row, place = [np.concatenate([r[i] for r in rows]) for i in range(4)]
    pieces = [x for r in rows for x in r[4]]
    n = place % WINDOWS + 1
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    begins = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    ranks = window_ranks(eight_bytes(data), np.repeat(begins, n) + inner)
    return [np.repeat(seed, n), ranks.view(np.int64), np.repeat(doc, n), np.repeat(row, n), np.repeat(place // WINDOWS, n) + inner]


def comparer(crowd: int):
    """Over positions sorted by seed: windows that a smaller document has, too, or all windows of
    a crowded seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in COMPARED.split(", ")]

        def made(columns: list[np.ndarray], crowded: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), crowded)), *map(pa.array, columns)], names=names)

        def settled(rows: list[tuple]) -> pa.RecordBatch:
            columns = windows_of(rows)
            order = np.lexsort((columns[2], columns[1], columns[0]))
            columns = [c[order] for c in columns]
            new = first_of(columns[:2])
            hit = columns[2] > columns[2][np.flatnonzero(new)][np.cumsum(new) - 1]
            return made([c[hit] for c in columns], False)

        held: list[tuple] = []
        count, crowded = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:4]] + [batch.column(4).to_pylist()]
            seed = columns[0]
            take = lambda a, b: tuple(c[a:b] for c in columns)  # noqa: B023, E731
            start = 0
            if crowded is not None:
                start = int(np.searchsorted(seed != crowded, True)) if seed[-1] != crowded else len(seed)
                if start:
                    yield made(windows_of([take(0, start)]), True)
                if start == len(seed):
                    continue
                crowded = None
            # The last seed may go on in the next batch.
            whole = start + int(np.searchsorted(seed[start:] == seed[-1], True))
            if whole > start or (held and held[-1][0][-1] != seed[-1]):
                if whole > start:
                    held.append(take(start, whole))
                yield settled(held)
                held, count = [], 0
            held.append(take(whole, len(seed)))
            count += len(seed) - whole
            if count > crowd:
                yield made(windows_of(held), True)
                held, count, crowded = [], 0, seed[-1]
        if held:
            yield settled(held)

    return run


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over windows sorted by seed, rank, doc_id: those that a smaller document has, too."""
    state = None
    for rows in batches:
        if not rows.num_rows:
            continue
        seed, rank, doc, row_no, at = [c.to_numpy(zero_copy_only=False) for c in rows.columns]
        new = first_of([seed, rank])
        least = doc[np.flatnonzero(new)]
        if state is not None and state[0] == seed[0] and state[1] == rank[0]:
            least[0] = state[2]
        state = (seed[-1], rank[-1], least[-1])
        hit = doc > least[np.cumsum(new) - 1]
        yield pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (row_no, at, at)], names=["row_no", "first", "last"])


def cut(text: bytes, first: np.ndarray, last: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs (start, end) and the bytes that stay."""
    if not len(first):
        return [], text
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    new = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
    runs = [(int(first[a]), int(end[b - 1])) for a, b in zip(new, np.append(new[1:], len(first)), strict=True)]
    edges = [0, *[x for run in runs for x in run], len(text)]
    return runs, b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def stored(docs: DataFrame) -> tuple[DataFrame, int]:
    """part, row_no, doc_id and text in a table bucketed by part, and the number of parts: later
    steps find a part in place and do not shuffle the texts."""
    spark = docs.sparkSession
    small_batches(spark)
    total = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    parts = total // PART_BYTES + 1
    name = f"texts_{uuid.uuid4().hex}"
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        text_of().cast("binary").alias("text"),
    ).withColumn("part", part_of("row_no", parts))
    buckets = min(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "part").saveAsTable(name)
    return spark.table(name), parts


def part_of(row_no: str, parts: int):
    return F.pmod(F.xxhash64(row_no), F.lit(parts)).cast("long")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, runs (removed, start and end), kept (binary)."""
    texts, parts = stored(docs)
    asked = positions(texts.select("part", "row_no", "doc_id", "text"), parts)
    found = settle(asked.repartition("seed").sortWithinPartitions("seed", "around", "doc_id").mapInArrow(rerank, OPEN), "reranked", "zstd")
    open_ = with_surroundings(texts, found.where("NOT covered"))
    compared = settle(open_.repartition("seed").sortWithinPartitions("seed").mapInArrow(comparer(CROWD), COMPARED), "compared", "zstd")
    crowded = compared.where("crowded").select("seed", "rank", "doc_id", "row_no", "first")
    more = crowded.repartition("seed", "rank").sortWithinPartitions("seed", "rank", "doc_id").mapInArrow(repeated, "row_no long, first long, last long")
    first = F.shiftright("place", 6)
    covered = (
        found.where("covered").select("row_no", first.alias("first"), (first + F.col("place").bitwiseAND(WINDOWS - 1)).alias("last"))
        .union(compared.where("NOT crowded").select("row_no", "first", F.col("first").alias("last")))
        .union(more)
    )
    per_row = covered.groupBy("row_no").agg(F.collect_list(F.struct("first", "last")).alias("covered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes, all_runs, kept = [], [], []
            for text, covered in zip(rows.column(1), rows.column(2), strict=True):
                text, fields = text.as_py(), covered.values
                none = np.zeros(0, dtype=np.int64)
                first, last = [none if fields is None else fields.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
                runs, left = cut(text, first, last)
                sizes.append(len(text))
                all_runs.append([{"start": a, "stop": b} for a, b in runs])
                kept.append(left)
            types = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes, pa.int64()), pa.array(all_runs, types), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "runs", "kept"])

    joined = texts.join(per_row, "row_no", "left_outer").select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "text", "covered")
    return map_batches(joined, run, "doc_id long, n_bytes long, runs array<struct<start:bigint,stop:bigint>>, kept binary")
