"""SimHash near-duplicate detection by the generalised pigeonhole principle.

A bit of a fingerprint is 1 if it is set in more than half of the hashes (XXH64, seed 42) of the
text's word shingles. Documents link when their fingerprints differ in at most ``DISTANCE`` bits.

Search: the 64 bits are grouped into partitions of correlated bits. With a threshold t_i per
partition (-1: not probed) and the sum of t_i + 1 equal to DISTANCE + 1, any two fingerprints
that link differ by at most t_i bits in some partition i. The number of partitions and the
thresholds come from a dynamic program over estimated costs: rows to shuffle, which grow with the
choices of t_i bits, and candidate pairs, estimated from the bits' shares over all fingerprints
and from a bounded sample of pairs. A fingerprint is sent once per probed partition and choice of
t_i bits, with those bits left out of the key; fingerprints that meet at a key are verified.

Copies: equal fingerprints are one node. At a key, up to ``PAIRWISE`` fingerprints are compared
pair by pair; more are searched breadth first, which gives a tree and not all pairs. A key with
more than ``CROWD`` fingerprints is dealt out once more by 16-bit blocks (of four blocks, one is
equal where at most three bits differ), so no group has to fit one task.

Near copies (``deduplicate``): shingles of five words and a Jaccard similarity of 0.8, on
fingerprints of ``NEAR_BITS`` bits. Texts with equal sets of shingles are one node. The same program
groups the bits and allocates thresholds for a sum of ``NEAR_PROBED`` + 1; pairs within so many bits
meet for certain, and as any of some twenty keys will do, so do nearly all within ``NEAR_DISTANCE``
bits, which are the candidates. A pair belongs to the first key at which it meets. At a key a text is
paired with its first few candidates only, in the order of a hash; those are verified by their sets of
shingles and contracted. Texts with more candidates at a key meet there once more with their sets: one
row for a text and key, not one for a pair. They are verified in the task, without pairs of one
component, and what is found contracts at once. A key's largest component meets the others only, and
crowded keys are dealt out in parts. So every candidate pair of texts that stay apart has been verified.

Nulls and empty texts have fingerprint zero, which links like any other. Rows without an id link
too, but name no component. Rows that repeat an id are one document where it names a component.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.common import map_batches, settle, text_of
from padron.llm.components import components
from padron.operators.skew import lookup_join

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3

#: For near copies: words of a shingle, bits of a fingerprint, bits that may differ and bits within
#: which pairs meet for certain, and what verified pairs must reach.
NEAR_SHINGLE = 5
NEAR_BITS = 256
NEAR_DISTANCE = 50
NEAR_PROBED = 20
SIMILARITY = 0.8
#: Groups of bits the program may choose from.
NEAR_PARTITIONS = (18, 20, 21, 22)
#: What comparing a pair in memory costs of a shuffled row.
NEAR_PAIR_COST = 0.002
#: Pairs of a text at a key that are verified as rows.
NEAR_PAIRS = 4
#: Shingles of a part of a crowded key; a task holds two parts.
FRAGMENT = 1 << 20
#: Texts of a key that are compared with each other at once.
BLOCK = 256

PARTITIONS = (2, 3, 4)
#: Estimates of candidates use so many fingerprints, and pairs of them, at most.
SAMPLE = 4096
SAMPLE_PAIRS = 2_000_000
#: A verified pair costs so much of a shuffled row.
PAIR_COST = 0.05

PAIRWISE = 8
CROWD = 20_000


def shingles(text: bytes, size: int) -> np.ndarray:
    """Hashes of all shingles, repeated ones too; a text of fewer words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hash_of = xxhash.xxh64_intdigest
        hashes = [hash_of(joined[a:b], SEED) for a, b in zip(starts[: 1 - size].tolist(), ends[size - 1 :].tolist(), strict=True)]
    return np.array(hashes, dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    each = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(each), 4096):
        counts += np.unpackbits(each[i : i + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(each)))


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    return majority(shingles(text, size))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every row; the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [signed(fingerprint(t)) for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return map_batches(docs.select("doc_id", text_of().cast("binary").alias("text")), run, "doc_id long, fp long")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, in how many both are 1: over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for rows in batches:
            fps = rows.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for i in range(0, len(fps), 1 << 16):
                bits = np.unpackbits(fps[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        counts = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], names=["cell", "n"])

    rows = distinct.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BITS * BITS + 1)
    for r in rows:
        counts[r.cell] = r.n
    return int(counts[-1]), counts[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near-equal size, correlated bits together."""
    bits = len(both)
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    related = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left, groups = set(range(bits)), []
    for size in [len(x) for x in np.array_split(np.arange(bits), parts)]:
        group = [max(left, key=lambda b: (related[b, list(left)].sum(), -b))]
        while len(group) < size:
            group.append(max(left.difference(group), key=lambda b: (related[b, group].sum(), -b)))
        groups.append(sorted(group))
        left.difference_update(group)
    return groups


def at_most(share: np.ndarray, sampled: np.ndarray, distance: int = DISTANCE) -> list[float]:
    """Estimated chance that two fingerprints differ by at most t bits of a group, t = 0 .. distance:
    the larger of what independent bits give and what sampled pairs show."""
    chances = np.array([1.0])
    for p in share:
        differ = 2 * p * (1 - p)
        chances = np.append(chances * (1 - differ), 0) + np.append(0, chances * differ)
    model = np.cumsum(chances)
    seen = [(sampled <= t).mean() if len(sampled) else 0.0 for t in range(distance + 1)]
    return [float(max(model[min(t, len(share))], seen[t])) for t in range(distance + 1)]


def allocate(costs: list[list[float]], distance: int = DISTANCE) -> tuple[float, list[int]]:
    """Thresholds -1 .. distance per group, with sum of (threshold + 1) equal to distance + 1, of
    least cost; ``costs[i][t]`` is the cost of threshold t in group i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for t in range(-1, distance + 1):
                after = spent + t + 1
                value = total + (cost[t] if t >= 0 else 0.0)
                if after <= distance + 1 and (after not in new or value < new[after][0]):
                    new[after] = (value, [*chosen, t])
        best = new
    return best[distance + 1]


def search_plan(n: int, both: np.ndarray, sample: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and their thresholds; ``sample`` are fingerprints as 64-bit numbers."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return cheapest_plan(n, both, bits, PARTITIONS, DISTANCE, PAIR_COST)


def cheapest_plan(
    n: int, both: np.ndarray, sample: np.ndarray, partitions: tuple[int, ...], distance: int, pair_cost: float
) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and their thresholds of least estimated cost; ``sample`` has a row of bits
    per fingerprint."""
    random = np.random.default_rng(SEED)
    share = np.diag(both) / max(n, 1)
    pairs = random.integers(0, max(len(sample), 1), (SAMPLE_PAIRS * BITS // len(both) if len(sample) > 1 else 0, 2))
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    plans = []
    for parts in partitions:
        groups = group_bits(n, both, parts)
        costs = []
        for group in groups:
            own = sample[:, group] if len(sample) else np.zeros((0, len(group)), dtype=np.uint8)
            parts_of = [pairs[i : i + (1 << 18)] for i in range(0, len(pairs), 1 << 18)]
            differ = np.concatenate([np.zeros(0, dtype=np.int64), *[(own[p[:, 0]] != own[p[:, 1]]).sum(axis=1) for p in parts_of]])
            chance = at_most(share[group], differ, distance)
            # More bits than the group has cannot be left out; without rows the fewest masks are best.
            rows = [max(n, 1) * math.comb(len(group), t) if t <= len(group) else math.inf for t in range(distance + 1)]
            costs.append([rows[t] + pair_cost * n * n / 2 * chance[t] for t in range(distance + 1)])
        plans.append((*allocate(costs, distance), groups))
    _, thresholds, groups = min(plans, key=lambda p: p[0])
    return groups, thresholds


def masks(groups: list[list[int]], thresholds: list[int]) -> list[int]:
    """For each row a fingerprint is sent as: the bits its key keeps."""
    return [
        sum(1 << b for b in group if b not in out)
        for group, t in zip(groups, thresholds, strict=True)
        if t >= 0
        for out in combinations(group, t)
    ]


def probes(distinct: DataFrame, kept_bits: list[int]) -> DataFrame:
    """``key, fp``: the kept bits, hashed with the number of the mask. Equal keys are candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = np.array(kept_bits, dtype=np.uint64)
        salts = np.arange(1, len(each) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for rows in batches:
            all_fps = rows.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint64)
            for i in range(0, len(all_fps), 4096):
                fps = all_fps[i : i + 4096]
                keys = (fps[:, None] & each[None, :]) + salts[None, :]
                keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                keys ^= keys >> np.uint64(29)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fps, len(each)).view(np.int64))], names=["key", "fp"]
                )

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def tree(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what is connected within ``DISTANCE``, breadth first."""
    links, left = [], fps
    while len(left):
        ahead, left = [left[0]], left[1:]
        while ahead and len(left):
            here = ahead.pop()
            near = np.bitwise_count(left ^ here) <= DISTANCE
            if near.any():
                links += [(here, x) for x in left[near]]
                ahead += list(left[near])
                left = left[~near]
    return links


def linker(crowd: int | None):
    """Over rows sorted by key: verified links (kind 0), or the rows of a crowded key (kind 1)."""

    def made(a, b, kind: int) -> pa.RecordBatch:
        a, b = np.asarray(a, dtype=np.uint64), np.asarray(b, dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), kind, dtype=np.int32))],
            names=["a", "b", "kind"],
        )

    def groups(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(keys))
        sizes = np.repeat(ends - starts, ends - starts)
        for shift in range(1, PAIRWISE):
            same = np.flatnonzero((keys[shift:] == keys[:-shift]) & (sizes[shift:] <= PAIRWISE))
            if not len(same):
                break
            near = same[np.bitwise_count(fps[same] ^ fps[same + shift]) <= DISTANCE]
            if len(near):
                yield made(fps[near], fps[near + shift], 0)
        for g in np.flatnonzero(ends - starts > PAIRWISE):
            links = tree(fps[starts[g] : ends[g]])
            if links:
                a, b = zip(*links, strict=True)
                yield made(a, b, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        crowded = None
        for rows in batches:
            more_keys, more = [rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            keys, fps = np.concatenate([keys, more_keys]), np.concatenate([fps, more.view(np.uint64)])
            if crowded is not None:
                here = keys == crowded
                yield made(keys[here].view(np.uint64), fps[here], 1)
                if here.all():
                    keys, fps = keys[:0], fps[:0]
                    continue
                keys, fps, crowded = keys[~here], fps[~here], None
            if not len(keys):
                continue
            # The last key may go on in the next batch.
            whole = int(np.searchsorted(keys == keys[-1], True)) if keys[0] != keys[-1] else 0
            yield from groups(keys[:whole], fps[:whole]) if whole else ()
            keys, fps = keys[whole:], fps[whole:]
            if crowd is not None and len(keys) > crowd:
                crowded = keys[0]
                yield made(keys.view(np.uint64), fps, 1)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from groups(keys, fps)

    return run


def linked(rows: DataFrame, crowd: int | None) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(linker(crowd), "a long, b long, kind int")


def planned(distinct: DataFrame) -> list[int]:
    """The masks by which fingerprints within ``DISTANCE`` meet."""
    n, both = bit_statistics(distinct)
    # The sample is bounded, in the order of a hash, and only estimates costs.
    chosen = distinct.select("fp").orderBy(F.xxhash64("fp", F.lit(SEED)), "fp").limit(SAMPLE).collect()
    sample = np.array([r.fp for r in chosen], dtype=np.int64).view(np.uint64)
    return masks(*search_plan(n, both, sample))


def links(distinct: DataFrame) -> DataFrame:
    """``a, b``: enough links between distinct fingerprints to connect all that are connected."""
    found = settle(linked(probes(distinct, planned(distinct)), CROWD), "found-links")
    blocks = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.shiftrightunsigned("b", 16 * j).bitwiseAND(0xFFFF).alias("block")) for j in range(DISTANCE + 1)]))
    dealt = found.where("kind = 1").select("a", F.col("b").alias("fp"), blocks.alias("s"))
    again = linked(dealt.select(F.xxhash64("a", "s.j", "s.block").alias("key"), "fp"), None)
    return found.where("kind = 0").select("a", "b").union(again.select("a", "b"))


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id, links (of its fingerprint's class)."""
    rows = settle(fingerprints(docs), "fingerprints")
    distinct = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "distinct")
    roots = components(links(distinct)).select(F.col("node").alias("fp"), "root")
    member = distinct.join(roots, "fp", "left_outer").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "root").select("fp", "copies", "component_id")
    return lookup_join(rows, named, ["fp"], "copies").drop("copies")


def digest_of() -> Column:
    return F.unhex(F.sha2(text_of().cast("binary"), 256))


def wide_majority(hashes: np.ndarray) -> bytes:
    """``NEAR_BITS`` bits by majority; each shingle's hash is mixed into so many."""
    total = np.zeros(NEAR_BITS, dtype=np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        for word in range(NEAR_BITS // BITS):
            x = part + np.uint64((word + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
            total[BITS * word : BITS * (word + 1)] += np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), bitorder="little").tobytes()


def near_rows(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, digest, node, fp, n`` of every row: digests of the text and of its set of shingles,
    fingerprint, number of distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            nodes, fps, sizes = [], [], []
            for text in rows.column(2).to_pylist():
                found = np.unique(shingles(text, size))
                nodes.append(xxhash.xxh3_128_digest(found.tobytes(), SEED))
                fps.append(wide_majority(found))
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(nodes, pa.binary()), pa.array(fps, pa.binary()), pa.array(sizes, pa.int64())],
                names=["doc_id", "digest", "node", "fp", "n"],
            )

    given = docs.select("doc_id", digest_of().alias("digest"), text_of().cast("binary").alias("text"))
    return map_batches(given, run, f"doc_id {dict(given.dtypes)['doc_id']}, digest binary, node binary, fp binary, n long")


def bits_of(fps: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(fps), dtype=np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")


def wide_plan(nodes: DataFrame) -> list[list[int]]:
    """The bits kept by each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((NEAR_BITS, NEAR_BITS)), 0
        for rows in batches:
            if rows.num_rows:
                bits = bits_of(rows.column(0).to_pylist()).astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        counts = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], names=["cell", "n"])

    rows = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()
    counts = np.array([r.n for r in rows], dtype=float) if rows else np.zeros(NEAR_BITS**2 + 1)
    # The sample is bounded, in the order of a hash, and only estimates costs.
    chosen = nodes.select("fp").orderBy(F.xxhash64("fp", F.lit(SEED)), "fp").limit(SAMPLE).collect()
    sample = bits_of([r.fp for r in chosen]) if chosen else np.zeros((0, NEAR_BITS), dtype=np.uint8)
    groups, thresholds = cheapest_plan(int(counts[-1]), counts[:-1].reshape(NEAR_BITS, NEAR_BITS), sample, NEAR_PARTITIONS, NEAR_PROBED, NEAR_PAIR_COST)
    return [[b for b in group if b not in out] for group, t in zip(groups, thresholds, strict=True) if t >= 0 for out in combinations(group, t)]


def wide_probes(nodes: DataFrame, kept_bits: list[list[int]]) -> DataFrame:
    """``key, node, fp, n``: a row per node and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            fps = rows.column(1)
            bits = bits_of(fps.to_pylist()).astype(np.int64)
            keys = [(bits[:, kept] << np.arange(len(kept))).sum(axis=1) * len(kept_bits) + i for i, kept in enumerate(kept_bits)]
            again = pa.array(np.tile(np.arange(rows.num_rows), len(keys)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *[rows.column(i).take(again) for i in range(3)]], names=["key", "node", "fp", "n"])

    return map_batches(nodes.select("node", "fp", "n"), run, "key long, node binary, fp binary, n long")


def packed_masks(kept_bits: list[list[int]]) -> np.ndarray:
    masks = np.zeros((len(kept_bits), NEAR_BITS), dtype=np.uint8)
    for i, kept in enumerate(kept_bits):
        masks[i, kept] = 1
    return np.packbits(masks, axis=1, bitorder="little").view("<u8")


def whole_groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """The rows of each run of equal values in the first ``width`` columns, which are of type long."""
    held: list[pa.RecordBatch] = []
    last = None
    for rows in batches:
        if not rows.num_rows:
            continue
        by = np.stack([rows.column(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)
        cuts = [0, *(np.flatnonzero((np.diff(by, axis=0) != 0).any(axis=1)) + 1).tolist(), len(by)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            here = by[start].tolist()
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            last = here
            held.append(rows.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def words_of(fps: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(fps.to_pylist()), dtype="<u8").reshape(len(fps), -1)


def candidates(fps: np.ndarray, sizes: np.ndarray, later: slice, earlier: slice, distance: int, similarity: float) -> np.ndarray:
    """For each row of ``later`` and of ``earlier``, whether they are candidates in that order."""
    near = np.bitwise_count(fps[later][:, None] ^ fps[earlier][None, :]).sum(axis=2) <= distance
    place = np.arange(len(fps))
    near &= place[earlier][None, :] < place[later][:, None]
    x, y = sizes[later][:, None], sizes[earlier][None, :]
    return near & (np.minimum(x, y) >= similarity * np.maximum(x, y))


def first_met(near: np.ndarray, later: np.ndarray, earlier: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Takes pairs that meet at a key ``before`` out of ``near``; the places of those that stay."""
    x, y = np.nonzero(near)
    differ = later[x] ^ earlier[y]
    for mask in before:
        met = ((differ & mask) == 0).all(axis=1)
        near[x[met], y[met]] = False
        x, y, differ = x[~met], y[~met], differ[~met]
    return x, y


def pairer(distance: int, similarity: float, kept_bits: list[list[int]], most: int):
    """Over rows sorted by key and order: for each text its first ``most`` candidates (``b`` is the
    later one). A pair belongs to the first key at which it meets and has one place there. With ``a``
    null: the texts that have candidates; with ``b`` null: the texts that have more at this key."""
    masks = packed_masks(kept_bits)

    def group(key: int, nodes: list[bytes], fps: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch | None:
        a, b = [], []
        seen, more = np.zeros((2, len(fps)), dtype=bool)
        before = masks[: key % len(masks)]
        for i in range(0, len(fps), BLOCK):
            here = slice(i, min(i + BLOCK, len(fps)))
            found = np.zeros(here.stop - i, dtype=np.int64)
            for j in range(0, here.stop, 2048):
                there = slice(j, min(j + 2048, here.stop))
                near = candidates(fps, sizes, here, there, distance, similarity)
                later, earlier = first_met(near, fps[here], fps[there], before)
                rank = near.cumsum(axis=1)[later, earlier] + found[later]
                found += near.sum(axis=1)
                seen[i + later] = seen[j + earlier] = True
                asked = rank <= most
                b += [nodes[i + k] for k in later[asked].tolist()]
                a += [nodes[j + k] for k in earlier[asked].tolist()]
                more[i + later[~asked]] = more[j + earlier[~asked]] = True
        if not seen.any():
            return None
        seen, more = ([nodes[k] for k in np.flatnonzero(x).tolist()] for x in (seen, more))
        a, b = [*a, *[None] * len(seen), *more], [*b, *seen, *[None] * len(more)]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([key] * len(a), pa.int64())], names=["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1):
            if rows.num_rows > 1:
                found = group(rows.column(0)[0].as_py(), rows.column(1).to_pylist(), words_of(rows.column(2)), rows.column(3).to_numpy())
                if found is not None:
                    yield found

    return run


def searcher(distance: int, similarity: float, kept_bits: list[list[int]]):
    """Over rows sorted by key, two parts of its texts and the part: enough verified links to connect
    all candidates of the key, of which one is in either part, that are similar."""
    masks = packed_masks(kept_bits)

    def group(before: np.ndarray, cut: int, fps: np.ndarray, label: np.ndarray, sets: list[bytes]) -> Iterator[tuple[int, int]]:
        """Rows from ``cut`` on against those before it, or all against all where it is 0; ``label``
        numbers the components and is changed as links are found."""
        sizes = np.array([len(x) // 8 for x in sets])
        shingle, stops = np.unique(np.frombuffer(b"".join(sets), dtype="<u8"), return_inverse=True)[1], sizes.cumsum()
        starts, own = stops - sizes, np.zeros(len(shingle) + 1, dtype=bool)
        for i in range(cut, len(fps), BLOCK):
            here = slice(i, min(i + BLOCK, len(fps)))
            for j in range(0, cut or here.stop, 2048):
                there = slice(j, min(j + 2048, cut or here.stop))
                near = candidates(fps, sizes, here, there, distance, similarity) & (label[here][:, None] != label[there][None, :])
                later, earlier = first_met(near, fps[here], fps[there], before)
                for x in np.unique(later).tolist():
                    y = j + earlier[later == x]
                    x += i
                    y = y[label[y] != label[x]]
                    if not len(y):
                        continue
                    # The places of the shingles of all candidates, one after the other.
                    ends = sizes[y].cumsum()
                    place = np.arange(ends[-1]) + np.repeat(starts[y] - ends + sizes[y], sizes[y])
                    mine = shingle[starts[x] : stops[x]]
                    own[mine] = True
                    shared = np.append(0, own[shingle[place]].cumsum())
                    own[mine] = False
                    both = shared[ends] - shared[ends - sizes[y]]
                    for k in y[both >= similarity * (sizes[x] + sizes[y] - both)].tolist():
                        if label[k] != label[x]:
                            label[label == label[k]] = label[x]
                            yield k, x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 3):
            key, p, q = (rows.column(i)[0].as_py() for i in range(3))
            cut = int((rows.column(3).to_numpy() == p).sum()) if p != q else 0
            nodes = rows.column(4).to_pylist()
            label = rows.column(6).combine_chunks().dictionary_encode().indices.to_numpy().copy()
            found = list(group(masks[: key % len(masks)], cut, words_of(rows.column(5)), label, rows.column(7).to_pylist()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([nodes[pair[i]] for pair in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return run


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, hashes``: the distinct shingles of each wanted text (``digest, node``), sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [np.unique(shingles(t, size)).tobytes() for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.binary())], names=["node", "hashes"])

    given = docs.select(digest_of().alias("digest"), text_of().cast("binary").alias("text")).join(wanted, "digest")
    return map_batches(given.select("node", "text"), run, "node binary, hashes binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles have a Jaccard similarity of at least ``similarity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            near = []
            for x, y in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, dtype="<u8"), np.frombuffer(y, dtype="<u8")
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(both >= similarity * (len(a) + len(b) - both))
            kept = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(kept), rows.column(1).filter(kept)], names=["a", "b"])

    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    both = first.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    return map_batches(both.select("a", "b", "x", "y"), run, "a binary, b binary")


def merged(roots: DataFrame, new: DataFrame) -> DataFrame:
    """The roots once the links ``new`` are added; only the components they join are looked at."""
    if new.isEmpty():
        return roots
    root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    between = new.join(root_of("a"), "a", "left_outer").join(root_of("b"), "b", "left_outer")
    joined = components(between.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
    later = joined.select(F.col("node").alias("root"), F.col("root").alias("_root"))
    moved = roots.join(later, "root", "left_outer").select("node", F.coalesce("_root", "root").alias("root"))
    return settle(moved.unionByName(joined.join(roots.select("node"), "node", "left_anti").select("node", "root")), "near-roots")


def crowded_links(
    crowded: DataFrame, texts: DataFrame, sets: DataFrame, roots: DataFrame, search: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``a, b``: links between the ``crowded`` texts (``key, node``) of each key that ``search`` verifies.

    The texts of a key outside its largest component meet each other and that component, whose own
    texts need not meet. Parts of ``FRAGMENT`` shingles on average keep what one task holds bounded.
    """
    known = crowded.join(texts.select("node", "fp", "n"), "node").join(roots, "node", "left_outer")
    rows = settle(known.withColumn("root", F.coalesce("root", "node")), "near-crowded")
    sums = rows.groupBy("key", "root").agg(F.sum(F.col("n") + 1).alias("n"))
    largest = sums.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    parts = lambda n: F.ceil(n / FRAGMENT)
    dealt = largest.select("key", F.col("main.root").alias("main"), parts(F.col("main.n")).alias("mains"), parts(F.col("n") - F.col("main.n")).alias("rests")).where("rests > 0")
    hashed, is_main = F.xxhash64("node", F.lit(SEED)), F.col("root") == F.col("main")
    part = F.when(is_main, F.pmod(hashed, "mains")).otherwise(F.col("mains") + F.pmod(hashed, "rests"))
    other = F.explode(F.sequence(F.when(is_main, F.col("mains")).otherwise(F.lit(0).cast("long")), F.col("mains") + F.col("rests") - 1))
    met = rows.join(dealt, "key").join(sets, "node").withColumn("part", part).withColumn("other", other)
    met = met.select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "node", "fp", "root", "hashes")
    return map_batches(met.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "part", "node"), search, "a binary, b binary")


def near_links(docs: DataFrame, texts: DataFrame, size: int, distance: int, similarity: float) -> DataFrame:
    """``node, root`` of the nodes that are linked to others; ``texts``: ``node, fp, n, digest``."""
    kept_bits = wide_plan(texts)
    placed = wide_probes(texts, kept_bits).withColumn("place", F.xxhash64("node", F.lit(SEED)))
    dealt = placed.repartition("key").sortWithinPartitions("key", "place", "node").select("key", "node", "fp", "n")
    met = settle(dealt.mapInArrow(pairer(distance, similarity, kept_bits, NEAR_PAIRS), "a binary, b binary, key long"), "near-met")
    wanted = met.where("a IS NULL").select(F.col("b").alias("node")).distinct()
    wanted = settle(texts.join(wanted, "node", "left_semi").select("digest", "node"), "near-wanted")
    sets = settle(shingle_sets(docs, wanted, size), "near-sets")
    new = settle(verified(met.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b"), sets, similarity), "near-links")
    roots = components(new)
    crowded = met.where("b IS NULL").select("key", F.col("a").alias("node"))
    if crowded.isEmpty():
        return roots
    search = searcher(distance, similarity, kept_bits)
    return merged(roots, settle(crowded_links(crowded, texts, sets, roots, search), "near-links"))


def near_classes(docs: DataFrame, size: int, distance: int, similarity: float) -> DataFrame:
    """``doc_id, digest, root`` of every row of ``docs``: texts that are linked share a root.

    Texts link when their fingerprints differ in at most ``distance`` bits and the sets of their
    shingles of ``size`` words are similar.
    """
    rows = settle(near_rows(docs, size), "near-rows")
    texts = rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.min("digest").alias("digest"))
    roots = near_links(docs, settle(texts, "near-texts"), size, distance, similarity)
    return rows.join(roots, "node", "left_outer").select("doc_id", "digest", F.coalesce("root", "node").alias("root"))


def deduplicate(docs: DataFrame, size: int = NEAR_SHINGLE, distance: int = NEAR_DISTANCE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` of each component: that of the least id (nulls last), then digest.

    Rows are found again by id and digest; of rows that repeat both one stays.
    """
    found = near_classes(docs, size, distance, similarity)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    kept = found.groupBy("root").agg(least).select(F.col("first.doc_id").alias("_kept"), F.col("first.digest").alias("_digest"))
    packed = docs.select(docs["doc_id"].alias("_id"), digest_of().alias("_own"), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    stay = packed.join(kept, F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_own") == F.col("_digest")))
    nth = F.row_number().over(Window.partitionBy("_id", "_own").orderBy("_own"))
    return stay.withColumn("_nth", nth).where("_nth = 1").select("_row.*")
