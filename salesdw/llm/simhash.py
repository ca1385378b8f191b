"""SimHash near-duplicates found by the pigeonring principle.

A fingerprint of 64 bits is a ring of 16 segments. If two fingerprints differ in at most k bits, some segment starts
a chain whose differences, summed over its first l segments, stay within l * k / 16 for every l. So the first
segments of that chain (as long as the budget is below one bit) are equal, and of the next ones (budget below two)
one half is equal: those bits are the keys that bring candidates together. The chain's other budgets are tested
before the full Hamming distance.

Copies share a fingerprint and are one node. A key's fingerprints are not paired with each other: a search from one
of them reaches those within the distance that have not been reached yet, and only its tree of links is returned.
A key with more than ``largest_run`` distinct fingerprints is not held at all: its bits are joined by one part of the
chain's next segments, once for each of k + 1 parts, of which one must be equal too; and so on until every key is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdw.llm.common import slices, utf8
from salesdw.llm.components import components
from salesdw.staging import Staging

SEED = 42
SEGMENTS, SEGMENT_BITS = 16, 4


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # on bytes: A-Z and the six white-space characters only
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_of(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[at:] for at in range(shingle))))
    hashes = np.array([hash_of(one, SEED) for one in shingles], "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", shingle: int = 3) -> DataFrame:
    """``key`` and ``fingerprint`` (long, the bits as they are) of every whole text; no words give zero."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            values = np.array([fingerprint(text, shingle) for text in utf8(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=[key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(rows, f"`{key}` {kind}, fingerprint bigint")


def chain_ends(distance: int) -> list[int]:
    """For budgets of 0, 1, ... bits, the longest chain that still has this budget."""
    return [min(SEGMENTS, -(-(spent + 1) * SEGMENTS // distance) - 1) for spent in range(distance)]


def _rotated(values: np.ndarray, start: int) -> np.ndarray:
    turn = np.uint64(SEGMENT_BITS * start)
    return values if start == 0 else values << turn | values >> (np.uint64(64) - turn)


def chain_keys(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each fingerprint, and for each key the place of its fingerprint."""
    ends = chain_ends(distance)
    exact = SEGMENT_BITS * ends[0]
    near = SEGMENT_BITS * (ends[1] - ends[0]) if distance > 1 else 0
    keys = []
    for start in range(SEGMENTS):
        turned = _rotated(values, start)
        head = turned >> np.uint64(64 - exact)
        for half in range(2 if near else 1):
            low = near // 2 if half == 0 else near - near // 2
            rest = (turned << np.uint64(exact + half * (near // 2))) >> np.uint64(64 - low) if near else np.uint64(0)
            joined = (head << np.uint64(low) | rest) if near else head
            # The last five bits tell start and half, so that keys of different chains do not meet.
            tag = np.uint64(2 * start + half)
            keys.append((joined << np.uint64(5)) | tag)
    return np.concatenate(keys), np.tile(np.arange(len(values)), len(keys))


def close(differing: np.ndarray, start: np.ndarray | int, distance: int) -> np.ndarray:
    """Whether the chain from ``start`` keeps its budgets and the whole difference is small enough."""
    if np.isscalar(start):
        turned = _rotated(differing, int(start))
    else:
        turn = (SEGMENT_BITS * start).astype(np.uint64)
        turned = differing << turn | np.where(turn == 0, np.uint64(0), differing >> (np.uint64(64) - turn) % np.uint64(64))
    fine = np.ones(turned.shape, bool)
    for spent, end in enumerate(chain_ends(distance)):
        if end < SEGMENTS:
            fine &= np.bitwise_count(turned >> np.uint64(64 - SEGMENT_BITS * end)) <= spent
    return fine & (np.bitwise_count(differing) <= distance)


def _tree(values: np.ndarray, start: int, distance: int) -> list[np.ndarray]:
    """Links that connect whatever is connected among ``values`` by close pairs."""
    links, waiting = [], values
    frontier = waiting[:0]
    while len(waiting):
        if not len(frontier):
            frontier, waiting = waiting[:1], waiting[1:]
        reached = []
        for at in range(0, len(frontier), 64):
            if not len(waiting):
                break
            block = frontier[at : at + 64]
            near = close(block[:, None] ^ waiting[None, :], start, distance)
            found = near.any(axis=0)
            links.append(np.stack([block[near[:, found].argmax(axis=0)], waiting[found]]))
            reached.append(waiting[found])
            waiting = waiting[~found]
        frontier = np.concatenate(reached) if reached else waiting[:0]
    return links


def _links(distance: int, small_run: int, largest_run: int):
    """Over (key, fingerprint, mask) rows sorted by key: links a-b. Rows of oversized keys are given back: the
    fingerprint as a, no b, key and mask."""

    def finished(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        found = []
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(edges, len(keys)))
        starts = ((keys & np.uint64(31)) >> np.uint64(1)).astype(np.int64)
        in_small = np.repeat(sizes <= small_run, sizes)
        for step in range(1, small_run):
            left = np.flatnonzero((keys[:-step] == keys[step:]) & in_small[:-step]) if len(keys) > step else []
            if not len(left):
                break
            good = left[close(values[left] ^ values[left + step], starts[left], distance)]
            found.append(np.stack([values[good], values[good + step]]))
        for at, size in zip(edges[sizes > small_run].tolist(), sizes[sizes > small_run].tolist()):
            found += _tree(values[at : at + size], int(starts[at]), distance)
        return np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.uint64)

    def batch_of(links: np.ndarray) -> pa.RecordBatch:
        sides = [pa.array(side.view(np.int64)) for side in np.ascontiguousarray(links)]
        empty = pa.nulls(links.shape[1], pa.int64())
        return pa.RecordBatch.from_arrays([*sides, empty, empty], names=["a", "b", "key", "mask"])

    def lone(key: np.uint64, mask: np.uint64, values: np.ndarray) -> pa.RecordBatch:
        same = [pa.array(np.full(len(values), one).view(np.int64)) for one in (key, mask)]
        columns = [pa.array(values.view(np.int64)), pa.nulls(len(values), pa.int64()), *same]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "key", "mask"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        oversized = mask = None
        for batch in batches:
            if not batch.num_rows:
                continue
            more, own, masks = (column.to_numpy().view(np.uint64) for column in batch.columns)
            if oversized is not None:
                same = more == oversized
                if same.any():
                    yield lone(oversized, mask, own[same])
                more, own, masks = more[~same], own[~same], masks[~same]
                if not len(more):
                    continue
                oversized = None
            keys, values = np.concatenate([keys, more]), np.concatenate([values, own])
            last = int(np.searchsorted(keys.view(np.int64), keys.view(np.int64)[-1]))
            if last:
                yield batch_of(finished(keys[:last], values[:last]))
                keys, values = keys[last:], values[last:]
            if len(keys) > largest_run:
                oversized, mask = keys[-1], masks[-1]
                yield lone(oversized, mask, values)
                keys, values = keys[:0], values[:0]
        if len(keys):
            yield batch_of(finished(keys, values))

    return rows


def key_masks(distance: int) -> np.ndarray:
    """The bits of a fingerprint that a key of ``chain_keys`` holds, by the key's tag."""
    ends = chain_ends(distance)
    exact = SEGMENT_BITS * ends[0]
    near = SEGMENT_BITS * (ends[1] - ends[0]) if distance > 1 else 0
    masks = []
    for start in range(SEGMENTS):
        for half in range(2):
            low = near // 2 if half == 0 else near - near // 2
            turned = ((1 << exact) - 1) << (64 - exact) | ((1 << low) - 1) << (64 - exact - half * (near // 2) - low)
            masks.append((turned >> SEGMENT_BITS * start | turned << (64 - SEGMENT_BITS * start)) % (1 << 64))
    return np.array(masks, np.uint64)


@lru_cache(maxsize=4096)
def finer_masks(mask: int, start: int, distance: int) -> list[int]:
    """``mask`` and one of distance + 1 parts of the other bits, taken along the ring from the chain's start."""
    ring = [(63 - SEGMENT_BITS * start - at) % 64 for at in range(64)]
    free = [bit for bit in ring if not mask >> bit & 1]
    cuts = [len(free) * part // (distance + 1) for part in range(distance + 2)]
    return [mask | sum(1 << bit for bit in free[begin:end]) for begin, end in zip(cuts, cuts[1:])]


def finer_keys(distance: int):
    """Over (key, fingerprint, mask) rows: the same rows under keys of more bits, with the masks of these."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values, masks = (column.to_numpy().view(np.uint64) for column in batch.columns)
            tags = keys & np.uint64(31)
            for mask, tag in set(zip(masks.tolist(), tags.tolist())):
                own = values[(masks == np.uint64(mask)) & (tags == np.uint64(tag))]
                for finer in finer_masks(mask, tag >> 1, distance):
                    # A mixed hash; values that meet by chance are parted by the distance.
                    with np.errstate(over="ignore"):
                        mixed = (own & np.uint64(finer)) ^ np.uint64(finer) * np.uint64(0x9E3779B97F4A7C15)
                        for turn, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                            mixed = (mixed ^ mixed >> np.uint64(turn)) * np.uint64(factor)
                    key = (mixed ^ mixed >> np.uint64(31)) & ~np.uint64(31) | np.uint64(tag)
                    columns = [key, own, np.full(len(own), finer, np.uint64)]
                    yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)) for one in columns], names=["key", "fingerprint", "mask"])

    return rows


def near_components(
    marks: DataFrame, staging: Staging, distance: int = 3, small_run: int = 8, largest_run: int = 100_000
) -> DataFrame:
    """``fingerprint`` and ``root`` for every fingerprint that has another within reach.

    A root is the smallest linked fingerprint (as a signed number); roots themselves have no row.
    """
    spark = marks.sparkSession
    distinct = marks.select("fingerprint").distinct()
    masks = key_masks(distance)
    schema = "key long, fingerprint long, mask long"

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            keys, place = chain_keys(own, distance)
            columns = [keys, own[place], masks[(keys & np.uint64(31)).astype(np.int64)]]
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)) for one in columns], names=["key", "fingerprint", "mask"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Fingerprints that may differ in no more bits than the distance are few and need no further split.
    search = _links(distance, small_run, max(largest_run, 1 << distance))
    rows, links, level = distinct.mapInArrow(keyed, schema), None, 0
    while links is None or not crowded.isEmpty():
        if level:
            rows = crowded.mapInArrow(finer_keys(distance), schema)
        dealt = rows.repartition(parts, "key").sortWithinPartitions("key")
        found = staging.put(dealt.mapInArrow(search, "a long, b long, key long, mask long"), f"near-{level}")
        own = found.where("b is not null").select("a", "b")
        links = links.unionByName(own) if level else own
        crowded = found.where("b is null").select("key", F.col("a").alias("fingerprint"), "mask")
        level += 1
    return components(links, staging).select(F.col("node").alias("fingerprint"), "root")


def near_duplicates(docs: DataFrame, staging: Staging, key: str = "doc_id", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` (long) and ``component``: the smallest key reachable over links.

    Null keys are never the smallest, unless a component has no other. Repeated rows stay.
    """
    marks = staging.put(fingerprints(docs, key, shingle), "fingerprints")
    least = marks.groupBy("fingerprint").agg(F.min(key).alias("least"))
    roots = near_components(marks, staging, distance)
    rooted = least.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_print = rooted.select("fingerprint", "root").join(smallest, "root").select("fingerprint", "component")
    return marks.join(of_print, "fingerprint").select(key, "fingerprint", "component")
