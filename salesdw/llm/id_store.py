"""Token ids in grammar-compressed shards.

A shard holds whole documents in order. Its ids are compressed by replacing frequent neighbouring pairs with new
symbols, many pairs a round; pairs of one round never overlap, because no symbol is a left part of one and a right
part of another. This goes on until no pair of unlike symbols stands ``least`` times in the shard: a rule costs about as
much as it saves below that. A shard's row has ``least``, the rules, the number of ids each rule expands to, the remaining symbols, and
the documents' lengths, so a document is found by summing expansion lengths and only its own symbols are expanded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesdw.llm.common import shared_chunk_ids

END_ID = 1
# Multiply the parts of a pair; the upper bits of the sum are its cell.
CELL_LEFT, CELL_RIGHT, CELL_BITS = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), 18


def cells(lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
    return ((lefts * CELL_LEFT + rights * CELL_RIGHT) >> np.uint32(32 - CELL_BITS)).astype(np.int64)


def joined(lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
    return lefts.astype(np.uint64) << np.uint64(32) | rights
SHARD_SCHEMA = (
    "part int, shard int, first_symbol long, least int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "rules binary, rule_tokens binary, symbols binary"
)


def compress(ids: np.ndarray, first_symbol: int, pairs_a_round: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The remaining symbols, and the rules: rule n makes symbol ``first_symbol + n`` from two earlier ones."""
    symbols, rules = ids.astype(np.uint32), np.zeros((0, 2), np.uint64)
    while len(symbols) > 1:
        # Only pairs whose cell of a hash table is full enough can be frequent; the others need no exact count.
        cell = cells(symbols[:-1], symbols[1:])
        full = np.bincount(cell, minlength=1 << CELL_BITS) >= least
        near = np.flatnonzero(full[cell])
        found, times = np.unique(joined(symbols[near], symbols[near + 1]), return_counts=True)
        often = np.flatnonzero((times >= least) & (found >> np.uint64(32) != found & np.uint64(0xFFFFFFFF)))
        often = often[np.argsort(-times[often], kind="stable")]
        lefts, rights, chosen = set(), set(), []
        for pair in found[often].tolist():
            left, right = pair >> 32, pair & 0xFFFFFFFF
            if left in rights or right in lefts:
                continue
            lefts.add(left)
            rights.add(right)
            chosen.append(pair)
            if len(chosen) == pairs_a_round:
                break
        if not chosen:
            break
        ordered = np.sort(np.array(chosen, np.uint64))
        taken = np.zeros(1 << CELL_BITS, bool)
        taken[cells((ordered >> np.uint64(32)).astype(np.uint32), ordered.astype(np.uint32))] = True
        hits = near[taken[cell[near]]]
        pairs = joined(symbols[hits], symbols[hits + 1])
        place = np.minimum(np.searchsorted(ordered, pairs), len(ordered) - 1)
        same = ordered[place] == pairs
        hits = hits[same]
        symbols[hits] = (first_symbol + len(rules) + place[same]).astype(np.uint32)
        kept = np.ones(len(symbols), bool)
        kept[hits + 1] = False
        symbols = symbols[kept]
        made = np.stack([ordered >> np.uint64(32), ordered & np.uint64(0xFFFFFFFF)], axis=1)
        rules = np.concatenate([rules, made])
    return symbols.astype("<u4"), rules.astype("<u4")


def expansion_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    lengths = np.ones(len(rules), np.uint32)
    for number, pair in enumerate(rules.tolist()):
        lengths[number] = sum(lengths[part - first_symbol] if part >= first_symbol else 1 for part in pair)
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    while True:
        made = symbols >= first_symbol
        if not made.any():
            return symbols
        places = np.cumsum(1 + made) - (1 + made)
        wide = np.repeat(symbols, 1 + made)
        parts = rules[symbols[made] - first_symbol]
        wide[places[made]], wide[places[made] + 1] = parts[:, 0], parts[:, 1]
        symbols = wide


class ShardReader:
    """Random access to the ids of one shard row."""

    def __init__(self, shard: dict):
        self.first = shard["first_symbol"]
        self.rules = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
        self.symbols = np.frombuffer(shard["symbols"], "<u4")
        known = np.frombuffer(shard["rule_tokens"], "<u4").astype(np.int64)
        self.each = np.ones(len(self.symbols), np.int64)
        made = self.symbols >= self.first
        self.each[made] = known[self.symbols[made] - self.first]
        self.ends = np.cumsum(self.each)
        # Every rule's ids once, end to end, for all ranges that meet it.
        numbers = np.arange(self.first, self.first + len(self.rules), dtype=np.uint32)
        self.spelled = expand(numbers, self.rules, self.first)
        self.spelled_at = np.cumsum(known) - known

    def read(self, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """The ids ``start`` to ``start + length`` of each range, expanding only the symbols that cover them.

        The covering symbols of all ranges are laid end to end and copied from their rules' ids together.
        """
        low = np.searchsorted(self.ends, starts, "right")
        high = np.minimum(np.searchsorted(self.ends, starts + lengths, "left") + 1, len(self.symbols))
        count = np.maximum(high - low, 0)
        covering = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        symbols, each = self.symbols[covering], self.each[covering]
        ends = np.cumsum(each)
        ids = np.repeat(symbols, each)
        made = symbols >= self.first
        wide, size = symbols[made] - self.first, each[made]
        own = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(own, size)
        ids[np.repeat((ends - each)[made], size) + inside] = self.spelled[np.repeat(self.spelled_at[wide], size) + inside]
        # Where each range's symbols begin among the laid out ids, and what is skipped of the first one.
        edges = np.concatenate([[0], ends])[np.cumsum(count) - count]
        before = np.concatenate([[0], self.ends])[np.minimum(low, len(self.symbols))]
        begin = edges + np.where(count > 0, starts - before, 0)
        return [ids[a:b] for a, b in zip(begin.tolist(), (begin + np.where(count > 0, lengths, 0)).tolist())]


def encode_shards(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = END_ID,
    partitions: int | None = None,
    shard_tokens: int = 1_000_000,
    pairs_a_round: int = 2048,
    least: int = 16,
) -> DataFrame:
    """Shards of all documents in ascending doc_id order, null ids first, equal ids ordered by text.

    ``part`` and ``shard`` give the order. A null text has the end id alone. Write the result to keep it: the
    partition bounds come from a sample of the keys, so it is not repeatable until written.
    """
    spark = docs.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, *keys).sortWithinPartitions(*keys, "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = shared_chunk_ids(tokenizer), np.uint32(end_id).tobytes()
        first = max(known.library.get_vocab_size(), end_id + 1)
        part, number = TaskContext.get().partitionId(), 0
        names: list = []
        encoded: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(encoded), "<u4")
            symbols, rules = compress(ids, first, pairs_a_round, least)
            row = {
                "part": part,
                "shard": number,
                "first_symbol": first,
                "least": least,
                "n_tokens": len(ids),
                "doc_ids": names,
                "doc_tokens": [len(one) // 4 for one in encoded],
                "rules": rules.tobytes(),
                "rule_tokens": expansion_lengths(rules, first).astype("<u4").tobytes(),
                "symbols": symbols.tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=layout)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), known.of_texts(batch.column(1))):
                names.append(doc_id)
                encoded.append(ids + end)
                size += len(encoded[-1]) // 4
                if size >= shard_tokens:
                    yield flush()
                    names, encoded, size, number = [], [], 0, number + 1
        if names:
            yield flush()

    long_list = pa.list_(pa.int64())
    layout = pa.schema(
        [
            ("part", pa.int32()),
            ("shard", pa.int32()),
            ("first_symbol", pa.int64()),
            ("least", pa.int32()),
            ("n_tokens", pa.int64()),
            ("doc_ids", long_list),
            ("doc_tokens", long_list),
            ("rules", pa.binary()),
            ("rule_tokens", pa.binary()),
            ("symbols", pa.binary()),
        ]
    )
    return ordered.mapInArrow(shards, SHARD_SCHEMA)


def decode_shards(shards: DataFrame) -> DataFrame:
    """One row per document: part, shard, place (from 0), doc_id, shard_start, n_tokens, ids (binary).

    Each document is read by itself through the expansion lengths of its shard.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in (row for at in range(batch.num_rows) for row in batch.slice(at, 1).to_pylist()):
                sizes = np.array(shard["doc_tokens"], np.int64)
                starts, count = np.cumsum(sizes) - sizes, len(sizes)
                ids = [one.astype("<u4").tobytes() for one in ShardReader(shard).read(starts, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, shard["part"], np.int32)),
                        pa.array(np.full(count, shard["shard"], np.int32)),
                        pa.array(np.arange(count, dtype=np.int32)),
                        pa.array(shard["doc_ids"], pa.int64()),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["part", "shard", "place", "doc_id", "shard_start", "n_tokens", "ids"],
                )

    wanted = shards.select("part", "shard", "first_symbol", "doc_ids", "doc_tokens", "rules", "rule_tokens", "symbols")
    return wanted.mapInArrow(
        documents, "part int, shard int, place int, doc_id long, shard_start long, n_tokens long, ids binary"
    )


def shard_starts(shards: DataFrame) -> DataFrame:
    """part, shard, before: ids in all shards before. Summed over parts first, so no window holds all shards."""
    by_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = by_part.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("own"))
    return own.join(parts, "part").select("part", "shard", (F.col("own") + F.col("part_start")).alias("before"))
