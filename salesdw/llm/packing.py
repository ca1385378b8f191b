"""Best-fit packing of documents into sequences of a fixed number of ids.

Pieces are spread evenly over groups. Each group packs its own pieces by best-fit decreasing and compares its
number of sequences with the best of a family of dual-feasible-function bounds. A group that meets its bound is
certified: no packing of its pieces is shorter. A group with a gap gives up every sequence that is not full, a
certified one only its emptiest sequence, whose room is the rounding of the bound. The given-up sequences are dealt
anew, so that pieces of different groups meet, and packed again; a new packing is taken only where it is shorter.
Only row-sized facts move between the rounds, and a task never holds more than about ``per_group`` pieces.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw.llm.common import shared_chunk_ids, slices
from salesdw.staging import Staging

END_ID = 0


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = END_ID, chunks: int = 550_000) -> DataFrame:
    """Ids of each document and its end, cut where they exceed ``capacity``.

    One row per piece: doc_id, piece, start (ids before it), length and ids (little-endian unsigned 32-bit).
    A null or empty text has the end id alone. Rows that repeat a doc_id are documents of their own. A Python worker
    keeps the ids of some ``chunks`` chunks of text, also while it waits for other work.
    """
    width = 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = shared_chunk_ids(tokenizer, chunks), np.uint32(end_id).tobytes()
        for batch in (part for whole in batches for part in slices(whole)):
            names, numbers, parts = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = known.of_text(text) + end
                for number, start in enumerate(range(0, len(ids), width)):
                    names.append(doc_id)
                    numbers.append(number)
                    parts.append(ids[start : start + width])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array(numbers, pa.int32()),
                    pa.array([number * capacity for number in numbers], pa.int64()),
                    pa.array([len(part) // 4 for part in parts], pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select("doc_id", "text").mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids binary")


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each piece its sequence (from 0) and its place there; larger first, into the least room that fits."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # rooms: bit r is set while a sequence with room r is open
    lengths = sizes.tolist()
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = lengths[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, target = capacity, used
            used += 1
        bins[item], offsets[item] = target, capacity - room
        if room > size:
            by_room[room - size].append(target)
            rooms |= 1 << (room - size)
    return bins, offsets


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual feasible functions; no packing has fewer sequences."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    # First family: sizes above capacity - t count whole, those below t not at all, for t up to half.
    below = np.concatenate([[0], np.cumsum(count * size)])
    half = np.arange(capacity // 2 + 1)
    large = len(sizes) - np.cumsum(count)[capacity - half]
    middle = below[capacity - half + 1] - below[half]
    best = int(np.max(large - (-middle // capacity)))
    # Second family: round sizes to multiples of 1/k, exact multiples of 1/(k+1) staying as they are.
    for k in range(1, 33):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int(np.dot(count, value)) // (capacity * k)))
    return best


def pack(
    pieces: DataFrame, staging: Staging, capacity: int, per_group: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """``pieces`` with sequence_id, offset, group_sequences and group_bound; and all certificates (round, group,
    sequences, bound).

    Sequences with room are exchanged and packed again until a round saves none. The group's columns belong to the
    group that packed a sequence last: equal, they certify that no packing of its pieces has fewer sequences.
    Columns of ``pieces`` with one of the four names are replaced.
    ``pieces`` needs a ``length`` between 1 and ``capacity``, which must not be null; other columns are carried
    along, so leave out large ones. Repeated rows are packed each on its own. An empty table stays empty.
    """
    own = ["sequence_id", "offset", "group_sequences", "group_bound"]
    pieces = pieces.drop(*own)
    names = pieces.columns
    kept_fields = [*pieces.schema.fields]
    packed_schema = T.StructType(
        [
            *kept_fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("_open", T.BooleanType()),
            T.StructField("_group", T.LongType()),
            T.StructField("group_sequences", T.LongType()),
            T.StructField("group_bound", T.LongType()),
            T.StructField("_given", T.LongType()),
        ]
    )

    def repack(number: int):
        def one_group(table: pa.Table) -> pa.Table:
            sizes = table.column("length").to_numpy()
            group = table.column("_group")[0].as_py()
            bins, offsets = best_fit_decreasing(sizes, capacity)
            made = int(bins.max()) + 1
            ids = (number << 50) + (group << 18) + bins
            if number:
                old = table.column("sequence_id").to_numpy()
                before, place = np.unique(old, return_inverse=True)
                if len(before) <= made:
                    ids, offsets, bins, made = old, table.column("offset").to_numpy(), place, len(before)
            bound = lower_bound(sizes, capacity)
            room = capacity - np.bincount(bins, weights=sizes, minlength=made).astype(np.int64)
            given = room > 0 if made > bound else (np.arange(made) == room.argmax()) & (room > 0)
            result = table.select(names)
            for name, values in (("sequence_id", ids), ("offset", offsets), ("_open", given[bins])):
                result = result.append_column(name, pa.array(values))
            for name, value in (("_group", group), ("group_sequences", made), ("group_bound", bound), ("_given", int(given.sum()))):
                result = result.append_column(name, pa.array(np.full(len(sizes), value, np.int64)))
            return result

        return one_group

    done, reports = [], []
    current = pieces.withColumn("_place", F.monotonically_increasing_id())
    spread = "_place"
    waiting = None
    for number in itertools.count():
        rows = current.count()
        groups = max(1, math.ceil(rows / per_group))
        dealt = current.withColumn("_group", F.pmod(F.xxhash64(F.col(spread), F.lit(number)), F.lit(groups)))
        wanted = [*names, "_group"] if number == 0 else [*names, "_group", "sequence_id", "offset"]
        packed = dealt.select(*wanted).groupBy("_group").applyInArrow(repack(number), packed_schema)
        state = staging.put(packed, f"packed-{number}")
        facts = ("group_sequences", "sequences"), ("group_bound", "bound"), ("_given", "given")
        report = state.groupBy("_group").agg(*[F.first(fact).alias(name) for fact, name in facts])
        made, given = report.agg(F.sum("sequences"), F.sum("given")).first()
        reports.append(report.select(F.lit(number).alias("round"), F.col("_group").alias("group"), "sequences", "bound"))
        last = rows == 0 or number > 0 and (groups == 1 or made >= waiting)
        finished = state if last else state.where(~F.col("_open"))
        done.append(finished.select(*names, *own))
        if last:
            break
        waiting = given
        current, spread = state.where("_open").select(*names, "sequence_id", "offset"), "sequence_id"
    result, certificates = done[0], reports[0]
    for part in done[1:]:
        result = result.unionByName(part)
    for part in reports[1:]:
        certificates = certificates.unionByName(part)
    return result, certificates
